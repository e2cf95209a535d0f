"""A small hand-made shop: enough rows to exercise the traps of the weekly jobs."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from shelfweek.sources.tables import Sources

AS_OF = date(2024, 1, 14)
SUNDAY = datetime(2024, 1, 7)
DURING = datetime(2024, 1, 10, 9, 30)


def item(n: int) -> str:
    return str(n).zfill(20)


def d(x) -> Decimal:
    return Decimal(str(x))


def shop(spark, **changes) -> Sources:
    """The source tables; ``changes`` replaces the rows of single tables."""
    tables = {
        "products": (
            "item_code string, report_item_code string, section_code string, product_type string, vendor_id string, "
            "purchase_from_vendor_id string, user_char15 string, reorderable string, reorderable_item string, isbn string, "
            "upc string, title string, price decimal(19,4), cost decimal(19,4)",
            [
                (item(1), "", " FIC ", "NBAF", "V", "P", "", "N", "N", "978A", "1", "One", d(10), d(4)),
                (item(2), "", "KID", "HBF ", "IDINGRAMDI", "P", "", "N", "N", "978B", "2", "Two", d(20), d(8)),
                (item(3), item(1), "FIC", "NBAF", "V", "P", "", "N", "N", "", "1234567890123456", "Three", d(30), d(12)),
                (item(4), "", "IDLE", "NBAF", "V", "P", "", "N", "N", "978D", "4", "Four", d(5), d(2)),
                (item(5), "", "FIC", "PRMO", "V", "P", "", "N", "N", "978E", "5", "Promo", d(5), d(2)),
                (item(6), "", "FIC", "BOOK", "V", "P", "", "N", "N", "978F", "6", "Used", d(5), d(2)),
                (item(7), "", "FIC", "PRMO", "IDTXBKSTAP", "P", "", "N", "N", "978G", "7", "Tote", d(5), d(2)),
            ]),
        "product_types": ("product_type string, p_type_class string", [("NBAF", "NEW"), ("HBF ", "NEW"), ("PRMO", "NEW"), ("BOOK", "USED")]),
        "vendors": ("vendor_id string, user_char30 string", [("IDAURORA", ""), ("TEXASBKMNA", "TTBReorder")]),
        "base_inventory": ("item_code string", [(item(6),)]),
        "locations": ("location_id string, location_no string", [("1", "00001"), ("2", "00002"), ("3", "00003"), ("900", "00900")]),
        "section_map": ("section string, subj string, cap string, goal_grp string, secn string, ttb_vendor string, default_scheme string",
                        [("FIC", None, "A", "A", "FIC", None, "S1"), ("KID", None, "B", "B", "KID", None, "S2"), (None, "HIS", "A", "A", "FIC", None, None)]),
        "item_master": ("item_code string, item string, vendor string, rord_grp string",
                        [(item(1), item(1), "CDC", "CDC"), (item(2), item(2), "BS-r", "BS")]),
        "shipment_header": ("transfer_id int, from_location_no string, to_location_no string, date_transferred timestamp_ntz",
                            [(1, "00944", "00001", DURING), (2, "00900", "00001", DURING), (3, "00944", "00001", datetime(2024, 1, 14))]),
        "shipment_detail": ("transfer_id int, item_code string, qty int, cost_each decimal(19,4)",
                            [(1, item(1), 5, d(3)), (1, item(1), 2, d(3)), (1, item(5), 9, d(3)), (2, item(1), 7, d(3)), (3, item(1), 7, d(3))]),
        "receiving_header": ("batch_id int, location_no string, shipment_type string", [(1, "00001", "R"), (2, "00001", "X")]),
        "receiving_detail": ("batch_id int, item_code string, qty int, process_date timestamp_ntz", [(1, item(1), 4, DURING), (2, item(1), 9, DURING)]),
        "sales_line": ("location_id string, item_code string, sales_xaction_id int, xaction_type string, is_return string, status string, quantity int, "
                       "unit_price decimal(19,4), register_price decimal(19,4), extended_amt decimal(19,4), business_date date",
                       [("1", item(1), 1, "S", "n", "A", 2, d(10), d(10), d(20), DURING.date()),
                        ("1", item(1), 2, "S", "y", "A", 1, d(10), d(8), d(-8), DURING.date()),
                        ("1", item(1), 3, "S", None, "A", 1, d(10), d(7), d(7), DURING.date()),
                        ("1", item(2), 4, "S", "n", "A", 3, d(20), d(15), d(45), DURING.date()),
                        ("1", item(1), 5, "S", "n", "V", 50, d(10), d(10), d(500), DURING.date())]),
        "transfer_header": ("transfer_bin_no int, location_no string, to_location_no string, transfer_type int, status_code int, update_time timestamp_ntz",
                            [(n, "00001", "00002", n, 3, DURING) for n in range(1, 9)] + [(9, "00900", "00002", 3, 3, DURING)]),
        "transfer_detail": ("transfer_bin_no int, dips_item_code string, sips_item_code string, quantity int, dips_cost decimal(19,4), status_code int",
                            [(n, item(1), "", n, d(2), 1) for n in range(1, 9)] + [(9, item(1), "", 100, d(2), 1), (1, item(1), "", 77, d(2), 2)]),
        "orders_web": ("facility_id int, market_order_id string, sku string, order_status string, item_status string, quantity int, item_price decimal(19,4), "
                       "extended_amount decimal(19,4), shipping_amount decimal(19,4), item_refund_amount decimal(19,4), order_date timestamp_ntz, "
                       "site_last_modified_date timestamp_ntz",
                       [(1, "w1", "D" + item(2), "Shipped", "Shipped", 1, d(18), d(18), d(3), d(18), DURING, DURING),
                        (1, "w2", "D" + item(2), "CANCELED", "x", 1, d(18), d(18), d(3), d(0), DURING, DURING)]),
        "facilities": ("facility_id int, store_no string", [(1, "00001")]),
        "orders_marketplace": ("facility_id int, isis_order_id int, market_order_id string, sku string, order_status string, shipped_quantity int, "
                               "price decimal(19,4), shipping_fee decimal(19,4), refund_amount decimal(19,4), order_date timestamp_ntz, refund_date timestamp_ntz",
                               [(1, 10, "m1", "D" + item(1), "Shipped", 1, d(9), d(2), d(0), DURING, None),
                                (1, 11, "m1", "D" + item(1), "Shipped", 2, d(9), d(2), d(5), DURING, DURING)]),
        "fulfil_header": ("order_id int, isis_order_id int, order_system string", [(1, 10, "MON"), (2, 11, "SAS")]),
        "fulfil_detail": ("order_id int, location_no string, status int, problem_status_id int, price decimal(19,4)",
                          [(1, "00002", 1, None, d(9)), (2, "00003", 1, 0, d(9))]),
        "stores": ("x int", []),
    }
    made = {}
    for name, (schema, data) in tables.items():
        made[name] = spark.createDataFrame(changes.get(name, data), schema)
    return Sources(made)
