"""Loads, keyed masters and layouts on disk: written to the shared folder, read back and used by the jobs."""

from __future__ import annotations

import uuid

from registry.base import query
from registry.facts import MASTER, NEW_FOLDS, SERIAL, serial_sources, typed
from registry.inbound import CLOSED, DATED, LINE, stock_and_waves
from registry.rates import ITEMS, MONTHS, YEARS, free_stock
from registry.standins import AS_OF, order_weeks
from shelfweek.functions.dates import week_bounds
from shelfweek.plans import inbound, item_master, merged_rates, new_goods, serial_items
from shelfweek.sources import keyed, layout, tables

RECENT_WEEKS = 60
BUCKETS = 16
FOLDED = ("shipments", "receipts", "transfers")


def folder(s, name: str) -> str:
    return f"{tables.shared_folder(s.part.sparkSession)}/shelfweek-stored/{name}-{uuid.uuid4().hex}"


@query(
    "min_dt:s subj:s loc_no:s sold_qty:i sold_val:d list_val:d md_sold_qty:i md_sold_val:d md_list_val:d age_015:i age_030:i age_060:i "
    "age_180:i age_365:i",
    f"SELECT * FROM s_sale WHERE min_dt >= DATE '{week_bounds(AS_OF, RECENT_WEEKS)[0]}' AND min_dt < DATE '{week_bounds(AS_OF, RECENT_WEEKS)[1]}'", **SERIAL,
)
def serial_sales_of_stored_weeks(s):
    """The latest weeks of register lines out of a table with a folder a week of business dates; the other folders are not read."""
    priced = serial_items.priced_inventory(s, *week_bounds(*order_weeks(s)))
    path = folder(s, "lines")
    layout.write_by_day(serial_sources(s).sales_line, path, "business_date", whole_weeks=True)
    s["sales_line"] = s.part.sparkSession.read.parquet(path)
    return serial_items.weekly_serial_sales(s, priced, *week_bounds(AS_OF, RECENT_WEEKS))


@query("min_dt:s section:s loc_no:s " + typed(new_goods.MEASURES), "SELECT * FROM acts", **NEW_FOLDS)
def new_goods_in_buckets(s):
    """All measures of the new goods from headers and lines that lie in buckets of their key and join without a shuffle."""
    names = ("products", "base_inventory", "locations", "sales_line", *[t for pair in FOLDED for t in layout.FACT_PAIRS[pair][:2]])
    src = tables.Sources({name: s[name] for name in names})
    src = layout.bucket_facts(src, folder(s, "buckets"), BUCKETS, FOLDED, f"facts_{uuid.uuid4().hex}")
    return new_goods.new_goods_activity(src, *week_bounds(*order_weeks(s)))


def stored_pair(s, tiers, name: str, key: str, day: str):
    path = folder(s, name)
    layout.write_pairs({f"tier{i}": pair for i, pair in enumerate(tiers)}, path, key, day)
    return layout.read_pairs(s.part.sparkSession, path)


@query(
    "rpt_it:s active:s min_ship_dt:s cr_sold_qty:i at_sold_qty:i cr_custs:i at_custs:i cr_wh_ros:d at_wh_ros:d active_days:d days_diff:d",
    "SELECT * REPLACE (CAST(min_ship_dt AS DATE) AS min_ship_dt) FROM wholesale", **ITEMS,
)
def wholesale_rates_of_stored_tiers(s):
    """Wholesale rates from live and archive tiers that are one table, partitioned by tier and year."""
    pair = stored_pair(s, s.wh_shipment_tiers, "shipments", "internal_shipment_num", "actual_ship_date_time")
    return merged_rates.wholesale_rates(merged_rates.wholesale_lines(pair), s.ledger_items, free_stock(s), AS_OF, MONTHS, YEARS)


@query(LINE, DATED + "s_stock", **CLOSED)
def stock_lines_of_stored_tiers(s):
    """Stocked items with the receipt or order nearest in time, from tiers that are one table each."""
    receipts = stored_pair(s, s.wh_receipt_tiers, "receipts", "internal_receipt_num", "receipt_date")
    orders = stored_pair(s, s.wh_po_tiers, "orders", "purchase_order_id", "created_date_time")
    stock = tables.staged(stock_and_waves(s), "stock")
    return inbound.stock_lines(stock, inbound.receipts([receipts], stock), inbound.purchase_orders([orders], stock))


@query("item_code:s item:s vendor:s rord_grp:s", "SELECT * FROM refreshed_master", **MASTER)
def master_synced(s):
    """The stored master brought up to the refreshed one by rewriting the buckets that differ."""
    path = folder(s, "master")
    keyed.sync_keyed(s.stored_master, path, "item_code")
    s["item_master"] = keyed.read_keyed(s.part.sparkSession, path, s.stored_master)
    keyed.sync_keyed(item_master.refresh_item_master(s), path, "item_code")
    return keyed.read_keyed(s.part.sparkSession, path, s.stored_master)


@query(
    "item_code:s item:s vendor:s rord_grp:s",
    """SELECT * FROM (SELECT item_code, m.item, u.vendor, u.rord_grp FROM stored_master m JOIN item_master u USING (item_code)
        UNION ALL SELECT item_code, item_code, vendor, rord_grp FROM item_master WHERE item_code NOT IN (SELECT item_code FROM stored_master))
        WHERE item_code NOT IN (SELECT item_code FROM products WHERE in_base)""",
)
def master_changed(s):
    """Items inserted, updated and deleted in the buckets that hold them."""
    path = folder(s, "master")
    keyed.sync_keyed(s.stored_master, path, "item_code")
    news, gone = s.item_master, s.base_inventory

    def change(old):
        grown = tables.insert_missing(old, news, ["item_code"])
        return tables.delete_keys(tables.update_changed(grown, news, "item_code", "vendor", ["vendor", "rord_grp"]), gone, ["item_code"])

    keyed.change_keyed(s.stored_master, path, "item_code", news.select("item_code").unionByName(gone), change)
    return keyed.read_keyed(s.part.sparkSession, path, s.stored_master)
