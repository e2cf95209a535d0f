from datetime import date, datetime

from pyspark.sql import functions as F

from shelfweek import fixed_values as fv
from shelfweek.plans import inbound, merged_rates
from shelfweek.sources.tables import Sources

LINE = "item string, scheme_id string, qty bigint, status string, last_date timestamp_ntz, notes1 string, notes2 string, notes3 string"


def line(item, status, notes1="n"):
    return (item, None, 1, status, datetime(2024, 1, 1), notes1, None, None)


def test_adjusted_items_keep_only_their_stock_lines(spark, rows):
    df = spark.createDataFrame([line("a", fv.STATUS_STOCK, fv.NO_RECEIPT), line("a", fv.STATUS_PO_ONLY), line("b", fv.STATUS_PO_ONLY)], LINE)
    assert rows(inbound.prefer_adjusted(df), "item", "status") == [("a", fv.STATUS_STOCK), ("b", fv.STATUS_PO_ONLY)]


def verdicts(spark, data):
    df = spark.createDataFrame([(i, s, t, c) for i, s, t, c in data], "item string, status string, title string, company_mark string")
    counted = inbound.with_line_counts(df)
    verdict = inbound.dup_verdict(F.col("status"), F.col("title_lines"), F.col("company_lines"), F.col("best_status"))
    return {r.item: r.v for r in counted.select("item", verdict.alias("v")).collect()}


def test_duplicate_verdicts(spark):
    got = verdicts(spark, [
        ("1", fv.STATUS_PO_ONLY, "t", ""), ("2", fv.STATUS_STOCK, "t", "TTB"),             # two companies: order line is a duplicate
        ("3", fv.STATUS_PO_PARTIAL, "u", ""), ("4", fv.STATUS_STOCK, "u", "TTB"),          # partial order is the earliest stage
        ("5", fv.STATUS_PO_ONLY, "v", ""), ("6", fv.STATUS_STOCK, "v", ""),                # same company twice is fine
        ("7", fv.STATUS_PO_ONLY, None, None),
    ])
    assert got == {"1": "dup", "2": "ok", "3": "maybe", "4": "ok", "5": "ok", "6": "ok", "7": "ok"}


def test_untitled_lines_are_counted_together(spark):
    df = spark.createDataFrame([(str(n), fv.STATUS_STOCK, None, None) for n in range(50)], "item string, status string, title string, company_mark string")
    assert {(r.title_lines, r.company_lines) for r in inbound.with_line_counts(df).collect()} == {(50, 50)}


def test_suggestions_take_the_larger_set_and_the_out_of_stock_set_on_a_tie(spark, rows):
    data = [(51, "a", "1", 5), (36, "a", "1", 3), (51, "b", "1", 4), (36, "b", "2", 4), (36, "b", "3", 0), (99, "c", "1", 9)]
    df = spark.createDataFrame(data, "set_id int, rpt_it string, loc string, order_qty int")
    assert rows(inbound.suggested_orders(df, 51, 36)) == [("a", 5, 1), ("b", 4, 1)]
    assert inbound.latest_set(df) == 99


def test_stock_without_match_has_no_receipt(spark, rows):
    stock = spark.createDataFrame([("a", 9, datetime(2024, 1, 1), 2, 0), ("b", 1, datetime(2024, 1, 1), 5, 0), ("c", 1, None, 0, 0)],
                                  "item string, inv_qty bigint, first_date timestamp_ntz, wave_qty bigint, prog_qty bigint")
    rcts = spark.createDataFrame([("a", "r1", "x", "t", datetime(2024, 1, 2), "s")],
                                 "item string, receipt_id string, ship_from string, receipt_type string, close_date timestamp_ntz, item_category3 string")
    pos = spark.createDataFrame([("b", "p1", "y", "t", datetime(2024, 1, 2), "q")],
                                "item string, purchase_order_id string, ship_from string, receipt_type string, created_date_time timestamp_ntz, item_category3 string")
    got = rows(inbound.stock_lines(stock, rcts, pos), "item", "scheme_id", "qty", "status", "notes1", "notes2")
    assert got == [("a", "s", 7, fv.STATUS_WAVED, "r1", "x"), ("b", "q", 0, fv.STATUS_WAVED, fv.NO_RECEIPT, "y"),
                   ("c", None, 1, fv.STATUS_STOCK, fv.NO_RECEIPT, None)]


def test_rates_of_a_single_shipment_use_four_weeks(spark):
    lines = spark.createDataFrame([("1", "c1", datetime(2024, 1, 1), 28)], "item string, buyer string, shipped timestamp_ntz, total_qty int")
    items = spark.createDataFrame([], "item_code string, rpt_it string")
    stock = spark.createDataFrame([("1",)], "item string")
    r = merged_rates.wholesale_rates(lines, items, stock, datetime(2024, 1, 11).date()).first()
    assert (r.rpt_it, r.active, float(r.at_wh_ros), float(r.active_days), float(r.days_diff)) == ("1".zfill(20), "active", 1.0, 28.0, 10.0)
    old = merged_rates.wholesale_rates(lines, items, stock, datetime(2044, 1, 11).date())
    assert old.count() == 0


def test_stages_are_made_once_for_the_preference(spark, rows, monkeypatch, capsys):
    """the lines of all stages are stored before those of adjusted items are preferred, which reads them twice."""
    made = {"stock_lines": [("a", "3 - Scale Inv", "no rct"), ("b", "3 - Scale Inv", "R1")], "open_po_lines": [("a", "1a - PO without Rcts", "P1"), ("c", "1a - PO without Rcts", "P2")],
            "unreceived_po_lines": [("b", "1b - PO with Rcts", "P3")], "open_receipt_lines": [(None, "2 - Open Rct", "R2")]}
    for name, data in made.items():
        frame = spark.createDataFrame([line(*found) for found in data], LINE)
        monkeypatch.setattr(inbound, name, lambda *args, frame=frame: frame)
    for name in ("available_stock", "stock_with_waves", "receipts", "purchase_orders"):
        monkeypatch.setattr(inbound, name, lambda *args, **named: spark.range(1))
    src = Sources(wh_inventory=None, wh_location=None, wh_shipment_detail=None, purchase_order_register=None,
                  wh_receipt_tiers=[(None, None)] * 2, wh_po_tiers=[(None, None)])
    lines = inbound.stage_lines(src, date(2001, 8, 2))
    lines.explain("simple")
    assert "Union" not in capsys.readouterr().out
    assert rows(lines, "item", "notes1") == [("a", "no rct"), ("b", "P3"), ("b", "R1"), ("c", "P2"), (None, "R2")]
