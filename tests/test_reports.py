"""Labels and caps of the reports, inbound lines of stocked items only, report files of jobs."""

from datetime import date, datetime

from pyspark.sql import functions as F

from shelfweek.operators import joins
from shelfweek.plans import chain_report, inbound, report_files, report_jobs, section_rates

TIME = "yr int, wk int, min_dt date"
WEEK = (2024, 2, date(2024, 1, 7))


def store_rows(spark, *rows):
    schema = f"used_new string, src string, {TIME}, cap string, secn string, stores long, sold_qty long, ship_qty long"
    frame = spark.createDataFrame([("New", "DIPS", *WEEK, cap, secn, n, sold, 1) for cap, secn, n, sold in rows], schema)
    return frame.withColumns({m: F.lit(0).cast(k) for m, k in chain_report.STORE_MEASURES.items() if m not in frame.columns})


def online_rows(spark, *rows):
    schema = f"used_new string, src string, {TIME}, cap string, secn string, stores long, onl_sold_qty long"
    frame = spark.createDataFrame([("New", "DIPS", *WEEK, cap, secn, n, sold) for cap, secn, n, sold in rows], schema)
    return frame.withColumns({m: F.lit(0).cast(k) for m, k in chain_report.ONLINE_MEASURES.items() if m not in frame.columns})


def merged(spark, store, online):
    out = chain_report.merge_online(store_rows(spark, *store), online_rows(spark, *online), ["cap", "secn"])
    return sorted((r.cap, r.secn, r.stores, r.sold_qty, r.onl_sold_qty) for r in out.collect())


def test_online_rows_meet_store_rows_whatever_their_cap(spark):
    assert merged(spark, [("A", "FIC", 3, 10)], [("B", "FIC", 9, 4)]) == [("A", "FIC", 3, 14, 4)]
    assert merged(spark, [("A", "FIC", 3, 10)], [("B", "FIC", 9, 4), ("A", "FIC", 2, 1), (None, "FIC", 1, 5)]) == [("A", "FIC", 3, 20, 10)]


def test_online_amounts_count_once_where_a_section_has_two_caps(spark):
    assert merged(spark, [("A", "FIC", 3, 10), ("B", "FIC", 2, 20)], [("B", "FIC", 9, 4)]) == [("A", "FIC", 3, 10, 0), ("B", "FIC", 2, 24, 4)]
    assert merged(spark, [("A", "FIC", 3, 10), ("B", "FIC", 2, 20)], [("C", "FIC", 9, 4)]) == [("A", "FIC", 3, 14, 4), ("B", "FIC", 2, 20, 0)]


def test_labels_without_a_section_meet_too(spark):
    assert merged(spark, [("A", None, 3, 10)], [("B", None, 9, 4), ("B", "KID", 1, 7)]) == [("A", None, 3, 14, 4), ("B", "KID", 1, 7, 7)]


def test_labels_that_stand_at_a_subject_only_have_rows_of_zeros(spark):
    section_map = spark.createDataFrame(
        [("S1", None, "A", "g", "FIC", "", ""), (None, "HIS", "A", "g", "FIC", "", ""), (None, "MAP", "B", "g", "MAPS", "", ""), (None, "OLD", "B", "g", "MAPS", "", "")],
        "section string, subj string, cap string, goal_grp string, secn string, ttb_vendor string, default_scheme string")
    weeks = spark.createDataFrame([(2024, 1, date(2023, 12, 31)), WEEK], TIME)
    spine = section_rates.section_weeks(section_map, weeks)
    assert sorted((r.section or "", r.cap, r.secn, r.wk) for r in spine.collect()) == [("", "B", "MAPS", 1), ("", "B", "MAPS", 2), ("S1", "A", "FIC", 1), ("S1", "A", "FIC", 2)]
    sold = spark.createDataFrame([("S1", WEEK[2], 5, 7)], "section string, min_dt date, ship_qty long, st_sold_qty long")
    none = spark.createDataFrame([], "section string, min_dt date, onl_sold_qty long")
    whole = spark.createDataFrame([], "section string, min_dt date, wh_sold_its long, wh_sold_qty long")
    rows = section_rates.combine_channels(spine, sold, none, whole).collect()
    assert sorted((r.secn, r.wk, r.sold_qty) for r in rows) == [("FIC", 1, 0), ("FIC", 2, 7), ("MAPS", 1, 0), ("MAPS", 2, 0)]


def receipt_tier(spark, items):
    heads = spark.createDataFrame([(1, "R1", "F", "t", datetime(2024, 1, 3), datetime(2024, 1, 2))],
                                  "internal_receipt_num int, receipt_id string, ship_from string, receipt_type string, close_date timestamp_ntz, receipt_date timestamp_ntz")
    details = spark.createDataFrame([(1, item, "S", n) for n, item in enumerate(items)], "internal_receipt_num int, item string, item_category3 string, total_qty int")
    return heads, details


def test_receipts_of_items_that_are_not_stocked_are_left_out_before_they_are_grouped(spark, rows):
    tiers = [receipt_tier(spark, "abca"), receipt_tier(spark, "cd")]
    stock = spark.createDataFrame([("a",), ("d",)], "item string")
    some = inbound.receipts(tiers, stock)
    assert rows(some) == rows(inbound.receipts(tiers).where("item in ('a', 'd')"))
    plan = some._jdf.queryExecution().optimizedPlan().toString()
    for part in plan.split("Aggregate")[1:]:
        assert "LeftSemi" in part


def test_not_in_looks_its_list_up_once(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    listed = spark.createDataFrame([(2,), (3,)], "v int")
    assert rows(joins.not_in(df, "k", listed)) == [(1,)]
    assert rows(joins.not_in(df, "k", listed.limit(0))) == [(1,), (2,), (None,)]
    assert rows(joins.not_in(df, "k", listed.union(spark.createDataFrame([(None,)], "v int")))) == []
    out = joins.not_in(df, "k", listed)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Subquery subquery#") - plan.count("ReusedSubquery") <= 1 or "ReusedSubquery" in plan


def test_jobs_write_their_reports_in_order(spark, tmp_path):
    rates = ["ly_sros", "sros", "ly_oros", "oros", "ly_wros", "wros"] + [f"exp_{m}{n}mo" for m in "sow" for n in (1, 2, 3)]
    data = [(2024, 2, WEEK[2], cap, secn, *[1.0] * len(rates)) for cap, secn in (("B", "x"), ("A", "z"), ("A", "y"))]
    expected = spark.createDataFrame(data, f"{TIME}, cap string, secn string, " + ", ".join(f"{r} double" for r in rates))
    schemas = report_jobs.write_section_rates(expected, str(tmp_path))
    lines = report_files.read_report(spark, str(tmp_path / "section_rates"), schemas["section_rates"]).collect()
    assert [(r.cap, r.secn) for r in sorted(lines, key=lambda r: r.line_no)] == [("A", "y"), ("A", "z"), ("B", "x")]
