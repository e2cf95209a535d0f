"""Rules that only show beyond the size of the test tables: wide numbers, mixed map rows, grid width, staging."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from registry.inbound import WHOLE_NUMBERS
from registry.standins import padded
from shelfweek.operators import joins
from shelfweek.plans import inbound, merged_rates, section_rates
from shelfweek.plans.online_new import sections_of
from shelfweek.sources import layout
from shelfweek.sources.tables import shared_folder


def test_wide_numbers_keep_their_digits(spark):
    df = spark.createDataFrame([(1_499_990,), (1_499_999,), (7,)], "k long")
    assert sorted(r[0] for r in df.select(padded("k", 6)).collect()) == ["000007", "1499990", "1499999"]


def test_neighbouring_orders_stay_apart(spark):
    lines = spark.createDataFrame([("P1499990", "5"), ("P1499999", "5")], "purchase_order_id string, item string")
    register = spark.createDataFrame([("1499999", "5".zfill(20))], "po_number string, item_code string")
    assert [r[0] for r in inbound.verified(lines, register, WHOLE_NUMBERS).collect()] == ["P1499999"]


def test_a_section_takes_one_whole_row_of_the_map(spark, rows):
    schema = "section string, cap string, goal_grp string, secn string, ttb_vendor string, default_scheme string"
    section_map = spark.createDataFrame([("S", "A", "g", "z", "v", "d"), ("S", "B", "g", "a", "v", "d")], schema)
    assert rows(sections_of(section_map), "section", "cap", "secn") == [("S", "A", "z")]


def test_the_grid_uses_the_whole_cluster(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "100")
        grid = joins.all_pairs(spark.range(300).toDF("a"), spark.range(400).toDF("b"))
        slices = grid.hint("merge").select(F.col("a"), F.col("b"))
        assert slices.count() == 120_000
        dealt = spark.range(400).toDF("b").select(joins._salt(spark.range(400).toDF("b"), 200).alias("s"))
        assert dealt.distinct().count() > 16
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_look_up_reads_only_what_is_used(spark, capsys):
    df = spark.createDataFrame([("a", 1, "x")], "k string, n int, unused string")
    joins.look_up(df, spark.createDataFrame([("a", 9)], "k string, m int"), ["k"]).select("n", "m").explain("simple")
    assert "xxhash64" not in capsys.readouterr().out


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, name, default=None):
            return {"spark.master": "spark://host:7077"}.get(name, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_ledger_cells_hold_stores_of_current_movements_only(spark, rows):
    moves = [("a", "a", f"{k:05d}", "Sale", -1, datetime(1999, 1, 1 + k)) for k in range(20)]
    moves += [("a", "a", "00003", "CDC", 5, datetime(2001, 11, 1)), ("a", "a", None, "Sale", -2, datetime(2001, 11, 2)), ("a", "a", "00004", "Sale", -3, None)]
    ledger = spark.createDataFrame(moves, "item_code string, item string, loc string, xacn string, qty int, date timestamp_ntz")
    cells = merged_rates.ledger_cells(ledger, date(2001, 11, 11))
    assert rows(cells, "cr_loc", "cr_ship_qty", "at_ship_qty", "cr_sold_qty", "at_sold_qty") == [("00003", 5, 5, 0, 0), (None, 0, 0, 2, 25)]


def test_tiers_over_one_detail_table_join_it_once(spark, rows):
    details = spark.createDataFrame([(k % 6, f"i{k}", "TTB WHOLESALE", "TTB", "X", k, "s1") for k in range(30)],
                                    "internal_shipment_num int, item string, order_type string, company string, customer string, total_qty int, item_category1 string")
    heads = [spark.createDataFrame([(k, "C", datetime(2001 - tier, 3, 1 + k)) for k in (tier, tier + 2, 5)],
                                   "internal_shipment_num int, customer string, actual_ship_date_time timestamp_ntz") for tier in range(3)]
    copies = [(h, details.select("*")) for h in heads]
    for job, names in ((lambda tiers: merged_rates.wholesale_lines(*tiers), ("item", "shipped", "total_qty")),
                       (lambda tiers: section_rates.shipped_tiers(tiers, ["TTB WHOLESALE"]), ("min_dt", "item", "qty"))):
        shared = job([(h, details) for h in heads])
        assert rows(shared, *names) == rows(job(copies), *names)
        assert shared._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


@pytest.mark.parametrize("few", [0, 2, 64])
def test_nearest_keeps_the_ends_of_a_gap_whatever_the_number_of_times(spark, rows, monkeypatch, few):
    monkeypatch.setattr(joins, "FEW_TIMES", few)
    day = lambda d, h=0: datetime(2001, 1, d, h)
    left = spark.createDataFrame([("a", day(5)), ("a", day(9)), ("a", day(20)), ("b", day(3)), (None, day(3)), ("c", day(1)), ("a", None)], "k string, t timestamp_ntz")
    found = [("a", day(d, 7), d) for d in range(10, 19)] + [("a", day(5), 5), ("a", day(5), 4), ("a", day(1), 1), ("b", day(4), 40), ("b", day(2), 20), (None, day(9), 9), ("b", None, 0)]
    right = spark.createDataFrame(found, "k string, s timestamp_ntz, n int")
    nearest = joins.nearest_in_time(left, right, "k", "t", "s", ["n"], ["n"])
    expected = {("a", day(5)): 4, ("a", day(9)): 10, ("a", day(20)): 18, ("b", day(3)): 20, (None, day(3)): 9, ("c", day(1)): None, ("a", None): None}
    assert {(r["k"], r["t"]): r["n"] for r in nearest.collect()} == expected


def test_tiers_are_stored_without_a_shuffle_to_their_folders(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda *args: pytest.fail("rows are shuffled to their folders"))
    heads = spark.createDataFrame([(1, date(2000, 1, 1)), (1, date(2001, 1, 1)), (2, None)], "k int, day date")
    details = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, item string")
    layout.write_pairs({"live": (heads, details)}, str(tmp_path), "k", "day")
    assert rows(layout.read_pairs(spark, str(tmp_path))[1], "item", "tier_year") == [("x", 2000), ("x", 2001), ("y", 0), ("z", 0)]
