import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfweek.functions.dates import with_year_week
from shelfweek.operators import joins, sets, windows


def keyed(spark, values, name="k"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_not_in_rules(spark, rows):
    df = keyed(spark, ["a", "b", None])
    assert rows(joins.not_in(df, "k", keyed(spark, ["a"]))) == [("b",)]
    assert rows(joins.not_in(df, "k", keyed(spark, ["a", None]))) == []
    assert rows(joins.not_in(df, "k", keyed(spark, []))) == [("a",), ("b",), (None,)]


def test_anti_and_semi_joins_with_null_keys(spark, rows):
    df, listed = keyed(spark, ["a", None]), keyed(spark, ["a", "a", None])
    assert rows(joins.absent(df, listed, ["k"])) == [(None,)]
    assert rows(joins.absent(df, listed, ["k"], null_safe=True)) == []
    assert rows(joins.present(df, listed, ["k"])) == [("a",)]


def test_look_up_keeps_every_row_of_a_hot_key(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 700, 1).otherwise(F.col("id")).alias("k"), F.lit(1).alias("n"))
    stats = df.groupBy("k").agg(F.count("*").alias("copies"))
    found = joins.look_up(df, stats, ["k"])
    assert found.count() == 1000
    assert found.where("k = 1 and copies = 700").count() == 700


def test_group_stats_equal_a_window(spark, rows):
    data = [(random.choice(["x", "y", None]), random.choice([1, 2, None]), n) for n in range(200)]
    df = spark.createDataFrame(data, "a string, b int, v int")
    got = joins.with_group_stats(df, ["a", "b"], n=F.count("*"), top=F.max("v"))
    over = Window.partitionBy("a", "b")
    assert rows(got) == rows(df.withColumns({"n": F.count("*").over(over), "top": F.max("v").over(over)}))


def test_all_pairs_is_complete(spark):
    pairs = joins.all_pairs(spark.range(7).toDF("a"), spark.range(50).toDF("b"), spread=4)
    assert pairs.count() == 350 and pairs.distinct().count() == 350


def test_reconcile_keeps_one_sided_and_null_keys(spark, rows):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, l int")
    right = spark.createDataFrame([("b", 5), ("c", 6), (None, 7)], "k string, r int")
    assert rows(joins.reconcile(left, right, ["k"])) == [("a", 1, None), ("b", 2, 5), ("c", None, 6), (None, 3, 7)]


def test_resolve_alias_follows_one_hop(spark, rows):
    items = spark.createDataFrame([("1", "1"), ("2", "1"), ("3", "2"), ("4", "gone")], "item_code string, points_to string")
    assert rows(joins.resolve_alias(items)) == [("1", "1"), ("2", "1"), ("3", "1")]


def test_prior_year_does_not_multiply_on_shared_labels(spark):
    days = [datetime(2022, 12, 25), datetime(2023, 1, 1), datetime(2024, 1, 7), datetime(2023, 12, 31)]
    df = spark.createDataFrame([("s", d.date(), n) for n, d in enumerate(days)], "secn string, min_dt date, qty int")
    got = joins.prior_year(with_year_week(df), ["secn"], {"qty": "ly"}).orderBy("min_dt").collect()
    assert len(got) == 4
    assert [r.ly for r in got] == [None, None, 0, None]


def brute_force(left, right):
    answer = {}
    for item, at in left:
        best = None
        for key, when, rid in right:
            if key == item and when is not None and at is not None:
                floor = lambda d: d.replace(minute=0, second=0)
                gap = abs((floor(when) - floor(at)).total_seconds()) // 3600
                best = min(best, (gap, rid)) if best else (gap, rid)
        answer[(item, at)] = best
    return answer


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_nearest_in_time_against_brute_force(spark, seed):
    rng = random.Random(seed)
    base = datetime(2024, 1, 1)
    stamp = lambda: base + timedelta(minutes=rng.randrange(0, 20000))
    left = list({(rng.choice("abc"), stamp()) for _ in range(40)}) + [("z", stamp()), ("a", None)]
    right = [(rng.choice("abc"), rng.choice([stamp(), stamp(), None]), f"r{n:03d}") for n in range(60)]
    got = joins.nearest_in_time(
        spark.createDataFrame(left, "item string, at timestamp_ntz"),
        spark.createDataFrame(right, "item string, closed timestamp_ntz, rid string"),
        "item", "at", "closed", ["rid"], ["rid"]).collect()
    assert len(got) == len(left)
    expected = brute_force(left, right)
    for r in got:
        best = expected[(r.item, r.at)]
        assert (r.hours_apart, r.rid) == (best if best else (None, None))


def test_nearest_tie_goes_to_the_smaller_id(spark):
    left = spark.createDataFrame([("a", datetime(2024, 1, 2, 12))], "item string, at timestamp_ntz")
    right = spark.createDataFrame(
        [("a", datetime(2024, 1, 2, 14), "r1"), ("a", datetime(2024, 1, 2, 10), "r2"), ("a", datetime(2024, 1, 2, 10, 30), "r0")],
        "item string, closed timestamp_ntz, rid string")
    assert joins.nearest_in_time(left, right, "item", "at", "closed", ["rid"], ["rid"]).first().rid == "r0"


def test_short_series_rates(spark):
    data = [("s", datetime(2024, 1, 7 * n).date(), 4 * n) for n in (1, 2, 3)]
    df = spark.createDataFrame(data, "secn string, min_dt date, q int")
    over = windows.series(["secn"])
    got = df.withColumns({"t": windows.trailing_rate("q", over), "f": windows.leading_rate("q", over)}).orderBy("min_dt").collect()
    assert [(float(r.t), None if r.f is None else float(r.f)) for r in got] == [(1.0, 5.0), (3.0, 3.0), (6.0, None)]
    moves = df.withColumns({**windows.deltas("q", over), **windows.looks_ahead("q", over, 1, 2)}).orderBy("min_dt").collect()
    assert [(r.d1_q, r.d2_q, r.f1_q, r.f2_q) for r in moves] == [(None, None, 8, 12), (4, None, 12, None), (4, 4, None, None)]


def test_keep_first_and_latest(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z")], "k string, n int, v string")
    assert rows(windows.keep_first(df, ["k"], ["n"])) == [("a", 1, "y"), ("b", 1, "z")]
    assert rows(windows.latest_value(df, ["k"], "v", "n")) == [("a", "x"), ("b", "z")]


def test_diff_both_ways(spark, rows):
    new = spark.createDataFrame([(datetime(2024, 1, 7).date(), 1), (datetime(2024, 1, 7).date(), 2)], "min_dt date, q int")
    old = spark.createDataFrame([(datetime(2024, 1, 7).date(), 2), (datetime(2024, 1, 7).date(), 3), (datetime(2023, 1, 1).date(), 9)],
                                "min_dt date, q int")
    assert rows(sets.diff_both_ways(new, old), "q", "side") == [(1, "new"), (3, "old")]
