"""Loads that hold, keyed masters, layouts on disk, steps side by side."""

from datetime import date, datetime, timedelta
from pathlib import Path
from threading import Barrier

import pytest
from pyspark.sql import functions as F
from shop import AS_OF, shop

from shelfweek.functions.dates import week_bounds
from shelfweek.operators import joins
from shelfweek.plans import merged_rates, new_goods, refresh, serial_items, weekly
from shelfweek.sources import keyed, layout, tables

WEEKS = [date(2024, 1, 7) + timedelta(days=7 * k) for k in range(4)]
KEYS = ["min_dt", "secn"]


def facts(spark, *data):
    return spark.createDataFrame(list(data), "min_dt date, secn string, qty int")


def files(path):
    return sorted(str(p.relative_to(path)) for p in Path(path).rglob("*.parquet"))


def stored(spark, path):
    return sorted((r.min_dt, r.secn, r.qty) for r in spark.read.parquet(str(path)).collect())


def executed(df):
    """The final plan of a frame that has been run, as text."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


# --- loads ----------------------------------------------------------------------------------------

def test_a_load_counts_what_it_writes_and_touches_its_weeks_only(spark, tmp_path):
    path = tmp_path / "facts"
    first = tables.append_new(facts(spark, *[(w, s, 1) for w in WEEKS[:2] for s in "ab"], (None, "x", 7)), str(path), KEYS)
    assert first == tables.LoadCounts(5, 1, 3)
    before = files(path)
    second = tables.append_new(facts(spark, (WEEKS[1], "a", 9), (WEEKS[1], "c", 2), (WEEKS[2], "a", 3), (None, "x", 8)), str(path), KEYS)
    assert second == tables.LoadCounts(2, 0, 2)
    kept = [f for f in files(path) if f in before]
    assert {f.split("/")[0] for f in kept} == {"min_dt=2024-01-07", "min_dt=__HIVE_DEFAULT_PARTITION__"}
    rows = {(r.min_dt, r.secn): r.qty for r in spark.read.parquet(str(path)).collect()}
    assert rows == {(WEEKS[0], "a"): 1, (WEEKS[0], "b"): 1, (WEEKS[1], "a"): 1, (WEEKS[1], "b"): 1, (WEEKS[1], "c"): 2, (WEEKS[2], "a"): 3, (None, "x"): 7}
    assert [p.name for p in tmp_path.iterdir()] == ["facts"]


def test_rows_of_a_week_outside_the_window_stay(spark, tmp_path):
    path = str(tmp_path / "facts")
    tables.append_new(facts(spark, (WEEKS[0], "a", 1), (WEEKS[1], "a", 1)), path, KEYS)
    tables.append_new(facts(spark, (WEEKS[1], "b", 2), (WEEKS[0], "z", 5)), path, KEYS, (WEEKS[1], WEEKS[2]))
    assert stored(spark, path) == [(WEEKS[0], "a", 1), (WEEKS[0], "z", 5), (WEEKS[1], "a", 1), (WEEKS[1], "b", 2)]


def test_a_load_that_fails_while_its_rows_are_made_changes_nothing(spark, tmp_path):
    path = tmp_path / "facts"
    tables.append_new(facts(spark, (WEEKS[0], "a", 1)), str(path), KEYS)
    before = files(path)
    good = facts(spark, *[(w, s, 2) for w in WEEKS for s in "ab"])
    broken = good.withColumn("qty", F.when((F.col("min_dt") == WEEKS[2]) & (F.col("secn") == "b"), F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("qty")))
    with pytest.raises(Exception, match="lost"):
        tables.append_new(broken, str(path), KEYS)
    assert files(path) == before
    tables.append_new(good, str(path), KEYS)
    assert stored(spark, path) == sorted([(WEEKS[0], "a", 1), (WEEKS[0], "b", 2), *[(w, s, 2) for w in WEEKS[1:] for s in "ab"]])


@pytest.mark.parametrize("moment", ["before", "middle", "after"])
def test_a_load_cut_off_in_the_middle_is_finished_by_the_next(spark, tmp_path, monkeypatch, moment):
    path = str(tmp_path / "facts")
    old = facts(spark, *[(w, "a", 1) for w in WEEKS])
    new = facts(spark, *[(w, "b", 2) for w in WEEKS[1:]])
    tables.append_new(old, path, KEYS)
    overwrite = tables._overwrite_parts

    def cut_off(rows, target, by):
        if moment == "middle":  # the first week is gone, the second is new, the third is old
            tables._delete(spark, f"{target}/min_dt={WEEKS[1]}")
            overwrite(rows.where(F.col(by) == WEEKS[2]), target, by)
        if moment == "after":
            overwrite(rows, target, by)
        raise OSError("driver lost")

    monkeypatch.setattr(tables, "_overwrite_parts", cut_off)
    with pytest.raises(OSError, match="driver lost"):
        tables.append_new(new, path, KEYS)
    monkeypatch.undo()
    again = tables.append_new(new, path, KEYS)
    assert again.rows == 0
    assert stored(spark, path) == sorted([(w, "a", 1) for w in WEEKS] + [(w, "b", 2) for w in WEEKS[1:]])
    assert [p.name for p in tmp_path.iterdir()] == ["facts"]


# --- masters --------------------------------------------------------------------------------------

MASTER = "code string, grp string"


def master(spark, rows):
    return spark.createDataFrame([(f"{k:04d}", g) for k, g in rows], MASTER)


def test_a_change_rewrites_its_buckets_only(spark, rows, tmp_path):
    path = tmp_path / "master"
    first = master(spark, [(k, "g" if k % 3 else None) for k in range(500)])
    assert keyed.sync_keyed(first, str(path), "code", 16).parts == 16
    before = files(path)
    assert keyed.sync_keyed(first.repartition(3), str(path), "code", 16) == tables.LoadCounts(0, 0, 0)
    assert files(path) == before
    changed = first.where("code <> '0007'").withColumn("grp", F.when(F.col("code") == "0009", "h").otherwise(F.col("grp"))).union(master(spark, [(900, "new")]))
    counts = keyed.sync_keyed(changed, str(path), "code", 16)
    touched = {r[0] for r in master(spark, [(7, ""), (9, ""), (900, "")]).select(keyed.bucket_of("code", 16)).collect()}
    assert counts == tables.LoadCounts(2, 0, len(touched))
    assert {f for f in before if int(f.split("=")[1].split("/")[0]) not in touched} <= set(files(path))
    assert not {f for f in before if int(f.split("=")[1].split("/")[0]) in touched} & set(files(path))
    assert rows(keyed.read_keyed(spark, str(path), first)) == rows(changed)


def test_a_bucket_that_loses_its_last_row_goes(spark, rows, tmp_path):
    path = tmp_path / "master"
    keyed.sync_keyed(master(spark, [(1, "a"), (2, "b"), (3, "c")]), str(path), "code", 64)
    keyed.sync_keyed(master(spark, [(2, "b")]), str(path), "code", 64)
    assert len(files(path)) == 1
    like = master(spark, [])
    assert rows(keyed.read_keyed(spark, str(path), like)) == [("0002", "b")]
    keyed.sync_keyed(like, str(path), "code", 64)
    assert keyed.read_keyed(spark, str(path), like).count() == 0


def test_changes_of_listed_keys_read_their_buckets_only(spark, rows, tmp_path):
    path = tmp_path / "master"
    first = master(spark, [(k, "g") for k in range(400)])
    keyed.sync_keyed(first, str(path), "code", 32)
    before, seen = files(path), []
    news = master(spark, [(5, "h"), (1000, "n")])
    gone = master(spark, [(6, "")])

    def change(old):
        seen.append(old.count())
        grown = tables.insert_missing(old, news, ["code"])
        return tables.delete_keys(tables.update_changed(grown, news, "code", "grp", ["grp"]), gone, ["code"])

    counts = keyed.change_keyed(first, str(path), "code", news.union(gone), change, 32)
    assert counts.rows == 2 and counts.parts <= 3 and seen[0] < 100
    assert len(set(before) & set(files(path))) >= 29
    wanted = {f"{k:04d}": "g" for k in range(400) if k != 6} | {"0005": "h", "1000": "n"}
    assert dict(map(tuple, keyed.read_keyed(spark, str(path), first).collect())) == wanted
    with pytest.raises(Exception, match="outside the listed keys"):
        keyed.change_keyed(first, str(path), "code", gone, lambda old: old.union(master(spark, [(7, "x"), (8, "x"), (9, "x"), (10, "x")])), 32)
    assert dict(map(tuple, keyed.read_keyed(spark, str(path), first).collect())) == wanted


# --- layouts --------------------------------------------------------------------------------------

def register(spark, days=40):
    lines, heads = [], []
    for k in range(days):
        day = date(2023, 12, 10) + timedelta(days=k)
        for x in range(3):
            number = 10 * k + x
            lines.append(("1", f"1{number % 7 + 1:09d}", number, "S", "n", "A", 1, 10, 9, 9, day))
            heads.append(("1", number, "S", "A", day, datetime(day.year, day.month, day.day, 12)))
    lines = spark.createDataFrame(lines, "location_id string, item_code string, sales_xaction_id int, xaction_type string, is_return string, status string, "
                                         "quantity int, unit_price int, register_price int, extended_amt int, business_date date")
    heads = spark.createDataFrame(heads, "location_id string, sales_xaction_id int, xaction_type string, status string, business_date date, end_date timestamp_ntz")
    priced = spark.createDataFrame([(k, "1", "00001", "HIS", 12, date(2023, 12, 1)) for k in range(1, 8)],
                                   "item_code int, location_id string, location_no string, subj string, list_price int, date_in_stock date")
    return lines, heads, priced


@pytest.mark.parametrize("whole_weeks, folders", [(False, 7), (True, 1)])
def test_a_weekly_load_reads_the_days_of_its_sales_only(spark, rows, tmp_path, whole_weeks, folders):
    lines, heads, priced = register(spark)
    layout.write_by_day(lines, str(tmp_path / "lines"), "business_date", whole_weeks)
    start, end = week_bounds(AS_OF)
    plain = serial_items.weekly_serial_sales(tables.Sources(sales_line=lines, sales_header=heads), priced, start, end)
    src = tables.Sources(sales_line=spark.read.parquet(str(tmp_path / "lines")), sales_header=heads)
    sold = serial_items.weekly_serial_sales(src, priced, start, end)
    assert rows(sold) == rows(plain) and sold.collect()[0]["sold_qty"] == 21
    plan = executed(sold)
    assert "dynamicpruning" in plan
    assert partitions_read(sold) == folders


def partitions_read(df):
    """Folders that the scans of an executed frame have read."""
    def scans(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            yield from scans(node.executedPlan())
            return
        if name.endswith("QueryStageExec"):
            yield from scans(node.plan())
            return
        if name == "FileSourceScanExec":
            yield node
        children = node.children()
        for i in range(children.size()):
            yield from scans(children.apply(i))

    df.collect()
    found = [node.metrics() for node in scans(df._jdf.queryExecution().executedPlan())]
    return sum(m.apply("numPartitions").value() for m in found if m.contains("numPartitions"))


def test_buckets_join_without_a_shuffle(spark, rows, tmp_path):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    src, window, pairs = shop(spark), week_bounds(AS_OF), ("shipments", "receipts", "transfers")
    layout.bucket_facts(src, str(tmp_path), 4, pairs, "written")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        dealt = layout.open_facts(src, str(tmp_path), 4, pairs, "opened")  # as another session would
        assert rows(new_goods.new_goods_activity(dealt, *window)) == rows(new_goods.new_goods_activity(src, *window))
        for header, detail, keys in (layout.FACT_PAIRS[name] for name in pairs):
            plan = executed(dealt[detail].join(dealt[header], keys))
            assert "Exchange" not in plan and "SortMergeJoin" in plan
        goods = weekly.new_goods_products(src)
        plans = {name: executed(weekly.fold_shipments(s, goods, ["section"], *window)) for name, s in (("plain", src), ("dealt", dealt))}
        assert plans["plain"].count("hashpartitioning(transfer_id") >= 2 and "hashpartitioning(transfer_id" not in plans["dealt"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for table in (t for name in pairs for t in layout.FACT_PAIRS[name][:2]):
            spark.sql(f"DROP TABLE IF EXISTS written_{table}")
            spark.sql(f"DROP TABLE IF EXISTS opened_{table}")


def shipments(spark, first, n, year):
    heads = [(first + k, "C", datetime(year, 1 + k % 12, 3) if k % 9 else None) for k in range(n)] + [(first, "D", datetime(year + 1, 1, 1))]
    details = [(first + k % (n + 2), f"i{k % 5}", "TTB WHOLESALE", "TTB", "X", 1 + k) for k in range(4 * n)]
    return (spark.createDataFrame(heads, "internal_shipment_num int, customer string, actual_ship_date_time timestamp_ntz"),
            spark.createDataFrame(details, "internal_shipment_num int, item string, order_type string, company string, customer string, total_qty int"))


def test_tiers_as_one_table_join_as_tier_by_tier(spark, rows, tmp_path):
    # The same shipment numbers occur in both tiers, and one of them has headers of two years.
    tiers = {"live": shipments(spark, 100, 30, 2023), "archive": shipments(spark, 100, 40, 2019)}
    layout.write_pairs(tiers, str(tmp_path), "internal_shipment_num", "actual_ship_date_time")
    pair = layout.read_pairs(spark, str(tmp_path))
    assert rows(merged_rates.wholesale_lines(pair)) == rows(merged_rates.wholesale_lines(*tiers.values()))
    live = layout.read_pairs(spark, str(tmp_path), ["live"])
    assert rows(merged_rates.wholesale_lines(live)) == rows(merged_rates.wholesale_lines(tiers["live"]))
    assert {f.split("tier=")[1].split("/")[0] for f in live[1].inputFiles()} <= {"live", "archive"}
    assert partitions_read(live[1]) == 3  # 2023, 2024 and year 0 of one tier


def test_a_date_filter_reads_the_years_it_needs(spark, tmp_path):
    tiers = {"live": shipments(spark, 100, 30, 2023), "archive": shipments(spark, 500, 40, 2019)}
    layout.write_pairs(tiers, str(tmp_path), "internal_shipment_num", "actual_ship_date_time")
    headers, details = layout.read_pairs(spark, str(tmp_path))
    recent = layout.between_days(headers, "actual_ship_date_time", date(2023, 6, 1), date(2024, 1, 1))
    keys = layout.pair_keys(recent, details, "internal_shipment_num")
    joined = details.join(F.broadcast(recent.select(*keys)), keys)
    plain = tiers["live"][1].join(tiers["live"][0].where("actual_ship_date_time >= '2023-06-01' and actual_ship_date_time < '2024-01-01'"), "internal_shipment_num")
    assert joined.count() == plain.count() > 0
    assert "dynamicpruning" in executed(joined)
    assert partitions_read(joined) == 2  # one year of headers and the same of details


# --- grids ----------------------------------------------------------------------------------------

def test_the_grid_moves_the_rows_of_its_larger_side_once(spark):
    left, right = spark.range(1000).toDF("a"), spark.range(50).toDF("b")
    grid = joins.all_pairs(left, right)
    assert grid.distinct().count() == 50_000
    plan = grid._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("RepartitionByExpression [a") == 1


def test_grids_of_nulls_nothing_and_odd_names(spark):
    left = spark.createDataFrame([(1, None), (2, "x")], "`a.b` int, c string")
    right = spark.createDataFrame([(None,), ("y",)], "d string")
    assert joins.all_pairs(left, right).columns == ["a.b", "c", "d"]
    assert sorted(map(str, joins.all_pairs(left, right).collect())) == sorted(map(str, left.crossJoin(right).collect()))
    assert joins.all_pairs(left, right.limit(0)).count() == joins.all_pairs(left.limit(0), right).count() == 0


def test_a_large_small_side_is_refused_and_dealt_with_a_spread(spark, monkeypatch):
    monkeypatch.setattr(joins, "GRID_ROWS", 10)
    left, right = spark.range(3).toDF("a"), spark.range(11).toDF("b")
    with pytest.raises(Exception, match="give a spread"):
        joins.all_pairs(left, right).count()
    assert joins.all_pairs(left, right, spread=8).distinct().count() == 33
    assert joins.all_pairs(left, right.limit(10)).count() == 30


# --- steps side by side ---------------------------------------------------------------------------

def steps(monkeypatch, **builds):
    monkeypatch.setattr(refresh, "FACTS", [(name, table, build, KEYS) for name, (table, build) in builds.items()])
    monkeypatch.setattr(refresh, "_load_master", lambda *a: tables.LoadCounts(0, 0, 0))


def test_independent_steps_run_side_by_side_and_one_table_keeps_its_order(spark, tmp_path, monkeypatch):
    meeting, order = Barrier(3, timeout=60), []

    def step(name, meet=True):
        def build(src, as_of, weeks):
            if meet:
                meeting.wait()  # only passes when three steps are under way together
            order.append((name, spark.sparkContext.getLocalProperty("spark.scheduler.pool")))
            return facts(spark, (WEEKS[0], name, 1), (None, name, 1))
        return build

    steps(monkeypatch, a=("ta", step("a")), b=("tb", step("b")), c=("tc", step("c")), d=("tc", step("d", False)))
    status = refresh.weekly_refresh(spark, tables.Sources(), str(tmp_path), AS_OF, at_once=3)
    assert dict(status) == dict.fromkeys(("item_master", "a", "b", "c", "d"), "done")
    assert order.index(("c", "c")) < order.index(("d", "d"))
    assert status.counts["d"] == tables.LoadCounts(2, 1, 2)
    assert spark.read.parquet(str(tmp_path / "tc")).count() == 4


def test_a_failure_skips_what_has_not_begun(spark, tmp_path, monkeypatch):
    def fails(src, as_of, weeks):
        raise ValueError("broken")

    def works(src, as_of, weeks):
        return facts(spark, (WEEKS[0], "x", 1))

    steps(monkeypatch, a=("ta", fails), b=("ta", works), c=("tc", works), d=("td", works))
    status = refresh.weekly_refresh(spark, tables.Sources(), str(tmp_path), AS_OF, at_once=1)
    assert dict(status) == {"item_master": "done", "a": "failed: ValueError", "b": "skipped", "c": "skipped", "d": "skipped"}
    assert set(status.counts) == {"item_master"}


def test_a_load_writes_its_rows_once_and_a_rerun_writes_only_keys(spark, tmp_path, monkeypatch):
    """a first load needs no copy beside its weeks; a rerun compares keys, not whole rows; a mixed load adds what is missing."""
    path, written = str(tmp_path / "facts"), []
    staged, swap = tables.staged, tables._swap_in
    monkeypatch.setattr(tables, "staged", lambda df, label: written.append((label, df.columns)) or staged(df, label))
    monkeypatch.setattr(tables, "_swap_in", lambda *args: written.append(("swap", args[4])) or swap(*args))
    data = facts(spark, *[(w, s, 1) for w in WEEKS[:2] for s in "ab"], (None, "x", 7), (WEEKS[0], None, 4), (WEEKS[0], None, 5))
    assert tables.append_new(data, path, KEYS) == tables.LoadCounts(7, 1, 3) and written == []
    assert tables.append_new(data, path, KEYS) == tables.LoadCounts(0, 0, 0)
    assert written == [("missing", KEYS)]
    more = facts(spark, (WEEKS[0], "a", 9), (WEEKS[2], "c", 2), (WEEKS[2], "c", 3), (None, "y", 1), (None, "x", 1), (WEEKS[0], None, 1))
    assert tables.append_new(more, path, KEYS) == tables.LoadCounts(3, 1, 2)
    assert sorted(written[-1][1], key=str) == [WEEKS[2], None]
    assert sorted((str(r.min_dt), str(r.secn), r.qty) for r in spark.read.parquet(path).collect()) == sorted(
        [(str(w), s, 1) for w in WEEKS[:2] for s in "ab"] + [("None", "x", 7), (str(WEEKS[0]), "None", 4), (str(WEEKS[0]), "None", 5),
                                                            (str(WEEKS[2]), "c", 2), (str(WEEKS[2]), "c", 3), ("None", "y", 1)])
    assert [p.name for p in tmp_path.iterdir()] == ["facts"]
