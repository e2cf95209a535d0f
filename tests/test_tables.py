from datetime import date

import pytest

from shelfweek.sources import tables


def facts(spark, *data):
    return spark.createDataFrame(list(data), "min_dt date, secn string, qty int")


WEEK = date(2024, 1, 7)
WINDOW = (date(2024, 1, 7), date(2024, 1, 14))


def test_append_twice_equals_append_once_even_with_null_keys(spark, rows, tmp_path):
    path = str(tmp_path / "facts")
    df = facts(spark, (WEEK, "a", 1), (WEEK, None, 2))
    for _ in range(2):
        tables.append_new(df, path, ["min_dt", "secn"], WINDOW)
    assert rows(spark.read.parquet(path), "secn", "qty") == [("a", 1), (None, 2)]
    tables.append_new(facts(spark, (WEEK, "a", 9), (WEEK, "b", 3)), path, ["min_dt", "secn"], WINDOW)
    assert rows(spark.read.parquet(path), "secn", "qty") == [("a", 1), ("b", 3), (None, 2)]


def test_append_of_nothing_and_then_rows(spark, tmp_path):
    path = str(tmp_path / "facts")
    tables.append_new(facts(spark).limit(0), path, ["min_dt", "secn"], WINDOW)
    tables.append_new(facts(spark, (WEEK, "a", 1)), path, ["min_dt", "secn"], WINDOW)
    assert spark.read.parquet(path).count() == 1


def test_atomic_write_replaces_a_table_that_is_being_read(spark, rows, tmp_path):
    path = str(tmp_path / "master")
    tables.atomic_write(facts(spark, (WEEK, "a", 1)), path)
    grown = spark.read.parquet(path).unionByName(facts(spark, (WEEK, "b", 2)))
    tables.atomic_write(grown, path)
    assert rows(spark.read.parquet(path), "secn") == [("a",), ("b",)]
    assert [p.name for p in tmp_path.iterdir()] == ["master"]


def test_failed_write_leaves_the_table_alone(spark, rows, tmp_path):
    path = str(tmp_path / "master")
    tables.atomic_write(facts(spark, (WEEK, "a", 1)), path)
    with pytest.raises(Exception):
        tables.atomic_write(facts(spark, (WEEK, "a", 1)).selectExpr("raise_error(secn) as secn"), path)
    assert rows(spark.read.parquet(path), "secn") == [("a",)]


def test_master_changes(spark, rows):
    master = spark.createDataFrame([("1", "A", "g"), ("2", None, "g"), ("3", "C", "g")], "item_code string, vendor string, grp string")
    new = spark.createDataFrame([("1", "B", "h"), ("2", "B", "h"), ("3", "C", "h"), ("4", "D", "h")], "item_code string, vendor string, grp string")
    updated = tables.update_changed(tables.insert_missing(master, new, ["item_code"]), new, "item_code", "vendor", ["vendor", "grp"])
    assert rows(updated) == [("1", "B", "h"), ("2", None, "g"), ("3", "C", "g"), ("4", "D", "h")]
    assert rows(tables.delete_keys(updated, new.where("vendor = 'D'"), ["item_code"]), "item_code") == [("1",), ("2",), ("3",)]
    assert rows(tables.drop_where(master, master.vendor == "A"), "item_code") == [("2",), ("3",)]


def test_staged_tables_go_with_their_block(spark, tmp_path):
    df = facts(spark, (WEEK, "a", 1))
    with tables.staging(spark):
        kept = tables.staged(df, "label")
        assert kept.count() == 1
        file = kept.inputFiles()[0]
    from pathlib import Path
    assert not Path(file.removeprefix("file:").replace("//", "/")).exists()


def test_csv_export_is_sorted(spark, tmp_path):
    path = str(tmp_path / "report")
    tables.export_csv(facts(spark, (WEEK, "b", 1), (WEEK, "a", 2)), path, ["secn"])
    assert [r.secn for r in spark.read.csv(path, header=True).collect()] == ["a", "b"]


def test_load_trims_the_named_keys(spark, tmp_path):
    spark.createDataFrame([("A1  ", "x "), (None, "y")], "code string, note string").write.parquet(str(tmp_path / "items"))
    src = tables.load(spark, str(tmp_path), ["items"], {"items": ["code"]})
    assert {tuple(r) for r in src["items"].collect()} == {("A1", "x "), (None, "y")}


def test_report_tables_are_rebuilt_and_reloaded(spark, rows, tmp_path):
    path = str(tmp_path / "report")
    tables.rebuild(facts(spark, (WEEK, "a", 1)), path)
    tables.reload(facts(spark, (WEEK, "b", 2)), path, ["secn", "qty"])
    stored = spark.read.parquet(path)
    assert stored.columns == ["secn", "qty"] and rows(stored) == [("b", 2)]


def test_report_files_keep_their_order_over_many_files(spark, tmp_path):
    from shelfweek.plans import report_files

    rows = [(f"{i % 7:05d}", WEEK, i % 5, None if i % 11 == 0 else f"t{i % 13:02d}") for i in range(200)]
    df = spark.createDataFrame(rows, "loc_no string, min_dt date, cur_sold_qty int, title string").repartition(5)
    path = str(tmp_path / "titles")
    report_files.write_report(df, path, "titles")
    read = report_files.read_report(spark, path, df.schema).collect()
    assert sorted(r.line_no for r in read) == list(range(1, 201))
    wanted = sorted(rows, key=lambda r: (r[0], r[1], -r[2], r[3] or ""))
    assert [tuple(r)[:4] for r in sorted(read, key=lambda r: r.line_no)] == wanted


def test_an_empty_report_has_no_lines(spark, tmp_path):
    from shelfweek.plans import report_files

    df = spark.createDataFrame([], "cap string, secn string, qty int")
    report_files.write_report(df, str(tmp_path / "empty"), "inbound_overview")
    assert report_files.read_report(spark, str(tmp_path / "empty"), df.schema).count() == 0
