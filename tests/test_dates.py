from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfweek.functions import dates


def test_week_bounds_end_on_a_sunday():
    assert dates.week_bounds(date(2022, 3, 9)) == (date(2022, 2, 27), date(2022, 3, 6))
    assert dates.week_bounds(date(2022, 3, 6)) == (date(2022, 2, 27), date(2022, 3, 6))
    assert dates.week_bounds(date(2022, 3, 6), 3) == (date(2022, 2, 13), date(2022, 3, 6))


@pytest.mark.parametrize("day, label", [
    (date(2016, 1, 1), (2015, 52)), (date(2016, 12, 31), (2016, 52)), (date(2017, 1, 1), (2017, 1)),
    (date(2020, 12, 27), (2021, 1)), (date(2021, 1, 2), (2021, 1)), (date(2022, 12, 25), (2023, 1)),
    (date(2023, 1, 1), (2023, 1)), (date(2028, 12, 31), (2028, 54)),
])
def test_year_and_week_labels_at_year_ends(day, label):
    assert dates.retail_year_week(day) == label


def test_column_and_python_labels_agree(spark):
    start, end = date(2011, 1, 1), date(2030, 1, 1)
    got = {r.day: (r.yr, r.wk) for r in dates.retail_calendar(spark, start, end).collect()}
    days = [start + timedelta(days=n) for n in range((end - start).days)]
    assert got == {day: dates.retail_year_week(day) for day in days}


def test_week_changes_at_sunday_midnight(spark, rows):
    stamps = [(datetime(2024, 1, 6, 23, 59, 59),), (datetime(2024, 1, 7, 0, 0, 0),)]
    df = spark.createDataFrame(stamps, "at timestamp_ntz").select(dates.week_start(F.col("at")))
    assert rows(df) == [(date(2023, 12, 31),), (date(2024, 1, 7),)]


def test_week_table_holds_whole_weeks(spark):
    weeks = dates.week_table(spark, date(2024, 1, 7), date(2024, 1, 28)).orderBy("min_dt").collect()
    assert [(w.min_dt, w.end_dt) for w in weeks] == [
        (date(2024, 1, 7), date(2024, 1, 14)), (date(2024, 1, 14), date(2024, 1, 21)), (date(2024, 1, 21), date(2024, 1, 28))]


def test_hour_boundaries_count_marks_not_hours(spark):
    pairs = [(datetime(2024, 1, 1, 0, 59), datetime(2024, 1, 1, 1, 1)), (datetime(2024, 1, 2, 0, 0), datetime(2024, 1, 1, 23, 59))]
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(dates.hour_boundaries(F.col("a"), F.col("b"))).collect()] == [1, -1]


def test_week_boundaries_count_sundays(spark):
    df = spark.createDataFrame([(date(2024, 1, 6), date(2024, 1, 7)), (date(2024, 1, 7), date(2024, 1, 13))], "a date, b date")
    assert [r[0] for r in df.select(dates.week_boundaries(F.col("a"), F.col("b"))).collect()] == [1, 0]


def test_fiscal_labels(spark):
    df = dates.with_fiscal(spark.createDataFrame([(2020, 26), (2020, 27)], "yr int, wk int"))
    assert [tuple(r) for r in df.select("fy", "fw", "fw_wk").collect()] == [(2019, 52, "52-26"), (2020, 1, "01-27")]


def test_cost_month_rounds_to_the_nearest_month(spark):
    df = spark.createDataFrame([(2024, 1), (2024, 2), (2024, 52)], "yr int, wk int")
    got = [r[0] for r in df.select(dates.cost_month(F.col("yr"), F.col("wk"))).collect()]
    assert got == [date(2024, 1, 1), date(2024, 2, 1), date(2025, 1, 1)]


def test_months_before_clamps_to_month_end():
    assert dates.months_before(date(2024, 5, 31), 3) == date(2024, 2, 29)
    assert dates.months_before(date(2024, 1, 15), 12) == date(2023, 1, 15)
    assert dates.months_before(date(2024, 3, 31), 4) == date(2023, 11, 30)
