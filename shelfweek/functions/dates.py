"""Retail calendar arithmetic. Weeks start on Sunday and are keyed by that Sunday's date."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: from this year on, week 53 rolls into week 1 of the next year; before it, weeks count one lower.
ROLL_FORWARD_YEAR = 2017


def last_sunday(as_of: date | None = None) -> date:
    """The latest Sunday on or before ``as_of``."""
    day = as_of or date.today()
    return day - timedelta(days=day.isoweekday() % 7)


def week_bounds(as_of: date | None = None, weeks: int = 1) -> tuple[date, date]:
    """Half-open window of the last ``weeks`` complete Sunday-to-Sunday weeks."""
    end = last_sunday(as_of)
    return end - timedelta(weeks=weeks), end


def within(stamp: Column, start: date, end: date) -> Column:
    """Half-open range test on the raw column, so that it reaches the scan."""
    return (stamp >= F.lit(start)) & (stamp < F.lit(end))


def week_start(stamp: Column) -> Column:
    """Sunday of the week that holds ``stamp``; the equi-join key for weeks."""
    day = F.to_date(stamp)
    return F.date_sub(day, F.dayofweek(day) - 1)


def week_of_year(stamp: Column) -> Column:
    """Week number where week 1 holds 1 January and weeks start on Sunday (1 to 54)."""
    day = F.to_date(stamp)
    lead = F.dayofweek(F.trunc(day, "year")) - 1
    return (F.floor((F.dayofyear(day) - 1 + lead) / 7) + 1).cast("int")


def retail_year(stamp: Column) -> Column:
    year, week = F.year(stamp), week_of_year(stamp)
    return (
        F.when((week == 53) & (year >= ROLL_FORWARD_YEAR), year + 1)
        .when((week == 1) & (year < ROLL_FORWARD_YEAR), year - 1)
        .otherwise(year)
    )


def retail_week(stamp: Column) -> Column:
    year, week = F.year(stamp), week_of_year(stamp)
    return (
        F.when(year >= ROLL_FORWARD_YEAR, F.when(week == 53, 1).otherwise(week))
        .otherwise(F.when(week == 1, 52).otherwise(week - 1))
        .cast("int")
    )


def with_week(df: DataFrame, stamp: str, name: str = "min_dt") -> DataFrame:
    """Add the week key of a timestamp column."""
    return df.withColumn(name, week_start(F.col(stamp)))


def with_year_week(df: DataFrame, week: str = "min_dt") -> DataFrame:
    """Add ``yr`` and ``wk`` of a week key; they are labels, never join keys."""
    return df.withColumns({"yr": retail_year(F.col(week)), "wk": retail_week(F.col(week))})


def retail_calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day of the half-open range: day, retail year and week, first day of the week."""
    days = spark.range((end - start).days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"))
    return days.select(
        "day",
        retail_year(F.col("day")).alias("yr"),
        retail_week(F.col("day")).alias("wk"),
        week_start(F.col("day")).alias("first_day"),
    )


def week_table(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per week that starts in the half-open range, with its own half-open bounds."""
    days = retail_calendar(spark, start, end).where(F.col("day") == F.col("first_day"))
    return days.select("yr", "wk", F.col("day").alias("min_dt"), F.date_add("day", 7).alias("end_dt"))


def fiscal_year(yr: Column, wk: Column) -> Column:
    return F.when(wk > 26, yr).otherwise(yr - 1)


def fiscal_week(wk: Column) -> Column:
    return F.when(wk > 26, wk - 26).otherwise(wk + 26)


def fiscal_label(wk: Column) -> Column:
    """``fiscal-calendar`` week label, two digits each."""
    two = [F.lpad(number.cast("string"), 2, "0") for number in (fiscal_week(wk), wk)]
    return F.concat_ws("-", *two)


def with_fiscal(df: DataFrame) -> DataFrame:
    yr, wk = F.col("yr"), F.col("wk")
    return df.withColumns({"fy": fiscal_year(yr, wk), "fw": fiscal_week(wk), "fw_wk": fiscal_label(wk)})


def hour_boundaries(start: Column, end: Column) -> Column:
    """Number of full-hour marks between two timestamps, in wall-clock time."""
    return F.datediff(end, start).cast("bigint") * 24 + F.hour(end) - F.hour(start)


def week_boundaries(start: Column, end: Column) -> Column:
    """Number of Sundays crossed between two dates."""
    return (F.datediff(week_start(end), week_start(start)) / 7).cast("int")


def cost_month(yr: Column, wk: Column) -> Column:
    """First day of the month whose average cost applies to a retail week (rounded to the nearest month)."""
    day = F.date_add(F.make_date(yr, F.lit(1), F.lit(1)), (wk * 7).cast("int"))
    return F.trunc(F.add_months(day, F.round(F.dayofmonth(day) / 28).cast("int")), "month")


def retail_year_week(day: date) -> tuple[int, int]:
    """The retail year and week label of one date, for values the driver needs while building a plan."""
    lead = date(day.year, 1, 1).isoweekday() % 7
    week = (day.timetuple().tm_yday - 1 + lead) // 7 + 1
    if day.year >= ROLL_FORWARD_YEAR:
        return (day.year + 1, 1) if week == 53 else (day.year, week)
    return (day.year - 1, 52) if week == 1 else (day.year, week - 1)


def months_before(day: date, months: int) -> date:
    """Same day of an earlier month, or that month's last day."""
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    following = date(year + (month == 11), (month + 1) % 12 + 1, 1)
    return date(year, month + 1, min(day.day, (following - timedelta(days=1)).day))
