"""Set operators: distinct unions, snapshot comparison, quality probes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweek.operators.joins import present


def union_distinct(*frames: DataFrame) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), frames).distinct()


def diff_facts(new: DataFrame, old: DataFrame, week: str = "min_dt") -> DataFrame:
    """New rows that the stored facts do not hold in the same form; stored weeks outside the new ones are ignored."""
    stored = present(old, new.select(week), [week])
    return new.subtract(stored.select(*new.columns))


def diff_both_ways(new: DataFrame, old: DataFrame, week: str = "min_dt") -> DataFrame:
    same_weeks = present(old, new.select(week), [week]).select(*new.columns)
    gained = diff_facts(new, old, week).withColumn("side", F.lit("new"))
    lost = same_weeks.subtract(new).withColumn("side", F.lit("old"))
    return gained.unionByName(lost)


def missing_dates(df: DataFrame, week: str = "min_dt") -> DataFrame:
    """Rows that found no calendar week; none are expected."""
    return df.where(F.col(week).isNull())


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys stored more than once; none are expected."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")
