"""Window operators on weekly series: moving rates, changes, looks ahead, running totals, first rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfweek.functions.measures import RATE


def series(by: list[str], order: str = "min_dt"):
    return Window.partitionBy(*by).orderBy(order)


def frame_rate(value: str, over, first: int, last: int, divisor: int) -> Column:
    """Sum over a frame of rows, divided by a fixed count even where the frame is cut short.

    Frames count rows, so the series must be dense.
    """
    return (F.sum(value).over(over.rowsBetween(first, last)).cast("double") / float(divisor)).cast(RATE)


def trailing_rate(value: str, over, n: int = 4) -> Column:
    return frame_rate(value, over, 1 - n, 0, n)


def leading_rate(value: str, over, n: int = 4) -> Column:
    return frame_rate(value, over, 1, n, n)


def deltas(value: str, over, steps: int = 3) -> dict[str, Column]:
    """Change over each of the last ``steps`` steps: newest first."""
    lagged = [F.col(value), *[F.lag(value, n).over(over) for n in range(1, steps + 1)]]
    return {f"d{n}_{value}": lagged[n - 1] - lagged[n] for n in range(1, steps + 1)}


def looks_ahead(value: str, over, jump: int = 4, steps: int = 4) -> dict[str, Column]:
    """The value ``jump``, ``2*jump``, ... rows later."""
    return {f"f{n}_{value}": F.lead(value, n * jump).over(over) for n in range(1, steps + 1)}


def running_sum(value: str, over) -> Column:
    return F.sum(value).over(over.rowsBetween(Window.unboundedPreceding, 0))


def last_active(condition: Column, stamp: str, over) -> Column:
    """Latest date so far on which the condition held."""
    return F.max(F.when(condition, F.col(stamp))).over(over.rowsBetween(Window.unboundedPreceding, 0))


def latest_value(df: DataFrame, by: list[str], value: str, stamp: str, tie: str | None = None) -> DataFrame:
    """Value at the latest timestamp of each key, by a grouped aggregate."""
    order = F.struct(stamp, tie) if tie else F.col(stamp)
    return df.groupBy(*by).agg(F.max_by(value, order).alias(value))


def keep_first(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """One row per key: the smallest in the given order, with the other columns as the last tie-break.

    A grouped minimum over structs combines before the shuffle, where a ranking would sort whole groups.
    """
    rest = [name for name in df.columns if name not in by and name not in order]
    picked = df.groupBy(*by).agg(F.min(F.struct(*order, *rest)).alias("_row"))
    return picked.select(*[name if name in by else F.col(f"_row.{name}").alias(name) for name in df.columns])


def first_row(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """One whole row per key: the least by the columns in order, nulls last."""
    order = F.struct(*[part for name in columns for part in (F.col(name).isNull(), F.col(name).alias(name))])
    best = df.groupBy(key).agg(F.min_by(F.struct(*columns), order).alias("_first"))
    return best.select(key, *[F.col(f"_first.{name}").alias(name) for name in columns])
