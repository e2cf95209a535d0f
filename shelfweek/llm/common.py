"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfweek.sources.tables import staged, staging

__all__ = ["SPACE", "WORD", "let", "packed", "sized", "staged", "staging", "table", "unpacked", "words_of"]

FILE_BYTES = 16 << 20

# A word is a run of characters other than ASCII white space; the same pattern is valid in Spark and in DuckDB.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def packed(df: DataFrame, **named: Column) -> DataFrame:
    """All columns of ``df`` as the struct ``row``, beside named expressions over them: no name can clash."""
    return df.select(F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("row"),
                     *[column.alias(name) for name, column in named.items()])


def unpacked(df: DataFrame, **replaced: Column) -> DataFrame:
    """The columns of the struct ``row`` again, some of them replaced (same name, same type)."""
    fields = df.schema["row"].dataType.fields
    return df.select(*[
        (replaced[field.name].cast(field.dataType) if field.name in replaced else F.col("row").getField(field.name)).alias(field.name)
        for field in fields
    ])


def sized(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` in no more partitions than its bytes need, about ``FILE_BYTES`` each.

    A shuffle that is as wide as the cluster would leave one file a task, however few rows there are, and its readers one
    task a file. ``rows`` is an upper bound. Where the bytes need more partitions than there are, nothing changes.
    """
    return df.coalesce(max(1, -(-rows * row_bytes // FILE_BYTES)))
