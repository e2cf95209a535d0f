"""Registration of queries with their SQL statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry.oracle_tables import compose
from registry.standins import Retail

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Output types both engines share: bigint, double, text and boolean; dates as text."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegralType):
            column = column.cast("bigint")
        elif isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("date").cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(columns: str, sql: str | None = None, **extra: str):
    """Register a query under its function name; ``columns`` names and types the output, ``sql`` states it."""

    def register(build: Callable[[Retail], DataFrame]):
        names = [c.split(":")[0] for c in columns.split()]

        def run(spark: SparkSession, root: str) -> DataFrame:
            return plain(build(Retail(spark, root)).select(*names))

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLE[build.__name__] = compose(columns, sql, extra)
        return build

    return register
