"""How large tables are laid out on disk so that jobs read and shuffle less of them.

* Register lines lie in one folder a day or week; a job that knows the days of its sales reads those folders only.
* Headers and details that are joined again and again lie in buckets of their key, so the join needs no shuffle.
* Live and archive tiers of a header and detail table are one table each, partitioned by tier and year.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfweek.functions.dates import week_start
from shelfweek.operators.joins import present
from shelfweek.sources.tables import Sources

TIER, YEAR = "tier", "tier_year"


# --- by day ---------------------------------------------------------------------------------------

def week_column(day: str) -> str:
    return f"{day}_week"


def write_by_day(lines: DataFrame, path: str, day: str, whole_weeks: bool = False) -> None:
    """One folder a day, or one a week where the lines of a day are few. The rebalance hint splits a large one over tasks."""
    by = week_column(day) if whole_weeks else day
    if whole_weeks:
        lines = lines.withColumn(by, week_start(F.col(day)))
    lines.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(path)


def on_days_of(lines: DataFrame, heads: DataFrame, day: str) -> DataFrame:
    """The lines of the days that ``heads`` has, or of their weeks; the days are known only when the job runs.

    On a table that is stored by day or week the scan skips all other folders. The list is broadcast: it has one row a
    day at most, however many headers there are.
    """
    week = week_column(day)
    if week in lines.columns:
        return present(lines, F.broadcast(heads.select(week_start(F.col(day)).alias(week)).distinct()), [week]).drop(week)
    return present(lines, F.broadcast(heads.select(day).distinct()), [day])


# --- buckets --------------------------------------------------------------------------------------

def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> None:
    """Store a table in buckets of its key, one file a bucket, and register it under the name in this session.

    Two tables with as many buckets of the same keys join without a shuffle. Choose the number by the larger one, about
    128 MB a bucket.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)


def open_bucketed(spark: SparkSession, table: str, path: str, schema: T.StructType, keys: list[str], buckets: int) -> DataFrame:
    """Register buckets that another session wrote. How they were dealt is not in the files, so it is given again."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    named = ", ".join(f"`{key}`" for key in keys)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({named}) SORTED BY ({named}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


# Headers and details that the weekly facts join, and the key they share.
FACT_PAIRS = {
    "shipments": ("shipment_header", "shipment_detail", ["transfer_id"]),
    "receipts": ("receiving_header", "receiving_detail", ["batch_id"]),
    "transfers": ("transfer_header", "transfer_detail", ["transfer_bin_no"]),
    "sales": ("sales_header", "sales_line", ["location_id", "business_date", "sales_xaction_id", "xaction_type"]),
}


def bucket_facts(src: Sources, path: str, buckets: int, pairs: Iterable[str] = tuple(FACT_PAIRS), mark: str = "bucketed") -> Sources:
    """Store the named pairs in buckets and return the sources with them in place of the tables they came from.

    A later session gets them by ``open_facts``; ``mark`` sets the tables' names apart from others in the session.
    """
    for header, detail, keys in (FACT_PAIRS[name] for name in pairs):
        for table in (header, detail):
            write_bucketed(src[table], f"{mark}_{table}", f"{path}/{table}", keys, buckets)
    return open_facts(src, path, buckets, pairs, mark)


def open_facts(src: Sources, path: str, buckets: int, pairs: Iterable[str] = tuple(FACT_PAIRS), mark: str = "bucketed") -> Sources:
    """The sources with the named pairs read from their buckets; ``src`` tells the columns of each table."""
    opened = Sources(src)
    for header, detail, keys in (FACT_PAIRS[name] for name in pairs):
        for table in (header, detail):
            opened[table] = open_bucketed(src[table].sparkSession, f"{mark}_{table}", f"{path}/{table}", src[table].schema, keys, buckets)
    return opened


# --- tiers ----------------------------------------------------------------------------------------

def write_pairs(tiers: Mapping[str, tuple[DataFrame, DataFrame]], path: str, key: str, day: str) -> None:
    """Store (headers, details) of all tiers as two tables, partitioned by tier and the year of the header's day.

    A detail lies with its header. Where a key has headers of several years in a tier, its details lie in each of those
    years, so that joining on key, tier and year is the join on the key. Year 0 holds headers without a day and details
    without a header. A task writes a file for each tier and year it holds, so the rows are not shuffled to their folders first.
    """
    stored = {"headers": [], "details": []}
    for name, (headers, details) in tiers.items():
        dated = headers.withColumns({TIER: F.lit(name), YEAR: F.coalesce(F.year(day), F.lit(0))})
        years = dated.groupBy(key).agg(F.collect_set(YEAR).alias(YEAR)).select(key, F.explode(YEAR).alias(YEAR))
        placed = details.join(years, key, "left").withColumns({TIER: F.lit(name), YEAR: F.coalesce(YEAR, F.lit(0))})
        stored["headers"].append(dated)
        stored["details"].append(placed.select(*details.columns, TIER, YEAR))
    for kind, frames in stored.items():
        stacked = reduce(lambda a, b: a.unionByName(b), frames)
        stacked.write.mode("overwrite").option("compression", "zstd").partitionBy(TIER, YEAR).parquet(f"{path}/{kind}")


def read_pairs(spark: SparkSession, path: str, tiers: Iterable[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(headers, details) of the named tiers, or of all; only their folders are read."""
    both = [spark.read.parquet(f"{path}/{kind}") for kind in ("headers", "details")]
    if tiers is not None:
        both = [df.where(F.col(TIER).isin(*tiers)) for df in both]
    return both[0], both[1]


def pair_keys(headers: DataFrame, details: DataFrame, key: str) -> list[str]:
    """What joins a header to its details: the key, and tier and year where both are stored by them.

    With those, years that a filter on the headers rules out are not read on the side of the details either.
    """
    return [key, *[name for name in (TIER, YEAR) if name in headers.columns and name in details.columns]]


def by_details(tiers: Iterable[tuple[DataFrame, DataFrame]]) -> list[tuple[DataFrame, DataFrame]]:
    """The pairs with the headers of tiers that share one detail table stacked, so that its lines are read and joined once."""
    stacked: list[tuple[DataFrame, DataFrame]] = []
    for headers, details in tiers:
        shared = next((i for i, (_, known) in enumerate(stacked) if known is details), None)
        if shared is None:
            stacked.append((headers, details))
        else:
            stacked[shared] = (stacked[shared][0].unionByName(headers), details)
    return stacked


def between_days(headers: DataFrame, day: str, start: date | None = None, end: date | None = None) -> DataFrame:
    """Headers from ``start`` to before ``end``; of headers stored by year only the years in question are read."""
    tests = [] if start is None else [F.col(day) >= F.lit(start)]
    tests += [] if end is None else [F.col(day) < F.lit(end)]
    if YEAR in headers.columns:
        tests += [] if start is None else [F.col(YEAR) >= start.year]
        tests += [] if end is None else [F.col(YEAR) <= end.year]
    return reduce(lambda df, test: df.where(test), tests, headers)
