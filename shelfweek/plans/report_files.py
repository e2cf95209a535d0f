"""Report files in the order their readers expect, and report tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from shelfweek.sources.tables import export_csv

# The order of each report; a minus stands for descending.
ORDERS = {
    "chain_by_source": ("used_new", "src", "yr", "wk", "fy", "fw", "fw_wk", "min_dt"),
    "chain_by_section": ("src", "min_dt", "cap", "secn"),
    "titles": ("loc_no", "min_dt", "-cur_sold_qty", "title"),
    "program_detail": ("-yr", "-wk", "cap", "goal_grp"),
    "program_rollup": ("yr", "wk", "program"),
    "section_rates": ("cap", "secn"),
    "inbound_detail": ("rord_grp", "title_code", "-status", "item_code"),
    "inbound_overview": ("cap", "secn"),
}


def order_of(names: Iterable[str]) -> list[Column]:
    return [F.col(name[1:]).desc() if name.startswith("-") else F.col(name).asc() for name in names]


def write_report(df: DataFrame, path: str, report: str) -> None:
    """The report as CSV files; file by file and line by line they are in the report's order."""
    export_csv(df, path, order_of(ORDERS[report]))


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The lines of a report file with ``line_no``, their place over all files.

    Lines are numbered inside each file; a file starts after the lines of the files before it.
    """
    lines = spark.read.schema(schema).csv(path, header=True).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"))
    sizes = lines.groupBy("_file").agg(F.count("*").alias("_rows"))  # one row per file
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_file").orderBy("_block", "_line"))
    return lines.join(starts, "_file").withColumn("line_no", F.col("_start") + inside).drop("_file", "_block", "_line", "_start")
