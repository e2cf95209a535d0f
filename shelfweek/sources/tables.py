"""Scans, staged tables and writes on plain parquet folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfweek.functions.text import clean_keys
from shelfweek.operators.joins import absent, present


class Sources(dict):
    """Named source tables with attribute access (``src.products``)."""

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self[name]
        except KeyError as missing:
            raise AttributeError(f"source table {name!r} was not given") from missing


def load(spark: SparkSession, root: str, names: Iterable[str], keys: Mapping[str, Iterable[str]] | None = None) -> Sources:
    """Scan one parquet folder per table name; nothing is read until a job needs it.

    ``keys`` names the text keys of tables whose codes are stored with trailing blanks; they are trimmed here once.
    Filters on a trimmed column do not reach the scan, so only such tables should be listed.
    """
    keys = keys or {}
    return Sources({name: clean_keys(spark.read.parquet(f"{root}/{name}"), *keys.get(name, ())) for name in names})


def union_tiers(*tiers: DataFrame) -> DataFrame:
    """Stack year shards or live and archive tables by column name."""
    return reduce(lambda left, right: left.unionByName(right), tiers)


def literal_rows(spark: SparkSession, rows, schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


# --- staged tables ------------------------------------------------------------------------------

def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    On a cluster a missing setting is an error: an executor's own disk is not seen by the others. Only a single
    local machine may fall back to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="shelfweek-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


_AREA: ContextVar[str | None] = ContextVar("staging area", default=None)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Staged tables written inside the block live in a folder of their own, which goes when the block ends.

    Every result that reads them must be written inside the block. Staged tables of other runs stay untouched.
    """
    area = f"{shared_folder(spark)}/shelfweek-staged/{uuid.uuid4().hex}"
    token = _AREA.set(area)
    try:
        yield
    finally:
        _AREA.reset(token)
        _delete(spark, area)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write an aggregated frame that several outputs read, and scan it back.

    It cuts lineage, survives the loss of executors, gives each reader its own column pruning and hands
    the optimizer true sizes. Use it after aggregation only, never on raw lines. Outside a ``staging`` block
    the table stays in the shared folder until that is cleaned.
    """
    spark = df.sparkSession
    area = _AREA.get() or f"{shared_folder(spark)}/shelfweek-staged/{spark.sparkContext.applicationId}"
    path = f"{area}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# --- writes -------------------------------------------------------------------------------------

def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop(spark, path)
    if fs.exists(target):
        fs.delete(target, True)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, old = _hadoop(spark, source)
    if not fs.rename(old, _hadoop(spark, target)[1]):
        raise OSError(f"could not move {source} to {target}")


def read_or_empty(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The stored table, or no rows of the same schema before the first load."""
    if _exists(spark, path):
        return spark.read.schema(like.schema).parquet(path)
    return spark.createDataFrame([], like.schema)


def atomic_write(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """Replace a table as a whole: write beside it, then swap by rename, so readers never see half of it.

    Between the two renames there is no table at the path for a moment, and on an object store a rename is a copy: a
    reader that starts then fails and has to start again. A write that fails leaves the old table.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    fresh, previous = f"{path}.new-{mark}", f"{path}.old-{mark}"
    df.write.partitionBy(*partition_by).parquet(fresh)
    had_table = _exists(spark, path)
    if had_table:
        _rename(spark, path, previous)
    try:
        _rename(spark, fresh, path)
    except Exception:
        if had_table:
            _rename(spark, previous, path)
        raise
    if had_table:
        _delete(spark, previous)


def rebuild(df: DataFrame, path: str) -> None:
    """Drop and recreate a report table."""
    atomic_write(df, path)


def reload(df: DataFrame, path: str, columns: Iterable[str]) -> None:
    """Empty and refill a report table with its columns picked by name."""
    atomic_write(df.select(*columns), path)


# --- loads by whole partitions ---------------------------------------------------------------------

@dataclass(frozen=True)
class LoadCounts:
    """What one load wrote: new or changed rows, those of them without a week, and the partitions that were replaced."""

    rows: int
    undated: int
    parts: int


def _part_folder(path: str, by: str, value) -> str:
    return f"{path}/{by}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def _in_parts(by: str, parts: Iterable) -> Column:
    """A test on the partition column that the scan answers from the folder names."""
    known = [value for value in parts if value is not None]
    test = F.col(by).isin(*known) if known else F.lit(False)
    return test | F.col(by).isNull() if None in parts else test


def replace_parts(df: DataFrame, path: str, by: str, parts: list) -> None:
    """Replace the listed partitions of a table by the rows of ``df``; a listed partition without rows goes.

    ``df`` may read the table. The rows are first written beside it, as ``<path>.load``, which appears complete or not at
    all; then the partitions are overwritten from there and the copy is removed. A load that is cut off in between is
    finished by ``recover``, which the next load calls, so whatever happens all listed partitions are replaced or none.
    """
    mark = f"{path}.load-{uuid.uuid4().hex}"
    df.write.parquet(f"{mark}/rows")
    _swap_in(df.sparkSession, mark, path, df.schema[by], parts)


def _swap_in(spark: SparkSession, mark: str, path: str, by: T.StructField, parts: list) -> None:
    """Declare the rows under ``mark`` complete and replace the listed partitions by them."""
    spark.createDataFrame([(value,) for value in parts], T.StructType([by])).coalesce(1).write.parquet(f"{mark}/parts")
    _rename(spark, mark, f"{path}.load")
    recover(spark, path, by.name)


def recover(spark: SparkSession, path: str, by: str) -> bool:
    """Finish a load that wrote its rows but may not have replaced all partitions; says whether there was one."""
    load = f"{path}.load"
    if not _exists(spark, load):
        return False
    rows, parts = spark.read.parquet(f"{load}/rows"), [r[0] for r in spark.read.parquet(f"{load}/parts").collect()]
    _overwrite_parts(rows, path, by)
    filled = {r[0] for r in rows.select(by).distinct().collect()}  # partitions of one load
    for value in parts:
        if value not in filled:
            _delete(spark, _part_folder(path, by, value))
    _delete(spark, load)
    return True


def _overwrite_parts(rows: DataFrame, path: str, by: str) -> None:
    """The rebalance hint gives each partition few files and still splits a large one over tasks."""
    rows.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def append_new(df: DataFrame, path: str, keys: list[str], window: tuple[date, date] | None = None,
               week: str = "min_dt") -> LoadCounts:
    """Add the rows whose key is not stored yet; null keys match each other, so a rerun adds nothing.

    The table is partitioned by week. With the window of the new rows only their weeks are compared, and only keys are: rows
    are made for a second time where some keys are stored and some are not. Weeks that gain rows are replaced as a whole by
    their stored and new rows, all or none of them (as by ``replace_parts``); a table that does not exist yet appears as a
    whole. The rows are counted while they are written, without a second scan. Two loads of one table must not run at the
    same time.
    """
    spark = df.sparkSession
    recover(spark, path, week)
    stored = read_or_empty(spark, path, df)
    compared = stored
    if window is not None:
        compared = stored.where((F.col(week) >= F.lit(window[0])) & (F.col(week) < F.lit(window[1])))
    exists = _exists(spark, path)
    with staging(spark):
        found = df
        if exists and not compared.isEmpty():
            missing = staged(only_new(compared.select(*keys), df.select(*keys), keys), "missing")
            if missing.isEmpty():
                return LoadCounts(0, 0, 0)
            found = present(df, missing, keys, null_safe=True)
        seen = Observation()
        found = found.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(week).isNull()).alias("undated"))
        mark = f"{path}.load-{uuid.uuid4().hex}"
        try:
            if exists:
                found.write.parquet(f"{mark}/rows")
            else:
                _overwrite_parts(found, f"{mark}/rows", week)
            counts = seen.get
            rows = spark.read.schema(df.schema).parquet(f"{mark}/rows")
            weeks = [r[0] for r in rows.select(week).distinct().collect()] if counts["rows"] else []  # weeks of one load
            if weeks and exists:
                stored.where(_in_parts(week, weeks)).write.mode("append").parquet(f"{mark}/rows")
                _swap_in(spark, mark, path, df.schema[week], weeks)
            elif weeks:
                _rename(spark, f"{mark}/rows", path)
        finally:
            _delete(spark, mark)
    return LoadCounts(counts["rows"], counts["undated"], len(weeks))


def export_csv(df: DataFrame, path: str, order_by: Iterable[str | Column] = ()) -> None:
    """Report files for users, sorted over all files where an order is given."""
    columns = list(order_by)
    ordered = df.orderBy(*columns) if columns else df
    ordered.write.mode("overwrite").csv(path, header=True)


# --- row changes as frame to frame functions ------------------------------------------------------

def only_new(target: DataFrame, df: DataFrame, keys: list[str], null_safe: bool = True) -> DataFrame:
    return absent(df, target, keys, null_safe=null_safe)


def insert_missing(master: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    return master.unionByName(only_new(master, new, keys).select(*master.columns))


def update_changed(master: DataFrame, updates: DataFrame, key: str, watch: str, columns: list[str]) -> DataFrame:
    """Take ``columns`` from the update row where the watched column differs; a null on either side changes nothing.

    ``updates`` has one row per key.
    """
    incoming = updates.select(F.col(key), *[F.col(name).alias(f"_{name}") for name in columns])
    changed = F.coalesce(F.col(f"_{watch}") != F.col(watch), F.lit(False))
    joined = master.join(incoming, key, "left")
    fresh = {name: F.when(changed, F.col(f"_{name}")).otherwise(F.col(name)) for name in columns}
    return joined.withColumns(fresh).select(*master.columns)


def delete_keys(master: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return absent(master, keys, on)


def keep_keys(master: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return present(master, keys, on)


def drop_where(df: DataFrame, condition) -> DataFrame:
    """Remove matching rows; rows for which the condition is unknown stay."""
    return df.where(~F.coalesce(condition, F.lit(False)))
