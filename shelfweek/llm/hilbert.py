"""Sharding along a Hilbert curve over document metadata.

Source, language and size are quantised to ``BITS`` bits each; documents are sorted by their index on the Hilbert curve
through that grid, and the order is cut into runs of equal bytes. Neighbours on the curve are close in all dimensions,
so a shard, and every row group in it, spans a small box of the metadata and whole files can be skipped. Among equal
indexes, equal texts stand side by side.

Defined cases: a null text has no bytes (its size is 1, its checksum that of an empty text); null sources and languages
come first; a document goes where the middle of its bytes falls, so shards differ by less than the largest document;
rows equal in everything that orders them are interchangeable; an empty table gives an empty result; columns that are
not named are carried along by ``write_shards`` and otherwise neither read nor changed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfweek.llm.common import staged

SHARDS = 8
DIMENSIONS, BITS = 3, 7
MIN_BLOCKS, MAX_BLOCKS, BLOCK_ROWS = 64, 1000, 100_000


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of points (rows) with coordinates of ``bits`` bits."""
    x = points.astype(np.uint64).T.copy()
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit, low = one << np.uint64(level), (one << np.uint64(level)) - one
        for i in range(len(x)):
            up = (x[i] & bit) != 0
            # Where the bit is set the first coordinate is mirrored; elsewhere it trades low bits with coordinate i.
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (one << np.uint64(level)), (one << np.uint64(level)) - one, np.uint64(0))
    x ^= turn
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(len(x)):
            index = index << one | x[i] >> np.uint64(level) & one
    return index


@F.pandas_udf(T.LongType())
def _curve(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
    return pd.Series(hilbert_index(np.stack([a, b, c], axis=1), BITS).astype(np.int64))


def _grade(rows: DataFrame, name: str) -> DataFrame:
    """(name, grade): the distinct values in order, spread over the grid. One row per value of a metadata column."""
    values = rows.select(name).distinct()
    order = Window.orderBy(F.col(name).asc_nulls_first())
    grade = F.floor((F.row_number().over(order) - 1) * (1 << BITS) / F.count(F.lit(1)).over(Window.partitionBy()))
    return values.select(F.col(name).alias(f"of_{name}"), grade.cast("int").alias(f"grade_{name}"))


def placed(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``rows`` (row, id, source, lang, size, crc) with shard and slot.

    Running sums over the whole order are made in two steps: over blocks cut at quantiles of the order, then inside each
    block. The cuts only divide the work; any cuts give the same result.
    """
    for name in ("source", "lang"):
        grades = _grade(rows, name)
        rows = rows.join(grades, F.col(name).eqNullSafe(F.col(f"of_{name}")), "left").drop(f"of_{name}")
    grade_size = F.least(F.lit((1 << BITS) - 1), F.floor(4 * F.log2("size"))).cast("int")
    index = _curve("grade_source", "grade_lang", grade_size)
    # 21 bits of the curve, then 21 of the text's checksum, then 21 of the id, so that no single key grows large.
    fine = F.shiftleft(F.shiftright("crc", 11), 21).bitwiseOR(F.shiftrightunsigned(F.xxhash64("id"), 43))
    key = F.shiftleft(index, 42).bitwiseOR(fine)
    keyed = staged(rows.select("row", "id", "size", "crc", key.alias("key")), "curve")
    n, total = keyed.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    blocks = int(min(MAX_BLOCKS, max(MIN_BLOCKS, n // BLOCK_ROWS)))
    cuts = keyed.agg(F.percentile_approx("key", [i / blocks for i in range(1, blocks)], 10 * blocks)).first()[0] or []
    bounds = np.unique(np.array(cuts, dtype=np.int64))

    @F.pandas_udf(T.IntegerType())
    def block_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, keys.to_numpy(), "right").astype(np.int32))

    dealt = keyed.withColumn("block", block_of("key"))
    sums = dealt.groupBy("block").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # at most MAX_BLOCKS rows
    sums = sums.select("block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("b0"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("r0"))
    inside = Window.partitionBy("block").orderBy("key", "id", "size", "crc").rowsBetween(Window.unboundedPreceding, 0)
    run = dealt.withColumns({"bytes": F.sum("size").over(inside), "at": F.row_number().over(inside)}).join(sums, "block")
    middle = F.col("b0") + F.col("bytes") - F.col("size") / 2
    shard = F.least(F.lit(shards - 1), F.floor(middle * shards / F.lit(max(total, 1)))).cast("int")
    run = staged(run.select("row", "size", "crc", shard.alias("shard"), (F.col("r0") + F.col("at") - 1).alias("place")), "placed")
    first = run.groupBy("shard").agg(F.min("place").alias("first"))
    return run.join(first, "shard").withColumn("slot", (F.col("place") - F.col("first")).cast("long"))


def _described(docs: DataFrame, keep: list[str], id_column: str, text: str, source: str, lang: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(id_column).alias("id"), F.col(source).alias("source"), F.col(lang).alias("lang"),
        (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("crc"))


def shard_report(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """Where every document goes: shard and slot, by the law of equal bytes."""
    out = placed(_described(docs, [id_column], id_column, text, source, lang))
    return out.select(f"row.{id_column}", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang") -> None:
    """Write the documents as one folder per shard, in curve order, so that the files' value ranges are narrow."""
    out = placed(_described(docs, docs.columns, id_column, text, source, lang))
    ordered = out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.select("row.*", F.col("shard").alias("_shard")).write.partitionBy("_shard").parquet(path)
