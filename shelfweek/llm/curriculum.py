"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule: a piecewise linear weight over training time from 0 to 1. Its integral gives the
source's share of the mix. A target stops at ``CAP`` times the source's size and the excess goes to the other sources
by weight. A source's documents stand in a fixed hashed order, pass after pass, until its target of words is reached;
the document at the end is taken in part. The word at which a copy begins, as a share of the target, is the share of
the schedule's integral that has passed by then: inverting the integral gives the training position of the copy. The
mix is range-sorted by position.

Defined cases: a null text has no words and is never taken; a null source is a source of its own, ordered last; documents
with equal ids are ordered by size, and rows equal in both are interchangeable; without any words all targets are zero;
an empty table gives an empty result; columns that are not named are carried along unchanged.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfweek.llm.common import SPACE, WORD, packed, staged, unpacked

CAP = 3
WEIGHTS = (1, 2, 3)
# Schedules in turn: (time, factor) knots by which a source's weight is multiplied. Each integrates to one.
RAMPS = (((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.5), (1.0, 0.5)), ((0.0, 0.5), (0.5, 1.5), (1.0, 0.5)))
BLOCK_ROWS = 100_000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def cycled_schedules(sources: DataFrame) -> DataFrame:
    """Schedules for sources in code point order, null last: weights and ramps repeat in turn.

    There is one row per source; they are numbered in one task, which holds names and sizes of sources only.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in WEIGHTS]), rank % len(WEIGHTS))
    ramps = F.array(*[F.array(*[F.struct(F.lit(t).alias("t"), F.lit(w).alias("w")) for t, w in ramp]) for ramp in RAMPS])
    knots = F.transform(F.get(ramps, rank % len(RAMPS)), lambda k: F.struct(k["t"].alias("t"), (k["w"] * weight).alias("w")))
    return sources.select("*", knots.alias("knots"))


def _segments(knots: Column) -> Column:
    """(t0, w0, t1, w1, area before, area) of each linear piece."""
    pieces = F.transform(F.sequence(F.lit(0), F.size(knots) - 2), lambda i: F.struct(
        F.get(knots, i)["t"].alias("t0"), F.get(knots, i)["w"].alias("w0"), F.get(knots, i + 1)["t"].alias("t1"), F.get(knots, i + 1)["w"].alias("w1")))

    def area(p: Column) -> Column:
        return (p["w0"] + p["w1"]) / 2 * (p["t1"] - p["t0"])

    return F.transform(pieces, lambda p, i: F.struct(
        p["t0"].alias("t0"), p["w0"].alias("w0"), p["t1"].alias("t1"), p["w1"].alias("w1"),
        F.aggregate(F.slice(pieces, 1, i), F.lit(0.0), lambda s, q: s + area(q)).alias("before"), area(p).alias("area")))


def targets(sources: DataFrame, cap: int = CAP) -> DataFrame:
    """(key, source, source_size, segments, weight, target) from (key, source, source_size, knots).

    Sources are ordered by the level at which they reach their cap; the level at which the rest share what is left is
    the fixed point of handing on the excess. One row per source, so the window is as small as the list of sources.
    """
    weighed = sources.withColumn("segments", _segments(F.col("knots"))).drop("knots")
    weighed = weighed.withColumn("weight", F.aggregate("segments", F.lit(0.0), lambda s, p: s + p["area"]))
    weighed = weighed.withColumn("most", F.col("source_size") * float(cap))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("level"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    live = F.col("weight") > 0
    leveled = weighed.withColumn("level", F.when(live, F.col("most") / F.col("weight")).otherwise(F.lit(math.inf)))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    heavy = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    shared = leveled.withColumn("shared", F.when(live, left / heavy))
    # The shared level rises with every source that is capped for good reason and falls with each one beyond.
    water = F.coalesce(F.max(F.when(F.col("shared") <= F.col("level"), F.col("shared"))).over(everything), F.lit(0.0))
    target = F.least(F.col("most"), water * F.col("weight"))
    return shared.select("key", "source", "source_size", "segments", "weight", target.alias("target"))


def _position(share: Column, segments: Column) -> Column:
    """The time by which ``share`` of the schedule's integral has passed."""
    whole = F.aggregate(segments, F.lit(0.0), lambda s, p: s + p["area"])
    passed = F.filter(segments, lambda p: (p["before"] <= share * whole) & (p["area"] > 0))
    piece = F.element_at(passed, -1)
    rest = share * whole - piece["before"]
    slope = (piece["w1"] - piece["w0"]) / (piece["t1"] - piece["t0"])
    root = F.sqrt(F.greatest(piece["w0"] * piece["w0"] + 2 * slope * rest, F.lit(0.0)))
    return F.least(piece["t1"], piece["t0"] + F.when(root + piece["w0"] > 0, 2 * rest / (root + piece["w0"])).otherwise(0.0))


def source_key(source: Column) -> Column:
    """A key without nulls, so that joins and windows share one partitioning."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def taken(docs: DataFrame, id_column: str = "doc_id", size: Column | None = None, source: str = "source",
          schedules=cycled_schedules, cap: int = CAP) -> DataFrame:
    """Each document as ``row`` with its size, its source's size and target, the words taken and its first position.

    Running sums are made in two steps: over blocks of a source (cut by the hashed order, so a large source has many
    blocks of even size), then inside each block.
    """
    size = word_count(F.col("text")) if size is None else size
    order = F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    narrow = docs.select(F.col(source).alias("source"), size.alias("size"), order.alias("order"))
    cells = narrow.groupBy("source", F.substring("order", 1, 4).alias("cell")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    cells = staged(cells.withColumn("key", source_key(F.col("source"))), "mix-cells")  # at most 65,536 rows a source
    per_source = cells.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    mix = staged(targets(schedules(per_source), cap).drop("source"), "mix-targets")
    largest = cells.groupBy("key").agg(F.sum("rows").alias("rows")).agg(F.max("rows")).first()[0] or 0
    digits = min(4, max(2, math.ceil(math.log(max(largest / BLOCK_ROWS, 1), 16))))
    running = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    starts = cells.withColumn("block", F.substring("cell", 1, digits)).groupBy("key", "block").agg(F.sum("size").alias("size"))
    starts = starts.select("key", "block", (F.sum("size").over(running) - F.col("size")).alias("block_start"))

    rows = packed(docs, id=F.col(id_column), key=source_key(F.col(source)), size=size, order=order)
    rows = rows.withColumn("block", F.substring("order", 1, digits)).join(mix, "key").join(starts, ["key", "block"])
    inside = Window.partitionBy("key", "block").orderBy("order", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("start", F.col("block_start") + F.sum("size").over(inside) - F.col("size"))
    words = F.least(F.round("target").cast("long"), F.col("source_size") * F.lit(cap))
    passes = F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0))
    placed = placed.withColumn("words", words).withColumn("passes", passes.cast("long"))
    rest = F.greatest(F.lit(0), F.least(F.col("size"), F.col("words") - F.col("passes") * F.col("source_size") - F.col("start")))
    placed = placed.withColumn("rest", rest).withColumn("taken", F.col("passes") * F.col("size") + F.col("rest"))
    share = F.when(F.col("target") > 0, F.least(F.lit(1.0), F.col("start") / F.col("target"))).otherwise(F.lit(0.0))
    return placed.withColumn("position", F.when(F.col("taken") > 0, _position(share, F.col("segments"))))


def range_sorted(df: DataFrame, *order: Column) -> DataFrame:
    """The rows in order over all partitions, each of which holds one range."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def mix_report(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document in training order: its size, its source's size and target, the words taken of it and its first position.

    Documents of which nothing is taken come last.
    """
    sized = staged(docs.select(F.col(id_column), F.col(source), word_count(F.col(text)).alias("mix_size")), "mix-sizes")
    out = range_sorted(taken(sized, id_column, F.col("mix_size"), source), F.col("position").asc_nulls_last(), F.col("id"), F.col("size"))
    return out.select(F.col("row").getField(id_column).alias(id_column), "size", "source_size", "target", "taken", "position")


def mixed(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source",
          n_chars: str | None = "n_chars", schedules=cycled_schedules, cap: int = CAP) -> DataFrame:
    """The mix itself: one row per copy in training order, with the columns of ``docs``; a last copy taken in part is cut to its words."""
    plan = taken(docs, id_column, word_count(F.col(text)), source, schedules, cap).where(F.col("taken") > 0)
    copies = F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes")), lambda c: F.struct(
        c.alias("copy"), F.when(c < F.col("passes"), F.col("size")).otherwise(F.col("rest")).alias("words")))
    each = plan.select("*", F.explode(F.filter(copies, lambda c: c["words"] > 0)).alias("c"))
    begin = F.col("c.copy") * F.col("source_size") + F.col("start")
    each = each.withColumn("position", _position(F.least(F.lit(1.0), begin / F.col("target")), F.col("segments")))
    each = range_sorted(each, F.col("position"), F.col("id"), F.col("c.copy"))
    partial = F.col("c.words") < F.col("size")
    body = F.col("row").getField(text)
    pieces = F.regexp_extract_all(body, F.lit(f"{SPACE}*{WORD}"), F.lit(0))
    cut = F.when(partial, F.array_join(F.slice(pieces, 1, F.col("c.words").cast("int")), "")).otherwise(body)
    changed = {text: cut}
    if n_chars is not None and n_chars in docs.columns:
        changed[n_chars] = F.when(partial, F.length(cut)).otherwise(F.col("row").getField(n_chars))
    return unpacked(each, **changed)
