"""Merkle dataset manifest with incremental witnesses.

Every source is a tree over its documents in the order of their ids, and the roots of the sources are the leaves of the
tree above. Up to ``ARITY`` consecutive nodes make one node of the next level, until one is left.

Leaves are appended one by one (``OpenTree``). A node that joins an open run gets a partial witness: the digests before
it. Every sibling that is completed later extends it, and all leaves below the node share the step. Aligned blocks of
``ARITY ** BLOCK_LEVELS`` leaves are appended by tasks of their own, each in one stream of rows; the roots of the blocks
are then appended in the same way one storey higher. Downward, the witness of a block's root travels once to its block
and completes the witnesses there. No task holds more than a block, and nothing but counts comes to the driver.

Defined cases: a null value is hashed as ``-`` and differs from an empty text; a null source is a tree of its own, ordered
first; null ids come first, rows with equal ids are ordered by their leaf, and repeated rows are leaves of their own that
are interchangeable; a lone leaf is its own root and has no witness; an empty table gives an empty result; texts of any
length are hashed whole; columns that are not named are neither read nor changed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfweek.llm.common import staged

ARITY = 16
BLOCK_LEVELS = 3
ROWS_OUT = 256  # rows of one Arrow batch; a witness has some kilobytes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WITNESS = "array<struct<left:string,right:string>>"


def node(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


class OpenTree:
    """A tree of a fixed number of levels that leaves are appended to.

    ``runs[k]`` are the nodes of the open run of level ``k`` and ``spans[k]`` the leaves below each. A step of a witness
    is (digests before, digests after); the second part grows while the run is open.
    """

    def __init__(self, levels: int):
        self.levels = levels
        self.runs: list[list[str]] = [[] for _ in range(levels + 1)]
        self.steps: list[list[tuple[str, list[str]]]] = [[] for _ in range(levels + 1)]
        self.first: list[int] = [0] * (levels + 1)  # the first leaf below each open run
        self.witnesses: list[list[tuple[str, list[str]]]] = []

    def append(self, leaf: str) -> None:
        self.witnesses.append([])
        self._join(0, leaf, len(self.witnesses) - 1)

    def _join(self, level: int, digest: str, first: int) -> None:
        run = self.runs[level]
        if level < self.levels:
            for step in self.steps[level]:
                step[1].append(digest)
            mine = ("".join(run), [])
            self.steps[level].append(mine)
            for leaf in range(first, len(self.witnesses)):
                self.witnesses[leaf].append(mine)
        if not run:
            self.first[level] = first
        run.append(digest)
        if level < self.levels and len(run) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        digest = node("".join(self.runs[level]))
        self.runs[level], self.steps[level] = [], []
        self._join(level + 1, digest, self.first[level])

    def close(self) -> str:
        """The root: open runs are completed from the leaves upward, however short they are."""
        for level in range(self.levels):
            if self.runs[level]:
                self._complete(level)
        return self.runs[self.levels][0]

    def witness(self, leaf: int) -> list[tuple[str, str]]:
        return [(left, "".join(right)) for left, right in self.witnesses[leaf]]


# --- leaves -----------------------------------------------------------------------------------------

def _field(value: Column) -> Column:
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(_field, values)), 256)


def folded(leaf: Column, witness: Column) -> Column:
    """The root that follows from a leaf and its witness."""
    return F.aggregate(witness, leaf, lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256))


def proof(witness: Column) -> Column:
    """All siblings in one text, from the leaf's run up to the root's, left to right."""
    return F.array_join(F.transform(witness, lambda step: F.concat(step["left"], step["right"])), "")


# --- trees ------------------------------------------------------------------------------------------

def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``at``, the place within ``tree`` from 0 in the given order, and ``n``, the leaves of the tree.

    The rows are range-partitioned once; the counts of (tree, partition) give every partition its first place, and places
    inside are counted there. A large tree lies in many partitions.
    """
    dealt = staged(rows.repartitionByRange("tree", *order).withColumn("part", F.spark_partition_id()), "merkle-ranges")
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    starts = dealt.groupBy("tree", "part").count().select(
        "tree", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"), F.sum("count").over(Window.partitionBy("tree")).alias("n"))
    inside = Window.partitionBy("tree", "part").orderBy(*order)
    placed = dealt.withColumn("in_part", F.row_number().over(inside)).join(starts, ["tree", "part"])
    return placed.withColumn("at", F.col("start") + F.col("in_part") - 1).drop("part", "start", "in_part")


def _blocks(nodes: DataFrame) -> DataFrame:
    """``nodes`` with their block and the number of levels that it builds."""
    # n - 1 has as many hexadecimal digits as a tree of n leaves has levels.
    levels = F.when(F.col("n") > 1, F.length(F.hex(F.col("n") - 1))).otherwise(0)
    return nodes.withColumns({"levels": F.least(F.lit(BLOCK_LEVELS), levels).cast("int"), "block": F.shiftright("at", 4 * BLOCK_LEVELS)})


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Ranges of rows of one block."""
    tree, block = batch.column("tree").to_pylist(), batch.column("block").to_numpy()
    start = 0
    for i in range(1, batch.num_rows + 1):
        if i == batch.num_rows or block[i] != block[start] or tree[i] != tree[start]:
            yield start, i
            start = i


def _block_roots(blocked: DataFrame) -> DataFrame:
    """(tree, at, digest, n): the root of each block, numbered by block, and how many blocks its tree has."""
    names = ["tree", "at", "n", "digest"]
    size = ARITY ** BLOCK_LEVELS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, tree = None, None
        done: list[tuple[str, int, int, str]] = []
        for batch in batches:
            digests, levels = batch.column("digest").to_pylist(), batch.column("levels").to_pylist()
            for a, b in _segments(batch):
                this = batch.column("tree")[a].as_py(), batch.column("block")[a].as_py(), -(-batch.column("n")[a].as_py() // size)
                if this != key:
                    if tree is not None:
                        done.append((*key, tree.close()))
                    key, tree = this, OpenTree(levels[a])
                for digest in digests[a:b]:
                    tree.append(digest)
            if len(done) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)
                done = []
        if tree is not None:
            done.append((*key, tree.close()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)

    dealt = blocked.select("tree", "block", "at", "n", "levels", "digest").repartition("tree", "block").sortWithinPartitions("tree", "block", "at")
    return dealt.mapInArrow(run, "tree string, at long, n long, digest string")


def _completed(blocked: DataFrame, above: DataFrame) -> DataFrame:
    """The rows with their whole witnesses; ``above`` (tree, at, witness, subroot, root) has one row for each block.

    The row of a block's root is sorted in front of the block's leaves, so it travels once, not with every leaf.
    """
    leaves = blocked.select("tree", "block", "at", "levels", "digest", "row", F.lit(None).cast(WITNESS).alias("witness"),
                            F.lit(None).cast("string").alias("subroot"), F.lit(None).cast("string").alias("root"))
    row_type = blocked.schema["row"].dataType
    heads = above.select("tree", F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"), F.lit(0).alias("levels"), F.lit("").alias("digest"),
                         F.lit(None).cast(row_type).alias("row"), "witness", "subroot", "root")
    dealt = leaves.unionByName(heads).repartition("tree", "block").sortWithinPartitions("tree", "block", "at")
    out = T.StructType([T.StructField("tree", T.StringType()), T.StructField("at", T.LongType()), T.StructField("digest", T.StringType()), T.StructField("row", row_type),
                        *[above.schema[c] for c in ("witness", "subroot", "root")]])

    def flushed(head: dict, tree: OpenTree, at: list, digests: list, rows: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        tree.close()
        kept = pa.concat_arrays(rows)
        upper = [(s["left"], s["right"]) for s in head["witness"]]
        for a in range(0, len(at), ROWS_OUT):
            b = min(a + ROWS_OUT, len(at))
            steps = [tree.witness(i) + upper for i in range(a, b)]
            ends = np.concatenate([[0], np.cumsum([len(s) for s in steps])]).astype(np.int32)
            flat = [step for s in steps for step in s]
            sides = pa.StructArray.from_arrays([pa.array([s[k] for s in flat], pa.string()) for k in (0, 1)], ["left", "right"])
            yield pa.RecordBatch.from_arrays([
                pa.array([head["tree"]] * (b - a), pa.string()), pa.array(at[a:b], pa.int64()), pa.array(digests[a:b], pa.string()), kept.slice(a, b - a),
                pa.ListArray.from_arrays(pa.array(ends), sides), *[pa.array([head[c]] * (b - a), pa.string()) for c in ("subroot", "root")],
            ], names=out.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, tree, at, digests, rows = None, None, [], [], []
        for batch in batches:
            places, texts, levels = (batch.column(c).to_pylist() for c in ("at", "digest", "levels"))
            for a, b in _segments(batch):
                if places[a] < 0:
                    if tree is not None:
                        yield from flushed(head, tree, at, digests, rows)
                    head, tree, at, digests, rows = {c: batch.column(c)[a].as_py() for c in ("tree", "witness", "subroot", "root")}, None, [], [], []
                    a += 1
                if a < b:
                    tree = tree or OpenTree(levels[a])
                    for digest in texts[a:b]:
                        tree.append(digest)
                    at += places[a:b]
                    digests += texts[a:b]
                    rows.append(batch.column("row").slice(a, b - a))
        if tree is not None:
            yield from flushed(head, tree, at, digests, rows)

    return dealt.mapInArrow(run, out)


def witnessed(nodes: DataFrame, finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``nodes`` (tree, at, n, digest, row) with the witness of each up to the top.

    ``finish`` gets the roots of the trees (tree, at, n, digest) and returns (tree, at, witness, subroot, root) for them: what
    their own witnesses are in the tree above. Blocks shrink the nodes 4,096 times a round, so there are few rounds.
    """
    blocked = _blocks(nodes)
    roots = staged(_block_roots(blocked), "merkle-roots")
    if roots.where("at > 0").isEmpty():
        above = finish(roots)
    else:
        above = witnessed(roots.withColumn("row", F.struct(F.lit(True).alias("inner"))), finish).select("tree", "at", "witness", "subroot", "root")
    return _completed(blocked, above)


def _alone(roots: DataFrame) -> DataFrame:
    return roots.select("tree", "at", F.array().cast(WITNESS).alias("witness"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))


def _sources(roots: DataFrame) -> DataFrame:
    """The roots of the sources as leaves of one tree."""
    leaves = roots.select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), "digest")
    leaves = staged(numbered(leaves, "source_tree").withColumn("row", F.struct("source_tree")), "merkle-subroots")
    top = witnessed(leaves, _alone)
    return top.select(F.col("row.source_tree").alias("tree"), F.lit(0).cast("long").alias("at"), "witness", F.col("digest").alias("subroot"), "root")


def manifest(docs: DataFrame, id_column: str = "doc_id", source: str = "source", fields: tuple[str, ...] = FIELDS, **carried: Column) -> DataFrame:
    """Id, leaf, witness (steps from the leaf up), source's root and root of every document, with columns made by ``carried``."""
    tree = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    leaf = leaf_digest(*[F.col(f"`{c}`") for c in fields])
    row = F.struct(F.col(f"`{id_column}`").alias("id"), *[column.alias(name) for name, column in carried.items()])
    leaves = docs.select(tree.alias("tree"), leaf.alias("digest"), row.alias("row")).withColumn("id", F.col("row.id"))
    nodes = staged(numbered(leaves, "id", "digest").drop("id"), "merkle-leaves")
    out = witnessed(nodes, lambda roots: staged(_sources(roots), "merkle-sources"))
    return out.select(F.col("row.id").alias(id_column), F.col("digest").alias("leaf"), "witness", "subroot", "root", *[F.col("row").getField(c).alias(c) for c in carried])


def write_manifest(docs: DataFrame, path: str, **names) -> None:
    """The manifest as files: one row per document with its leaf, its witness and both roots."""
    manifest(docs, **names).write.parquet(path)


# Which documents the check tampers with.
TAMPERED_EVERY = 5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def verified(docs: DataFrame, id_column: str = "doc_id", source: str = "source", text: str = "text", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """The manifest's digests, and whether each document still folds to the root after some texts were lower-cased."""
    changed = [F.translate(F.col(c), UPPER, LOWER) if c == text else F.col(f"`{c}`") for c in fields]
    hit = F.crc32(F.col(id_column).cast("string").cast("binary")) % TAMPERED_EVERY == 0
    tampered = F.when(hit, leaf_digest(*changed))
    out = manifest(docs, id_column, source, fields, tampered_leaf=tampered)
    out = out.withColumn("folded_root", folded(F.coalesce("tampered_leaf", "leaf"), F.col("witness")))
    return out.select(id_column, "leaf", "subroot", "root", F.sha2(proof(F.col("witness")), 256).alias("proof_sha256"), "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
