"""Embedding near-duplicates by cross-polytope hashing after fast Hadamard rotations.

A vector is rotated pseudo-randomly (three rounds of random signs and a fast Hadamard transform); its code is the nearest
vertex of the cross-polytope, that is the largest coordinate and its sign. A table joins ``CODES`` codes into a key, and
probes the keys in which one code is replaced by the second nearest vertex. Vectors that share a key in any table are
candidates and are verified by their cosine in double precision. At the limit of 0.95 a pair shares a key of one table
with probability 0.55, so all tables miss it with probability 0.0001; closer pairs are missed far more rarely.

Equal vectors are one node with a number of copies. Small buckets give pairs; large ones are cut into blocks in which
links are counted by matrix products and never listed: a block returns a count per node and the links that keep its
components together. A pair that meets in several buckets is counted in one of them only.

Defined cases: null, empty and zero vectors, and those with null or non-finite components, link with nothing; vectors of
different lengths never link; repeated rows are copies that link with each other; a null id counts as no id when the
least is taken; an empty table gives an empty result; columns that are not named are neither read nor changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweek.llm.common import staged
from shelfweek.llm.graph import components

TABLES, CODES = 12, 3
SLOTS = CODES + 1  # keys of a table: the nearest vertices, and one replaced at a time
LIMIT = 0.95
SMALL = 32
BLOCK = 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal fast Hadamard transform of rows whose length is a power of two."""
    n, d, h = len(x), x.shape[1], 1
    while h < d:
        pairs = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def keys_of(vectors: np.ndarray) -> np.ndarray:
    """Keys of unit vectors, as (vector, table, slot); the seed depends on the dimension only."""
    n, dim = vectors.shape
    width = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dim] = vectors
    random = np.random.default_rng([7_919, dim])
    out = np.empty((n, TABLES, SLOTS), np.int64)
    rows = np.arange(n)[:, None]
    for table in range(TABLES):
        codes = np.empty((n, CODES, 2), np.uint64)
        for c in range(CODES):
            x = padded
            for _ in range(3):
                x = hadamard(x * random.choice([-1.0, 1.0], width))
            top = np.argpartition(-np.abs(x), 1, axis=1)[:, :2] if width > 2 else np.tile(np.arange(2), (n, 1))
            size = np.abs(x[rows, top])
            top = np.where((size[:, :1] >= size[:, 1:]), top, top[:, ::-1])
            codes[:, c] = (top * 2 + (x[rows, top] > 0)).astype(np.uint64)
        for slot in range(SLOTS):
            key = np.full(n, np.uint64(dim * 1_000 + table), np.uint64)
            for c in range(CODES):
                key = key * np.uint64(2 * width + 1) + codes[:, c, 1 if slot == c + 1 else 0]
                key = (key ^ (key >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            out[:, table, slot] = key.view(np.int64)
    return out


def _matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=dtype).reshape(len(column), -1)


def _nodes(rows: DataFrame) -> DataFrame:
    """(node, root, copies, unit, keys) of the distinct valid vectors."""
    distinct = rows.where("node is not null").groupBy("node").agg(F.min("id").alias("root"), F.count(F.lit(1)).alias("copies"), F.any_value("vector").alias("vector"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.asarray(v, dtype=np.float64) for v in batch.column("vector").to_pylist()]
            unit = [v / np.linalg.norm(v) for v in (v / np.abs(v).max() for v in vectors)]
            keys: list = [None] * len(unit)
            for dim in {len(v) for v in unit}:
                at = [i for i, v in enumerate(unit) if len(v) == dim]
                for i, k in zip(at, keys_of(np.stack([unit[i] for i in at]))):
                    keys[i] = k.ravel()
            yield pa.RecordBatch.from_arrays([
                batch.column("node"), batch.column("root"), batch.column("copies"),
                pa.array(unit, pa.list_(pa.float64())), pa.array(keys, pa.list_(pa.int64())),
            ], names=["node", "root", "copies", "unit", "keys"])

    return distinct.mapInArrow(hashed, "node long, root long, copies long, unit array<double>, keys array<long>")


def _verified(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) with a cosine of at least the limit, and the copies of both."""
    def side(name: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), F.col("copies").alias(f"c{name}"), F.col("unit").alias(f"u{name}"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("ua").to_pylist(), batch.column("ub").to_pylist()
            good = pa.array([len(x) == len(y) and float(np.dot(x, y)) >= LIMIT for x, y in zip(a, b)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(good) for c in ("a", "b", "ca", "cb")], names=["a", "b", "ca", "cb"])

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(check, "a long, b long, ca long, cb long")


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least key that two rows of keys (row, table, slot) share in a table; the largest integer if none."""
    least = np.full(len(a), np.iinfo(np.int64).max)
    for table in range(TABLES):
        same = a[:, table, :, None] == b[:, table, None, :]
        least = np.minimum(least, np.where(same, a[:, table, :, None], np.iinfo(np.int64).max).min(axis=(1, 2)))
    return least


def _block_counts(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
    """Links of one block of a bucket: for each node how many vectors it gains, and a node its component is known by."""
    bucket, i, j = key
    node, copies, chunk = block["node"].to_numpy(), block["copies"].to_numpy(), block["chunk"].to_numpy()
    unit = np.stack(block["unit"].to_list())
    keys = np.stack(block["keys"].to_list()).reshape(len(block), TABLES, SLOTS)
    small = np.stack(block["is_small"].to_list()).reshape(len(block), TABLES, SLOTS)
    # Keys of small buckets and of large ones apart; what doesn't count gets a value of its own on either side.
    small_a, small_b = np.where(small, keys, -1), np.where(small, keys, -2)
    large_a, large_b = np.where(small, -1, keys), np.where(small, -2, keys)
    left, right = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
    gained, root = np.zeros(len(block), np.int64), np.arange(len(block))
    none = np.iinfo(np.int64).max
    for start in range(0, len(left), 64):
        rows = left[start:start + 64]
        x, y = np.nonzero(unit[rows] @ unit[right].T >= LIMIT)
        x, y = rows[x], right[y]
        if i == j:
            x, y = x[node[x] < node[y]], y[node[x] < node[y]]
        mine = _common(large_a[x], large_b[y]) == bucket
        x, y = x[mine], y[mine]
        alone = _common(small_a[x], small_b[y]) == none
        x, y = x[alone], y[alone]
        np.add.at(gained, x, copies[y])
        np.add.at(gained, y, copies[x])
        while (apart := root[x] != root[y]).any():  # join the components of both ends, those of earlier rows as a whole
            x, y = x[apart], y[apart]
            low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
            np.minimum.at(root, high, low)
            while (root != root[root]).any():
                root = root[root]
    return pd.DataFrame({"node": node, "links": gained, "label": node[root]})


def linked_vectors(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For every vector the number of vectors linked to it, its component's least id, and whether that is its own."""
    value = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(value, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    valid = F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.when(valid, value).alias("vector"))
    rows = rows.withColumn("node", F.when(F.col("vector").isNotNull(), F.xxhash64(F.transform("vector", lambda x: x + F.lit(0.0)))))
    nodes = staged(_nodes(rows), "vectors")
    each = nodes.select("node", F.explode("keys").alias("key"))
    shared = each.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    buckets = staged(each.join(shared, "key"), "buckets")

    members = buckets.where(f"members <= {SMALL}").groupBy("key").agg(F.sort_array(F.collect_set("node")).alias("m"))
    pairs = members.select(F.explode(F.flatten(F.transform("m", lambda a, i: F.transform(
        F.slice("m", i + 2, SMALL), lambda b: F.struct(a.alias("a"), b.alias("b")))))).alias("p")).select("p.*").distinct()
    few = staged(_verified(pairs, nodes), "pairs")

    large = buckets.where(f"members > {SMALL}").distinct().withColumn("chunks", F.ceil(F.col("members") / BLOCK).cast("int"))
    touched = large.select("node").distinct()
    smalls = buckets.join(touched, "node", "left_semi").where(f"members <= {SMALL}").groupBy("node").agg(F.collect_set("key").alias("small"))
    payload = nodes.join(touched, "node", "left_semi").join(smalls, "node", "left")
    flags = F.transform("keys", lambda k: F.coalesce(F.array_contains("small", k), F.lit(False)))
    payload = payload.select("node", "copies", "unit", "keys", flags.alias("is_small"))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    spread = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda k: F.struct(F.least(F.col("chunk"), k).alias("i"), F.greatest(F.col("chunk"), k).alias("j")))
    blocks = large.withColumn("chunk", chunk).select("key", "node", "chunk", F.explode(spread).alias("b")).select("key", "node", "chunk", "b.i", "b.j")
    counted = blocks.join(payload, "node").groupBy("key", "i", "j").applyInPandas(_block_counts, "node long, links long, label long")
    many = staged(counted.groupBy("node", "label").agg(F.sum("links").alias("links")), "blocks")

    links = few.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(many.where("node <> label").select(F.col("node").alias("u"), F.col("label").alias("v")))
    parts = components(links)
    gained = few.select(F.col("a").alias("node"), F.col("cb").alias("links")).unionByName(few.select(F.col("b").alias("node"), F.col("ca").alias("links")))
    gained = gained.unionByName(many.select("node", "links")).groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.select("node", "root", "copies").join(gained, "node", "left").join(parts, "node", "left")
    known = staged(known.select("node", "root", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("part")), "known")
    least = known.groupBy("part").agg(F.min("root").alias("least"))
    out = rows.drop("vector").join(known.join(least, "part"), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("least"))
    return out.select(F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))
