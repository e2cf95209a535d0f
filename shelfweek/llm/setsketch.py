"""Near-duplicate detection by SetSketch registers over word shingles.

A register is the exponentially spaced, truncated minimum of exponential variables over the set: with ``x`` the least
variable, ``floor(1 - log_BASE(x))`` between 0 and ``TOP``. Registers of a union are the maxima of the registers, and two
sets agree in a register about as often as they overlap, so bands of registers bring similar sets into one bucket.
Candidates are rated by the joint likelihood of how many registers are equal, larger and smaller, given both sizes, and
those that are not clearly too far apart are confirmed on their full sets.

Distinct sets are the nodes; copies only share their node. Small buckets are compared in full. In a large bucket every
member is compared with one of them first, and components are formed. What is then still apart inside a large bucket
is compared in blocks on full sets, leaving out pairs of one component; a block returns links that join components,
never all its pairs. So a bucket of many near copies costs about its size, and no link between components is lost.

Defined cases: a null text, or one without words, has an empty set and stays alone; one word is a set of one; repeated
rows and rows with equal ids are documents of their own; a null id counts as no id when the least is taken; an empty
table gives an empty result; columns that are not named are neither read nor changed. Sets are known by 64-bit hashes
of their sorted 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfweek.llm.common import packed, sized, staged, unpacked
from shelfweek.llm.graph import components

BANDS, ROWS = 40, 5
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
SHINGLE = 2
PERCENT = 80
# Ratings vary by about 0.03 at the limit; candidates rated lower than this are five deviations below it.
RATED = 0.65
DOCUMENT_BYTES = 4_000  # of one document, as a rough size for the number of files
SMALL = 16  # members of a bucket that is compared in full
BLOCK_SHINGLES = 400_000  # shingles of one side of a block

_RANDOM = np.random.default_rng(20_240_229)
_FACTORS = _RANDOM.integers(1, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(1, 1 << 63, REGISTERS, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles; bytes are lower-cased in A-Z only and split at ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(width, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashed[k:len(words) - size + 1 + k])
    return np.unique(out)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a set: equal sets have equal sketches, and the sketch of a union is the larger of each register."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at:at + 4096]
        for r in range(0, REGISTERS, 8):
            value = part[None, :] * _FACTORS[r:r + 8, None] + _SHIFTS[r:r + 8, None]
            np.minimum(least[r:r + 8], value.min(axis=1), out=least[r:r + 8])
    if not len(hashes):
        return np.zeros(REGISTERS, np.uint16)
    # The least uniform value gives the least exponential one.
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(np.uint16)


def merged(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.maximum(left, right)


def likely_jaccard(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarities of most likelihood, for rows of registers and the sizes of their sets."""
    above, below = (a > b).sum(1), (a < b).sum(1)
    equal = a.shape[1] - above - below
    u = n_a / (n_a + n_b)
    v = 1 - u

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def log_likelihood(j: np.ndarray) -> np.ndarray:
        more, less = np.clip(p(u - v * j), 1e-12, 1), np.clip(p(v - u * j), 1e-12, 1)
        return above * np.log(more) + below * np.log(less) + equal * np.log(np.clip(1 - more - less, 1e-12, 1))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    ratio = (np.sqrt(5) - 1) / 2
    for _ in range(25):  # golden section; the likelihood has one peak
        left, right = high - ratio * (high - low), low + ratio * (high - low)
        rising = log_likelihood(left) < log_likelihood(right)
        low, high = np.where(rising, left, low), np.where(rising, high, right)
    return (low + high) / 2


# --- tables -----------------------------------------------------------------------------------------

def document_key(id_column: str, text: str) -> Column:
    """Id and text as one key: rows that agree in it are repeated rows."""
    return F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(F.col(text), F.lit(""))))


def sketched(docs: DataFrame, id_column: str, text: str, width: int, keep_sets: bool = False) -> DataFrame:
    """(id, key, n, node, registers) of each document, or (node, set) where the sets themselves are wanted."""
    rows = docs.select(F.col(id_column).cast("long").alias("id"), document_key(id_column, text).alias("key"), F.col(text).alias("body"))

    def node(hashes: np.ndarray) -> int:
        return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, width) for t in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("key"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([node(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary()),
            ], names=["id", "key", "n", "node", "registers"])

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, width) for t in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                pa.array([node(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            ], names=["node", "set"])

    if keep_sets:
        return rows.drop("id", "key").mapInArrow(full, "node long, set array<long>")
    return rows.mapInArrow(sketches, "id long, key string, n long, node long, registers binary")


def banded(nodes: DataFrame) -> DataFrame:
    """(key, node, n): one key for each band of a node's registers."""
    factors = _FACTORS[:ROWS]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            r = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(-1, BANDS, ROWS)
            key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), r.shape[:2]).copy()
            for k in range(ROWS):
                key = _mixed(key * factors[k] + r[:, :, k])
            yield pa.RecordBatch.from_arrays([
                pa.array(key.ravel().view(np.int64)), pa.array(np.repeat(batch.column("node").to_numpy(), BANDS)),
                pa.array(np.repeat(batch.column("n").to_numpy(), BANDS)),
            ], names=["key", "node", "n"])

    return nodes.select("node", "n", "registers").mapInArrow(keys, "key long, node long, n long")


def _close_sizes(a: Column, b: Column) -> Column:
    """Sets can only be similar enough if their sizes are."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _candidates(small: DataFrame, large: DataFrame) -> DataFrame:
    """Distinct pairs (a, b): all of a small bucket, and each member of a large one with its first and its last node."""
    members = small.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("node", "n"))).alias("m"))

    def partners(x: Column, i: Column) -> Column:
        later = F.filter(F.slice("m", i + 2, SMALL), lambda y: _close_sizes(x["n"], y["n"]))
        return F.transform(later, lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b")))

    pairs = members.select(F.explode(F.flatten(F.transform("m", partners))).alias("p")).select("p.*")
    stars = large.select(F.explode(F.array("first", "last")).alias("hub"), "node").where("hub <> node")
    return pairs.unionByName(stars.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b"))).distinct()


def _rated(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs that the sizes and the likelihood of their registers do not rule out."""
    both = pairs.join(nodes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb")), "b")
    both = both.join(nodes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra")), "a")
    both = both.where(_close_sizes(F.col("na"), F.col("nb")))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
            good = likely_jaccard(ra, rb, batch.column("na").to_numpy().astype(float), batch.column("nb").to_numpy().astype(float)) >= RATED
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(good)), batch.column("b").filter(pa.array(good))], names=["a", "b"])

    return both.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(rate, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (u, v) among the pairs, by full sets. The set of the rarer side travels; the other waits at its key."""
    left = pairs.join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
    both = left.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return both.where(100 * common >= PERCENT * union).select(F.col("a").alias("u"), F.col("b").alias("v"))


def _block_links(members: pd.DataFrame) -> pd.DataFrame:
    """Links of one block that join components: rows of both sides, or of one side with itself.

    Intersections are counted over the postings of the shingles, so only pairs with something in common cost anything.
    """
    # The component that most of a block belongs to comes last: its members never look for each other.
    sizes, component = members["set"].map(len).to_numpy(), members["component"].to_numpy()
    home = members["home"].to_numpy()
    order = np.argsort(home, kind="stable")
    sets, sizes, component, home, node = [members["set"].iloc[i] for i in order], sizes[order], component[order], home[order], members["node"].to_numpy()[order]
    values = np.concatenate(sets) if len(sets) else np.empty(0, np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    by_value = np.argsort(values, kind="stable")
    values, owner = values[by_value], owner[by_value]
    parent = {c: c for c in set(component.tolist())}

    def root(c):
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    u, v = [], []
    for i in range(len(sets)):
        if home[i]:
            break  # the rest are of one component
        lo, hi = np.searchsorted(values, sets[i], "left"), np.searchsorted(values, sets[i], "right")
        n = hi - lo
        hits = owner[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        common = np.bincount(hits, minlength=len(sets))
        linked = np.flatnonzero(100 * common >= PERCENT * (sizes[i] + sizes - common))
        for j in linked[linked != i].tolist():
            a, b = root(component[i]), root(component[j])
            if a != b:
                parent[max(a, b)] = min(a, b)
                u.append(node[i])
                v.append(node[j])
    return pd.DataFrame({"u": pd.Series(u, dtype="int64"), "v": pd.Series(v, dtype="int64")})


def _open_members(large: DataFrame, parts: DataFrame) -> DataFrame:
    """Members of large buckets that still hold several components, with the blocks they go to.

    Members outside the component of the bucket's first node are strangers. Strangers meet each other and the rest; the
    rest do not meet each other.
    """
    named = large.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    homes = named.where("first = node").select("key", F.col("component").alias("home_component"))
    named = named.join(homes, "key").withColumn("home", F.col("component") == F.col("home_component"))
    weights = named.groupBy("key").agg(
        F.sum(F.when(~F.col("home"), F.col("n")).otherwise(0)).alias("strange"), F.sum(F.when(F.col("home"), F.col("n")).otherwise(0)).alias("known"))
    weights = weights.where("strange > 0").select(
        "key", F.ceil(F.col("strange") / BLOCK_SHINGLES).cast("int").alias("p"), F.greatest(F.lit(1), F.ceil(F.col("known") / BLOCK_SHINGLES)).cast("int").alias("q"))
    dealt = named.join(weights, "key").withColumn(
        "chunk", F.when(F.col("home"), F.pmod(F.xxhash64("node"), F.col("q"))).otherwise(F.pmod(F.xxhash64("node"), F.col("p"))).cast("int"))
    # Blocks of strangers: (i, j) with i <= j. Blocks of strangers i with known chunk j: (i, p + j).
    with_known = F.transform(F.sequence(F.lit(0), F.col("q") - 1), lambda j: F.struct(F.col("chunk").alias("i"), (F.col("p") + j).alias("j")))
    with_strange = F.transform(F.sequence(F.lit(0), F.col("p") - 1), lambda j: F.struct(
        F.least(F.col("chunk"), j).alias("i"), F.greatest(F.col("chunk"), j).alias("j")))
    of_known = F.transform(F.sequence(F.lit(0), F.col("p") - 1), lambda i: F.struct(i.alias("i"), (F.col("p") + F.col("chunk")).alias("j")))
    blocks = F.when(F.col("home"), of_known).otherwise(F.concat(with_strange, with_known))
    return dealt.select("key", "node", "component", "home", F.explode(blocks).alias("b")).select("key", "node", "component", "home", "b.i", "b.j")


def node_components(rows: DataFrame, docs: DataFrame, id_column: str, text: str, width: int) -> DataFrame:
    """(node, component) of the distinct sets that are linked."""
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.min("id").alias("root"), F.any_value("n").alias("n"), F.any_value("registers").alias("registers"))
    nodes = staged(sized(nodes, n, 2 * REGISTERS + 24), "nodes")
    bands = banded(nodes)
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("first"), F.max("node").alias("last"))
    buckets = staged(sized(bands.join(shared.where("members > 1"), "key"), n * BANDS, 40), "buckets")
    large = buckets.where(f"members > {SMALL}")
    # A member of a small bucket meets at most SMALL / 2 others on average, one of a large bucket two.
    pairs = staged(sized(_rated(_candidates(buckets.where(f"members <= {SMALL}"), large), nodes), n * BANDS * SMALL // 2, 16), "pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(large.select("node")).distinct()
    roots = nodes.join(wanted, "node", "left_semi").select(F.coalesce(F.col("root").cast("string"), F.lit("")).alias("root"))
    holders = docs.join(roots.distinct(), F.coalesce(F.col(id_column).cast("string"), F.lit("")) == F.col("root"), "left_semi")
    sets = sketched(holders, id_column, text, width, keep_sets=True).join(wanted, "node", "left_semi")
    sets = staged(sized(sets.groupBy("node").agg(F.any_value("set").alias("set")), total, 8), "sets")
    # A pair brings two sets with it.
    links = staged(sized(_confirmed(pairs, sets), pairs.count(), 16 * (1 + total // max(n, 1))), "confirmed")
    count = links.count()
    parts = staged(sized(components(links), 2 * count, 16), "parts")
    meeting = _open_members(large, parts).join(sets, "node").select("key", "i", "j", "node", "component", "home", "set")
    more = staged(meeting.groupBy("key", "i", "j").applyInPandas(_block_links, "u long, v long"), "block-links")
    added = more.count()
    if not added:
        return parts
    return staged(sized(components(links.unionByName(more)), 2 * (count + added), 16), "parts")


def _assigned(docs: DataFrame, id_column: str, text: str, width: int) -> DataFrame:
    """(id, key, n, part) of each document; documents of one part belong together, and those without words have none."""
    docs = docs.select(id_column, text)
    rows = staged(sketched(docs, id_column, text, width), "sketches")
    parts = node_components(rows, docs, id_column, text, width)
    joined = rows.drop("registers").join(parts, "node", "left")
    return joined.select("id", "key", "n", F.coalesce("component", "node").alias("part"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """For every document the size of its set, the least id it is linked to by any path, and whether that is its own."""
    rows = staged(_assigned(docs, id_column, text, width), "assigned")
    least = rows.where("part is not null").groupBy("part").agg(F.min("id").alias("least"))
    out = rows.join(least, "part", "left").withColumn("component_id", F.when(F.col("part").isNull(), F.col("id")).otherwise(F.col("least")))
    return out.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """The documents with one of each group of near duplicates: the one of the least id; documents without words all stay."""
    rows = _assigned(docs, id_column, text, width)
    n = docs.count()
    rows = staged(sized(rows, n, 120), "assigned")
    best = rows.where("part is not null").groupBy("part").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("best"))
    stay = best.select(F.col("best.key").alias("key"), F.lit(True).alias("single"))
    stay = stay.unionByName(rows.where("part is null").select("key", F.lit(False).alias("single")).distinct())
    found = packed(docs, key=document_key(id_column, text)).join(stay, "key")
    # Repeated rows share a key; of a group with words only one row stays.
    single = found.where("single").groupBy("key").agg(F.any_value("row").alias("row")).select("row")
    return unpacked(sized(single.unionByName(found.where("not single").select("row")), n, DOCUMENT_BYTES))
