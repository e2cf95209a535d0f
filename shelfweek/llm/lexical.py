"""Ranked lexical search by MaxScore with pair bounds.

The index is cut into blocks of documents. A block holds, for every term, the documents it occurs in and how often.
Scores need the number of documents, of term occurrences and of documents per term, which are summed over all blocks.

A query visits every block once. The score of a document is the sum of its terms' impacts. Before a block is searched,
the intersection list of every pair of neighbouring terms (neighbours by weight) is formed, once for all queries that
share the pair: the documents that hold both, with their two impacts and the largest joint one. A pair then adds no more
than that, or the impact of one term alone, where independent maxima would add up. Terms are visited from the highest bound down; once the bounds of
the remaining pairs cannot lift a new document to the ``TOP``-th score found so far, no new candidates are admitted, and
candidates that cannot reach it any more are dropped. What is skipped is below the result for certain, so the result
equals full scoring; equal scores are kept and settled by the id.

Blocks return their own best ``TOP`` documents for each query, which are ranked again. Queries are taken in batches of a
bounded number of terms.

Defined cases: a null text, or one without terms, is no document; a query without terms has no rows; a term repeated in a
query counts each time; repeated items are queries of their own; documents with equal ids and scores are ordered
arbitrarily but each keeps its own rank, null ids come last; an empty table gives an empty result; columns that are not
named are neither read nor changed.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfweek.llm.common import staged

TOP = 20
BLOCK_DOCS = 8192
BLOCK_TERMS = 4_000_000  # occurrences after which a block is closed, whatever its number of documents
BATCH_TERMS = 200_000  # term occurrences of the queries of one batch
ROWS_OUT = 50_000
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all characters beyond ASCII; only A-Z are lower-cased."""
    return TERM.findall((text or "").encode("utf-8", "surrogatepass").lower())


# --- the index --------------------------------------------------------------------------------------

INDEX = "block string, term string, docs array<int>, counts array<int>, ids array<long>, sizes array<int>"


class _Block:
    """Documents gathered until the block is full."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.numbers: dict[bytes, int] = {}
        self.found: list[np.ndarray] = []
        self.total = 0

    def add(self, id_: int | None, words: list[bytes]) -> None:
        number = self.numbers
        for word in set(words).difference(number):
            number[word] = len(number)
        self.found.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
        self.ids.append(id_)
        self.sizes.append(len(words))
        self.total += len(words)

    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCS or self.total >= BLOCK_TERMS

    def rows(self, name: str) -> Iterator[pa.RecordBatch]:
        """One row with the documents (its term is null), then one row for each term."""
        def lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.astype(np.int32)))

        columns = ["block", "term", "docs", "counts", "ids", "sizes"]
        none = pa.nulls(1, pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([
            pa.array([name]), pa.nulls(1, pa.string()), none, none, pa.array([self.ids], pa.list_(pa.int64())), pa.array([self.sizes], pa.list_(pa.int32()))], names=columns)
        key = np.concatenate(self.found).astype(np.int64) * len(self.ids) + np.repeat(np.arange(len(self.ids)), self.sizes)
        self.found = []
        key, count = np.unique(key, return_counts=True)
        doc = key % len(self.ids)
        start = np.searchsorted(key // len(self.ids), np.arange(len(self.numbers) + 1))
        words = list(self.numbers)
        for a in range(0, len(words), ROWS_OUT):
            b = min(a + ROWS_OUT, len(words))
            ends, part = start[a:b + 1] - start[a], slice(start[a], start[b])
            yield pa.RecordBatch.from_arrays([
                pa.array([name] * (b - a)), pa.array(words[a:b], pa.binary()).cast(pa.string()), lists(doc[part], ends), lists(count[part], ends),
                pa.nulls(b - a, pa.list_(pa.int64())), pa.nulls(b - a, pa.list_(pa.int32()))], names=columns)


def indexed(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of all documents with terms; blocks are named by the task that wrote them."""
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("body"), F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, n, part = _Block(), 0, 0
        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
            bodies = batch.column("body")
            for i, id_ in enumerate(batch.column("id").to_pylist()):
                words = terms(bodies[i].as_py())
                if words:
                    block.add(id_, words)
                if block.full():
                    yield from block.rows(f"{part}-{n}")
                    block, n = _Block(), n + 1
        if block.ids:
            yield from block.rows(f"{part}-{n}")

    return rows.mapInArrow(run, INDEX)


# --- search -----------------------------------------------------------------------------------------

class Query:
    """Distinct terms with their weights (times repeats), the heaviest first."""

    def __init__(self, number: int, weights: dict[str, int]):
        self.number = number
        self.terms = sorted(weights, key=lambda t: (-weights[t], t))
        self.weights = [weights[t] for t in self.terms]
        self.pairs = list(zip(range(0, len(self.terms) - 1, 2), range(1, len(self.terms), 2)))


class BlockSearch:
    """The postings of one block that a batch of queries needs."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, postings: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.ids, self.lengths, self.postings = ids, lengths, postings
        self.impacts: dict[str, np.ndarray] = {}
        self.both: dict[tuple[str, str], tuple[np.ndarray, np.ndarray]] = {}  # impacts of both terms in the documents that hold both
        self.joint: dict[tuple[str, str, int, int], int] = {}
        self.added = 0  # documents that stayed candidates to the end, of all queries

    @classmethod
    def of(cls, ids, sizes, terms_, docs, counts, n: int, total: int) -> BlockSearch:
        size = np.asarray(sizes, dtype=np.int64)
        m = 100 - 25 + (25 * size * n) // total
        block = cls(np.asarray(ids), m, {})
        for term, where, count in zip(terms_, docs, counts):
            where, count = np.asarray(where, dtype=np.int64), np.asarray(count, dtype=np.int64)
            block.postings[term] = where, count
            block.impacts[term] = (1_000_000_000 * count) // (1000 * count + 12 * m[where])
        return block

    def bound(self, term: str, weight: int) -> int:
        return weight * int(self.impacts[term].max()) if term in self.impacts else 0

    def prepare(self, queries: list[Query]) -> None:
        """Form the intersection lists of all pairs that the queries have."""
        for a, b in {(q.terms[i], q.terms[j]) for q in queries for i, j in q.pairs}:
            if a in self.impacts and b in self.impacts:
                _, in_a, in_b = np.intersect1d(self.postings[a][0], self.postings[b][0], assume_unique=True, return_indices=True)
                self.both[a, b] = self.impacts[a][in_a], self.impacts[b][in_b]

    def pair_bound(self, a: str, b: str, wa: int, wb: int) -> int:
        """The most that two terms add to any document of the block: jointly in the intersection, or one alone."""
        key = a, b, wa, wb
        if key not in self.joint:
            best = max(self.bound(a, wa), self.bound(b, wb))
            impact_a, impact_b = self.both.get((a, b), ((), ()))
            self.joint[key] = max(best, int((wa * impact_a + wb * impact_b).max())) if len(impact_a) else best
        return self.joint[key]

    def search(self, query: Query, floor: int, top: int = TOP) -> tuple[np.ndarray, np.ndarray]:
        """(document, score) that may be among the best ``top`` of all blocks, given that ``top`` documents reach ``floor``."""
        groups = [[a, b] for a, b in query.pairs] + ([[len(query.terms) - 1]] if len(query.terms) % 2 else [])
        bounds = [self.pair_bound(*(query.terms[i] for i in g), *(query.weights[i] for i in g)) if len(g) == 2 else self.bound(query.terms[g[0]], query.weights[g[0]])
                  for g in groups]
        order = sorted(range(len(groups)), key=lambda k: -bounds[k])
        rest = sum(bounds)
        scores = np.zeros(len(self.ids), dtype=np.int64)
        alive: np.ndarray | None = None  # None while every document may still enter
        for k in order:
            if rest < floor and alive is None:
                alive = np.flatnonzero(scores > 0)
            if alive is not None:
                alive = alive[scores[alive] + rest >= floor]
                if not len(alive):
                    break
            for i in groups[k]:
                if query.terms[i] in self.impacts:
                    self._add(scores, alive, query.terms[i], query.weights[i])
            rest -= bounds[k]
            # Scores only grow: what ``top`` documents have already is a floor, too.
            so_far = scores if alive is None else scores[alive]
            if len(so_far) >= top:
                floor = max(floor, int(np.partition(so_far, len(so_far) - top)[len(so_far) - top]))
        alive = np.flatnonzero(scores > 0) if alive is None else alive
        self.added += len(alive)
        alive = alive[scores[alive] >= floor]
        if len(alive) > top:
            least = np.partition(scores[alive], len(alive) - top)[len(alive) - top]
            alive = alive[scores[alive] >= least]
        return alive, scores[alive]

    def _add(self, scores: np.ndarray, alive: np.ndarray | None, term: str, weight: int) -> None:
        where, impact = self.postings[term][0], self.impacts[term]
        if alive is None or 8 * len(alive) > len(where):
            scores[where] += weight * impact  # documents that are not alive are never read again
        else:
            at = np.searchsorted(where, alive)
            at[at == len(where)] = 0
            hit = where[at] == alive
            scores[alive[hit]] += weight * impact[at[hit]]


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _best(block: BlockSearch, queries: list[Query], floors: dict[int, list[int]], top: int) -> Iterator[tuple[int, int, int]]:
    for query in queries:
        seen = floors.setdefault(query.number, [])
        found, scores = block.search(query, seen[0] if len(seen) >= top else 1, top)
        # Equal scores beyond the last place are settled by the id, within the block and later among blocks.
        ids = block.ids[found]
        order = np.lexsort((ids, pd.isna(ids), -scores) if ids.dtype != object else (np.array([i or 0 for i in ids]), [i is None for i in ids], -scores))[:top]
        floors[query.number] = sorted(sorted(seen + scores[order].tolist(), reverse=True)[:top])
        for k in order.tolist():
            yield query.number, ids[k], int(scores[k])


def ranked(index: DataFrame, items: DataFrame, id_column: str = "item_id", text: str = "text", doc_column: str = "doc_id", top: int = TOP) -> DataFrame:
    """The ``top`` documents of each item: (item, rank, document, score)."""
    spark = index.sparkSession
    heads = index.where("term is null")
    n, total = heads.agg(F.coalesce(F.sum(F.size("sizes")), F.lit(0)), F.coalesce(F.sum(F.expr("aggregate(sizes, 0L, (s, x) -> s + x)")), F.lit(0))).first()
    item_type = items.schema[id_column].dataType.simpleString()
    results = []
    for batch in _batches(items.select(id_column, text)):
        wanted = sorted({t for _, counted in batch for t in counted})
        if not wanted or not n:
            continue
        # At most BATCH_TERMS terms: a few megabytes, so the index is filtered where it lies.
        words = F.broadcast(spark.createDataFrame([(t,) for t in wanted], "term string"))
        postings = staged(index.where("term is not null").join(words, "term", "left_semi").unionByName(heads), "postings")
        frequency = {r["term"]: r["df"] for r in postings.where("term is not null").groupBy("term").agg(F.sum(F.size("docs")).alias("df")).collect()}
        queries = [Query(number, {t: c * weight(n, frequency[t]) for t, c in counted.items() if t in frequency}) for number, (_, counted) in enumerate(batch)]
        names = spark.createDataFrame([(number, item) for number, (item, _) in enumerate(batch)], f"query int, {id_column} {item_type}")
        found = _searched(postings, [q for q in queries if q.terms], n, total, top)
        best = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
        placed = staged(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top), "ranked")
        results.append(placed.join(names, "query").select(id_column, "rank", F.col("id").alias(doc_column), "score"))
    if not results:
        return spark.createDataFrame([], f"{id_column} {item_type}, rank int, {doc_column} long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _batches(items: DataFrame) -> Iterator[list[tuple[object, dict[str, int]]]]:
    """Queries with the counts of their terms, read one partition at a time, in batches of BATCH_TERMS occurrences."""
    batch, size = [], 0
    for item, text in items.toLocalIterator():
        counted: dict[str, int] = {}
        for term in terms(text):
            counted[term.decode()] = counted.get(term.decode(), 0) + 1
        batch.append((item, counted))
        size += sum(counted.values())
        if size >= BATCH_TERMS:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def _searched(postings: DataFrame, queries: list[Query], n: int, total: int, top: int) -> DataFrame:
    """(query, id, score): the best of every block. Blocks of a task follow each other, and the scores found raise the floor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors: dict[int, list[int]] = {}
        name, parts = None, []
        for batch in batches:
            names = batch.column("block").to_pylist()
            start = 0
            for i in range(1, len(names) + 1):
                if i == len(names) or names[i] != names[start]:
                    if names[start] != name and parts:
                        yield _answers(parts, queries, n, total, floors, top)
                        parts = []
                    name = names[start]
                    parts.append(batch.slice(start, i - start))
                    start = i
        if parts:
            yield _answers(parts, queries, n, total, floors, top)

    dealt = postings.repartition("block").sortWithinPartitions("block", "term")
    return dealt.mapInArrow(run, "query int, id long, score long")


def _answers(parts: list[pa.RecordBatch], queries: list[Query], n: int, total: int, floors: dict[int, list[int]], top: int) -> pa.RecordBatch:
    rows = pa.Table.from_batches(parts)
    head = rows.filter(pc.is_null(rows["term"]))
    held = rows.filter(pc.is_valid(rows["term"]))
    ids = head["ids"][0].values
    ids = np.array(ids.to_pylist(), dtype=object) if ids.null_count else ids.to_numpy()

    def lists(column: str) -> list[np.ndarray]:
        return [x.values.to_numpy() for x in held[column]]

    block = BlockSearch.of(ids, head["sizes"][0].values.to_numpy(), held["term"].to_pylist(), lists("docs"), lists("counts"), n, total)
    block.prepare(queries)
    found = list(_best(block, queries, floors, top))
    query, id_, score = zip(*found) if found else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array([None if i is None else int(i) for i in id_], pa.int64()), pa.array(score, pa.int64())],
                                      names=["query", "id", "score"])


def top_documents(docs: DataFrame, items: DataFrame, doc_column: str = "doc_id", text: str = "text", item_column: str = "item_id", item_text: str = "text",
                  top: int = TOP) -> DataFrame:
    """The best ``top`` documents of each item, out of all documents."""
    return ranked(staged(indexed(docs, doc_column, text), "index"), items, item_column, item_text, doc_column, top)
