"""Lexical search, the Merkle manifest and packing against plain versions that keep everything in memory."""

import copy
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfweek.llm import lexical, merkle, packing

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = public_tokenizers.path("word_bpe_49k.json")


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en" if i and i % 3 else None, s, None if t is None else len(t)) for i, t, s in texts], DOCS)


def odd_texts():
    rng = random.Random(1)
    return [(0, None, "a"), (1, "", "b"), (2, " \n\t ", None), (3, "One Two", "a"), (3, "One Two", "a"), (4, "one two", ""), (None, "no id HERE", "b"),
            (5, " ".join(f"w{rng.randrange(300)}" for _ in range(30_000)), "a"), (6, "é 的 \U0001f600 Z", None), (7, "two " * 9, "Ä")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns named like the operators' own."""
    frame = documents(spark, odd_texts())
    for name in ("digest", "witness", "score", "rank", "piece", "offset", "row", "id", "block", "term", "body"):
        frame = frame.withColumn(name, F.lit("x"))
    return frame.cache()


# --- search ---------------------------------------------------------------------------------------

def plain_search(docs, items, top=20):
    words = [(i, re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in t or ""))) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n, total, df = len(words), sum(len(w) for _, w in words), Counter(t for _, w in words for t in set(w))
    out = []
    for item, text in items:
        asked = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
        scores = []
        for i, w in words:
            tf, m = Counter(w), 100 - 25 + (25 * len(w) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 12 * m)) for t in asked if tf[t])
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1)]
    return sorted(out, key=str)


def test_search_equals_full_scoring(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(f"t{int(rng.paretovariate(0.7)) % 90}" for _ in range(rng.randrange(1, 60)))) for i in range(400)]
    docs += [(1000 + i, docs[i % 5][1]) for i in range(60)] + [(2000, None), (2001, ""), (2002, "--- !!"), (2003, "É é T1 t1")]
    items = [(i, " ".join(f"T{int(rng.paretovariate(0.5)) % 90}" for _ in range(rng.randrange(1, 25)))) for i in range(25)] + [(25, None), (26, "zzz"), (3, "t1 t1 é"), (3, "t1 t1 é")]
    frames = documents(spark, [(i, t, "a") for i, t in docs]).repartition(7), spark.createDataFrame(items, "item_id int, text string")
    for top in (20, 3, 60):
        got = lexical.top_documents(*frames, top=top)
        assert sorted(map(tuple, got.collect()), key=str) == plain_search(docs, items, top)


def test_search_on_odd_and_empty_tables(spark, odd):
    items = spark.createDataFrame([(1, "two one"), (2, "HERE"), (3, "的 w7")], "item_id int, text string").withColumn("score", F.lit(1))
    got = sorted(map(tuple, lexical.top_documents(odd, items).collect()), key=str)
    assert got == plain_search([(i, t) for i, t, _ in odd_texts()], [(1, "two one"), (2, "HERE"), (3, "的 w7")])
    assert lexical.top_documents(odd.limit(0), items).count() == 0
    assert lexical.top_documents(odd, items.limit(0)).count() == 0


def test_block_search_skips_and_loses_nothing():
    rng = np.random.default_rng(5)
    skipped = 0
    for trial in range(60):
        n_docs, n_terms = 300, 24
        names, postings, counts = [f"t{k}" for k in range(n_terms)], [], []
        for k in range(n_terms):
            where = np.flatnonzero(rng.random(n_docs) < rng.choice([0.02, 0.1, 0.6]))
            postings.append(where)
            counts.append(rng.integers(1, 9, len(where)))
        held = [k for k in range(n_terms) if len(postings[k])]
        block = lexical.BlockSearch.of(np.arange(n_docs), rng.integers(20, 200, n_docs), [names[k] for k in held], [postings[k] for k in held], [counts[k] for k in held], n_docs, 110 * n_docs)
        query = lexical.Query(0, {names[k]: int(rng.integers(0, 5000)) for k in range(n_terms)})
        block.prepare([query])
        full = np.zeros(n_docs, dtype=np.int64)
        for name, w in zip(query.terms, query.weights):
            if name in block.impacts:
                full[block.postings[name][0]] += w * block.impacts[name]
        for a, b in query.pairs:
            joint = [sum(w * block.impacts[t][np.searchsorted(block.postings[t][0], d)] for t, w in ((query.terms[a], query.weights[a]), (query.terms[b], query.weights[b]))
                         if t in block.impacts and d in block.postings[t][0]) for d in range(n_docs)]
            assert block.pair_bound(query.terms[a], query.terms[b], query.weights[a], query.weights[b]) == max(joint)
        for floor in (1, int(np.sort(full)[-20]), int(np.sort(full)[-5])):
            found, scores = block.search(query, floor)
            best = np.sort(full[full > 0])[::-1]
            limit = max(floor, int(best[19]) if len(best) >= 20 else 1)
            assert sorted(found.tolist()) == np.flatnonzero(full >= limit).tolist()
            assert (scores == full[found]).all()
        skipped += int(np.count_nonzero(full)) * 3 - block.added
    assert skipped > 0


def test_index_blocks_hold_every_occurrence(spark):
    docs = documents(spark, [(i, f"a b{i % 3} a", "s") for i in range(50)]).repartition(3)
    index = lexical.indexed(docs).cache()
    assert index.where("term is null").agg(F.sum(F.size("ids"))).first()[0] == 50
    by_term = {r[0]: (r[1], r[2]) for r in index.where("term is not null").groupBy("term").agg(F.sum(F.size("docs")), F.sum(F.expr("aggregate(counts, 0L, (s, x) -> s + x)"))).collect()}
    assert by_term == {"a": (50, 100), "b0": (17, 17), "b1": (17, 17), "b2": (16, 16)}


# --- manifest -------------------------------------------------------------------------------------

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def plain_witness(levels, at):
    steps = []
    for level in levels[:-1]:
        run = at // 16 * 16
        steps.append(("".join(level[run:at]), "".join(level[at + 1:run + 16])))
        at //= 16
    return steps


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, source, lang, n_chars, text)."""
    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def lowered(text):
        return None if text is None else "".join(c.lower() if c.isascii() else c for c in text)

    trees = defaultdict(list)
    for row in rows:
        leaf = h(*map(field, row))
        hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
        trees[row[1]].append((row[0], leaf, h(*map(field, (*row[:4], lowered(row[4])))) if hit else leaf))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for rows_ in trees.values():
        rows_.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    levels = {s: levels_of([r[1] for r in trees[s]]) for s in names}
    top = levels_of([levels[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for at, (doc_id, leaf, tampered) in enumerate(trees[s]):
            steps = plain_witness(levels[s], at) + plain_witness(top, k)
            digest = tampered
            for left, right in steps:
                digest = h(left, digest, right)
            out.append((doc_id, leaf, levels[s][-1][0], top[-1][0], h(*(a + b for a, b in steps)), digest, digest == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257, 700])
def test_open_tree_equals_plain_tree(n):
    leaves = [h(str(i)) for i in range(n)]
    levels = levels_of(leaves)
    tree = merkle.OpenTree(len(levels) - 1)
    for leaf in leaves:
        tree.append(leaf)
    assert tree.close() == levels[-1][0]
    assert [tree.witness(i) for i in range(n)] == [plain_witness(levels, i) for i in range(n)]


def test_witnesses_grow_with_every_append():
    leaves = [h(str(i)) for i in range(300)]
    tree = merkle.OpenTree(3)
    lengths = []
    for n, leaf in enumerate(leaves, 1):
        tree.append(leaf)
        lengths.append(sum(len(a) + len(b) for a, b in tree.witness(0)))
        if n in (1, 5, 16, 40, 256, 300):  # the tree may be closed at any moment; the open one goes on
            closed = copy.deepcopy(tree)
            root = closed.close()
            for at in (0, n // 2, n - 1):
                digest = leaves[at]
                for left, right in closed.witness(at):
                    digest = h(left, digest, right)
                assert digest == root
    assert lengths == sorted(lengths) and len(set(lengths)) > 30


def plain_rows(frame):
    return [tuple(r) for r in frame.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_manifest_equals_plain_trees(spark):
    rng = random.Random(6)
    texts = [(i, f"Text {i} OF words", "hot") for i in range(4200)] + [(i, f"T{i}", rng.choice([None, "", "a", "ä", "Z"])) for i in range(4200, 4600)]
    texts += [(5000 + k, "Lone", f"only {k}") for k in range(20)]
    rng.shuffle(texts)
    docs = documents(spark, texts)
    assert sorted(map(tuple, merkle.verified(docs).collect()), key=str) == plain_manifest(plain_rows(docs))


def test_manifest_on_odd_and_empty_tables(spark, odd):
    got = merkle.verified(odd).collect()
    assert sorted(map(tuple, got), key=str) == plain_manifest(plain_rows(odd))
    assert merkle.verified(odd.limit(0)).count() == 0
    one = merkle.verified(odd.where("doc_id = 7")).collect()[0]
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == h("")


def test_witness_folds_to_the_root_from_files(spark, odd, tmp_path):
    merkle.write_manifest(odd, str(tmp_path / "manifest"))
    for row in spark.read.parquet(str(tmp_path / "manifest")).collect():
        digest = row["leaf"]
        for step in row["witness"]:
            digest = h(step["left"], digest, step["right"])
        assert digest == row["root"]


# --- packing --------------------------------------------------------------------------------------

def fewest_bins(lengths, capacity):
    """The optimum, by search over what the bin of the largest piece holds."""
    @cache
    def best(rest):
        if not rest:
            return 0
        fills = set()

        def fill(at, room, taken):
            fills.add(taken)
            for i in range(at, len(rest)):
                if rest[i] <= room:
                    fill(i + 1, room - rest[i], (*taken, i))

        fill(1, capacity - rest[0], (0,))
        return 1 + min(best(tuple(x for i, x in enumerate(rest) if i not in taken)) for taken in fills)

    return best(tuple(sorted(lengths, reverse=True)))


def bins_of(plan):
    out = defaultdict(list)
    for length, first, count, start, offset in plan.runs:
        for k in range(count):
            out[start + k].append((offset, length))
    return out


def test_reduction_keeps_an_optimum_and_bins_are_gapless():
    rng = random.Random(7)
    reduced = 0
    for _ in range(400):
        capacity = rng.choice([7, 12, 20])
        lengths = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 10))]
        plan = packing.Plan(Counter(lengths), capacity)
        bins = bins_of(plan)
        assert sorted(x for b in bins.values() for _, x in b) == sorted(lengths) and set(bins) == set(range(plan.bins))
        for content in bins.values():
            at = 0
            for offset, length in sorted(content):
                assert offset == at
                at += length
            assert at <= capacity
        rest = [x for b, content in bins.items() if b >= plan.fixed for _, x in content]
        best = fewest_bins(tuple(lengths), capacity)
        assert plan.fixed + fewest_bins(tuple(rest), capacity) == best
        assert best <= plan.bins <= best + 1
        reduced += plan.fixed
    assert reduced > 500


def test_plan_does_not_grow_with_the_counts():
    rng = random.Random(8)
    counts = Counter(min(2048, 1 + int(rng.lognormvariate(6, 1))) for _ in range(4000))
    one, many = packing.Plan(counts), packing.Plan({k: v * 1_000_003 for k, v in counts.items()})
    assert len(many.runs) < 3 * len(one.runs) + 4096
    total = sum(k * v for k, v in counts.items()) * 1_000_003
    assert many.bins < 1.01 * -(-total // 2048)


def check_packing(rows, texts, capacity=packing.CAPACITY):
    tokenizer = Tokenizer.from_file(WORDS)
    wanted = Counter()
    for i, text, _ in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), capacity):
            part = ids[k:k + capacity]
            wanted[i, k // capacity, k, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == wanted
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for content in held.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_packing_holds_every_piece_once(spark, odd):
    assert check_packing(packing.packed_pieces(odd, WORDS).collect(), odd_texts()) >= 1
    assert packing.packed_pieces(odd.limit(0), WORDS).count() == 0
    rng = random.Random(9)
    texts = [(i, " ".join(rng.choice(["the", "Weather's", "naïve,", "x1y2", "的", "don't", "STOP!!", "<|endoftext|>", "áb", "\x1c"]) for _ in range(rng.randrange(0, 900))), "s") for i in range(150)]
    used = check_packing(packing.packed_pieces(documents(spark, texts), WORDS).collect(), texts)
    tokens = sum(len(Tokenizer.from_file(WORDS).encode(t, add_special_tokens=False).ids) + 1 for _, t, _ in texts)
    assert used <= 1.05 * math.ceil(tokens / 2048)


def test_places_within_a_length_are_counted_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_ROWS", 50)
    rows = spark.createDataFrame([(i, 0, 0, 5 if i % 3 else 4, i) for i in range(600)], "id long, piece int, start long, length int, crc long")
    got = packing._ranked(rows, {4: 200, 5: 400}).collect()
    for length in (4, 5):
        places = sorted(r["place"] for r in got if r["length"] == length)
        assert places == list(range(len(places)))


def test_sequences_hold_the_ids(spark, odd):
    tokenizer = Tokenizer.from_file(WORDS)
    got = packing.sequences(odd, WORDS).collect()
    flat = Counter(x for r in got for x in r["ids"])
    assert flat == Counter(x for _, t, _ in odd_texts() for x in [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])
    assert max(len(r["ids"]) for r in got) <= packing.CAPACITY
