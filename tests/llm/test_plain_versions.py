"""Quote linking, shards, vectors, pages and URLs against plain versions, on random and on odd tables."""

import math
import random
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfweek.llm import cross_polytope, dom_model, hilbert, quotes, url_rules

MESSAGES = "conv_id long, turn long, role string, text string"


# --- quotes ---------------------------------------------------------------------------------------

def plain_lines(text):
    lines = []
    for line in re.split("\r?\n", text or ""):
        marks = re.match(r"(?:\x20?>)+\x20?", line)
        lines.append((marks[0].count(">") if marks else 0, line[marks.end():] if marks else line))
    return [(-1 if k + 1 < len(lines) and lines[k + 1][0] > level and re.match(r"(On|Le|Am|El) .{1,200}:\x20*$", text) else level, text)
            for k, (level, text) in enumerate(lines)]


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text).lower().strip(" ")


def plain_passages(lines):
    runs = []
    for level, text in lines:
        if runs and runs[-1][0] == level:
            runs[-1] = (level, runs[-1][1] + "\n" + text)
        else:
            runs.append((level, text))
    return {(level, normal(text)) for level, text in runs + lines if level >= 0 and normal(text)}


def plain_threads(messages):
    said = defaultdict(set)
    for conv, turn, _, text in messages:
        said[conv, turn] |= plain_passages(plain_lines(text))
    parent, linked = {}, {}
    for (conv, turn), passages in said.items():
        if conv is None or turn is None:
            continue
        found = []
        for level, passage in passages:
            origins = [t for (c, t), other in said.items() if c == conv and t is not None and (0, passage) in other]
            if level > 0 and origins and min(origins) < turn:
                found.append((level, -len(passage), -min(origins), passage))
        if found:
            parent[conv, turn], linked[conv, turn] = -min(found)[2], len({f[3] for f in found})
    out = []
    for conv, turn, role, text in messages:
        lines = plain_lines(text)
        own = re.sub(r"\n{3,}", "\n\n", "\n".join(t for level, t in lines if level == 0)).strip(" ")
        thread = [turn]
        while (conv, thread[0]) in parent:
            thread.insert(0, parent[conv, thread[0]])
        out.append((conv, turn, role, own, parent.get((conv, turn)), thread, len(thread) - 1, sum(level > 0 for level, _ in plain_passages(lines)), linked.get((conv, turn), 0),
                    f"<|{role or ''}|>\n{own}"))
    return out


def random_talk(rng, conversations=12):
    rows = []
    for conv in range(conversations):
        bodies = []
        for turn in range(rng.randrange(1, 14)):
            lines = []
            for _ in range(rng.randrange(0, 3)):
                if bodies and rng.random() < 0.8:
                    quoted = rng.choice(bodies[-2:] if rng.random() < 0.7 else bodies).split("\n")
                    start = rng.randrange(len(quoted))
                    if rng.random() < 0.4:
                        lines.append("On Monday somebody wrote:")
                    for line in quoted[start:start + rng.randrange(1, 4)]:
                        mark = rng.choice(["> ", ">", " > "])
                        lines.append(mark + (line.upper() if rng.random() < 0.2 else line.replace(" ", "  ") if rng.random() < 0.2 else line))
                lines.append(" ".join(rng.choice(["yes", "no", "why", "because", "it", "rains"]) for _ in range(rng.randrange(0, 4))))
            bodies.append("\n".join(lines))
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), bodies[-1] if rng.random() < 0.95 else None))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


def shown(rows):
    return sorted((tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in rows), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_quote_links_equal_a_plain_linker(spark, seed):
    rows = random_talk(random.Random(seed))
    want = plain_threads(rows)
    assert max(r[6] for r in want) >= 2 and sum(r[8] for r in want) > 10
    assert shown(quotes.threaded(spark.createDataFrame(rows, MESSAGES).repartition(3)).collect()) == shown(want)


def test_quotes_on_odd_and_empty_tables(spark):
    rows = [(1, 0, "user", "word " * 20_000), (1, 1, "user", "> " + "word " * 20_000 + "\nnew"), (1, 1, "user", "> other"), (None, 0, "user", "> word"), (1, None, None, None),
            (2, 0, "user", ""), (2, 1, "user", ">"), (2, 2, "user", "\n\n\n\n"), (2, 2, "user", "\n\n\n\n")]
    frame = spark.createDataFrame(rows, MESSAGES).withColumns({name: F.lit("x") for name in ("lines", "passages", "thread", "parent", "content", "conv")})
    assert shown(quotes.threaded(frame).collect()) == shown(plain_threads(rows))
    assert quotes.threaded(frame.limit(0)).count() == 0


# --- shards ---------------------------------------------------------------------------------------

def plain_shards(rows, shards=8):
    """(doc_id, size, crc, shard, slot) by one sort of all rows (doc_id, text, lang, source)."""
    def grades(values):
        order = sorted(set(values), key=lambda v: (v is not None, (v or "").encode()))
        return {v: k * 128 // len(order) for k, v in enumerate(order)}

    sources, langs = grades([r[3] for r in rows]), grades([r[2] for r in rows])
    keyed = []
    for doc_id, text, lang, source in rows:
        body = (text or "").encode()
        size, crc = len(body) + 1, zlib.crc32(body)
        point = np.array([[sources[source], langs[lang], min(127, math.floor(4 * math.log2(size)))]])
        hashed = xxhash.xxh64(struct.pack("<q", doc_id), seed=42).intdigest() >> 43 if doc_id is not None else 42 >> 43
        keyed.append((int(hilbert.hilbert_index(point, 7)[0]), crc >> 11, hashed, doc_id is not None, doc_id or 0, size, crc))
    keyed.sort()
    total, before, slots, out = sum(k[5] for k in keyed), 0, defaultdict(int), []
    for *_, known, doc_id, size, crc in keyed:
        shard = min(shards - 1, math.floor((before + size / 2) * shards / total))
        out.append((doc_id if known else None, size, crc, shard, slots[shard]))
        slots[shard] += 1
        before += size
    return sorted(out, key=str)


def shard_docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_shards_equal_a_plain_sort(spark):
    rng = random.Random(5)
    rows = [(i, "x" * rng.choice([0, 1, 5, 80, 900, 4000]) + str(rng.randrange(4)), rng.choice(["en", "de", None]), rng.choice(["hot"] * 20 + ["a", "b", "", None])) for i in range(900)]
    rows += [(2000 + i, "the same text", "en", "hot") for i in range(200)] + [(7, None, None, None), (None, "no id", "en", "a")]
    rng.shuffle(rows)
    got = hilbert.shard_report(shard_docs(spark, rows)).select("doc_id", "size", "text_crc32", "shard", "slot").collect()
    assert sorted(map(tuple, got), key=str) == plain_shards(rows)


def test_shards_of_odd_and_empty_tables(spark):
    rows = [(3, "a", "en", "s"), (3, "a", "en", "s"), (4, None, None, None), (5, "y" * 200_000, "en", "s"), (None, "", "", "")]
    frame = shard_docs(spark, rows).withColumns({name: F.lit("x") for name in ("size", "crc", "key", "block", "row", "id", "shard")})
    got = hilbert.shard_report(frame).select("doc_id", "size", "text_crc32", "shard", "slot").collect()
    assert sorted(map(tuple, got), key=str) == plain_shards(rows)
    assert hilbert.shard_report(frame.limit(0)).count() == 0


def test_a_filter_on_the_metadata_skips_files(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, "x" * rng.randrange(10, 300), rng.choice(["en", "de", "fr", "es"]), f"s{rng.randrange(12):02d}") for i in range(3000)]
    hilbert.write_shards(shard_docs(spark, rows), str(tmp_path / "shards"))
    files = spark.read.parquet(str(tmp_path / "shards")).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("source").alias("s0"), F.max("source").alias("s1"), F.min("lang").alias("l0"), F.max("lang").alias("l1")).collect()
    # Eight shards halve each of the three dimensions, so a source and a language need about a quarter of the files.
    needed = [sum(r["s0"] <= f"s{k:02d}" <= r["s1"] and r["l0"] <= lang <= r["l1"] for r in files) / len(files) for k in range(12) for lang in ("de", "en", "es", "fr")]
    assert len(files) >= 8 and sum(needed) / len(needed) < 0.35


# --- vectors --------------------------------------------------------------------------------------

@pytest.mark.parametrize("dimensions", [64, 256])
def test_pairs_at_the_limit_meet_in_some_table(dimensions):
    """Keys of a pair at a cosine of exactly 0.95: nine pairs in ten must share one at least (all do, of 1,000)."""
    rng = np.random.default_rng(7)
    a = rng.normal(size=(1000, dimensions))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(1, keepdims=True) * a
    b = 0.95 * a + math.sqrt(1 - 0.95**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    keys_a, keys_b = cross_polytope.keys_of(a), cross_polytope.keys_of(b)
    found = np.array([bool(set(x.ravel().tolist()) & set(y.ravel().tolist())) for x, y in zip(keys_a, keys_b)])
    assert found.mean() >= 0.99


def test_vectors_with_clashing_columns(spark):
    vectors = [(1, [1.0] * 64), (2, [1.0] * 64), (2, [1.0] * 64), (None, [0.5] * 64), (3, None)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumns({name: F.lit("x") for name in ("node", "key", "label", "kept", "n_links", "vector")})
    got = sorted(((r["vec_id"], r["n_links"]) for r in cross_polytope.linked_vectors(frame).collect()), key=str)
    assert got == sorted([(1, 3), (2, 3), (2, 3), (None, 3), (3, 0)], key=str)


# --- pages and URLs -------------------------------------------------------------------------------

def test_pages_odd_and_empty(spark):
    story = "<article><p>One story, told here in full.</p></article>"
    long = "<article>" + "".join(f"<p>Paragraph {k} of a long story, told in full.</p>" for k in range(3000)) + "</article>"
    rows = [(1, "u", story), (1, "u", story), (2, None, None), (3, "u", ""), (None, "u", story), (4, "u", long)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({name: F.lit("x") for name in ("text", "n_chars", "row", "body")})
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in dom_model.extracted(frame).collect()), key=str)
    told = "One story, told here in full."
    paragraphs = "\n".join(f"Paragraph {k} of a long story, told in full." for k in range(3000))
    assert got == sorted([(1, told, len(told)), (1, told, len(told)), (2, "", 0), (3, "", 0), (None, told, len(told)), (4, paragraphs, len(paragraphs))], key=str)
    assert dom_model.extracted(frame.limit(0)).count() == 0


def test_urls_odd_and_empty(spark):
    rows = [(1, None), (1, None), (None, "http://a.org/"), (2, ""), (3, "://"), (4, "http://" + "a." * 300 + "com/de/" + "x/" * 500), (5, "http://org"), (6, "HTTP://EXAMPLE.ORG/en/1"), (7, "http://.com/fr/é")]
    frame = spark.createDataFrame(rows, "page_id long, url string").withColumns({name: F.lit("x") for name in ("host", "path", "rule", "verdict", "key", "row")})

    def judged(page, url):
        host, path = "", ""
        if url is not None and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest)[0]
            path = re.match(r"[^?#]*", rest[len(host):])[0]
            host = "".join(c.lower() if c.isascii() else c for c in host)
        fits = [(len(h + p), h + p, v) for h, p, v in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (page, host, path, max(fits)[1], max(fits)[2]) if fits else (page, host, path, None, url_rules.DEFAULT)

    got = [tuple(r[c] for c in ("page_id", "host", "path", "rule", "verdict")) for r in url_rules.judged(frame).collect()]
    assert sorted(got, key=str) == sorted((judged(*r) for r in rows), key=str)
    assert url_rules.judged(frame.limit(0)).count() == 0
