"""The training-data operators on small hand-made tables, against brute force where SQL does not reach."""

import base64
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from shelfweek.llm import byte_tokens, cross_polytope, curriculum, dom_model, hilbert, line_frequency, quotes, secret_scan, setsketch, url_rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def documents(spark, texts, extra=""):
    data = [(i, t, "en", f"s{i % 3}" if i is not None and i % 5 else None, None if t is None else len(t)) + (("x",) * bool(extra)) for i, t in texts]
    return spark.createDataFrame(data, DOCS + extra)


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns named like results."""
    texts = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (3, "one"), (4, "one"), (None, "a null id here"), (5, prose(random.Random(1), 30_000)), (6, "é 的 \U0001f600 z")]
    return documents(spark, texts, ", kept string").withColumn("size", F.lit("x")).withColumn("key", F.lit(1)).cache()


REPORTS = [
    secret_scan.secret_report, curriculum.mix_report, setsketch.near_duplicates, hilbert.shard_report, line_frequency.line_rules,
    lambda d: byte_tokens.token_report(d, *BPE),
]


@pytest.mark.parametrize("report", REPORTS)
def test_every_row_of_an_odd_table_has_a_result(odd, report):
    assert report(odd).count() == odd.count()
    assert report(odd.limit(0)).count() == 0


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, odd, stage):
    out = stage(spark, odd, "")
    if stage is not corpus_pipeline.token_ids:
        assert out.columns == odd.columns
    out.collect()
    assert stage(spark, odd.limit(0), "").count() == 0


# --- secrets --------------------------------------------------------------------------------------

def test_spans_of_secrets(spark):
    texts = [(1, "é password = 'abcdefgh1' x"), (2, "secret=token: abcdefghij"), (3, "AKIA" + "A1" * 8 + " " + "0af" * 12), (4, "key Zx9Qw3Er7Ty1Ui5Op2Lk8J end"),
             (5, "id 0f8fad5b-d9cd-469f-a165-70867728950e"), (6, "PASSWD:abc")]
    got = {r["doc_id"]: r for r in secret_scan.secret_report(documents(spark, texts)).collect()}
    assert got[1]["spans"] == "assign:2:23" and got[2]["n_assign"] == 0 and got[6]["n_assign"] == 0
    assert got[3]["spans"] == "access:0:20,hex:21:57" and got[5]["spans"] == ""
    assert got[4]["n_entropy"] == 1 and got[4]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert got[1]["base_sha256"] == hashlib.sha256(b"assign:2:23").hexdigest()


def test_window_entropy_equals_brute_force(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdef0123456789XYZ+/") for _ in range(rng.randrange(15, 60))) for _ in range(40)] + ["a1" * 30]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for w, peak in df.select("w", secret_scan.peak_entropy(F.col("w")).alias("p")).collect():
        size = secret_scan.WINDOW
        if len(w) < size:
            assert peak is None
            continue
        best = max(-sum(n / size * math.log2(n / size) for n in Counter(w[i:i + size]).values()) for i in range(len(w) - size + 1))
        assert peak["best"] == pytest.approx(max(best, 0.0), abs=1e-9)


def test_masking_joins_overlapping_spans(spark):
    out = secret_scan.masked(documents(spark, [(1, "see token=" + "0af" * 12 + " now"), (2, "clean")])).orderBy("doc_id").collect()
    assert [r["text"] for r in out] == ["see [SECRET] now", "clean"] and out[0]["n_chars"] == len("see [SECRET] now")


# --- mix ------------------------------------------------------------------------------------------

def reshared(sizes, cap=3):
    """Targets by handing on the excess again and again."""
    weights = {s: 1 + k % 3 for k, s in enumerate(sorted(sizes))}
    full, total = {}, float(sum(sizes.values()))
    while True:
        left, heavy = total - sum(full.values()), sum(w for s, w in weights.items() if s not in full)
        share = {s: left * w / heavy for s, w in weights.items() if s not in full}
        over = {s for s, t in share.items() if t > cap * sizes[s]}
        if not over:
            return {**full, **share}
        full |= {s: float(cap * sizes[s]) for s in over}


def test_targets_and_words_taken(spark):
    rng = random.Random(3)
    data = [(i, prose(rng, rng.randrange(1, 60)), "en", rng.choice(["a"] * 30 + ["b", "c", "d", "e"]), 0) for i in range(400)]
    docs = spark.createDataFrame(data, DOCS)
    sizes = Counter()
    for _, text, _, source, _ in data:
        sizes[source] += len(text.split())
    want, rows = reshared(sizes), {r["doc_id"]: r for r in curriculum.mix_report(docs).collect()}
    taken = Counter()
    for i, _, _, source, _ in data:
        assert rows[i]["target"] == pytest.approx(want[source]) and 0 <= rows[i]["taken"] <= 3 * rows[i]["size"]
        taken[source] += rows[i]["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    copies = curriculum.mixed(docs).collect()
    assert Counter({r["source"]: 0 for r in copies}).keys() == sizes.keys()
    words = Counter()
    for r in copies:
        words[r["doc_id"]] += len(r["text"].split())
    assert all(words[i] == rows[i]["taken"] for i in rows)
    assert {tuple(r) for r in curriculum.mix_report(docs.repartition(7)).collect()} == {tuple(r) for r in rows.values()}


def test_the_report_of_the_mix_is_in_training_order(spark):
    rng = random.Random(5)
    data = [(i, prose(rng, rng.randrange(0, 60)), "en", rng.choice(["a"] * 9 + ["b", "c"]), 0) for i in range(300)]
    rows = curriculum.mix_report(spark.createDataFrame(data, DOCS).repartition(5)).collect()
    places = [r["position"] for r in rows if r["position"] is not None]
    assert len(rows) == 300 and places == sorted(places)
    assert [r["position"] for r in rows[:len(places)]] == places  # documents of which nothing is taken come last


# --- near duplicates ------------------------------------------------------------------------------

def components_of(sets, linked):
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and linked(sets[a], sets[b]):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def near_group(rng, n, words, edits):
    base = prose(rng, words).split()
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("small", [2, 16])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, small):
    """With small buckets set to two members, nearly all links go through stars and blocks."""
    monkeypatch.setattr(setsketch, "SMALL", small)
    monkeypatch.setattr(setsketch, "BLOCK_SHINGLES", 1_500)
    rng = random.Random(4)
    texts = near_group(rng, 70, 60, 14) + near_group(rng, 30, 25, 3) + [prose(rng, 50) for _ in range(20)] + ["A b", "a B", "solo", "SOLO", ""]
    rng.shuffle(texts)
    docs = documents(spark, list(enumerate(texts)))

    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text))
        return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset(w)

    sets = {i: shingles(t) for i, t in enumerate(texts)}
    want = components_of(sets, lambda a, b: bool(a) and bool(b) and 100 * len(a & b) >= 80 * len(a | b))
    got = {r["doc_id"]: r for r in setsketch.near_duplicates(docs).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["n_shingles"] == len(sets[i]) and r["kept"] == (want[i] == i) for i, r in got.items())
    kept = sorted(r["doc_id"] for r in setsketch.one_of_each(docs).collect())
    assert kept == sorted(i for i in want if want[i] == i)


def test_near_dedup_stage_equals_brute_force_of_five_words(spark):
    """Edits at scattered places leave texts similar in pairs of words and not in runs of five; such texts stay."""
    rng = random.Random(13)
    texts = []
    for _ in range(3):
        base = prose(rng, 100).split()
        texts.append(" ".join(base))
        for _ in range(10):
            copy = list(base)
            for at in range(rng.randrange(20), 100, 20):
                copy[at] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    texts += near_group(rng, 30, 100, 5) + ["four words are here", "Four words are here", "solo", ""]
    rng.shuffle(texts)

    def shingles(text, width):
        w = text.lower().split()
        return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()

    def kept(width):
        sets = {i: shingles(t, width) for i, t in enumerate(texts)}
        part = components_of(sets, lambda a, b: bool(a) and bool(b) and 100 * len(a & b) >= 80 * len(a | b))
        return sorted(i for i in part if part[i] == i)

    got = sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, documents(spark, list(enumerate(texts))), "").collect())
    assert got == kept(5) and len(kept(2)) < len(kept(5)) < len(texts)


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 2**63, 3000, dtype=np.uint64), rng.integers(0, 2**63, 1000, dtype=np.uint64)
    both = np.unique(np.concatenate([a, b]))
    assert (setsketch.merged(setsketch.registers(a), setsketch.registers(b)) == setsketch.registers(both)).all()
    rated = setsketch.likely_jaccard(setsketch.registers(a)[None], setsketch.registers(both)[None], np.array([3000.0]), np.array([4000.0]))
    assert rated[0] == pytest.approx(0.75, abs=0.12)


@pytest.mark.parametrize("small", [2, 32])
def test_vector_links_equal_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(cross_polytope, "SMALL", small)
    monkeypatch.setattr(cross_polytope, "BLOCK", 16)
    rng = np.random.default_rng(6)
    center = rng.normal(size=(4, 64))
    vectors = [*(center[k % 4] + 0.2 * rng.normal(size=64) for k in range(120)), *rng.normal(size=(40, 64))]
    vectors = [v.astype(np.float32).astype(float).tolist() for v in vectors]
    vectors += [vectors[0], vectors[0], None, [], [0.0] * 64, [float("nan")] * 64, [None] + vectors[1][1:], [1e30 * x for x in vectors[2]]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    good = {i: np.array(v) / np.linalg.norm(v) for i, v in enumerate(vectors) if v and None not in v and np.isfinite(v).all() and any(v)}
    links = {i: sum(1 for j in good if j != i and good[i] @ good[j] >= 0.95) for i in good}
    want = components_of(good, lambda a, b: a @ b >= 0.95)
    for r in cross_polytope.linked_vectors(df).collect():
        assert r["n_links"] == links.get(r["vec_id"], 0) and r["component_id"] == want.get(r["vec_id"], r["vec_id"])
    assert cross_polytope.linked_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [512, 200])
def test_sparse_chains_of_a_large_bucket_stay_whole(spark, monkeypatch, block):
    """All vectors share their keys; each is linked to the next of its chain only, so links meet in different batches."""
    monkeypatch.setattr(cross_polytope, "BLOCK", block)
    monkeypatch.setattr(cross_polytope, "keys_of", lambda v: np.tile(np.arange(48, dtype=np.int64).reshape(12, 4), (len(v), 1, 1)))
    rng = np.random.default_rng(12)
    vectors = []
    for _ in range(3):
        at = rng.normal(size=64)
        for _ in range(150):
            at /= np.linalg.norm(at)
            vectors.append(at)
            side = rng.normal(size=64)
            side -= (side @ at) * at
            at = 0.96 * at + 0.28 * side / np.linalg.norm(side)
    vectors = [vectors[i] for i in rng.permutation(len(vectors))]
    good = dict(enumerate(vectors))
    want = components_of(good, lambda a, b: a @ b >= 0.95)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in good.items()], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in cross_polytope.linked_vectors(df).collect()}
    assert len(set(want.values())) == 3
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert all(r["kept"] == (want[i] == i) for i, r in got.items())
    assert {i: r["n_links"] for i, r in got.items()} == {i: sum(1 for j in good if j != i and good[i] @ good[j] >= 0.95) for i in good}


# --- quality ----------------------------------------------------------------------------------------

def test_frequent_lines_go_and_copies_do_not_count(spark):
    rng = random.Random(7)
    common = "This Line  is everywhere in the host"
    texts = [(3 * k + 1, f"{prose(rng, 30)}\n{common.upper() if k % 2 else common}") for k in range(40)]
    copies = [(3 * k + 301, "the very same words again and again " + " ".join(f"c{j}" for j in range(30))) for k in range(40)]
    depleted = [(1000, "short start\n" + "\n".join([common] * 6))]
    docs = documents(spark, texts + copies + depleted)
    got = {r["doc_id"]: r for r in line_frequency.line_rules(docs).collect()}
    assert all(got[i]["kept"] for i, _ in texts + copies)
    assert not got[1000]["kept"] and not all(r["kept"] for r in got.values())
    clean = {r["doc_id"]: r for r in line_frequency.clean_documents(docs).collect()}
    assert clean[1]["text"] == texts[0][1].split("\n")[0] and clean[301]["text"] == copies[0][1] and clean[1]["n_chars"] == len(clean[1]["text"])


# --- tokens -----------------------------------------------------------------------------------------

def test_tokens_equal_the_library():
    bpe = byte_tokens.vocabulary(*BPE)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BPE[0], "rb"))}
    library = tiktoken.Encoding("own", pat_str=BPE[1], mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(8)
    parts = ["a", "b", "th", "ing", " ", "  ", "\n", "é", "的", "\U0001f600", "12", "==", "\t", "'s", "aaaa", "\x1c", "\x85", "<|endoftext|>"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(15)))
        ids = bpe.encode(text)
        assert ids.tolist() == library.encode_ordinary(text) and bpe.decode(ids) == text.encode()
        cut = rng.randrange(len(text) + 1)
        assert bpe.append(text[:cut], bpe.encode(text[:cut]), text[cut:]).tolist() == ids.tolist()
    for _ in range(300):
        piece = bytes(rng.choice(b"theringandab") for _ in range(80))
        at, removed, added = rng.randrange(80), rng.randrange(3), rng.choice([b"", b"x", b"er"])
        piece_after, table = bpe.edited(piece, bpe.extend(piece, []), at, removed, added)
        assert table == bpe.extend(piece_after, [])


# --- shards, pages, URLs, quotes ----------------------------------------------------------------------

def test_curve_visits_every_cell_by_single_steps():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    index = hilbert.hilbert_index(grid, 3)
    path = grid[np.argsort(index)]
    assert sorted(index.tolist()) == list(range(512)) and (np.abs(np.diff(path.astype(int), axis=0)).sum(1) == 1).all()


def test_shards_are_even_and_gapless(spark, tmp_path):
    rng = random.Random(9)
    docs = documents(spark, [(i, prose(rng, rng.randrange(1, 50))) for i in range(600)])
    rows = hilbert.shard_report(docs).collect()
    bytes_of = Counter()
    for r in rows:
        bytes_of[r["shard"]] += r["size"]
    assert max(bytes_of.values()) - min(bytes_of.values()) <= 2 * max(r["size"] for r in rows) and set(bytes_of) == set(range(8))
    for shard in bytes_of:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    hilbert.write_shards(docs, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 600


def test_main_text(spark):
    unseen = ("<html><body><div class='topnav'><a href=/>Home</a></div><div id=content><h2>A &lt;title&gt;</h2><p>First  part<br>of it.<p>Second &amp; last <b>part</b>, long enough to be prose.</div>"
              "<div class='comments'><p>I liked this story very much, thank you.</p></div><script>var x='<p>no</p>'</script></body></html>")
    pages = spark.createDataFrame([(1, "u", unseen), (2, "u", None), (3, "u", "<p <<>"), (4, "u", "<article><p>Only this.</article><footer>no</footer>")], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in dom_model.extracted(pages).collect()}
    assert got[1]["text"] == "A <title>\nFirst part of it.\nSecond & last part, long enough to be prose."
    assert got[2]["text"] == "" and got[2]["n_chars"] == 0 and got[4]["text"] == "Only this."
    assert dom_model.extracted(pages.limit(0)).count() == 0


def test_marginals_equal_enumeration():
    page = dom_model.parsed("<div class=a><p>x</p><p>y</p></div><div>z</div>")
    model = dom_model.Model({"tag=p": 0.7, "word=a": -1.2, "tag=div": 0.3}, -0.5, (((-0.1, -2.3), (-3.0, -0.05)), ((-0.2, -1.7), (-0.9, -0.5))))
    n, total, on = len(page.tags), 0.0, [0.0] * len(page.tags)
    for code in range(2 ** n):
        y = [code >> k & 1 for k in range(n)]
        score = model.root * y[0] + sum(model.features.get(f, 0) * y[k] for k, fs in enumerate(dom_model.features(page)) for f in fs)
        weight = math.exp(score + sum(model.pairs[page.tags[k] in dom_model.CONTAINERS][y[page.parents[k]]][y[k]] for k in range(1, n)))
        total += weight
        on = [a + weight * b for a, b in zip(on, y)]
    assert model.marginals(page) == pytest.approx([a / total for a in on])


def test_url_rules(spark):
    urls = [(1, "http://A.Example.org/es/1?x"), (2, "https://example.org/en/19#t"), (3, "x://b.com"), (4, "ftp://b.com/de/?"), (5, None), (6, "no scheme"), (7, "http://notexample.org/es/"), (7, "http://myorg/")]
    got = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_rules.judged(spark.createDataFrame(urls, "page_id long, url string").withColumn("rule", F.lit(0))).collect() if r["page_id"] < 7)
    assert got == [(1, "a.example.org", "/es/1", "example.org/es/", "block"), (2, "example.org", "/en/19", "example.org/en/1", "block"), (3, "b.com", "", None, "allow"),
                   (4, "b.com", "/de/", "com/de/", "block"), (5, "", "", None, "allow"), (6, "", "", None, "allow")]


def test_quotes_link_and_order(spark):
    rows = [(1, 0, "user", "First question here.\nSecond line."), (1, 1, "assistant", "An answer."), (1, 2, "user", "On Monday A wrote:\n> First question here.\n> Second line.\nMore on that."),
            (1, 3, "user", "> More on that.\n>> first  question here.\nDeep."), (2, 0, "user", "> First question here."), (None, None, None, None)]
    out = quotes.threaded(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).where("conv_id is not null").collect()
    got = {(r["conv_id"], r["turn"]): r for r in out}
    assert got[1, 2]["reply_to"] == 0 and got[1, 2]["content"] == "More on that." and got[1, 3]["reply_to"] == 2 and got[1, 3]["thread"] == [0, 2, 3]
    assert got[2, 0]["reply_to"] is None and got[2, 0]["n_quoted"] == 1 and got[1, 1]["depth"] == 0
    assert [r["turn"] for r in out if r["conv_id"] == 1] == [0, 2, 3, 1]
