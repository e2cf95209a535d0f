"""Quality rules by cross-document line frequency.

Lines are normalised (lower case, white space runs as one blank, trimmed) and hashed. For every host the distinct
texts that hold a line are counted; copies of one text count once, so a document is never boilerplate merely because
it was copied. A line above the host's limit is frequent. Frequent lines are removed, and a document of which hardly
anything remains is rejected.

Defined cases: a null or empty text has no words and fails the base rule; a null host is a host of its own; repeated
rows get equal verdicts; an empty table gives an empty result; columns that are not named are neither read nor changed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfweek.llm.common import SPACE, let, packed, sized, staged, unpacked, words_of

# Limits of the base rule and of the method; the queries use them as they stand.
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8
LIMIT_PERCENT = 2
LIMIT_TEXTS = 10
LEFT_WORDS = 20
LEFT_PERCENT = 30
DOCUMENT_BYTES = 4_000  # of one document, as a rough size for the number of files


def _repeated_words(hashes: Column) -> Column:
    """Words covered by windows of ``WINDOW`` words that occur at least twice in the text."""
    last = F.greatest(F.size(hashes) - WINDOW, F.lit(0))
    windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))

    def covered(marked: Column) -> Column:
        again = F.filter(marked, lambda x, k: (x["h"] == F.get(marked, k - 1)["h"]) | (x["h"] == F.get(marked, k + 1)["h"]))
        return let(
            F.sort_array(F.transform(again, lambda x: x["at"])),
            lambda at: F.aggregate(F.transform(at, lambda v, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - v, F.lit(WINDOW)))),
                                   F.lit(0), lambda total, n: total + n),
        )

    def count(windows: Column) -> Column:
        marked = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(marked, covered))

    return F.when(F.size(hashes) <= WINDOW, F.lit(0)).otherwise(let(windows, count))


def _word_measures(words: Column) -> Column:
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        let(F.transform(words, lambda w: F.xxhash64(w)), _repeated_words).cast("long").alias("n_repeat_words"),
    )


def _dup_lines(text: Column) -> Column:
    with_word = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(with_word, lambda lines: F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def _lines(text: Column) -> Column:
    """Hash and number of words of every line that has words, in order."""
    even = F.split(F.lower(F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " ")), "\n")
    kept = F.filter(F.transform(even, lambda line: F.trim(line)), lambda line: line != "")
    return F.transform(kept, lambda line: F.struct(
        F.xxhash64(line).alias("line"), (F.length(line) - F.length(F.replace(line, F.lit(" "))) + 1).alias("words")))


def _keys(text: Column, host: Column) -> list[Column]:
    return [F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit("")).alias("host"), F.md5(text).alias("key")]


def measured(docs: DataFrame, keep: list[str], text: str = "text", host: str = "source") -> DataFrame:
    """The kept columns beside the measures, the lines and the (host, key) of each document, in one pass over the text."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = let(words_of(body), _word_measures)
    out = docs.select(
        F.struct(*keep).alias("row"), *_keys(body, F.col(host)), words.alias("w"),
        F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        _dup_lines(body).alias("n_dup_lines"), _lines(body).alias("lines"),
    )
    failed = (F.col("w.n_words") < MIN_WORDS) | (100 * F.col("w.n_repeat_words") > MAX_REPEATED_PERCENT * F.col("w.n_words"))
    return out.select("row", "host", "key", "w.*", "n_symbols", "n_dup_lines", "lines", failed.alias("base_failed"))


def frequent_lines(texts: DataFrame, limit_percent: int = LIMIT_PERCENT, limit_texts: int = LIMIT_TEXTS) -> DataFrame:
    """(host, line) in more texts of the host than its limit; ``texts`` has one row per host and key.

    A host's limit is a share of its texts, so it has at most ``100 / limit_percent`` times its mean number of lines
    per text above the limit, however many texts it has. The count needed grows with the host, so a line that many texts
    of a large host share can stay.
    """
    held = texts.select("host", F.explode(F.array_distinct(F.col("lines.line"))).alias("line"))
    counts = held.groupBy("host", "line").count().where(F.col("count") > limit_texts)
    sizes = texts.groupBy("host").agg(F.count(F.lit(1)).alias("texts"))
    return counts.join(sizes, "host").where(100 * F.col("count") > limit_percent * F.col("texts")).select("host", "line")


def _removed(texts: DataFrame, frequent: DataFrame) -> DataFrame:
    """Per text with frequent lines: the words on them and the set of their hashes (at most its own distinct lines)."""
    lines = texts.select("host", "key", F.explode("lines").alias("l")).select("host", "key", "l.line", "l.words")
    hit = lines.join(frequent, ["host", "line"])
    return hit.groupBy("host", "key").agg(F.sum("words").alias("removed"), F.collect_set("line").alias("drop"))


def _judged(docs: DataFrame, keep: list[str], text: str, host: str, limit_percent: int, limit_texts: int) -> DataFrame:
    rows = staged(measured(docs, keep, text, host), "line-measures")
    n, lines = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("lines")), F.lit(0))).first()
    texts = rows.groupBy("host", "key").agg(F.any_value("lines").alias("lines"))
    texts = staged(sized(texts, 1, 60 * n + 12 * lines), "line-texts")
    removed = _removed(texts, frequent_lines(texts, limit_percent, limit_texts))
    joined = rows.drop("lines").join(removed, ["host", "key"], "left").withColumn("removed", F.coalesce("removed", F.lit(0)))
    left = F.col("n_words") - F.col("removed")
    depleted = (F.col("removed") > 0) & (left < LEFT_WORDS) & (100 * left < LEFT_PERCENT * F.col("n_words"))
    return joined.select("*", left.alias("n_left_words"), (~F.col("base_failed") & ~depleted).alias("kept"))


def line_rules(docs: DataFrame, id_column: str = "doc_id", text: str = "text", host: str = "source",
               limit_percent: int = LIMIT_PERCENT, limit_texts: int = LIMIT_TEXTS) -> DataFrame:
    """Measures and verdict of every document."""
    judged = _judged(docs, [id_column], text, host, limit_percent, limit_texts)
    return judged.select(f"row.{id_column}", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "n_left_words", "base_failed", "kept")


def clean_documents(docs: DataFrame, text: str = "text", host: str = "source", n_chars: str | None = "n_chars",
                    limit_percent: int = LIMIT_PERCENT, limit_texts: int = LIMIT_TEXTS) -> DataFrame:
    """The documents that are kept, without their frequent lines; ``n_chars`` follows the text where it was changed."""
    verdicts = _judged(docs, [host], text, host, limit_percent, limit_texts)
    verdicts = verdicts.groupBy("host", "key").agg(F.any_value("kept").alias("kept"), F.any_value("drop").alias("drop"))
    body = F.coalesce(F.col(text), F.lit(""))
    host_key, text_key = _keys(body, F.col(host))
    rows = packed(docs, host=host_key, key=text_key, body=body)
    rows = rows.join(verdicts.where("kept").select("host", "key", "drop"), ["host", "key"])

    def normal(line: Column) -> Column:
        return F.xxhash64(F.trim(F.lower(F.regexp_replace(line, SPACE + "+", " "))))

    stays = F.filter(F.split("body", "\n"), lambda line: ~F.array_contains("drop", normal(line)))
    rows = rows.withColumn("body", F.when(F.col("drop").isNull(), F.col("row").getField(text)).otherwise(F.array_join(stays, "\n")))
    changed = {text: F.col("body")}
    if n_chars is not None and n_chars in docs.columns:
        changed[n_chars] = F.when(F.col("drop").isNull(), F.col("row").getField(n_chars)).otherwise(F.length("body"))
    return sized(unpacked(rows, **changed), docs.count(), DOCUMENT_BYTES)
