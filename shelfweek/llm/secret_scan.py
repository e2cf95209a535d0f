"""Secret scans: pattern spans and sliding-window entropy spans.

The base spans are the matches of three patterns. The method adds candidate strings (long runs of key characters
with a digit) in which some window of ``WINDOW`` characters has a Shannon entropy above the limit of the candidate's
character class. Window counts are kept incrementally: each step lowers the count of the character that leaves and
raises that of the one that enters, and the entropy sum follows from those two counts alone. Candidates on the allow
list, and candidates that overlap a base span, add nothing. Positions count code points; ends are exclusive.

Defined cases: a null or empty text has no spans; texts of any length are scanned whole; repeated rows give repeated
results; an empty table gives an empty result; columns that are not named are neither read nor changed.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfweek.llm.common import let, unpacked, packed

# The base patterns and the least length of what they match.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
KINDS = ("assign", "access", "hex", "entropy")

# The method's parameters.
ALPHABET = string.ascii_letters + string.digits + "+/_=-"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
CLASS_LIMITS = {"hex": 3.11, "alnum": 3.71, "mixed": 3.86}
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",  # identifiers of rows and files
    r"^/?([a-z]+/)+[A-Za-z0-9_=-]*$",  # paths of lower-case words
    r"^[A-Za-z]*[0-9]+(-[0-9]+)*[A-Za-z]*$",  # one number, with a prefix or suffix of letters: dates, versions, part numbers
    r"(?i)example|sample|placeholder|changeme|x{6,}",
    r"(?i)0123456789|abcdefghij",
)

SPAN = "struct<start int, kind int, end int>"


def _any_case(pattern: str) -> str:
    """The keywords of a pattern in either case, without a flag, so that both engines read it alike."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in pattern)


def assign_pattern() -> str:
    keywords, rest = ASSIGN.split(")", 1)
    return _any_case(keywords) + ")" + rest


def _found(text: Column, pattern: str, kind: int, accept) -> Column:
    """Spans of the accepted, leftmost non-overlapping matches.

    Gaps between matches alternate with the matches, so positions are running sums of their lengths.
    """
    state = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def spans(matches: Column) -> Column:
        steps = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), matches.alias("match"))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["gap"])
            end = start + F.coalesce(F.length(x["match"]), F.lit(0))
            span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
            found = F.when(F.coalesce(accept(x["match"]), F.lit(False)), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
            return F.struct(end.alias("at"), found.alias("spans"))

        kept = F.filter(matches, accept)
        return F.when(F.size(kept) == 0, F.array().cast(f"array<{SPAN}>")).otherwise(F.aggregate(steps, state, step)["spans"])

    none = F.array().cast(f"array<{SPAN}>")
    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)).otherwise(none)


def _bits(count: Column) -> Column:
    """count * log2(count), from a table of the possible counts of one window."""
    table = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(WINDOW + 2)])
    return F.get(table, count)


def peak_entropy(candidate: Column) -> Column:
    """The largest entropy of a window of the candidate, and where its hot windows begin and end; null below one window."""
    codes = F.transform(F.split(candidate, ""), lambda c: F.position(c, F.lit(ALPHABET)))
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"), F.lit(0.0).cast("double").alias("bits"),
        F.lit(0.0).cast("double").alias("best"), F.lit(-1).alias("first"), F.lit(-1).alias("last"),
    )
    limit = class_limit(candidate)

    def scan(codes: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            enter, leave = F.get(codes, i), F.get(codes, i - WINDOW)
            # One character leaves and one enters; when they are the same the counts stay as they are.
            out = F.when(leave.isNull() | (leave == enter), F.lit(0)).otherwise(F.lit(1))
            into = F.when(leave == enter, F.lit(0)).otherwise(F.lit(1))
            n_out, n_in = F.get(acc["counts"], F.coalesce(leave, F.lit(0))), F.get(acc["counts"], enter)
            bits = (acc["bits"] + F.when(out == 1, _bits(n_out - 1) - _bits(n_out)).otherwise(0.0)
                    + F.when(F.coalesce(into, F.lit(1)) == 1, _bits(n_in + 1) - _bits(n_in)).otherwise(0.0))
            counts = F.transform(acc["counts"], lambda n, c: F.when((c == leave) & (out == 1), n - 1)
                                 .when((c == enter) & (F.coalesce(into, F.lit(1)) == 1), n + 1).otherwise(n))
            return let(F.struct(counts.alias("counts"), bits.alias("bits")), lambda new: _mark(acc, new, i, limit))

        steps = F.sequence(F.lit(0), F.greatest(F.size(codes) - 1, F.lit(0)))
        return F.aggregate(steps, start, step, lambda acc: F.struct(acc["best"].alias("best"), acc["first"].alias("first"), acc["last"].alias("last")))

    return F.when(F.length(candidate) >= WINDOW, let(codes, scan))


def _mark(acc: Column, new: Column, i: Column, limit: Column) -> Column:
    entropy = F.lit(math.log2(WINDOW)) - new["bits"] / WINDOW
    full = i >= WINDOW - 1
    hot = full & (entropy >= limit)
    return F.struct(
        new["counts"].alias("counts"), new["bits"].alias("bits"),
        F.when(full, F.greatest(acc["best"], entropy)).otherwise(acc["best"]).alias("best"),
        F.when(hot & (acc["first"] < 0), i - (WINDOW - 1)).otherwise(acc["first"]).alias("first"),
        F.when(hot, i + 1).otherwise(acc["last"]).alias("last"),
    )


def class_limit(candidate: Column) -> Column:
    return (F.when(candidate.rlike("^[0-9a-fA-F]+$"), F.lit(CLASS_LIMITS["hex"]))
            .when(candidate.rlike("^[0-9A-Za-z]+$"), F.lit(CLASS_LIMITS["alnum"])).otherwise(F.lit(CLASS_LIMITS["mixed"])))


def is_candidate(match: Column) -> Column:
    return match.rlike("[0-9]") & match.rlike("[A-Za-z]") & ~match.rlike("|".join(f"({p})" for p in ALLOWED if "(?i)" not in p)) \
        & ~match.rlike("|".join(p for p in ALLOWED if "(?i)" in p))


def _entropy_spans(text: Column, base: Column) -> Column:
    """Hot parts of the candidates that overlap no base span."""
    runs = _found(text, CANDIDATE, KINDS.index("entropy"), is_candidate)

    def hot(run: Column) -> Column:
        peak = peak_entropy(F.substring(text, run["start"] + 1, run["end"] - run["start"]))
        return let(peak, lambda p: F.struct((run["start"] + p["first"]).alias("start"), run["kind"].alias("kind"),
                                            F.when(p["first"] >= 0, run["start"] + p["last"]).alias("end")))

    free = F.filter(runs, lambda r: ~F.exists(base, lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    return F.filter(F.transform(free, hot), lambda s: s["end"].isNotNull())


def _shown(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` as ``row``, with ``base`` and ``spans``: arrays of (start, kind, end) in order."""
    rows = packed(docs, body=F.coalesce(F.col(text), F.lit("")))
    # A match is accepted by its secret part: what follows the keyword, separator and quote.
    value = r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?"""
    base = F.concat(
        _found(F.col("body"), assign_pattern(), 0, lambda m: F.length(F.regexp_replace(m, value, "")) >= ASSIGN_LEAST),
        _found(F.col("body"), ACCESS, 1, lambda m: F.length(m) >= ACCESS_LEAST),
        _found(F.col("body"), "[0-9a-f]{%d,}" % HEX_LEAST, 2, lambda m: F.length(m) >= HEX_LEAST),
    )
    rows = rows.withColumn("base", F.sort_array(base))
    added = _entropy_spans(F.col("body"), F.col("base"))
    return rows.select("row", "body", "base", F.sort_array(F.concat("base", added)).alias("spans"))


def secret_report(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, digest and positions of the spans of every document."""
    found = find_secrets(docs.select(id_column, text), text)

    def n(kind: int, spans: str = "base") -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        f"row.{id_column}", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        n(3, "spans").alias("n_entropy"), F.sha2(_shown(F.col("base")), 256).alias("base_sha256"), _shown(F.col("spans")).alias("spans"),
    )


def masked(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars", mask: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced by ``mask``; overlapping spans are masked as one."""
    found = find_secrets(docs, text)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        begin = F.greatest(s["start"], acc["at"])
        part = F.concat(F.substring("body", acc["at"] + 1, begin - acc["at"]), F.when(s["start"] >= acc["at"], F.lit(mask)).otherwise(F.lit("")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["parts"], F.array(part)).alias("parts"))

    def joined(acc: Column) -> Column:
        return F.concat(F.array_join(acc["parts"], ""), F.substring("body", acc["at"] + 1, F.length("body")))

    clean = F.when(F.size("spans") == 0, F.col("row").getField(text)).otherwise(F.aggregate("spans", start, step, joined))
    changed = {text: clean}
    if n_chars is not None and n_chars in docs.columns:
        changed[n_chars] = F.when(F.size("spans") == 0, F.col("row").getField(n_chars)).otherwise(F.length(clean))
    return unpacked(found, **changed)
