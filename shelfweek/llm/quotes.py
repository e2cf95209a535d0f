"""Chat formatting by quotation linking.

Lines of a message are parsed into quote levels (``>``, nested). Quoted passages are normalised and hashed and joined, in
the same conversation, to the message that first wrote them. A message replies to the message its shallowest, longest
passage comes from. Conversations are returned as rows in reply order (a reply follows what it quotes), without quotes.

Defined cases: a null text is empty; a quote of nothing that was written earlier links to nothing; a message without
linked quotes begins a thread of its own; repeated rows of one turn share the turn's parent and stay apart as rows; null
conversations and turns link to nothing; an empty table gives an empty result; columns that are not named are neither
read nor changed. Reply order needs as many rounds as the logarithm of the longest chain of quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfweek.llm.common import SPACE, let, staged

MARKS = r"^(?:\x20?>)+\x20?"
ATTRIBUTION = r"^(On|Le|Am|El) .{1,200}:\x20*$"
LINE = "struct<level int, text string>"


def parsed(text: Column) -> Column:
    """(level, text) of each line; a line that announces the quote below it counts as part of that quote."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n"), lambda line: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", "")).alias("level"), F.regexp_replace(line, MARKS, "").alias("text")))

    def announced(lines: Column) -> Column:
        return F.transform(lines, lambda x, i: F.struct(
            F.when((F.get(lines, i + 1)["level"] > x["level"]) & x["text"].rlike(ATTRIBUTION), F.lit(-1)).otherwise(x["level"]).alias("level"), x["text"].alias("text")))

    return let(lines, announced)


def _normal(text: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(text, SPACE + "+", " ")))


def passages(lines: Column) -> Column:
    """(level, text) of every run of lines of one level, and of each of its lines, normalised; empty ones are left out."""
    start = F.array().cast(f"array<{LINE}>")

    def step(runs: Column, x: Column) -> Column:
        last = F.get(runs, F.size(runs) - 1)
        grown = F.concat(F.slice(runs, 1, F.greatest(F.size(runs) - 1, F.lit(0))), F.array(F.struct(last["level"].alias("level"), F.concat_ws("\n", last["text"], x["text"]).alias("text"))))
        return F.when(F.coalesce(last["level"] == x["level"], F.lit(False)), grown).otherwise(F.concat(runs, F.array(x)))

    both = F.concat(F.aggregate(lines, start, step), lines)
    normal = F.transform(both, lambda p: F.struct(p["level"].alias("level"), _normal(p["text"]).alias("text")))
    return F.array_distinct(F.filter(normal, lambda p: (p["text"] != "") & (p["level"] >= 0)))


def own_text(lines: Column) -> Column:
    kept = F.filter(lines, lambda x: x["level"] == 0)
    return F.trim(F.regexp_replace(F.array_join(F.transform(kept, lambda x: x["text"]), "\n"), r"\n{3,}", "\n\n"))


def _parents(said: DataFrame) -> DataFrame:
    """(conv, turn, parent, linked) of the turns that quote an earlier one."""
    each = said.select("conv", "turn", F.explode("passages").alias("p")).select("conv", "turn", "p.level", F.length("p.text").alias("size"), F.xxhash64("p.text").alias("hash"))
    # The first message with a passage is its origin: one row per passage, however often it is said.
    origins = each.where("level = 0").groupBy("conv", "hash").agg(F.min("turn").alias("origin"))
    links = each.where("level > 0").join(origins, ["conv", "hash"]).where("origin < turn")
    best = F.min(F.struct("level", (-F.col("size")).alias("size"), (-F.col("origin")).alias("origin"))).alias("best")
    return links.groupBy("conv", "turn").agg(best, F.count_distinct("hash").alias("linked")).select("conv", "turn", (-F.col("best.origin")).alias("parent"), "linked")


def _threads(parents: DataFrame) -> DataFrame:
    """(conv, turn, path): the turns from the beginning of the thread to each turn that has a parent, by doubling."""
    state = staged(parents.select("conv", "turn", F.col("parent").alias("head"), F.array("parent", "turn").alias("path")), "threads")
    while True:
        heads = state.select(F.col("conv").alias("c"), F.col("turn").alias("t"), F.col("head").alias("above"), F.col("path").alias("upper"))
        step = state.join(heads, (F.col("conv") == F.col("c")) & (F.col("head") == F.col("t")), "left")
        if step.where("above is not null").isEmpty():
            return state.select("conv", "turn", "path")
        longer = F.concat("upper", F.slice("path", 2, F.size("path")))
        state = staged(step.select("conv", "turn", F.coalesce("above", "head").alias("head"), F.coalesce(longer, F.col("path")).alias("path")), "threads")


def threaded(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per message in reply order: what it answers, its thread, and its own words as a chat turn."""
    said = messages.select(F.col(conversation).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), parsed(F.col(text)).alias("lines"))
    said = staged(said.select("conv", "turn", "role", own_text(F.col("lines")).alias("content"), passages(F.col("lines")).alias("passages")), "messages")
    parents = staged(_parents(said), "parents")
    paths = _threads(parents).withColumnRenamed("path", "thread")
    out = said.join(parents, ["conv", "turn"], "left").join(paths, ["conv", "turn"], "left")
    thread = F.coalesce("thread", F.array("turn"))
    quoted = F.size(F.filter("passages", lambda p: p["level"] > 0))
    out = out.select(
        F.col("conv").alias(conversation), F.col("turn").alias(turn), F.col("role").alias(role), "content", F.col("parent").alias("reply_to"),
        thread.alias("thread"), (F.size(thread) - 1).alias("depth"), quoted.alias("n_quoted"), F.coalesce("linked", F.lit(0)).cast("long").alias("n_linked"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"), "content").alias("formatted"))
    return out.repartitionByRange(F.col(conversation), F.col("thread")).sortWithinPartitions(conversation, "thread")
