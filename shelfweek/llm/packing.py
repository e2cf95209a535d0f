"""Best-fit packing of token sequences after Martello-Toth dominance reduction.

Only lengths decide how things fit, and a length is a whole number up to the capacity. So the instance is the count of
pieces of every length: a table of at most ``capacity`` rows, whatever the size of the corpus. On it

* the reduction permanently fixes bins that dominate all others for their largest piece: a piece that nothing fits
  beside, a piece with the largest one that fits when that fills the bin or when no two others fit, and a piece with the
  two that are the best choice for both places when no three others fit. Each step fixes as many equal bins as there are
  copies and shrinks the instance, until no step applies;
* the rest goes best-fit in decreasing order, all pieces of a length at once: into the fullest bins with room for one.

Bins of equal contents are runs of numbers, so the plan is a list of runs (length, first place, count, first bin, offset)
whose number depends on the capacity, never on the corpus. Pieces are then numbered within their length, in blocks, and
look their bin up in the plan.

Defined cases: a null or empty text has the end token only; texts of any length are cut into pieces of the capacity;
rows with equal ids and repeated rows are pieces of their own; null ids stay null; an empty table gives an empty result;
columns that are not named are neither read nor changed.
"""

from __future__ import annotations

import re
import string
import struct
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfweek.llm.common import staged

CAPACITY = 2048
END = 0
BLOCK_ROWS = 1_000  # pieces of one length that are numbered together, on average
REMEMBERED = 800_000  # words that a worker remembers before it starts afresh
TEXTS = 32  # texts whose new words are encoded together
LONG_WORD = 60
# Words of Latin letters, with punctuation behind them but for apostrophes.
LETTERS = "".join(map(chr, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
TAIL = "".join(c for c in string.punctuation if c not in "'_")
SIMPLE = re.compile(f"([{LETTERS}]{{1,60}})([{re.escape(TAIL)}]{{0,8}})")


# --- tokens -----------------------------------------------------------------------------------------

class Words:
    """Ids of words, packed as bytes.

    The tokenizer cuts at ASCII white space and looks at nothing beyond it, so the ids of a text are those of its words
    in turn. Words not seen before are encoded together; the offsets tell whose each id is. Where the tokenizer treats
    letters and the punctuation behind them as its model does their lower case, such words go to the model at once.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.stems: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        # What the model is given for a letter.
        self.shown = {ord(c): "".join(piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(c)) for c in LETTERS.lower()}
        self.simple = all(
            self._whole(word + tail) == self._stem(word.lower()) + (self._whole(tail) if tail else b"")
            for word in ("A", "of", "Weather", "eronthwhreer", LETTERS, LETTERS[::-1]) for tail in ("", *TAIL, TAIL, TAIL[::-1]))

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _stem(self, word: str) -> bytes:
        ids = [token.id for token in self.tokenizer.model.tokenize(word.translate(self.shown))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def learn_simple(self, words: list[bytes]) -> list[bytes]:
        """Learns the words of letters and punctuation behind them; returns the others."""
        rest = []
        for word in words:
            match = SIMPLE.fullmatch(word.decode())
            if match is None:
                rest.append(word)
                continue
            stem, tail = match.groups()
            stem = stem.lower()
            if (ids := self.stems.get(stem)) is None:
                ids = self.stems[stem] = self._stem(stem)
            if tail:
                if tail not in self.tails:
                    self.tails[tail] = self._whole(tail)
                ids += self.tails[tail]
            self.known[word] = ids
        return rest

    def learn(self, words: list[bytes]) -> None:
        if self.simple:
            words = self.learn_simple(words)
        if not words:
            return
        got = self.tokenizer.encode(b" ".join(words).decode(), add_special_tokens=False)
        ids = np.array(got.ids, dtype="<u4").tobytes()
        starts = np.array([start for start, _ in got.offsets], dtype=np.int64)
        sizes = np.array([len(w.decode()) for w in words], dtype=np.int64)
        ends = 4 * np.searchsorted(starts, np.cumsum(sizes + 1), "left")
        at = 0
        for word, end in zip(words, ends.tolist()):
            self.known[word] = ids[at:end]
            at = end

    def ids(self, texts: list[str]) -> list[bytes]:
        if len(self.known) + len(self.stems) > REMEMBERED:
            self.known.clear()
            self.stems.clear()
            self.tails.clear()
        split = [text.encode().split() for text in texts]
        new = set().union(*split).difference(self.known)
        long = [w for w in new if len(w) > LONG_WORD]
        self.learn(list(new))
        out = [b"".join(map(self.known.__getitem__, words)) for words in split]
        for word in long:
            del self.known[word]
        return out


_LOADED: dict[str, Words] = {}


def pieces(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, crc[, ids]): the ids of each document and the end token, cut where they exceed the capacity."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("body"))
    end = np.array([END], dtype="<u4").tobytes()
    measures = [(lambda d: len(d) // 4, pa.int32()), (zlib.crc32, pa.int64())] if with_ids else [(lambda d: d[0], pa.int32()), (lambda d: d[1], pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _LOADED:
            _LOADED[path] = Words(path)
        words = _LOADED[path]
        for batch in batches:
            at, data, number = [], [], []
            for first in range(0, batch.num_rows, TEXTS):
                bodies = batch.column("body").slice(first, TEXTS).to_pylist()
                for i, ids in enumerate(words.ids([body or "" for body in bodies]), first):
                    ids += end
                    cut = [ids[k:k + 4 * capacity] for k in range(0, len(ids), 4 * capacity)]
                    at += [i] * len(cut)
                    data += cut if with_ids else [(len(d) // 4, zlib.crc32(d)) for d in cut]
                    number += range(len(cut))
            index = np.array(number, dtype=np.int32)
            columns = [
                batch.column("id").take(pa.array(at, pa.int32())), pa.array(index), pa.array(index.astype(np.int64) * capacity),
                *(pa.array([f(d) for d in data], kind) for f, kind in measures),
            ]
            names = ["id", "piece", "start", "length", "crc"]
            if with_ids:
                ends = np.concatenate([[0], np.cumsum([len(d) // 4 for d in data])]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(data), dtype=np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, piece int, start long, length int, crc long" + (", ids array<int>" if with_ids else ""))


# --- the plan, on counts of lengths -----------------------------------------------------------------

class Plan:
    """Runs (length, first place, count, first bin, offset): the pieces of a length at these places go to these bins."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = np.zeros(capacity + 1, dtype=np.int64)
        for length, count in counts.items():
            self.left[length] = count
        self.used = np.zeros(capacity + 1, dtype=np.int64)
        self.bins = 0
        self.runs: list[tuple[int, int, int, int, int]] = []
        self.reduce()
        self.fixed = self.bins
        self.best_fit()

    def place(self, length: int, count: int, first_bin: int, offset: int) -> None:
        self.runs.append((length, int(self.used[length]), count, first_bin, offset))
        self.used[length] += count
        self.left[length] -= count

    def fix(self, count: int, *lengths: int) -> None:
        """``count`` new bins of these lengths."""
        offset = 0
        for length in lengths:
            self.place(length, count, self.bins, offset)
            offset += length
        self.bins += count

    def times(self, *lengths: int) -> int:
        """How often these lengths can be taken together."""
        return min(int(self.left[x]) // lengths.count(x) for x in set(lengths))

    def largest(self, limit: int, *taken: int) -> int:
        """The largest length up to ``limit`` of which there is a copy beside the taken ones; 0 if none."""
        for length in np.flatnonzero(self.left[:max(limit, 0) + 1])[::-1].tolist():
            if self.left[length] > taken.count(length):
                return length
        return 0

    def smallest(self, n: int, taken: int) -> list[int]:
        """The ``n`` smallest pieces beside one of length ``taken``."""
        found: list[int] = []
        for length in np.flatnonzero(self.left).tolist():
            found += [length] * min(n - len(found), int(self.left[length]) - (length == taken))
            if len(found) >= n:
                break
        return found

    def dominating(self, length: int) -> tuple[int, ...] | None:
        """Lengths of a bin that dominates all others that hold a piece of this length, or None."""
        room = self.capacity - length
        partner = self.largest(room, length)
        if not partner:
            return (length,)
        least = self.smallest(3, length)
        # A full pair takes the place of any set beside the piece; if only one more fits, the largest is the best one.
        if partner == room or len(least) < 2 or least[0] + least[1] > room:
            return length, partner
        if len(least) == 3 and sum(least) <= room:
            return None
        # At most two fit beside the piece. Of all pairs, the best has the largest sum.
        pairs = self._pairs(room, length)
        total, first, second = max((a + b, a, b) for a, b in pairs)
        if partner >= total:
            return length, partner
        # The pair dominates if it is best in both places: its larger one is the largest that fits, and no pair has a larger smaller one.
        if first == partner and second >= max(b for _, b in pairs):
            return length, first, second
        return None

    def _pairs(self, room: int, taken: int) -> list[tuple[int, int]]:
        """For every larger length the largest smaller-or-equal one that fits with it beside one piece ``taken``."""
        out = []
        for a in np.flatnonzero(self.left[:room + 1])[::-1].tolist():
            if self.left[a] > (a == taken):
                b = self.largest(min(a, room - a), taken, a)
                if b:
                    out.append((a, b))
        return out

    def reduce(self) -> None:
        """Fix dominating bins from the largest length down, again until nothing changes."""
        changed = True
        while changed:
            changed = False
            for length in np.flatnonzero(self.left)[::-1].tolist():
                while self.left[length]:
                    bin_ = self.dominating(length)
                    if bin_ is None:
                        break
                    # What dominates once does so as long as there are copies: taking pieces away leaves fewer alternatives.
                    self.fix(self.times(*bin_), *bin_)
                    changed = True

    def best_fit(self) -> None:
        """All pieces that are left, in decreasing order; the fullest bin with room comes first."""
        open_: dict[int, deque[tuple[int, int]]] = {}  # room -> runs (first bin, count)

        def put(length: int, room: int, wanted: int) -> int:
            done = 0
            while done < wanted and open_.get(room):
                first, count = open_[room].popleft()
                n = min(count, wanted - done)
                self.place(length, n, first, self.capacity - room)
                open_.setdefault(room - length, deque()).append((first, n))
                if n < count:
                    open_[room].appendleft((first + n, count - n))
                done += n
            return done

        for length in np.flatnonzero(self.left)[::-1].tolist():
            while self.left[length]:
                room = min((r for r, runs in open_.items() if r >= length and runs), default=None)
                if room is not None:
                    put(length, room, int(self.left[length]))
                    continue
                fitting = self.capacity // length
                count = -(-int(self.left[length]) // fitting)
                open_.setdefault(self.capacity, deque()).append((self.bins, count))
                self.bins += count
                put(length, self.capacity, min(count, int(self.left[length])))

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(length and first place as one key in order, bin of the first place, offset)."""
        runs = np.array(sorted(self.runs), dtype=np.int64).reshape(-1, 5)
        return (runs[:, 0] << 48) + runs[:, 1], runs[:, 3], runs[:, 4]


# --- placing ----------------------------------------------------------------------------------------

def _ranked(rows: DataFrame, counts: dict[int, int], capacity: int = CAPACITY) -> DataFrame:
    """``rows`` with ``place``, the number within the length from 0. A frequent length is counted in blocks dealt by hash."""
    blocks = F.get(F.lit([-(-counts.get(length, 0) // BLOCK_ROWS) or 1 for length in range(capacity + 1)]), F.col("length"))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "piece", "crc"), blocks).cast("int"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("length", "block").count().select("length", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("length", "block").orderBy("id", "piece", "crc")
    counted = dealt.withColumn("in_block", F.row_number().over(inside)).join(starts, ["length", "block"])
    return counted.withColumn("place", F.col("first") + F.col("in_block") - 1).drop("block", "first", "in_block")


def placed(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` (id, piece, length, crc, ...) with sequence_id and offset. The counts of lengths are at most ``capacity`` rows."""
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    keys, bins, offsets = Plan(counts, capacity).arrays()
    ranked = _ranked(rows, counts, capacity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key = (batch.column("length").to_numpy().astype(np.int64) << 48) + batch.column("place").to_numpy()
                at = np.searchsorted(keys, key, "right") - 1
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(bins[at] + (key - keys[at])), pa.array(offsets[at])],
                                                 names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return ranked.select(*rows.columns, "place").mapInArrow(run, f"{schema}, sequence_id long, offset long")


def packed_pieces(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Where every piece goes: its sequence and its place in it."""
    rows = staged(pieces(docs, path, id_column, text, capacity), "pieces")
    out = placed(rows, capacity)
    return out.select(F.col("id").alias(id_column), "piece", "start", F.col("length").cast("long").alias("length"), F.col("crc").alias("ids_crc32"), "sequence_id", "offset")


def sequences(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, each at most ``capacity`` ids."""
    rows = staged(pieces(docs, path, id_column, text, capacity, with_ids=True), "pieces")
    where = placed(rows.drop("ids"), capacity)
    # Rows with equal id, piece and digest have equal ids, so any of them may stand in a place.
    same = ["id", "piece", "start", "length", "crc"]
    ids = rows.groupBy(*same).agg(F.any_value("ids").alias("ids"))
    a, b = where.alias("a"), ids.alias("b")
    joined = a.join(b, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in same]).select("sequence_id", F.struct("a.offset", "b.ids").alias("part"))
    parts = joined.groupBy("sequence_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
