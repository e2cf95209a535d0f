"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a piece exactly one vocabulary token can be the last one of its encoding. Scanning the piece once,
a token that ends at a byte is that prefix's last token if it may follow the last token of the prefix before it, which
only depends on the two tokens. The table of last tokens is a complete encoding of every prefix: reading it backwards
gives the tokens, bytes can be appended without touching what is there, and after an edit only the bytes around it are
scanned again, until the table agrees with the old one.

Spark hands out the rows in Arrow batches; a task keeps one vocabulary and a bounded memory of pieces it has seen.

Defined cases: a null or empty text has no tokens and decodes to no bytes; texts of any length are encoded whole;
repeated rows give repeated results; an empty table gives an empty result; null ids decode to no bytes.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REMEMBERED = 300_000  # pieces, and token pairs, that a worker remembers before it starts afresh
LONG_PIECE = 40
TEXTS, CHARACTERS = 512, 4_000_000  # texts, and their characters, whose new pieces are scanned together
NO_LIMIT = 1 << 31


class ByteBPE:
    """A vocabulary of byte strings with ranks; the lowest rank merges first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.longest = max(map(len, ranks), default=1)
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._fits: dict[int, bool] = {}
        self._pieces: dict[str, bytes] = {}  # ids of pieces seen so far, packed
        self._flat: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        self.usable = {token: rank for token, rank in ranks.items() if len(token) == 1 or self.halves(rank) is not None}

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBPE:
        with open(path, "rb") as file:
            return cls({base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}, pattern)

    # --- which tokens may stand side by side ----------------------------------------------------

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for single bytes and for tokens that no merges reach."""
        if token not in self._halves:
            data = self.bytes[token]
            parts = [self.ranks.get(data[i:i + 1]) for i in range(len(data))]
            while len(parts) > 2:
                merges = [(self.ranks.get(self.bytes[a] + self.bytes[b], NO_LIMIT), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
                rank, at = min(merges)
                if rank >= NO_LIMIT or rank >= token:
                    break
                parts[at:at + 2] = [rank]
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border between two neighbouring tokens.

        The border is followed back through the merges that made both tokens. A pair that met at the border at some
        moment must not have been mergeable before the merge that ended that moment.
        """
        a, b, limit, good = left, right, NO_LIMIT, True
        while True:
            if self.ranks.get(self.bytes[a] + self.bytes[b], NO_LIMIT) < limit:
                good = False
                break
            whole_a, whole_b = len(self.bytes[a]) == 1, len(self.bytes[b]) == 1
            if whole_a and whole_b:
                break
            # Undo the later of the two last merges. Of equal merges the left one happens first, so the right one is undone first.
            if whole_b or (not whole_a and a > b):
                limit, a = a, self.halves(a)[1]
            else:
                limit, b = b + 1, self.halves(b)[0]
        if len(self._fits) >= REMEMBERED:
            self._fits.clear()
        self._fits[left << 32 | right] = good
        return good

    # --- prefix tables --------------------------------------------------------------------------

    def extend(self, piece: bytes, last: list[int], upto: int | None = None) -> list[int]:
        """Continue the table ``last`` (one token per prefix already scanned) to all prefixes of ``piece``.

        Only one token can be the last of a prefix, so the order of trying is free: mostly it is the token before with
        one byte more, else a shorter one that starts behind it.
        """
        tokens, known, longest = self.usable.get, self._fits.get, self.longest
        begin = len(last) - len(self.bytes[last[-1]]) if last else 0
        for end in range(len(last) + 1, (len(piece) if upto is None else upto) + 1):
            token = tokens(piece[begin:end])
            if token is not None:
                if begin == 0:
                    last.append(token)
                    continue
                good = known(last[begin - 1] << 32 | token)
                if good or good is None and self.fits(last[begin - 1], token):
                    last.append(token)
                    continue
            for start in (*range(begin + 1, end), *range(begin - 1, max(-1, end - longest - 1), -1)):
                token = tokens(piece[start:end])
                if token is None:
                    continue
                if start == 0:
                    break
                good = known(last[start - 1] << 32 | token)
                if good or good is None and self.fits(last[start - 1], token):
                    break
            else:
                raise ValueError("the vocabulary lacks a byte")
            begin = start
            last.append(token)
        return last

    def edited(self, piece: bytes, last: list[int], at: int, removed: int, added: bytes) -> tuple[bytes, list[int]]:
        """The piece with ``removed`` bytes at ``at`` replaced, and its table.

        The table before the edit stays. Behind it, once as many entries in a row as the longest token agree with the
        old table, all later ones do.
        """
        new = piece[:at] + added + piece[at + removed:]
        shift, table, agree = len(added) - removed, list(last[:at]), 0
        while len(table) < len(new):
            self.extend(new, table, len(table) + 1)
            old = len(table) - shift
            agree = agree + 1 if old > at + removed and last[old - 1] == table[-1] else 0
            if agree >= self.longest:
                table.extend(last[old:])
        return new, table

    def tokens(self, last: list[int]) -> list[int]:
        out, end = [], len(last)
        while end:
            out.append(last[end - 1])
            end -= len(self.bytes[out[-1]])
        return out[::-1]

    # --- texts ----------------------------------------------------------------------------------

    def piece(self, piece: str) -> list[int]:
        """Tokens of one match of the pattern; a piece that is itself in the vocabulary is one token."""
        data = piece.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.tokens(self.extend(data, []))  # the same ids as all merges give

    def learn(self, pieces: list[str]) -> None:
        """Remember the ids of pieces. In sorted order neighbours share the table of their common prefix."""
        last, before = [], b""
        for piece in sorted(pieces):
            data = piece.encode("utf-8", "surrogatepass")
            whole = self.ranks.get(data)
            if whole is None:
                same = min(len(data), len(before))
                while data[:same] != before[:same]:
                    same -= 1
                del last[same:]
                ids, before = self.tokens(self.extend(data, last)), data
                self._pieces[piece] = struct.pack(f"{len(ids)}i", *ids)
            else:
                self._pieces[piece] = struct.pack("i", whole)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        if len(self._pieces) > REMEMBERED:
            self._pieces.clear()
        split = [self.pattern.findall(text) for text in texts]
        new = set().union(*split).difference(self._pieces)
        self.learn(list(new))
        out = [np.frombuffer(b"".join(map(self._pieces.__getitem__, pieces)), dtype=np.int32) for pieces in split]
        for piece in new:
            if len(piece) > LONG_PIECE:
                del self._pieces[piece]
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> bytes:
        if self._flat is None:
            order = [self.bytes.get(i, b"") for i in range(max(self.bytes, default=-1) + 1)]
            lengths = np.array([len(x) for x in order], dtype=np.int64)
            self._flat = np.frombuffer(b"".join(order), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths
        data, starts, lengths = self._flat
        n = lengths[ids]
        return data[np.repeat(starts[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())].tobytes()

    def append(self, text: str, ids: np.ndarray, more: str) -> np.ndarray:
        """Ids of ``text + more``: only the last pieces, which the added text may change, are encoded anew."""
        pieces = self.pattern.findall(text)
        keep = len(pieces)
        # What is added can join the last piece, and white space before it may be cut differently.
        while keep and (keep == len(pieces) or pieces[keep].isspace() or pieces[keep - 1].isspace()):
            keep -= 1
        tail = "".join(pieces[keep:])
        return np.concatenate([ids[:len(ids) - len(self.encode(tail))], self.encode(tail + more)])


_LOADED: dict[tuple[str, str], ByteBPE] = {}


def vocabulary(path: str, pattern: str) -> ByteBPE:
    """One vocabulary per worker process."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBPE.load(path, pattern)
    return _LOADED[path, pattern]


def _encoded(bpe: ByteBPE, texts: pa.Array) -> pa.ListArray:
    lists, chunk, size = [], [], 0
    for value in texts:
        chunk.append(value.as_py() or "")
        size += len(chunk[-1])
        if len(chunk) >= TEXTS or size >= CHARACTERS:
            lists += bpe.encode_all(chunk)
            chunk, size = [], 0
    lists += bpe.encode_all(chunk)
    ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists) if lists else np.empty(0, np.int32)))


def _decoded(bpe: ByteBPE, lists: pa.ListArray) -> pa.BinaryArray:
    return pa.array([bpe.decode(ids.values.to_numpy()) if ids.is_valid else b"" for ids in lists], pa.binary())


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None, decode: bool = False) -> DataFrame:
    """The kept columns of ``docs`` (all of them by default) as ``row``, with the ids of the text as ``ids``.

    With ``decode`` the same worker decodes the ids again, so that one vocabulary does for both: ``decoded`` has the bytes.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row"), F.col(text).alias("body"))
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
    if decode:
        schema = schema.add("decoded", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path, pattern)
        for batch in batches:
            ids = _encoded(bpe, batch.column("body"))
            more = [_decoded(bpe, ids)] if decode else []
            yield pa.RecordBatch.from_arrays([batch.column("row"), ids, *more], names=schema.names)

    return rows.mapInArrow(run, schema)


def decoded(frame: DataFrame, path: str, pattern: str) -> DataFrame:
    """``frame`` (row, ids) with the bytes of the ids as ``decoded``."""
    schema = T.StructType([*frame.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _decoded(bpe, batch.column("ids"))], names=[*batch.schema.names, "decoded"])

    return frame.mapInArrow(run, schema)


def token_rows(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns as ``row``, the ids, their number and digest, and the digest of the bytes they decode to."""
    out = encoded(docs, path, pattern, text, keep, decode=True)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select("row", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def token_report(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Number of tokens, digest of the ids and digest of the bytes they decode to, for every document."""
    out = token_rows(docs, path, pattern, text, [id_column])
    return out.select(F.col("row").getField(id_column).alias(id_column), "n_tokens", "ids_sha256", "decoded_sha256")
