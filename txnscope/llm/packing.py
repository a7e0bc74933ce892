"""Sequence packing by best-fit decreasing.

A document's ids (its tokens, then an end id) are cut into full windows and a
remainder.  Pieces are taken from the longest down; each goes into the open
window with the least room that holds it, found in a segment tree indexed by
remaining room, else into a new one.

Pieces of one length are interchangeable, so the packing is planned on the
histogram of lengths (at most ``window`` numbers, whatever the input): windows
with the same room and history form a run, and a step moves as many pieces of
the length as the run holds.  The plan, a short list of (length, first rank,
last rank, first window, offset), is exactly what piece-by-piece best fit gives.
Each piece then finds its place by its rank among the pieces of its length,
counted in two levels (within a salt, and from the salts before it), so a
length that most pieces share is spread over many tasks.

Edge cases: null and empty texts are a piece of the end id only; repeated rows
are packed each; null ids are packed like any other; an empty table gives an
empty result.
"""

from __future__ import annotations

import string
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnscope.session import materialize

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


class Encoder:
    """Little-endian 32-bit ids of texts as bytes.

    A byte-level BPE never joins across the space before a non-space character,
    a single line break between two of them, or a word and the punctuation
    behind it.  Texts are cut there, and each word and each run of punctuation
    goes through the tokenizer's model once; any other chunk goes through the
    whole tokenizer, as do texts with runs of white space or the start of a
    special token."""

    def __init__(self, path: str, limit: int = 400_000):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.model = self.tokenizer.model
        self.spaced: dict[str, bytes] = {}          # words behind a space
        self.bare: dict[str, bytes] = {}            # words and punctuation without one
        # The byte-level alphabet: printable bytes stand for themselves, the others for 256 and up in turn.
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = iter(range(256, 512))
        self.alphabet = {b: b if b in shown else next(rest) for b in range(256)}
        self.line_break = self._whole("\n")

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        spelled = piece.encode("utf-8").decode("latin-1").translate(self.alphabet)
        return np.array([t.id for t in self.model.tokenize(spelled)], dtype="<u4").tobytes()

    def _chunk(self, chunk: str, space: str) -> bytes | None:
        """Ids of ``space`` ('' or ' ') and a chunk; None if the chunk is empty or begins with white space."""
        if not chunk or chunk[0].isspace():
            return None
        word = chunk.rstrip(string.punctuation)
        if not word.isalpha():
            left, line, right = chunk.partition("\n")
            if line and left and right and not left[-1].isspace() and not right[0].isspace():
                return self._chunk(left, space) + self.line_break + self._chunk(right, "")
            return self._whole(space + chunk)
        memo = self.spaced if space else self.bare
        head = memo.get(word)
        if head is None:
            head = memo[word] = self._piece(space + word)
        if len(word) == len(chunk):
            return head
        tail = self.bare.get(chunk[len(word):])
        if tail is None:
            tail = self.bare[chunk[len(word):]] = self._piece(chunk[len(word):])
        return head + tail

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        first, *rest = text.split(" ")
        if "<|" in text or first == "":
            return self._whole(text)
        if len(self.spaced) + len(self.bare) > self.limit:
            self.spaced.clear()
            self.bare.clear()
        known, out = self.spaced.get, [self._chunk(first, "") or self._whole(first)]
        for c in rest:
            got = known(c) or self._chunk(c, " ")
            if got is None:
                return self._whole(text)
            out.append(got)
        return b"".join(out)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut_pieces(docs: DataFrame, tokenizer_path: str, window: int = 1024, end_id: int = 0,
               with_ids: bool = False) -> DataFrame:
    """Pieces of every row of ``docs`` (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, and ids if asked for."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def work(batches):
        enc = encoder(tokenizer_path)
        names = [x.split()[0] for x in PIECES.split(", ")] + ["ids"] * with_ids
        for b in batches:
            out = []
            for i, t in zip(b["doc_id"], b["text"]):
                raw = enc.encode(t or "") + end
                n = len(raw) // 4
                for s in range(0, n, window):
                    part = raw[4 * s:4 * (s + window)]
                    out.append((None if pd.isna(i) else int(i), s, len(part) // 4, zlib.crc32(part), n)
                               + ((np.frombuffer(part, "<u4").astype(np.int32),) if with_ids else ()))
                if len(out) >= 20_000:
                    yield self_frame(out, names)
                    out = []
            if out:
                yield self_frame(out, names)

    def self_frame(out, names):
        frame = pd.DataFrame(out, columns=names)
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        return frame
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(work, PIECES + (", ids array<int>" if with_ids else ""))


class RoomTree:
    """Segment tree over remaining room 0..window: is there an open run at or above some room, and which is tightest."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.any = [0] * (2 * self.size)
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, room: int, first: int, last: int) -> None:
        """Windows ``first`` to ``last`` (exclusive) have ``room`` left."""
        if room and last > first:
            self.runs.setdefault(room, []).append((first, last))
            self._count(room, 1)

    def _count(self, room: int, by: int) -> None:
        i = room + self.size
        while i:
            self.any[i] += by
            i >>= 1

    def tightest(self, need: int) -> int | None:
        """Least room of at least ``need`` that an open window has."""
        i = need + self.size
        if self.any[i]:
            return need
        while i > 1:                               # up until a right sibling holds something, then down its left edge
            if not i & 1 and self.any[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None

    def take(self, room: int, most: int) -> tuple[int, int]:
        """Up to ``most`` windows of a run with ``room``: (first, last)."""
        first, last = self.runs[room].pop()
        self._count(room, -1)
        cut = min(last, first + most)
        self.add(room, cut, last)
        return first, cut


def plan(lengths: dict[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over a histogram: (length, first rank, last rank, first window, offset), ranks exclusive at the end."""
    tree, opened, out = RoomTree(window), 0, []
    for length in sorted(lengths, reverse=True):
        rank, n = 0, lengths[length]
        while rank < n:
            room = tree.tightest(length)
            if room is None:
                # Each new window takes one piece; if a second one fits, it is the tightest for it only
                # once no older window fits, so windows are opened and filled as best fit would do.
                per = window // length
                full, rest = divmod(n - rank, per)
                for k in range(per):
                    count = full
                    if count:
                        # window j of the new ones holds pieces rank + j * per + k; kept as strided runs
                        out.append((length, rank + k * full, rank + k * full + count, opened, k * length))
                tree.add(window - per * length, opened, opened + full)
                rank, opened = rank + per * full, opened + full
                if rest:
                    for k in range(rest):
                        out.append((length, rank + k, rank + k + 1, opened, k * length))
                    tree.add(window - rest * length, opened, opened + 1)
                    rank, opened = rank + rest, opened + 1
                continue
            first, last = tree.take(room, n - rank)
            out.append((length, rank, rank + last - first, first, window - room))
            tree.add(room - length, first, last)
            rank += last - first
    return out


def place(pieces: DataFrame, window: int = 1024, salt_rows: int = 50_000) -> DataFrame:
    """``pieces`` (a stored table) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    steps = plan(counts, window)
    salts = max(8, sum(counts.values()) // salt_rows)
    keyed = pieces.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)).cast("int"))
    w = Window.partitionBy("length", "__salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = keyed.withColumn("__in", F.row_number().over(w) - 1)
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    totals = keyed.groupBy("length", "__salt").agg(F.count("*").alias("__n")) \
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    ranked = ranked.join(totals, ["length", "__salt"]).withColumn("__rank", F.col("__in") + F.col("__before"))
    # The plan has a bounded number of steps: broadcast as one sorted array for each length.
    by_length: dict[int, list] = {}
    for s in steps:
        by_length.setdefault(s[0], []).append(s[1:])
    rows = [(k, [tuple(x) for x in v]) for k, v in by_length.items()]
    book = spark.createDataFrame(rows, "length bigint, __steps array<struct<lo:bigint,hi:bigint,first:bigint,at:bigint>>")
    step = F.filter("__steps", lambda s: (s["lo"] <= F.col("__rank")) & (F.col("__rank") < s["hi"]))[0]
    placed = ranked.join(F.broadcast(book), "length").withColumn("__s", step)
    return placed.withColumn("sequence_id", F.col("__s")["first"] + F.col("__rank") - F.col("__s")["lo"]) \
        .withColumn("offset", F.col("__s")["at"]).select(*pieces.columns, "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer_path: str, window: int = 1024, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    pieces = materialize(cut_pieces(docs, tokenizer_path, window, end_id, with_ids), "pieces")
    return place(pieces, window)
