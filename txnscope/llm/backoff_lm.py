"""Language-model scoring with a weighted backoff automaton.

Model (order ``order``): with counts ``c`` over training texts,

    P_1(w)       = (c(w) + 0.1) / (N + 0.1 (V + 1))
    P_k(w | h)   = (c(hw) + kappa P_{k-1}(w | h')) / (c(h) + kappa)

``h'`` is ``h`` without its first token.  As an automaton: n-grams shorter than
the order are states; a seen n-gram ``hw`` is an arc from ``h`` with weight
``log10 P_k(w | h)``; every state has a failure arc to ``h'`` with weight
``log10(kappa / (c(h) + kappa))``; the root has an arc for every word.  One
left-to-right traversal of a text carries the state and adds up weights.

The model grows with the corpus, so it is never sent whole anywhere:

1. Texts are packed into blocks of ``block_bytes`` (one row each, compressed)
   and written to the shared folder.
2. Each block sends its distinct n-grams as 64-bit keys with training counts,
   sorted and cut by their leading bits into shards; keys of a shard are one
   binary cell of differences, compressed.
3. Each shard adds up its counts and answers every block with the totals of
   the block's keys, in the block's order.
4. Each block builds the part of the automaton that its texts can reach and
   traverses its texts.

All work per task is bounded by the block or shard size: frequent words or
copies only repeat inside a block, where they are one key.

Edge cases: null and empty texts have the end token only; rows without an id
are scored, as held out (the id's text is empty); repeated rows count as often
as they occur; an empty table gives an empty result; with no training text
every token is unknown and ``P_1 = 1``.  Words meet by 64-bit hashes.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnscope.llm.common import text_bytes
from txnscope.session import materialize

END = b"\n"                                     # no word holds white space, so it is free for the end token
BLOCK = "block bigint, body binary"
MIX = np.uint64(0x9E3779B97F4A7C15)


def _pack(parts: list[bytes]) -> bytes:
    head = np.array([len(parts), *map(len, parts)], dtype="<i8").tobytes()
    return zlib.compress(head + b"".join(parts), 1)


def _unpack(blob: bytes) -> list[bytes]:
    raw = zlib.decompress(blob)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    ends = np.cumsum(np.frombuffer(raw, "<i8", n, 8)) + 8 * (n + 1)
    return [raw[a:b] for a, b in zip([8 * (n + 1), *ends[:-1].tolist()], ends.tolist())]


def _spread(x: np.ndarray) -> bytes:
    """A uint32 array with equal bytes brought together."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _gather(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def block_body(held: list[tuple[int | None, int, bytes]]) -> bytes:
    """(id, held out, text) of a run of texts as one cell: words are numbered in the block, hashes name them outside."""
    import xxhash

    number: dict[bytes, int] = {END: 0}
    seq: list[int] = []
    n_tokens = []
    for _, _, text in held:
        words = text.lower().split()
        seq.extend([number.setdefault(w, len(number)) for w in words])
        seq.append(0)
        n_tokens.append(len(words) + 1)
    h = xxhash.xxh64_intdigest
    return _pack([np.array([i or 0 for i, _, _ in held], dtype="<i8").tobytes(),
                  bytes((i is None) | out << 1 for i, out, _ in held), _spread(np.array(n_tokens)),
                  _spread(np.array(seq)), np.array([h(w, 42) for w in number], dtype="<u8").tobytes()])


def blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """One row for each run of texts of about ``block_bytes``."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        task, k, held, size = TaskContext.get().partitionId(), 0, [], 0
        for b in batches:
            for i, h, t in zip(b["doc_id"], b["held_out"], b["text"]):
                text = (t or "").encode("utf-8", "surrogatepass")
                held.append((None if pd.isna(i) else int(i), int(h), text))
                size += len(text) + 64
                if size >= block_bytes:
                    yield pd.DataFrame({"block": [task << 32 | k], "body": [block_body(held)]})
                    k, held, size = k + 1, [], 0
        if held:
            yield pd.DataFrame({"block": [task << 32 | k], "body": [block_body(held)]})
    return docs.select("doc_id", "held_out", "text").mapInPandas(pack, BLOCK)


class BlockGrams:
    """Texts of a block as arrays: word numbers with ends, and for each length k the number of the
    k-gram that ends at each token (-1 where the text has fewer tokens before it)."""

    def __init__(self, body: bytes, order: int):
        ids, flags, n_tokens, words, word_keys = _unpack(body)
        self.ids = np.frombuffer(ids, "<i8")
        flags = np.frombuffer(flags, np.uint8)
        self.no_id, self.held = (flags & 1).astype(bool), (flags & 2).astype(bool)
        self.n_tokens, self.words = _gather(n_tokens), _gather(words)
        self.ends = np.cumsum(self.n_tokens)
        word_keys = np.frombuffer(word_keys, "<u8")
        n_words = len(word_keys)
        within = np.arange(len(self.words)) - np.repeat(self.ends - self.n_tokens, self.n_tokens)
        train = np.repeat(~self.held, self.n_tokens)
        self.at, self.keys, self.counts, self.history, self.last = [], [], [], [], []
        for k in range(1, order + 1):
            if k == 1:
                at, keys = self.words, word_keys
                self.history.append(None)
                self.last.append(np.arange(n_words))
            else:
                where = np.nonzero(within >= k - 1)[0]
                pair = self.at[-1][where - 1] * n_words + self.words[where]
                uniq, inv = np.unique(pair, return_inverse=True)
                at = np.full(len(self.words), -1, dtype=np.int64)
                at[where] = inv
                self.history.append(uniq // n_words)
                self.last.append(uniq % n_words)
                x = self.keys[-1][self.history[-1]] * MIX + word_keys[self.last[-1]]
                x ^= x >> np.uint64(32)
                x *= MIX
                keys = x ^ (x >> np.uint64(29))
            self.at.append(at)
            self.keys.append(keys)
            use = (at >= 0) & train
            self.counts.append(np.bincount(at[use], minlength=len(keys)))


def _cut(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, and where each shard (leading bits) begins in it."""
    order = np.argsort(keys, kind="stable")
    edges = np.searchsorted(keys[order] >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)) \
        if bits else np.array([0, len(keys)])
    return order, edges


def _planes(x: np.ndarray) -> bytes:
    """Differences of sorted keys with equal bytes brought together, compressed."""
    d = np.diff(x, prepend=np.uint64(0)).astype("<u8")
    return zlib.compress(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _from_planes(b: bytes) -> np.ndarray:
    raw = np.frombuffer(zlib.decompress(b), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(raw.T).view("<u8").ravel(), dtype=np.uint64)


def _numbers(x: np.ndarray) -> bytes:
    most = x.max(initial=0)
    width = 1 if most < 256 else 4 if most < 1 << 32 else 8
    return b"%d" % width + zlib.compress(x.astype(f"<u{width}").tobytes(), 1)


def _from_numbers(b: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b[1:]), f"<u{b[:1].decode()}").astype(np.int64)


class Automaton:
    """States, arcs and failure arcs over the n-grams of one block.  State 0 is the root; the k-grams seen in
    training, k < order, follow.  ``arcs`` finds the number of the arc of a state and a word."""

    def __init__(self, grams: BlockGrams, counts: list[np.ndarray], n: int, v: int, kappa: float):
        order, self.n_words = len(counts), len(counts[0])
        prob = (counts[0] + 0.1) / (n + 0.1 * (v + 1))
        self.base = np.log10(prob)
        # end_state[k][g]: state of the longest ending of the (k+1)-gram g that is one, shorter than the order.
        fail, back, end_state, source, word, weight, to = [np.zeros(1, dtype=np.int64)], [np.zeros(1)], [], [], [], [], []
        n_states, suffix, own_state = 1, None, None
        for k in range(1, order + 1):
            c = counts[k - 1]
            if k > 1:                               # the (k-1)-gram left when the first token is dropped
                where = np.nonzero(grams.at[k - 1] >= 0)[0]
                suffix = np.zeros(len(c), dtype=np.int64)
                suffix[grams.at[k - 1][where]] = grams.at[k - 2][where]
                prob = (c + kappa * prob[suffix]) / (counts[k - 2][grams.history[k - 1]] + kappa)
            shorter = np.zeros(len(c), dtype=np.int64) if k == 1 else end_state[-1][suffix]
            seen = c > 0
            use = np.arange(len(c)) if k == 1 else np.nonzero(seen)[0]
            before = np.zeros(len(use), dtype=np.int64) if k == 1 else own_state[grams.history[k - 1][use]]
            if k < order:
                own_state = np.where(seen, n_states + np.cumsum(seen) - 1, -1)
                n_states += int(seen.sum())
                fail.append(shorter[seen])
                back.append(np.log10(kappa / (c[seen] + kappa)))
                end_state.append(np.where(seen, own_state, shorter))
            source.append(before)
            word.append(grams.last[k - 1][use])
            weight.append(np.log10(prob[use]))
            to.append((end_state[-1] if k < order else shorter)[use])
        keys = np.concatenate(source) * self.n_words + np.concatenate(word)
        self.arcs = dict(zip(keys.tolist(), range(len(keys))))
        self.weight, self.to = np.concatenate(weight).tolist(), np.concatenate(to).tolist()
        self.fail, self.back = np.concatenate(fail).tolist(), np.concatenate(back).tolist()

    def score(self, words: list[int]) -> float:
        """log10 probability of a text, read once from left to right."""
        arcs, weight, to, fail, back = self.arcs, self.weight, self.to, self.fail, self.back
        n, state, total = self.n_words, 0, 0.0
        for w in words:
            arc = arcs.get(state * n + w)
            while arc is None:
                total += back[state]
                state = fail[state]
                arc = arcs.get(state * n + w)
            total += weight[arc]
            state = to[arc]
        return total


def score_documents(docs: DataFrame, held_out, order: int = 2, kappa: float = 200.0, block_bytes: int = 3 << 19,
                    shard_bytes: int = 24 << 20) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs`` (doc_id, text).

    ``held_out`` is a boolean column; the model learns from the rows where it is false."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(held_out, F.lit(True)).alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    body = materialize(blocks(rows, block_bytes), "lm-blocks")
    bits = max(0, math.ceil(math.log2(max(1, text_bytes(docs) / shard_bytes))))

    def send(batches):
        for b in batches:
            for block, blob in zip(b["block"], b["body"]):
                g = BlockGrams(blob, order)
                out = []
                for k in range(order):
                    at, edges = _cut(g.keys[k], bits)
                    for s in np.nonzero(np.diff(edges))[0].tolist():
                        part = at[edges[s]:edges[s + 1]]
                        out.append((block, k, s, _planes(g.keys[k][part]), _numbers(g.counts[k][part])))
                del g                                   # before the next block is built
                yield pd.DataFrame(out, columns=["block", "level", "shard", "keys", "counts"])

    sent = body.mapInPandas(send, "block bigint, level int, shard bigint, keys binary, counts binary")

    def add_up(group: pd.DataFrame) -> pd.DataFrame:
        keys = [_from_planes(x) for x in group["keys"]]
        uniq, inv = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(uniq), dtype=np.int64)
        ends = np.cumsum([len(x) for x in keys])
        for (a, b), c in zip(zip([0, *ends[:-1]], ends), group["counts"]):
            total[inv[a:b]] += _from_numbers(c)         # keys of one block are distinct
        answers = [_numbers(total[inv[a:b]]) for a, b in zip([0, *ends[:-1]], ends)]
        out = pd.DataFrame({"block": group["block"], "level": group["level"], "shard": group["shard"],
                            "answer": answers, "n": 0, "v": 0})
        out.loc[out.index[0], ["n", "v"]] = [int(total.sum()), int((total > 0).sum())]
        return out

    answers = materialize(sent.groupBy("level", "shard").applyInPandas(
        add_up, "block bigint, level int, shard bigint, answer binary, n bigint, v bigint"), "lm-answers")
    n, v = answers.where("level = 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()

    def traverse(batches):
        for b in batches:
            for blob, got in zip(b["body"], b["got"]):
                g = BlockGrams(blob, order)
                by_level = {(r["level"], r["shard"]): r["answer"] for r in got}
                counts = []
                for k in range(order):
                    at, edges = _cut(g.keys[k], bits)
                    c = np.zeros(len(at), dtype=np.int64)
                    for s in np.nonzero(np.diff(edges))[0].tolist():
                        c[at[edges[s]:edges[s + 1]]] = _from_numbers(by_level[k, s])
                    counts.append(c)
                auto = Automaton(g, counts, n, v, kappa)
                known = np.add.reduceat((counts[0] > 0)[g.words].astype(np.int64), g.ends - g.n_tokens)
                base = np.add.reduceat(auto.base[g.words], g.ends - g.n_tokens)
                words = g.words.tolist()
                score = [auto.score(words[e - m:e]) for e, m in zip(g.ends.tolist(), g.n_tokens.tolist())]
                out = pd.DataFrame({"doc_id": pd.array(g.ids, dtype="Int64"), "held_out": g.held, "n_tokens": g.n_tokens,
                                    "n_known": known, "train_tokens": n, "base_score": base, "score": score})
                out.loc[g.no_id, "doc_id"] = pd.NA
                del g, auto, counts, words              # before the next block is built
                yield out

    gathered = answers.groupBy("block").agg(F.collect_list(F.struct("level", "shard", "answer")).alias("got"))
    return body.join(gathered, "block").mapInPandas(
        traverse, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                  "base_score double, score double")
