"""Toxicity severity by cumulative-link (proportional odds) ordinal regression.

``P(grade > k) = sigmoid(w . x - theta_k)`` with one weight vector ``w`` shared
by the ordered thresholds ``theta_0 < theta_1 < ...``.  ``x`` is sparse: for
each selected feature the number of distinct words of the text that carry it.
A word carries itself and its beginnings of 4 to 6 characters, so inflected and
compounded forms of a word seen in training still count.  The score is the
expected severity ``sum_k P(grade > k)``; a document is rejected when
``P(grade > 0)`` reaches ``reject_at``.

Training reads at most about ``max_labelled`` labelled rows (a documented
bound, held by a hash threshold on the id; the rows of both labels are thinned
alike).  Features are kept when the signed root of their log likelihood ratio
between toxic and clean rows reaches ``min_z``, at most ``max_features`` of them, so the model that
is sent to the tasks has a fixed bound.  Everything else covers all rows.

Grades: ``graded()`` turns the 0/1 label into three grades, using the model's
own features: clean 0; toxic 1; toxic with at least the median number of toxic
words among toxic rows 2.

Edge cases: null and empty texts have no features and get the severity of the
intercepts; null ids are scored like any other and never used for training;
null labels are left out of training; with no labelled rows, or one class only,
nothing is rejected and the severity is 0.
"""

from __future__ import annotations

import re
from collections import Counter
from math import fsum
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnscope.session import materialize

EDGES = ".,;:!?\"'()[]{}<>*&%$#|-_/\\"
_NOT_LETTERS = re.compile(r"^[\W\d_]+$")


def carried(word: str) -> tuple[str, ...]:
    """Features of a lower-cased word: itself (up to 40 characters) and its beginnings of 4 to 6 characters."""
    w = word.strip(EDGES)
    if not w or _NOT_LETTERS.match(w):
        return ()
    out = [f"={w}"] if len(w) <= 40 else []
    return (*out, *(f"^{w[:k]}" for k in (4, 5, 6) if len(w) > k))


def distinct_words(text: str | None) -> set[str]:
    return set((text or "").lower().split())


@dataclass
class OrdinalModel:
    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = ()
    reject_at: float = 0.5

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) in columns."""
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds)[None, :] - score[:, None], -60, 60)))


def _sample(labelled: DataFrame, max_labelled: int) -> DataFrame:
    n = labelled.count()
    if n <= max_labelled:
        return labelled
    cut = int(max_labelled / n * (1 << 30))
    return labelled.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < cut)


def select_features(rows: DataFrame, max_features: int, min_z: float, min_rows: int) -> list[tuple[str, float]]:
    """Features that tell toxic from clean rows at ``min_z``, each with its excess share of toxic rows."""
    def count(batches):
        pos, neg, n = Counter(), Counter(), [0, 0]
        for b in batches:
            for t, y in zip(b["text"], b["toxic"]):
                feats = {f for w in distinct_words(t) for f in carried(w)}
                (pos if y else neg).update(feats)
                n[int(bool(y))] += 1
        yield pd.DataFrame([("", n[1], n[0])] + [(f, pos[f], neg[f]) for f in pos.keys() | neg.keys()],
                           columns=["f", "pos", "neg"])
    counts = rows.select("text", "toxic").mapInPandas(count, "f string, pos bigint, neg bigint") \
        .groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    n_pos, n_neg = rows.agg(F.count(F.when(F.col("toxic") == 1, 1)), F.count(F.when(F.col("toxic") == 0, 1))).first()
    if not n_pos or not n_neg:
        return []
    part = n_pos / (n_pos + n_neg)
    n = F.col("pos") + F.col("neg")

    def term(seen: Column, share: float) -> Column:
        return F.when(seen > 0, seen * F.log(seen / (n * share))).otherwise(0.0)

    # Signed root of the log likelihood ratio: sound for features that one class never shows.
    ratio = (F.col("pos") / n) - part
    z = F.sqrt(F.greatest(2 * (term(F.col("pos"), part) + term(F.col("neg"), 1 - part)), F.lit(0.0)))
    top = counts.where(f"f <> '' and pos + neg >= {min_rows}").select("f", ratio.alias("r"), z.alias("z")) \
        .where(F.col("z") >= min_z).orderBy(F.col("z").desc(), "f").limit(max_features)
    return [(r["f"], r["r"]) for r in top.collect()]


class WordScores(dict):
    """Sums of the weights that a word carries, kept for up to ``most`` words."""

    def __init__(self, weights: dict[str, float], most: int = 200_000):
        super().__init__()
        self.weights, self.most = weights, most

    def __missing__(self, word: str) -> float:
        if len(self) >= self.most:
            self.clear()
        got = self[word] = fsum(self.weights.get(f, 0.0) for f in carried(word))
        return got


def encode(text: str | None, index: dict[str, int], memo: dict[str, tuple[int, ...]]) -> list[int]:
    """Feature numbers of a text, one for each distinct word that carries it."""
    out: list[int] = []
    for w in distinct_words(text):
        got = memo.get(w)
        if got is None:
            if len(memo) >= 200_000:
                memo.clear()
            got = memo[w] = tuple(index[f] for f in carried(w) if f in index)
        out.extend(got)
    return out


def fit_ordinal(x: list[np.ndarray], y: np.ndarray, n_features: int, n_grades: int, l2: float = 1e-5,
                steps: int = 1500, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by Adam on the mean negative log likelihood; thresholds are
    the first one plus positive gaps, so that they stay in order."""
    rows = np.repeat(np.arange(len(x)), [len(v) for v in x])
    cols = np.concatenate([*x, np.array([], dtype=np.int64)]).astype(np.int64)
    share = np.array([np.clip((y > k).mean(), 1e-4, 1 - 1e-4) for k in range(n_grades - 1)])
    cut = -np.log(share / (1 - share))
    par = np.concatenate([np.zeros(n_features), cut[:1], np.log(np.maximum(np.diff(cut), 1e-2))])
    m, v, n = np.zeros_like(par), np.zeros_like(par), len(y)
    one_hot = [(y == g) for g in range(n_grades)]
    for t in range(1, steps + 1):
        w, gaps = par[:n_features], np.exp(par[n_features + 1:])
        th = par[n_features] + np.concatenate([[0], np.cumsum(gaps)])
        s = np.bincount(rows, weights=w[cols], minlength=n)
        tail = 1 / (1 + np.exp(np.clip(th[None, :] - s[:, None], -40, 40)))          # P(y > k)
        full = np.concatenate([np.ones((n, 1)), tail, np.zeros((n, 1))], axis=1)
        d_s, d_th = np.zeros(n), np.zeros((n, n_grades - 1))
        for g in range(n_grades):
            hit = one_hot[g]
            p = np.maximum(full[hit, g] - full[hit, g + 1], 1e-12)
            up, lo = full[hit, g] * (1 - full[hit, g]), full[hit, g + 1] * (1 - full[hit, g + 1])
            d_s[hit] = -(up - lo) / p
            if g > 0:
                d_th[hit, g - 1] += up / p
            if g < n_grades - 1:
                d_th[hit, g] -= lo / p
        g_w = np.bincount(cols, weights=d_s[rows], minlength=n_features) / n + l2 * w
        g_t = d_th.sum(axis=0) / n
        g_first, g_gaps = g_t.sum(), np.array([g_t[k:].sum() for k in range(1, n_grades - 1)]) * gaps
        grad = np.concatenate([g_w, [g_first], g_gaps])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        par = par - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return par[:n_features], par[n_features] + np.concatenate([[0], np.cumsum(np.exp(par[n_features + 1:]))])


def graded(toxic: np.ndarray, n_toxic_words: np.ndarray) -> np.ndarray:
    """Grades 0, 1, 2 from the 0/1 label and the number of words with toxic features."""
    if not toxic.any():
        return np.zeros(len(toxic), dtype=np.int64)
    typical = np.median(n_toxic_words[toxic == 1])
    return np.where(toxic == 1, 1 + (n_toxic_words >= max(typical, 1)), 0).astype(np.int64)


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, max_features: int = 4096,
          min_z: float = 5.0, min_rows: int = 4, reject_at: float = 0.5) -> OrdinalModel:
    """Model from the labelled rows of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(_sample(known, max_labelled), "doc_id")
    rows = materialize(rows, "toxicity-labelled")       # bounded; read for the counts and for the fit
    chosen = select_features(rows, max_features, min_z, min_rows)
    if not chosen:
        return OrdinalModel(reject_at=reject_at)
    index = {f: i for i, (f, _) in enumerate(chosen)}
    toxic_feature = {i for i, (_, r) in enumerate(chosen) if r > 0}

    def to_rows(batches):
        memo: dict[str, tuple[int, ...]] = {}
        for b in batches:
            yield pd.DataFrame({"toxic": b["toxic"], "x": [encode(t, index, memo) for t in b["text"]]})
    got = rows.select("text", "toxic").mapInPandas(to_rows, "toxic int, x array<int>").toPandas()
    toxic = got["toxic"].to_numpy()
    x = [np.asarray(v, dtype=np.int64) for v in got["x"]]
    hits = np.array([sum(i in toxic_feature for i in v.tolist()) for v in x])
    grades = graded(toxic, hits)
    n_grades = max(2, int(grades.max()) + 1)
    w, th = fit_ordinal(x, grades, len(chosen), n_grades)
    return OrdinalModel({f: float(w[i]) for f, i in index.items()}, tuple(map(float, th)), reject_at)


def score(docs: DataFrame, model: OrdinalModel, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with expected_severity, grade (the likeliest), p_toxic = P(grade > 0) and toxic."""
    schema = "struct<s:double,g:int,p:double>"
    words = WordScores(model.weights)

    @F.pandas_udf(schema)
    def severity(texts: pd.Series) -> pd.DataFrame:
        # fsum: the order of a set's words leaves the sum as it is.
        total = np.array([fsum(map(words.__getitem__, distinct_words(t))) for t in texts], dtype=np.float64)
        tail = model.tails(total)
        full = np.concatenate([np.ones((len(tail), 1)), tail, np.zeros((len(tail), 1))], axis=1)
        return pd.DataFrame({"s": tail.sum(axis=1), "g": np.argmax(full[:, :-1] - full[:, 1:], axis=1).astype(np.int32),
                             "p": tail[:, 0]})

    name = lambda c: f"{prefix}{c}"
    if not model.thresholds:
        return docs.withColumns({name("expected_severity"): F.lit(0.0), name("grade"): F.lit(0),
                                 name("p_toxic"): F.lit(0.0), name("toxic"): F.lit(False)})
    out = docs.withColumn("__sev", severity(F.col(text).cast("string")))
    got: Column = F.col("__sev")
    return out.withColumns({name("expected_severity"): got["s"], name("grade"): got["g"], name("p_toxic"): got["p"],
                            name("toxic"): got["p"] >= model.reject_at}).drop("__sev")
