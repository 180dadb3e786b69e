"""Toxic passages and document scores by maximum-scoring segments.

Token scores: log-odds of a token in toxic against clean documents, both
smoothed by an informative Dirichlet prior (the token's share in all training
documents). Words count once per document, and so do the first four, five and
six letters of longer words, which carry the score of inflected forms. Log-odds
significant by their z value are the token's score, of toxic words (above 1)
and of clean ones (below 0); a word takes the highest of its toxic parts, else
its own negative one. All other words share one small cost, chosen so that the
expected score of clean text is negative, as segment statistics need it.

Segments: the linear-time search for all maximal scoring subsequences (every
passage whose score no extension or part of it raises).

Calibration: with lambda, the root of E[exp(lambda * score)] = 1 over clean
tokens, ``lambda * S - ln(n)`` is the log of the inverse expected number of
such passages in n clean words (extreme-value law, up to a constant). The best
passage so normalised and the sum over all significant ones (expected at most
``EXPECTED`` times in as much clean text) go through a logistic curve fitted on
the training documents' histogram, which gives a probability.

Bounds: ``max_train_docs`` labelled documents at most are used for fitting (a
documented bound, taken by hash, so the sample is the same on every run); token
statistics come from all of them, whole texts. The model holds significant
tokens only, so it is bounded by that sample, not by the corpus.

Edge cases: null and empty texts have no passage and score what a text without
a hit scores; rows whose label is null are not trained on; several labels of
one document count as toxic if any is; without both kinds of labels the score
is 0 for all rows; repeated rows are scored each; other columns pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import held_out, materialise

_OUTER = b".,;:!?\"'()[]{}"
PREFIXES = (4, 5, 6)
EXPECTED = 0.01  # a passage is significant if clean text of this length has as many at most
REACH = 100.0  # evidence beyond this adds nothing


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def _features(word: bytes) -> list[str]:
    """The first letters of the word, fewest first, then the word without outer punctuation."""
    core = word.strip(_OUTER).decode("utf-8", "replace")
    return [*(f"{core[:k]}*" for k in PREFIXES if len(core) > k), core] if core else []


class Passage(NamedTuple):
    start: int  # first word
    end: int  # past the last word
    score: float


@dataclass
class ToxicityModel:
    tokens: dict[str, float] = field(default_factory=dict)
    drift: float = 0.05  # cost of a word without a score
    lam: float = 1.0
    weights: tuple[float, float, float] | None = None  # constant, best passage, all significant passages

    def word_score(self, word: bytes) -> float:
        parts = _features(word)
        best = max((self.tokens.get(f, 0.0) for f in parts), default=0.0)
        return best if best > 0 else min(self.tokens.get(parts[-1], 0.0) if parts else 0.0, 0.0) or -self.drift


class _Memo(dict):
    """Word -> ``of(word)``; forgets when it grows large."""

    LIMIT = 200_000

    def __init__(self, of):
        super().__init__()
        self.of = of

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = s = self.of(word)
        return s

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.float64, len(words))


def maximal_segments(scores: np.ndarray) -> list[Passage]:
    """All maximal scoring segments of a text with these word scores; linear in their number.

    A run of words above 0 lies in one segment, so the search goes by runs.
    """
    up = np.concatenate(([False], scores > 0, [False]))
    edges = np.flatnonzero(up[1:] != up[:-1])
    if not len(edges):
        return []
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    left: list[float] = []
    right: list[float] = []
    span: list[list[int]] = []
    below: list[int] = []  # per segment: the nearest earlier one with a lower left sum, or -1
    for a, b, lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist(), sums[edges[::2]].tolist(), sums[edges[1::2]].tolist()):
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= lo:
                j = below[j]
            if j < 0 or right[j] >= hi:
                left.append(lo)
                right.append(hi)
                span.append([a, b])
                below.append(j)
                break
            lo, a = left[j], span[j][0]
            del left[j:], right[j:], span[j:], below[j:]
    return [Passage(a, b, r - x) for (a, b), x, r in zip(span, left, right)]


def _evidence(text: str | None, model: ToxicityModel, memo: _Memo) -> tuple[float, float, int]:
    """Best passage, all significant passages (both normalised), and the number of these."""
    words = _words(text)
    size = math.log(len(words) + 2.0)
    marks = [model.lam * p.score - size for p in maximal_segments(memo.array(words))]
    found = [m for m in marks if m >= -math.log(EXPECTED)]
    return min(max(marks, default=-size), REACH), min(sum(found), REACH), len(found)


def _probability(best, every, weights):
    z = weights[0] + weights[1] * best + weights[2] * every
    return 1.0 / (1.0 + np.exp(-np.clip(z, -50.0, 50.0)))


def assess(text: Column, model: ToxicityModel) -> Column:
    """struct(score: probability of a toxic document, 0 to 1; n_passages: number of significant passages)."""

    @F.pandas_udf("struct<score:double,n_passages:int>")
    def _assess(texts: pd.Series) -> pd.DataFrame:
        if model.weights is None:
            return pd.DataFrame({"score": 0.0, "n_passages": 0}, index=texts.index)
        memo = _Memo(model.word_score)
        x = np.array([_evidence(t, model, memo) for t in texts], float).reshape(-1, 3)
        return pd.DataFrame({"score": _probability(x[:, 0], x[:, 1], model.weights), "n_passages": x[:, 2].astype(np.int32)}, index=texts.index)

    return _assess(text)


def score(text: Column, model: ToxicityModel) -> Column:
    """Probability of a toxic document, 0 to 1."""
    return assess(text, model)["score"]


def find_passages(docs: DataFrame, model: ToxicityModel, text_col: str = "text", max_expected: float = EXPECTED) -> DataFrame:
    """``docs`` with ``passages``: array of (start, end, score, expected), words counted
    from 0, end exclusive; those expected at most ``max_expected`` times in as much clean text."""

    @F.pandas_udf("array<struct<start:int,end:int,score:double,expected:double>>")
    def _find(texts: pd.Series) -> pd.Series:
        memo = _Memo(model.word_score)
        out = []
        for t in texts:
            words = _words(t)
            rows = [(*p, (len(words) + 2) * math.exp(-model.lam * p.score)) for p in maximal_segments(memo.array(words))]
            out.append([{"start": a, "end": b, "score": s, "expected": e} for a, b, s, e in rows if e <= max_expected])
        return pd.Series(out, index=texts.index, dtype=object)

    return docs.withColumn("passages", _find(F.col(text_col)))


def training_rows(docs: DataFrame, labels: DataFrame, max_train_docs: int = 200_000) -> DataFrame:
    """(text, toxic) of the labelled documents that are not held out.

    The label side is bounded by ``max_train_docs``, so it is broadcast.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), 4))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    if n > max_train_docs:
        known = known.orderBy(F.xxhash64("doc_id", F.lit("toxicity"))).limit(max_train_docs)
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", (F.col("toxic") > 0).cast("int").alias("toxic"))


def _count_features(batches):
    """Documents of each kind that hold a feature, summed per task."""
    counts: dict[str, list[int]] = {}

    def drain():
        return pd.DataFrame([(k, a, b) for k, (a, b) in counts.items()], columns=["feature", "clean", "toxic"], dtype=object)

    for pdf in batches:
        for text, toxic in zip(pdf["text"], pdf["toxic"]):
            for feature in {f for w in set(_words(text)) for f in _features(w)}:
                counts.setdefault(feature, [0, 0])[toxic] += 1
            if len(counts) > 300_000:
                yield drain()
                counts.clear()
    if counts:
        yield drain()


def train(docs: DataFrame, labels: DataFrame, prior: float = 20.0, min_z: float = 3.0, min_docs: int = 4,
          max_train_docs: int = 200_000) -> ToxicityModel:
    """Fit token scores and calibration on the labelled documents that are not held out."""
    rows = materialise(training_rows(docs, labels, max_train_docs), "toxicity-train")
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    model = ToxicityModel()
    if not clean or not toxic:
        return model
    # A document of each kind as a draw: prior * share pseudo-documents hold the token.
    counts = rows.mapInPandas(_count_features, "feature string, clean long, toxic long").groupBy("feature").agg(
        F.sum("clean").alias("c0"), F.sum("toxic").alias("c1")).where(F.col("c0") + F.col("c1") >= min_docs)
    a = F.lit(prior) * (F.col("c0") + F.col("c1")) / F.lit(float(clean + toxic))
    odds = lambda c, n: F.log((F.col(c) + a) / (F.lit(float(n) + prior) - F.col(c) - a))
    counts = counts.withColumn("s", odds("c1", toxic) - odds("c0", clean)).withColumn(
        "z", F.col("s") / F.sqrt(1 / (F.col("c1") + a) + 1 / (F.col("c0") + a)))
    toxic_word = (F.col("z") >= min_z) & (F.col("s") > 1.0) & (F.col("c1") >= min_docs)
    clean_word = (F.col("z") <= -min_z) & ~F.col("feature").endswith("*")
    model.tokens = {r["feature"]: r["s"] for r in counts.where(toxic_word | clean_word).select("feature", "s").collect()}
    _fit_drift_and_lambda(rows, model)
    _fit_curve(rows, model)
    return model


def _fit_drift_and_lambda(rows: DataFrame, model: ToxicityModel) -> None:
    """Word score histogram of both kinds (rounded scores: few rows), then drift and lambda."""

    def run(batches):
        memo = _Memo(model.word_score)
        for pdf in batches:
            tally: dict[tuple[int, float], int] = {}
            for text, toxic in zip(pdf["text"], pdf["toxic"]):
                s = memo.array(_words(text))
                s[s == -model.drift] = 0.0
                for v, n in zip(*np.unique(np.round(s, 1), return_counts=True)):
                    tally[toxic, v] = tally.get((toxic, v), 0) + int(n)
            yield pd.DataFrame([(t, v, n) for (t, v), n in tally.items()], columns=["toxic", "s", "n"])

    hist = rows.mapInPandas(run, "toxic int, s double, n long").groupBy("toxic", "s").agg(F.sum("n").alias("n")).orderBy("toxic", "s").collect()
    in_toxic, in_clean = ([(r["s"], r["n"]) for r in hist if r["toxic"] == k] for k in (1, 0))
    share = lambda h: sum(n for s, n in h if s > 0) / max(1, sum(n for _, n in h))
    mean = sum(s * n for s, n in in_clean) / max(1, sum(n for _, n in in_clean))
    # Log-odds of a word without a score, and never so little that clean text drifts upwards.
    model.drift = max(-math.log1p(-min(share(in_toxic), 0.5)), 2.0 * mean, 1e-3)
    total = max(1, sum(n for _, n in in_clean))
    grow = lambda lam: sum(n * math.exp(min(lam * (s or -model.drift), 500.0)) for s, n in in_clean) / total - 1.0
    lo, hi = 1e-3, 1e-3
    while grow(hi) < 0 and hi < 8.0:
        lo, hi = hi, hi * 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if grow(mid) < 0 else (lo, mid)
    model.lam = max(lo, 1e-2)


def _fit_curve(rows: DataFrame, model: ToxicityModel, width: float = 0.25) -> None:
    """Logistic curve over the histogram of both kinds of evidence (cells of ``width``: a bounded table)."""

    def run(batches):
        memo = _Memo(model.word_score)
        for pdf in batches:
            x = np.array([_evidence(t, model, memo) for t in pdf["text"]], float).reshape(-1, 3)
            cell = np.round(x / width)
            yield pd.DataFrame({"best": cell[:, 0], "every": cell[:, 1], "toxic": pdf["toxic"].to_numpy()})

    cells = rows.mapInPandas(run, "best double, every double, toxic int").groupBy("best", "every", "toxic").agg(
        F.count(F.lit(1)).alias("n")).orderBy("best", "every", "toxic").collect()
    x = np.array([[1.0, c["best"] * width, c["every"] * width] for c in cells])
    y = np.array([c["toxic"] for c in cells], float)
    n = np.array([c["n"] for c in cells], float)
    w = np.zeros(3)
    ridge = np.diag([1e-3, 0.05, 0.05])
    for _ in range(50):
        p = _probability(x[:, 1], x[:, 2], w)
        step = np.linalg.solve((x * (n * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (n * (y - p)) - ridge @ w)
        w = w + np.clip(step, -2.0, 2.0)
        if np.abs(step).max() < 1e-8:
            break
    model.weights = tuple(float(v) for v in w)
