"""Toxicity (operator 4): maximum-scoring segments of token log-odds.

Learning. Words of labelled documents, and the beginnings of longer words, are counted in Spark by class,
once per document. A unit's score is its log-odds of standing in a toxic rather than a clean document under
an informative Dirichlet prior (``PRIOR_TOKENS`` tokens dealt out as in all labelled text), drawn towards 0
by ``CAUTION`` standard deviations. Units of either sign count, however rare; only those that this draws to 0
are left out of the model. A token has the most decided score of its word and its beginnings.
Every token also costs ``DRIFT``, so that neutral text has a negative sum and segments end.

Scoring. One pass finds all maximal scoring segments of a document (linear time, whatever its length). The
chance that neutral text of n tokens has a segment of score S or more is 1 - exp(-K n exp(-lambda S));
lambda solves sum p_w exp(lambda s_w) = 1 over the word frequencies p_w of clean documents. K is the mean of its
posterior given the best segments of clean documents set aside (those without a segment have score 0 and count as
such), under a prior worth one of them. Segments expected less than ``EXPECTED`` times are reported. The
best segment, all reported ones together and their number, in these units, are mapped to a probability by
a logistic fit on labelled documents set aside.

Defined results: NULL and empty texts have no segment and get the score of a text without any. Without
toxic or without clean labels every score is 0. Repeated rows are scored each; a repeated label counts as
toxic if any is.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.llm.common import id_crc32, leave_nothing, own_names

PRIOR_TOKENS = 10_000.0
CAUTION = 1.96
DRIFT = 0.1
EXPECTED = 0.05

# Labelled documents of each class that are learned from; of more, a hash of the id picks about as many.
LEARNED_PER_CLASS = 8192
# One in so many of these is set aside to calibrate.
CALIBRATE_EVERY = 4

# Letters of word beginnings.
BEGINNINGS = (7, 6, 5, 4)

# Token scores that a worker remembers before it starts anew; results do not depend on it.
REMEMBERED_TOKENS = 300_000

_TOKEN = re.compile(r"[^\W\d_]+")


class _Scores(dict):
    """Scores by token, looked up among the units once."""

    def __init__(self, units: dict[str, float]) -> None:
        super().__init__()
        self._units = units

    def __missing__(self, token: str) -> float:
        units = self._units
        found = units.get(token, 0.0)
        for n in BEGINNINGS:
            if len(token) > n:
                other = units.get(token[:n] + "*", 0.0)
                if abs(other) > abs(found):
                    found = other
        self[token] = found - DRIFT
        return found - DRIFT


def _units(tokens: list[str]) -> set[str]:
    words = set(tokens)
    return words | {w[:n] + "*" for w in words for n in BEGINNINGS if len(w) > n}


@dataclass
class ToxicityModel:
    """Scores of units (without drift) and calibration. The labelled documents used bound its size."""

    words: dict[str, float] = field(default_factory=dict)
    scale: float = 1.0  # lambda
    log_k: float = 0.0
    weights: tuple[float, ...] = ()
    _scores: _Scores | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_scores": None}

    def segments(self, tokens: list[str]) -> list[tuple[int, int, float]]:
        """Maximal scoring segments (first token, token after the last, score)."""
        if self._scores is None or len(self._scores) > REMEMBERED_TOKENS:
            self._scores = _Scores(self.words)
        values = np.fromiter(map(self._scores.__getitem__, tokens), np.float64, len(tokens))
        gains = np.flatnonzero(values > 0)
        if not len(gains):
            return []
        sums = np.concatenate(([0.0], np.cumsum(values)))
        # Each candidate: first, end, sum before it, sum at its end, place of the nearest candidate with a lower start.
        # A candidate that starts lower than all held ones makes these final.
        final: list[tuple[int, int, float, float, int]] = []
        held: list[tuple[int, int, float, float, int]] = []
        for i in gains.tolist():
            first, end, low, high = i, i + 1, float(sums[i]), float(sums[i + 1])
            j = len(held) - 1
            while True:
                while j >= 0 and held[j][2] >= low:
                    j = held[j][4]
                if j < 0:
                    final += held
                    held = [(first, end, low, high, -1)]
                    break
                if held[j][3] >= high:
                    held.append((first, end, low, high, j))
                    break
                first, _, low, _, lower = held[j]
                del held[j:]
                j = lower
        return [(first, end, high - low) for first, end, low, high, _ in final + held]

    def features(self, tokens: list[str]) -> tuple[list[tuple[int, int, float]], list[float]]:
        """Significant segments with their normalised scores, and the calibrated features."""
        size = math.log(max(len(tokens), 1))
        found = [(a, b, self.scale * s - self.log_k - size) for a, b, s in self.segments(tokens)]
        best = max([s for _, _, s in found], default=-size)
        significant = [x for x in found if x[2] > -math.log(EXPECTED)]
        together = sum(x[2] for x in significant)
        return significant, [1.0, best / 10, math.log1p(together), math.log1p(len(significant)), size / 10]

    def probability(self, features: list[float]) -> float:
        if not self.weights:
            return 0.0
        z = sum(w * x for w, x in zip(self.weights, features))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def tokens_of(text: str | None) -> list[str]:
    """Words in lower case, each by itself: some letters get longer, which moves no other word."""
    return [t.lower() for t in _TOKEN.findall(text or "")]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    leave_nothing()
    for batch in batches:
        totals: tuple[Counter, Counter] = (Counter(), Counter())
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            totals[toxic].update(_units(tokens_of(text)))
        names = list(totals[0] | totals[1])
        yield pa.RecordBatch.from_pydict(
            {"word": names, "clean": [totals[0][w] for w in names], "toxic": [totals[1][w] for w in names]},
            pa.schema([("word", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64())]),
        )


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Newton's method on the ridge-penalised likelihood; a handful of features."""
    beta = np.zeros(x.shape[1])
    penalty = np.diag([0.01, *[ridge] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty @ beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-9:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, per_class: int = LEARNED_PER_CLASS) -> ToxicityModel:
    """Learn from the labelled documents; the caller leaves out what is held out.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic. The chosen labels, at most about
    ``2 * per_class`` rows, are broadcast; so is the model later.
    """
    known = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return ToxicityModel()
    share = F.pmod(F.xxhash64("doc_id", F.lit("learn")), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.filter(share * F.when(F.col("toxic"), sizes[True]).otherwise(sizes[False]) < per_class).select(
        "doc_id",
        F.col("toxic").cast("int").alias("toxic"),
        (F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(CALIBRATE_EVERY)) == 0).alias("aside"),
    )
    learned = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    counts = (
        learned.filter("not aside").select("text", "toxic")
        .mapInArrow(_count, "word string, clean bigint, toxic bigint")
        .groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    ).persist()
    totals = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).first()
    n_clean, n_toxic = float(totals.clean or 0), float(totals.toxic or 0)
    if not n_clean or not n_toxic:
        counts.unpersist()
        return ToxicityModel()
    prior = F.lit(PRIOR_TOKENS / (n_clean + n_toxic)) * (F.col("clean") + F.col("toxic"))
    odds = lambda c, n: F.log((F.col(c) + prior) / (F.lit(n + PRIOR_TOKENS) - F.col(c) - prior))
    delta = odds("toxic", n_toxic) - odds("clean", n_clean)
    error = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    score = F.signum(delta) * F.greatest(F.lit(0.0), F.abs(delta) - CAUTION * error)
    # The labelled texts that are learned from bound the number of units.
    rows = counts.select("word", "clean", score.alias("score")).filter("score <> 0").orderBy("word").collect()
    counts.unpersist()
    model = ToxicityModel({r.word: r.score for r in rows})

    # lambda: neutral text gains nothing on average at that scale.
    gain = np.array([r.score for r in rows] + [0.0]) - DRIFT
    p = np.array([max(r.clean, 0.1) for r in rows] + [0.0]) / n_clean
    p[-1] = max(0.0, 1 - p.sum())
    low, high = 1e-6, 1.0
    while high < 64 and (p * np.exp(np.minimum(high * gain, 700))).sum() < 1:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (p * np.exp(np.minimum(middle * gain, 700))).sum() < 1 else (low, middle)
    model.scale = low

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [tokens_of(t) for t in batch.column(0).to_pylist()]
            best = [max([s for _, _, s in model.segments(t)], default=0.0) for t in texts]
            yield pa.RecordBatch.from_pydict({"toxic": batch.column(1), "n": pa.array(map(len, texts), pa.int64()), "best": pa.array(best, pa.float64())})

    aside = learned.filter("aside").select("text", "toxic")
    clean = [r for r in aside.mapInArrow(apart, "toxic int, n bigint, best double").collect() if not r.toxic]
    # Karlin and Altschul: P(best < S) = exp(-K n exp(-lambda S)), so that K has a gamma posterior.
    space = [r.n * math.exp(-model.scale * r.best) for r in clean if r.n]
    model.log_k = math.log((sum(r.best > 0 for r in clean) + 1) / (sum(space) + 1))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [model.features(tokens_of(t))[1] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"toxic": batch.column(1), "x": pa.array(rows, pa.list_(pa.float64()))})

    fitted = aside.mapInArrow(measured, "toxic int, x array<double>").collect()
    if not fitted:
        return model
    x = np.array(sorted([*r.x, float(r.toxic)] for r in fitted))
    y = x[:, -1]
    share_of = {True: sizes[True] / max(y.sum(), 1), False: sizes[False] / max((1 - y).sum(), 1)}
    weight = np.where(y > 0, share_of[True], share_of[False])
    model.weights = tuple(_logistic(x[:, :-1], y, weight * len(y) / weight.sum()).tolist())
    return model


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Add ``_toxicity`` (probability) and ``_segments``: significant passages as character spans with
    their normalised score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("_toxicity", "_segments")
    place, names = kept.columns.index(text), kept.columns
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leave_nothing()
        model = shared.value
        for batch in batches:
            scores, spans = [], []
            for value in batch.column(place).to_pylist():
                found, features = model.features(tokens_of(value))
                scores.append(model.probability(features))
                if found:
                    at = [m.span() for m in _TOKEN.finditer(value)]
                    found = [{"start": at[a][0], "end": at[b - 1][1], "score": s} for a, b, s in found]
                spans.append(found)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64()), pa.array(spans, kind)], [*names, "_toxicity", "_segments"]
            )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields]
    added = ["`_toxicity` double", "`_segments` array<struct<start: int, end: int, score: double>>"]
    return kept.mapInArrow(run, ", ".join([*fields, *added]))


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """Score per document; labels of fold 0 are never looked at."""
    fold = F.pmod(id_crc32("doc_id"), F.lit(folds))
    model = fit(docs, labels.filter(fold != 0))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        (fold == 0).alias("held_out"),
        F.col("_toxicity").alias("score"),
        (F.col("_toxicity") >= 0.5).cast("int").alias("predicted"),
        F.size("_segments").alias("n_segments"),
    )


def toxicity_filter(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, as they were; further columns may have any name."""
    inner, back = own_names(docs, "doc_id", "text")
    return back(score(inner, fit(inner, labels)).filter("_toxicity < 0.5"))
