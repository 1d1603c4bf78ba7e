"""Quality classifier (operator 12): supervised subword embeddings.

Every word (a run without white space), every two words in a row and every character n-gram of a word with
a space on both sides (``NGRAMS``) is hashed to one of ``BUCKETS`` learned vectors; case and punctuation
count, and a word that follows itself has one bucket whatever the word. A document is the mean of the
vectors of all its features, and a linear layer with softmax gives the chance of class 1.

Learning. Each labelled document becomes a bag of buckets in Spark, so that its size is bounded whatever
the text's length. One task trains on the bags with numpy: stochastic gradient descent, a document at a
time, over ``EPOCHS`` passes in an order drawn from a fixed seed. One in ``CALIBRATE_EVERY`` of the documents
is set aside, and a logistic fit on their raw scores, weighted to the class shares of all labelled
documents, makes the result a probability. At most about ``LEARNED_PER_CLASS`` documents of each class are
learned from, picked by a hash of the id; with ``BUCKETS`` bounded entries each that bounds the task.

Scoring. The layer is linear, so a document's score is the mean of one number per bucket, summed over
stretches of a long text.

Defined results: NULL, empty and white-space texts have no features and get the probability of a zero
vector. Without any label the score is 0.5 everywhere; with labels of one class alone it is that class
(0 or 1). NULL labels and ids are not learned from; of an id's labels the lowest counts, of its texts the least.
Repeated rows are scored each.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.llm.common import id_crc32, mix

BUCKETS = 1 << 15
DIMENSIONS = 16
NGRAMS = (3, 4, 5)

# Labelled documents of each class that are learned from; of more, a hash of the id picks about as many.
LEARNED_PER_CLASS = 2048
CALIBRATE_EVERY = 4
EPOCHS = 8
RATE = 0.3
# Vectors move by the gradient times so much, since a document's gradient is spread over all its features.
VECTOR_RATE = 20.0
SEED = 12

# Characters whose features are held at once.
STRETCH_CHARS = 1 << 19

_SPACE = np.zeros(128, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CUT = re.compile(r"[\x20\x09-\x0D]")
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        row = np.full(n + STRETCH_CHARS // 4, base, np.uint64)
        row[0] = 1
        known = np.cumprod(row)
        _powers[base] = known
    return known[:n]


def feature_buckets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every feature of several texts, and which text it belongs to."""
    joined = " " + " ".join(texts) + " "
    letters = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    space = _SPACE[np.minimum(letters, 127)] & (letters < 128)
    letters = np.where(space, np.uint32(0x20), letters)
    n = len(letters)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((letters.astype(np.uint64) + np.uint64(1)) * _power(_BASE, n), out=sums[1:])
    inverse = _power(_INVERSE, n)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1

    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edge[0::2], edge[1::2]
    word = (sums[ends] - sums[starts]) * inverse[starts]
    own = np.searchsorted(np.cumsum(lengths), starts, side="right")
    near = np.flatnonzero(own[1:] == own[:-1])
    two = np.where(word[near] == word[near + 1], np.uint64(0), mix(word[near]) + word[near + 1])
    found = [(starts, word ^ np.uint64(1 << 40)), (starts[near], two ^ np.uint64(2 << 40))]
    spaces = np.concatenate(([0], np.cumsum(space)))
    for size in NGRAMS:
        at = np.arange(n - size + 1)
        # No space inside; one at either end stands for the border of the word.
        at = at[spaces[at + size - 1] == spaces[at + 1]]
        found.append((at, (sums[at + size] - sums[at]) * inverse[at] ^ np.uint64(size << 40)))
    place = np.concatenate([f[0] for f in found])
    bucket = (mix(np.concatenate([f[1] for f in found])) % np.uint64(BUCKETS)).astype(np.int64)
    # A gram that begins with the space before a text is one of that text.
    return bucket, np.searchsorted(np.cumsum(lengths), place, side="right")


def stretches(text: str) -> Iterator[str]:
    """A text in stretches that end at white space, so that no feature but a pair of words is cut."""
    start = 0
    while len(text) - start > STRETCH_CHARS:
        cut = _CUT.search(text, start + STRETCH_CHARS)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:]


def _steps(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """(numbers, stretches) of a few hundred thousand characters each."""
    numbers, held, size = [], [], 0
    for number, text in enumerate(texts):
        for part in stretches(text):
            if held and size + len(part) > STRETCH_CHARS:
                yield numbers, held
                numbers, held, size = [], [], 0
            numbers.append(number)
            held.append(part)
            size += len(part)
    if held:
        yield numbers, held


def bags(texts: list[str]) -> list[np.ndarray]:
    """How often each bucket occurs, for each text."""
    out = [np.zeros(BUCKETS, np.float32) for _ in texts]
    for numbers, held in _steps(texts):
        bucket, owner = feature_buckets(held)
        for i, number in enumerate(numbers):
            out[number] += np.bincount(bucket[owner == i], minlength=BUCKETS)
    return out


@dataclass
class QualityModel:
    """Vectors of the buckets, the layer on top, and the calibration of its raw score."""

    vectors: np.ndarray | None = None
    layer: np.ndarray | None = None  # (DIMENSIONS + 1, 2), the bias last
    slope: float = 1.0
    offset: float = 0.0
    constant: float | None = 0.5

    def bucket_scores(self) -> np.ndarray:
        """What a feature of each bucket adds to the difference of the two outputs."""
        return (self.vectors @ (self.layer[:-1, 1] - self.layer[:-1, 0])).astype(np.float64)

    def raw(self, texts: list[str]) -> np.ndarray:
        of_bucket = self.bucket_scores()
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for numbers, held in _steps(texts):
            bucket, owner = feature_buckets(held)
            np.add.at(total, numbers, np.bincount(owner, of_bucket[bucket], len(held)))
            np.add.at(count, numbers, np.bincount(owner, minlength=len(held)))
        return total / np.maximum(count, 1) + float(self.layer[-1, 1] - self.layer[-1, 0])

    def probability(self, texts: list[str]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(texts) + self.offset, -500, 500)))

    def vectors_of(self, texts: list[str]) -> np.ndarray:
        """The mean vector of each text."""
        out = np.zeros((len(texts), DIMENSIONS))
        if self.vectors is not None:
            for i, bag in enumerate(bags(texts)):
                out[i] = bag @ self.vectors / max(bag.sum(), 1)
        return out


def train(ids: list[np.ndarray], weights: list[np.ndarray], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and layer, by stochastic gradient descent; both classes weigh alike.

    ``ids`` and ``weights`` are the distinct buckets of each document and their shares.
    """
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((DIMENSIONS + 1, 2), np.float32)
    layer[:-1] = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (DIMENSIONS, 2))
    share = len(classes) / (2 * np.maximum(np.bincount(classes, minlength=2), 1))
    steps, done = EPOCHS * len(classes), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(classes)).tolist():
            rate = RATE * (1 - done / steps)
            done += 1
            mean = weights[i] @ vectors[ids[i]]
            z = mean @ layer[:-1] + layer[-1]
            p = np.exp(z - z.max())
            p /= p.sum()
            p[classes[i]] -= 1
            p *= rate * min(share[classes[i]], 8.0)
            back = layer[:-1] @ p
            layer[:-1] -= np.outer(mean, p)
            layer[-1] -= p
            vectors[ids[i]] -= np.outer(VECTOR_RATE * weights[i], back)
    return vectors, layer


def _calibrate(raw: np.ndarray, classes: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit with a light penalty, by Newton's method."""
    x = np.column_stack((raw, np.ones(len(raw))))
    beta, penalty = np.array([1.0, 0.0]), np.diag([1e-2, 1e-3])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (p - classes)) + penalty @ (beta - np.array([1.0, 0.0]))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian, gradient)
        beta = beta - step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", per_class: int = LEARNED_PER_CLASS) -> QualityModel:
    """Learn ``target`` (0 or 1) of ``labels`` (doc_id) from the texts of ``docs``; the caller leaves out
    what is held out. The chosen ids, about ``2 * per_class`` at most, are broadcast."""
    known = (
        labels.select("doc_id", F.col(target).alias("label")).dropna()
        .groupBy("doc_id").agg((F.min("label") > 0).cast("int").alias("label"))
    )
    sizes = {r.label: r["count"] for r in known.groupBy("label").count().collect()}  # two rows at most
    if len(sizes) < 2:
        return QualityModel(constant=float(next(iter(sizes))) if sizes else 0.5)
    share = F.pmod(F.xxhash64("doc_id", F.lit("learn")), F.lit(1 << 30)) / float(1 << 30)
    size = F.when(F.col("label") == 1, sizes[1]).otherwise(sizes[0])
    chosen = known.filter(share * size < per_class)
    texts = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    )

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                counts = bags([batch.column(1)[row].as_py() or ""])[0]
                ids = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, 1),
                        batch.column(2).slice(row, 1),
                        pa.array([ids.astype(np.uint16).tobytes()], pa.binary()),
                        pa.array([counts[ids].tobytes()], pa.binary()),
                    ],
                    ["name", "label", "ids", "counts"],
                )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns[1:]])]
        ids = [np.frombuffer(r[1], np.uint16).astype(np.int64) for r in rows]
        counts = [np.frombuffer(r[2], np.float32) for r in rows]
        weights = [c / max(c.sum(), 1) for c in counts]
        classes = np.array([r[0] for r in rows], np.int64)
        aside = np.arange(len(rows)) % CALIBRATE_EVERY == 0
        use = [i for i in np.flatnonzero(~aside).tolist() if len(ids[i])]
        if len(set(classes[use].tolist())) < 2:
            use = [i for i in range(len(rows)) if len(ids[i])]
        if len(set(classes[use].tolist())) < 2:
            seen = set(classes[use].tolist()) or {0, 1}
            model = QualityModel(constant=sum(seen) / len(seen))
        else:
            vectors, layer = train([ids[i] for i in use], [weights[i] for i in use], classes[use])
            model = QualityModel(vectors, layer, constant=None)
            of_bucket = model.bucket_scores()
            raw = np.array([weights[i] @ of_bucket[ids[i]] for i in np.flatnonzero(aside)]) + float(layer[-1, 1] - layer[-1, 0])
            held = classes[aside]
            there = np.bincount(held, minlength=2)
            if there.min():
                per_row = np.array([sizes[0] / there[0], sizes[1] / there[1]])[held]
                model.slope, model.offset = _calibrate(raw, held, per_row * len(held) / per_row.sum())
            else:
                model.offset = math.log(sizes[1] / sizes[0])
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    trained = (
        texts.mapInArrow(bag, f"name {kind}, label int, ids binary, counts binary")
        .repartition(1).sortWithinPartitions(F.xxhash64("name", F.lit("order")), "name")
        .mapInArrow(learn, "model binary")
        .collect()  # one row, whose size the buckets bound
    )
    return pickle.loads(trained[0].model) if trained else QualityModel(constant=sizes[1] / (sizes[0] + sizes[1]))


def score(docs: DataFrame, model: QualityModel, text: str = "text", into: str = "quality_score") -> DataFrame:
    """Add ``into``, the chance of class 1; a column of that name is replaced, others pass through."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(into)
    place = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            found = pa.array(shared.value.probability(texts), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, into])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields]
    return kept.mapInArrow(run, ", ".join([*fields, f"`{into}` double"]))


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, cutoff: float = 0.3) -> DataFrame:
    """Score per document; labels of fold 0 are never looked at."""
    fold = F.pmod(id_crc32("doc_id"), F.lit(folds))
    model = fit(docs, labels.filter(fold != 0))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id",
        (fold == 0).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= cutoff).cast("int").alias("predicted"),
    )
