"""Document fingerprints (operator 2): a homomorphic multiset hash of paragraphs.

A paragraph (a line that is not blank) becomes a wide vector of numbers; a document's fingerprint is the
sum of its paragraphs' vectors. So paragraph order does not matter, and a paragraph is put in or taken out
by adding or subtracting its vector. The vector has two parts:

* ``DIGEST`` numbers modulo 2**16, read off a cryptographic hash of the paragraph. Sums of these are equal only for equal
  multisets of paragraphs, up to chance.
* ``SKETCH`` numbers modulo 2**32, more than a text of Spark's 2 GB has pairs either way, that hold the
  paragraph's word pairs, each counted with a random sign at a random place. Sums of these keep inner products: their cosine estimates how alike two documents' word pairs are,
  also where an edit cuts through a paragraph.

Fingerprints are printed as base64: the digest, then the lower and the upper halves of the sketch with its
signs folded in (0, -1, 1, -2, ...), so that the upper halves of all but very long texts are zeros, which
compress. Likeness is the cosine of the sketches, from 0 to 1; it is 1 for equal
fingerprints, and 0 if just one of the documents has no words.

Defined results: NULL and empty texts have the zero fingerprint. Neighbours are by descending doc_id with
NULL last; rows with the same doc_id are ordered by text. With one document, it is its own neighbour.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from cratewise.llm.common import Words, mix, shuffle_partitions, steps

DIGEST = 32
SKETCH = 256
WIDTH = DIGEST + SKETCH
_PAIR = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def paragraphs(text: bytes) -> list[bytes]:
    """Lines with something but white space in them."""
    return [line for line in text.split(b"\n") if line.strip()]


@lru_cache(maxsize=50_000)
def _digest_of(paragraph: bytes) -> np.ndarray:
    return np.frombuffer(hashlib.blake2b(paragraph, digest_size=2 * DIGEST).digest(), "<u2")


def _digest(text: bytes) -> np.ndarray:
    """Sum of the paragraphs' digests; one pass over as many paragraphs as there are."""
    total = np.zeros(DIGEST, np.uint16)
    lines = paragraphs(text)
    if lines:
        short = [_digest_of(p) if len(p) < 512 else np.frombuffer(hashlib.blake2b(p, digest_size=2 * DIGEST).digest(), "<u2") for p in lines]
        total += np.add.reduce(short, axis=0, dtype=np.uint16)
    return total


def vectors(texts: list[bytes]) -> np.ndarray:
    """Fingerprint of each text, one row of ``WIDTH`` numbers."""
    out = np.zeros((len(texts), WIDTH), np.uint32)
    for first, last in steps(texts):
        part = texts[first:last]
        for i, text in enumerate(part):
            out[first + i, :DIGEST] = _digest(text)
        words = Words(part)
        h = words.hashes
        if not len(h):
            continue
        # Pairs of neighbouring words of a paragraph; its first word is paired with the edge.
        breaks = np.concatenate(([0], np.cumsum(words.data == 10)))
        line = breaks[words.starts]
        before = np.concatenate(([np.uint64(0)], np.where(line[1:] == line[:-1], h[:-1], np.uint64(0))))
        pair = mix(before * _PAIR[0] + h * _PAIR[1])
        owner = np.searchsorted(words.offsets, words.starts, side="right") - 1
        at = owner * SKETCH + (pair & np.uint64(SKETCH - 1)).astype(np.int64)
        sign = 1.0 - 2.0 * ((pair >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
        sums = np.bincount(at, weights=sign, minlength=len(part) * SKETCH).astype(np.int64)
        out[first:last, DIGEST:] = (sums & 0xFFFFFFFF).astype(np.uint32).reshape(len(part), SKETCH)
    return out


def printed(vector: np.ndarray) -> str:
    signed = vector[DIGEST:].astype(np.uint32).view(np.int32)
    folded = ((signed << 1) ^ (signed >> 31)).view(np.uint32)
    parts = (vector[:DIGEST] & 0xFFFF, folded & 0xFFFF, folded >> 16)
    return base64.b64encode(np.concatenate(parts).astype("<u2").tobytes()).decode()


def parsed(fingerprint: str) -> np.ndarray:
    digest, low, high = np.split(np.frombuffer(base64.b64decode(fingerprint), "<u2").astype(np.uint32), [DIGEST, WIDTH])
    folded = low | (high << 16)
    return np.concatenate((digest, (folded >> 1) ^ -(folded & 1)))


def added(fingerprint: str, text: str) -> str:
    """The fingerprint after the paragraphs of ``text`` have been put in."""
    return printed(parsed(fingerprint) + vectors([text.encode()])[0])


def removed(fingerprint: str, text: str) -> str:
    """The fingerprint after the paragraphs of ``text`` have been taken out."""
    return printed(parsed(fingerprint) - vectors([text.encode()])[0])


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of the fingerprints in the rows of two matrices."""
    a, b = x[:, DIGEST:].astype(np.int32).astype(np.float64), y[:, DIGEST:].astype(np.int32).astype(np.float64)
    norms = np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
    cosine = np.divide((a * b).sum(axis=1), norms, out=np.zeros(len(a)), where=norms > 0)
    return np.where((x == y).all(axis=1), 1.0, np.clip(cosine, 0.0, 1.0))


def fingerprints(docs: DataFrame, text: str = "text", into: str = "_fingerprint") -> DataFrame:
    """Add the printed fingerprint of every text; other columns pass through."""
    kept = docs.drop(into)
    place, names = kept.columns.index(text), kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = vectors([v or b"" for v in batch.column(place).cast(pa.binary()).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(map(printed, found), pa.string())], [*names, into])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields]
    return kept.mapInArrow(run, ", ".join([*fields, f"`{into}` string"]))


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the start of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def neighbour_runs(docs: DataFrame) -> DataFrame:
    """Rows of (doc_id, text) dealt to ranges of descending doc_id, each followed by a guest.

    Column ``run`` numbers the ranges and ``guest`` marks the first rows of the next range, which the last
    row of this one needs. Texts are shuffled once. Bounds and first ids of the ranges come from the ids
    alone; there is one of each per range.
    """
    spark = docs.sparkSession
    n = 4 * shuffle_partitions(spark)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    cuts = ids.filter("doc_id is not null").agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10_000).alias("cuts")).first().cuts
    cuts = sorted(set(cuts or []), reverse=True)
    # Run 0 has the ids above the first cut; NULL ids come last.
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    shared = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(F.size(F.filter(bounds, lambda c: c >= F.col("doc_id"))))
    heads = [Row(run=r.run, head=r.head) for r in ids.groupBy(shared.alias("run")).agg(F.max("doc_id").alias("head")).orderBy("run").collect()]
    # A run's first id goes to the run before as well; that of the first run to the last.
    guests = [(h.head, heads[i - 1].run) for i, h in enumerate(heads)]
    known = {head: run for head, run in guests if head is not None}
    null_guest = next((run for head, run in guests if head is None), None)
    guest_of = F.create_map(*[F.lit(x) for pair in known.items() for x in pair]) if known else F.lit(None).cast("map<bigint,int>")
    guest = F.when(F.col("doc_id").isNull(), F.lit(null_guest).cast("int")).otherwise(guest_of[F.col("doc_id")])
    own = F.struct(shared.cast("int").alias("run"), F.lit(0).alias("guest"))
    also = F.struct(guest.cast("int").alias("run"), F.lit(1).alias("guest"))
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = dealt.select("doc_id", "text", F.explode(F.when(guest.isNull(), F.array(own)).otherwise(F.array(own, also))).alias("to"))
    return (
        dealt.select("to.run", "to.guest", "doc_id", "text")
        .repartition(shuffle_partitions(spark), "run")
        .sortWithinPartitions("run", "guest", F.desc_nulls_last("doc_id"), "text")
    )


_FIELDS = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edits, and how near both they and their neighbours are."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int | None, str, str]]]:
        """Documents with their successors, some at a time."""
        out, size = [], 0
        last, run, closed = None, None, True
        for batch in batches:
            for number, guest, doc_id, text in zip(*[c.to_pylist() for c in batch.columns]):
                if number != run:
                    last, run, closed = None, number, False
                if last is not None and not closed:
                    out.append((*last, text))
                    size += len(text)
                    closed = bool(guest)
                    if size > 1 << 20:
                        yield out
                        out, size = [], 0
                last = (doc_id, text)
        if out:
            yield out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in pairs(batches):
            texts = [t.encode() for _, t, _ in held]
            edits = [edited(t, f).encode() for _, t, f in held]
            whole, cut = vectors(texts), vectors(edits)
            # The successor is mostly the next row, whose vector is known.
            follows = [i + 1 if i + 1 < len(held) and held[i][2] is held[i + 1][1] else -1 for i in range(len(held))]
            alone = [i for i, f in enumerate(follows) if f < 0]
            after = whole[follows]
            after[alone] = vectors([held[i][2].encode() for i in alone])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([d for d, _, _ in held], pa.int64()),
                    "n_chars": pa.array([len(t) for _, t, _ in held], pa.int64()),
                    "edited_sha256": [hashlib.sha256(e).hexdigest() for e in edits],
                    "fingerprint": [printed(v) for v in whole],
                    "edited_fingerprint": [printed(v) for v in cut],
                    "near_edited": likeness(whole, cut),
                    "near_next": likeness(whole, after),
                }
            )

    return neighbour_runs(docs).mapInArrow(run, _FIELDS)
