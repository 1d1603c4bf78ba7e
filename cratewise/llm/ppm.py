"""LM scoring (operator 9): prediction by partial matching over bytes, and an add-one word model.

The byte model is a trie of the contexts of up to four bytes before a byte, with counts from all training
documents. A byte is coded in its longest context; there, and in each shorter one, every distinct byte seen
gives half a count to the escape (method D), and what longer contexts have predicted is excluded from
shorter ones. A text's score is the sum of log10 probabilities of its bytes and of its end. The word model
(``base_score``) adds one to the count of every word.

Nothing that grows with the corpus is sent to the driver or broadcast. Documents are cut into blocks of
some MB. A block lists its distinct words and byte 5-grams; counts are summed over all blocks by word and by
5-gram, the model is made where the contexts that share their last two bytes meet, and each block gets back
the numbers of just its own words and 5-grams. So a text of any length is scored with array lookups.

Words are told apart by 64-bit hashes. Defined results: NULL and empty texts are scored as their end alone.
Without training documents the counts are 0. Repeated rows are separate documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratewise.llm.common import Words, id_crc32, sorted_counts, steps
from cratewise.sources.stage import Stage

# Text bytes of a block: what one task scores at a time, beside the numbers of its words.
BLOCK_BYTES = 8 << 20

# Bytes that no UTF-8 text has: what stands before a text, and its end.
_BEFORE, _END = 0xFE, 0xFF

_WORD, _GRAM = 0, 1
# The end of a document as a word.
_END_WORD = 0x5851F42D4C957F2D


def _framed(texts: list[bytes]) -> np.ndarray:
    """Byte 5-grams (context of four and the byte) of all bytes of the texts, A-Z in lower case, and ends."""
    joined = b"".join([b"\xfe\xfe\xfe\xfe" + t.lower() + b"\xff" for t in texts])
    data = np.frombuffer(joined, np.uint8).astype(np.uint64)
    grams = np.zeros(len(data) - 4, np.uint64)
    for i in range(5):
        grams = grams << np.uint64(8) | data[i : len(data) - 4 + i]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 5
    starts = np.cumsum(sizes) - sizes
    keep = np.ones(len(grams), bool)
    for shift in (1, 2, 3, 4):  # those that end in what stands before the next text
        keep[starts[1:] - shift] = False
    return grams[keep]


class _Block:
    """Distinct words and 5-grams of a block with their training counts, and its documents."""

    def __init__(self) -> None:
        self.docs: list[tuple[int | None, bool, bytes]] = []
        self.size = 0

    def rows(self) -> tuple[dict[int, tuple[np.ndarray, np.ndarray]], bytes]:
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {_WORD: [], _GRAM: []}
        for held in (False, True):
            texts = [t for _, h, t in self.docs if h == held]
            if not texts:
                continue
            for first, last in steps(texts):
                part = texts[first:last]
                words = sorted_counts(Words(part).hashes)
                grams = sorted_counts(_framed(part))
                end = (np.array([_END_WORD], np.uint64), np.array([last - first]))
                for kind, both in ((_WORD, words), (_WORD, end), (_GRAM, grams)):
                    found[kind].append((both[0], both[1] * (not held)))
        merged = {
            kind: sorted_counts(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])) for kind, parts in found.items()
        }
        table = pa.table(
            {
                "doc_id": pa.array([d for d, _, _ in self.docs], pa.int64()),
                "held": pa.array([h for _, h, _ in self.docs]),
                "text": pa.array([t for _, _, t in self.docs], pa.large_binary()),
            }
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(table)
        return merged, sink.getvalue().to_pybytes()


_BLOCK_SCHEMA = "block bigint, kind int, key bigint, n bigint, docs binary"
_BLOCK_ARROW = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("key", pa.int64()), ("n", pa.int64()), ("docs", pa.binary())])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    block = _Block()

    def close() -> Iterator[pa.RecordBatch]:
        merged, docs = block.rows()
        yield pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([-1], pa.int32()), pa.array([0]), pa.array([len(block.docs)]), pa.array([docs], pa.binary())], schema=_BLOCK_ARROW
        )
        for kind, (keys, counts) in merged.items():
            for a in range(0, len(keys), 1 << 17):
                k, c = keys[a : a + (1 << 17)].view(np.int64), counts[a : a + (1 << 17)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(k), number)), pa.array(np.full(len(k), kind, np.int32)), pa.array(k), pa.array(c), pa.nulls(len(k), pa.binary())],
                    schema=_BLOCK_ARROW,
                )

    for batch in batches:
        texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
        for doc in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
            block.docs.append(doc)
            block.size += len(doc[2])
            if block.size >= BLOCK_BYTES:
                yield from close()
                number, block = number + 1, _Block()
    if block.docs:
        yield from close()


def model_of_contexts(counts: np.ndarray, *shorter: np.ndarray) -> np.ndarray:
    """log10 probability of every next byte in each of several contexts with all but their first byte in
    common.

    ``counts``: how often each byte follows, a row per context; ``shorter``: the same for the context without
    its first byte, its first two and so on, down to none.
    """
    probability = np.zeros(counts.shape)
    left = np.ones((len(counts), 1))  # of the escapes so far
    excluded = np.zeros(counts.shape, bool)
    for level in (counts, *shorter):
        free = np.where(excluded, 0.0, level)
        new = free > 0
        total = 2 * free.sum(axis=1, keepdims=True)
        seen = total > 0
        unit = left / np.where(seen, total, 1.0)
        probability = np.where(new, unit * (2 * free - 1), probability)
        left = np.where(seen, unit * new.sum(axis=1, keepdims=True), left)
        excluded |= new
    unseen = ~excluded
    probability = np.where(unseen, left / np.maximum(unseen.sum(axis=1, keepdims=True), 1), probability)
    return np.log10(probability)


def _contexts(lower: np.ndarray):
    anywhere = lower.sum(axis=0)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key", ignore_index=True)
        keys, n = rows["key"].to_numpy(), rows["n"].to_numpy().astype(np.float64)
        order = np.lexsort((keys, (keys >> 24) & 255))  # by the third byte before the last
        keys, n = keys[order], n[order]
        last, following = int(keys[0] >> 8) & 255, keys & 255
        two = np.bincount(following, weights=n, minlength=256)
        values = np.empty(len(keys))
        third = (keys >> 24) & 255
        cuts = np.flatnonzero(np.diff(third)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(keys)]):
            first, row = np.unique(keys[a:b] >> 32, return_inverse=True)
            four = np.zeros((len(first), 256))
            four[row, following[a:b]] = n[a:b]
            scores = model_of_contexts(four, four.sum(axis=0), two, lower[last], anywhere)
            values[a:b] = scores[row, following[a:b]]
        return pd.DataFrame({"key": keys, "value": values})

    return run


class _Lookup:
    """Values by 64-bit key: two open tables of places, and a search for the few keys that found no room.

    The tables hold 4 bytes a slot, and keys and values stay as they came, without a copy.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self._keys, self._values = keys, values
        self._bits = max(10, int(np.ceil(np.log2(max(len(keys), 1)))) + 1)
        self._tables = []
        rest = np.arange(len(keys), dtype=np.int32)
        for multiplier in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
            slot = self._slot(keys[rest], multiplier)
            places = np.zeros(1 << self._bits, np.int32)
            places[slot] = rest
            self._tables.append((multiplier, places))
            rest = rest[places[slot] != rest]
        self._rest = rest[np.argsort(keys[rest])]
        self._rest_keys = keys[self._rest]

    def _slot(self, keys: np.ndarray, multiplier: int) -> np.ndarray:
        slot = keys * np.uint64(multiplier)
        slot >>= np.uint64(64 - self._bits)
        return slot.view(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        multiplier, places = self._tables[0]
        place = places[self._slot(keys, multiplier)]
        missing = np.flatnonzero(self._keys[place] != keys)
        if len(missing):
            rest = keys[missing]
            multiplier, places = self._tables[1]
            found = places[self._slot(rest, multiplier)]
            still = np.flatnonzero(self._keys[found] != rest)
            if len(still):
                found[still] = self._rest[np.searchsorted(self._rest_keys, rest[still])]
            place[missing] = found
        return self._values[place]


_SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _scores(train_tokens: int, distinct: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = right.column("kind").to_numpy()
        keys, values = right.column("key").to_numpy().view(np.uint64), right.column("value").to_numpy()
        word, gram = _Lookup(keys[kind == _WORD], values[kind == _WORD]), _Lookup(keys[kind == _GRAM], values[kind == _GRAM])
        rest = np.log10(float(train_tokens + distinct + 1))
        out = []
        for payload in left.column("docs").to_pylist():
            docs = pa.ipc.open_stream(payload).read_all()
            texts = docs.column("text").to_pylist()
            for first, last in steps(texts):
                part = texts[first:last]
                words = Words(part)
                counts = word(np.append(words.hashes, np.uint64(_END_WORD)))
                logs = np.concatenate(([0.0], np.cumsum(np.log10(counts + 1) - rest)))
                known = np.concatenate(([0], np.cumsum(counts > 0)))
                a, b = words.bounds[:-1], words.bounds[1:]
                end = (np.log10(counts[-1] + 1) - rest, int(counts[-1] > 0))
                sums = np.concatenate(([0.0], np.cumsum(gram(_framed(part)))))
                stops = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1)
                out.append(
                    pa.table(
                        {
                            "doc_id": docs.column("doc_id")[first:last],
                            "held_out": docs.column("held")[first:last],
                            "n_tokens": pa.array(b - a + 1),
                            "n_known": pa.array(known[b] - known[a] + end[1]),
                            "base_score": pa.array(logs[b] - logs[a] + end[0]),
                            "score": pa.array(np.diff(sums[np.append(0, stops)])),
                        }
                    )
                )
        return pa.concat_tables([t.combine_chunks() for t in out])

    return run


def lm_scores(docs: DataFrame, held_out: Column | None = None) -> DataFrame:
    """Per document of (doc_id, text): what the contract of the module's head lists.

    ``held_out`` marks documents that are not learned from.
    """
    spark = docs.sparkSession
    stage = Stage(spark)
    held = F.pmod(id_crc32("doc_id"), F.lit(7)) == 2 if held_out is None else held_out
    rows = docs.select(F.col("doc_id").cast("bigint"), held.alias("held"), "text").mapInArrow(_blocks, _BLOCK_SCHEMA)
    blocks = stage.save("blocks", rows)
    asked = blocks.filter("kind >= 0").select("block", "kind", "key", "n")

    # Words: every block learns the whole count of each of its words.
    by_word = Window.partitionBy("key")
    words = asked.filter(F.col("kind") == _WORD).select("block", "kind", "key", "n", F.sum("n").over(by_word).cast("double").alias("value"))
    words = stage.save("words", words.withColumn("first", F.row_number().over(by_word.orderBy("block")) == 1))
    known = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("first") & (F.col("value") > 0)).alias("v")).first()

    # 5-grams: sums by key, then the contexts that share their last two bytes, at most 256 ** 3 rows.
    grams = stage.save("grams", asked.filter(F.col("kind") == _GRAM).groupBy("key").agg(F.sum("n").alias("n")))
    lower = np.zeros((256, 256))
    pairs = grams.groupBy(F.expr("(key >> 8) & 255").cast("int").alias("last"), F.expr("key & 255").cast("int").alias("next")).agg(F.sum("n").alias("n"))
    for r in pairs.collect():  # 256 x 256 rows at most
        lower[r["last"], r["next"]] = r["n"]
    model = grams.groupBy(F.expr("(key >> 8) & 65535")).applyInPandas(_contexts(lower), "key bigint, value double")
    values = asked.filter(F.col("kind") == _GRAM).select("block", "kind", "key").join(stage.save("model", model), "key").select("block", "kind", "key", "value")

    texts = blocks.filter("kind = -1").select("block", "docs").groupBy("block")
    numbers = words.select("block", "kind", "key", "value").unionByName(values).groupBy("block")
    scored = texts.cogroup(numbers).applyInArrow(_scores(known.n, known.v), _SCORED)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(known.n).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
