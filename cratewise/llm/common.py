"""What several operators share: table access, word patterns, hashed words of many texts at once."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Generic, TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the word contracts, for Java and DuckDB patterns alike.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Text bytes that one vectorised step handles; a longer document is a step of its own.
STEP_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def own_names(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with every column but ``used`` under a name no operator uses, and what gives the columns back.

    So columns that a caller adds may have any name, those of an operator's own columns included.
    """
    names = docs.columns
    inner = [c if c in used else f"extra {i}" for i, c in enumerate(names)]
    return docs.toDF(*inner), lambda rows: rows.select(*[f"`{c}`" for c in inner]).toDF(*names)


def words(text: Column | str) -> Column:
    """Words of a text, none for NULL."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def id_crc32(doc_id: Column | str) -> Column:
    """Unsigned crc32 of the id as text, which deals rows to folds; NULL ids count as empty."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text of an Arrow column, empty for NULL."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def steps(texts: list[bytes], limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts that hold ``limit`` bytes at most, or one text."""
    first = size = 0
    for index, text in enumerate(texts):
        if index > first and size + len(text) > limit:
            yield first, index
            first, size = index, 0
        size += len(text)
    if texts:
        yield first, len(texts)


class WordMemory:
    """Results by word, in two generations of at most ``most`` words each (or one step's words).

    Words that are asked for move to the younger one. When that is full it becomes the older one, whose
    predecessor goes; so frequent words stay, and a word that is rare is forgotten after a while.
    """

    def __init__(self, most: int) -> None:
        self._most = most
        self.known: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}

    def missing(self, words: set[bytes]) -> set[bytes]:
        """Words without a result, which the caller then adds to ``known``; all others are in it."""
        new = words.difference(self.known)
        if self.known and len(self.known) + len(new) > self._most:
            self.known, self._older, new = {}, self.known, words
        older = self._older
        kept = {w: older[w] for w in new if w in older}
        self.known.update(kept)
        return new.difference(kept)


_Made = TypeVar("_Made")
_in_worker: dict[tuple[str, str], object] = {}


def in_worker(key: tuple[str, str], make: Callable[[], _Made]) -> _Made:
    """What tasks of a worker share, made by the first of them. A worker holds one such thing at a time."""
    if key not in _in_worker:
        _in_worker.clear()
        _in_worker[key] = make()
    return _in_worker[key]


def leave_nothing() -> None:
    """Drop what tasks of an earlier operator still hold in this worker; for tasks that share nothing.

    A worker outlives the operator that filled it, and next to an idle tokenizer others have less memory.
    """
    _in_worker.clear()


_Key = TypeVar("_Key")
_Value = TypeVar("_Value")


class TwoGenerations(Generic[_Key, _Value]):
    """A memory of bounded size that keeps what is in use.

    Entries that are found move to the younger of two generations; when it is full, the older one is
    dropped and the younger takes its place.
    """

    def __init__(self, size: int) -> None:
        self._size = size
        self._young: dict[_Key, _Value] = {}
        self._old: dict[_Key, _Value] = {}

    def find(self, keys: Iterable[_Key]) -> dict[_Key, _Value]:
        """The known ones of some keys."""
        young, old = self._young, self._old
        found = {key: young[key] for key in keys if key in young}
        moved = {key: old[key] for key in keys if key in old and key not in found}
        found.update(moved)
        self.update(moved)
        return found

    def update(self, entries: dict[_Key, _Value]) -> None:
        if len(self._young) + len(entries) > self._size:
            self._old, self._young = self._young, {}
        self._young.update(entries)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shifted = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in visible)}
    return [shifted.get(b, chr(b)) for b in range(256)]


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        row = np.full(max(n, STEP_BYTES + 4096), base, np.uint64)
        row[0] = 1
        known = np.cumprod(row)
        if n <= STEP_BYTES + 4096:  # what a very long text needs is not kept
            _powers[base] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_spans(text: bytes | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions at which the words of a text that ends with white space start and end."""
    space = _IS_SPACE[np.frombuffer(text, np.uint8)]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


class Words:
    """Words of several texts: 64-bit hashes in order, A-Z in lower case.

    The hash is a polynomial over the bytes, read off prefix sums, so no word becomes an object.
    Words of text ``i`` are ``hashes[bounds[i]:bounds[i + 1]]``; ``starts`` and ``ends`` are byte
    positions in ``data``, the texts joined by line feeds.
    """

    def __init__(self, texts: list[bytes]) -> None:
        joined = b"\n".join(texts) + b"\n"
        self.data = _LOWER[np.frombuffer(joined, np.uint8)]
        self.starts, self.ends = word_spans(self.data)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(self.data)), out=sums[1:])
        own = (sums[self.ends] - sums[self.starts]) * _power(_INVERSE, len(self.data))[self.starts]
        self.hashes = mix(own ^ ((self.ends - self.starts).astype(np.uint64) << np.uint64(48)))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.offsets = np.concatenate(([0], np.cumsum(lengths)))
        self.bounds = np.searchsorted(self.starts, self.offsets)


def sorted_counts(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs (or the sum of its counts)."""
    if counts is None:
        keys = np.sort(keys)
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        return keys[first], np.diff(np.append(first, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts
