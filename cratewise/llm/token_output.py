"""Token-ID output (operator 1): documents as range-coded id blocks, written and read by Spark.

Layout of a written folder: Parquet rows (part, segment, n_ids, payload). ``part`` numbers the tasks in
ascending doc_id order and ``segment`` counts within a part; ``payload`` is one segment of
:mod:`cratewise.llm.idcoder`. Spark commits whole task outputs, so a lost executor leaves no torn file.

NULL doc_ids come first and equal ones are ordered by text. NULL and empty texts yield the end id alone.
"""

from __future__ import annotations

import json
import os
import string
import zlib
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cratewise.llm import idcoder
from cratewise.llm.common import WordMemory, in_worker, mix, shuffle_partitions, steps, text_bytes, word_spans
from cratewise.sources.stage import Stage

# Ids of a segment: it is closed with the document that reaches them.
SEGMENT_IDS = 6 << 20

# Words whose ids a worker remembers, in each of two generations; results do not depend on it. Those of at
# most SHORT bytes take about 60 bytes each, in arrays; the few others are objects.
REMEMBERED_WORDS = 1 << 20
REMEMBERED_LONG = 50_000
SHORT = 16

# Words that one call of the library encodes.
ASKED_AT_ONCE = 1024

# The normaliser and splitter whose words need no encoding of their own for A-Z and trailing punctuation.
_FOLDED = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_TAIL = 4  # longest punctuation that is cut off

_PARTS = [("<u8", 0), ("<u8", 8)]
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class _Words:
    """Distinct short words and their ids, found by open addressing; the whole word is compared."""

    def __init__(self, most: int) -> None:
        self._bits = max(4, (2 * most - 1).bit_length())
        self._slots = np.full(1 << self._bits, -1, np.int32)
        self._keys = [np.zeros(most, np.uint64), np.zeros(most, np.uint64), np.zeros(most, np.uint8)]
        self._begin = np.zeros(most + 1, np.int64)
        self._ids = np.zeros(4 * most, np.int32)
        self.size = 0

    def _slot(self, keys: list[np.ndarray]) -> np.ndarray:
        low, high, length = keys
        return (mix(low ^ mix(high + length)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def find(self, keys: list[np.ndarray]) -> np.ndarray:
        """Number of each word, -1 for one that is not here."""
        slot, last = self._slot(keys), len(self._slots) - 1
        found = self._slots[slot]
        todo = np.flatnonzero(found >= 0)
        while len(todo):
            here = found[todo]
            other = np.zeros(len(todo), bool)
            for own, key in zip(self._keys, keys):
                other |= own[here] != key[todo]
            todo = todo[other]
            slot[todo] = (slot[todo] + 1) & last
            found[todo] = self._slots[slot[todo]]
            todo = todo[found[todo] >= 0]
        return found

    def add(self, keys: list[np.ndarray], counts: np.ndarray, ids: np.ndarray) -> None:
        """Add distinct words that are not here; ``ids`` holds those of all words, ``counts`` of each."""
        first, last = self.size, self.size + len(counts)
        for own, key in zip(self._keys, keys):
            own[first:last] = key
        self._begin[first + 1 : last + 1] = self._begin[first] + np.cumsum(counts)
        if self._begin[last] > len(self._ids):
            self._ids = np.resize(self._ids, max(2 * len(self._ids), int(self._begin[last])))
        self._ids[self._begin[first] : self._begin[last]] = ids
        self.size = last
        number, slot = np.arange(first, last, dtype=np.int32), self._slot(keys)
        while len(number):
            free = self._slots[slot] < 0
            self._slots[slot[free]] = number[free]
            left = self._slots[slot] != number
            number, slot = number[left], (slot[left] + 1) & (len(self._slots) - 1)

    def ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each of these words has, and all of them in order."""
        begin = self._begin[numbers]
        counts = self._begin[numbers + 1] - begin
        return counts, self._ids[_ranges(begin, counts)]


def _ranges(begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... of each count, one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(begin - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def _distinct(keys: list[np.ndarray]) -> np.ndarray:
    """One place of each distinct word."""
    order = np.lexsort(keys)
    rows = [key[order] for key in keys]
    first = np.ones(len(order), bool)
    first[1:] = reduce(np.logical_or, [row[1:] != row[:-1] for row in rows])
    return order[first]


def _among(values: Iterable[int]) -> np.ndarray:
    """Whether each byte is one of these."""
    found = np.zeros(256, bool)
    found[list(values)] = True
    return found


# Letters of Latin-1 beyond ASCII are two bytes, of which the first is LATIN.
_LATIN, _SECOND = 0xC3, _among(set(range(0x80, 0xC0)) - {0x97, 0xB7})


class _Pieces:
    """Words cut and lower-cased as the tokenizer itself does first, so that fewer of them are distinct.

    Where normaliser and splitter are the known ones, punctuation after a letter of Latin-1 begins a piece
    of its own, and a word of such letters alone is plain: the splitter leaves it whole, and A-Z have the
    ids of a-z in it. Neither touches a special token: no byte of one is cut off, and none is of letters
    alone. Other tokenizers' words stay as they are.
    """

    def __init__(self, description: str) -> None:
        spec = json.loads(description)
        normal = (spec.get("normalizer") or {}).get("normalizers", [])
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        special = [t["content"] for t in spec["added_tokens"]]
        self._known = (
            [n["type"] for n in normal] == _FOLDED
            and (normal[1]["pattern"], normal[1]["content"]) == ({"Regex": r"\s+"}, " ")
            and [p["type"] for p in split] == ["Split", "ByteLevel"]
            and (split[0]["pattern"], split[0]["behavior"], split[0]["invert"]) == ({"Regex": _SPLIT}, "Removed", True)
            and not (split[1]["add_prefix_space"] or split[1]["use_regex"])
            and not any(t.isalpha() or t.split() != [t] for t in special)
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"])
            and spec["model"]["type"] == "BPE"
            and not spec["model"].get("dropout")
        )
        self._tail = _among(c for c in string.punctuation.encode() if not any(chr(c) in t for t in special))

    def cut(self, text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
        """The text and its words (in order, none empty) as pieces with the same ids, and which of them are plain."""
        if not self._known or not len(starts):
            return text, starts, ends, np.zeros(len(starts), bool)
        data = np.frombuffer(text, np.uint8).copy()
        letter = ((data | 32) - 97) < 26
        pair = np.flatnonzero(data == _LATIN)
        pair = pair[_SECOND[data[pair + 1]]]
        letter[pair] = letter[pair + 1] = True
        at = np.flatnonzero(self._tail[data[ends - 1]])
        place, found = ends[at] - 1, []
        for _ in range(_TAIL):
            inside = place > starts[at]
            at, place = at[inside], place[inside]
            here = letter[place - 1]
            found.append((at[here], place[here]))
            more = self._tail[data[place - 1]]
            at, place = at[more], place[more] - 1
        at, place = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(at)
        at, place = at[order], place[order]
        starts, ends = np.insert(starts, at + 1, place), np.insert(ends, at, place)
        others = np.cumsum(~letter, dtype=np.int32)
        plain = others[ends - 1] == others[starts]
        plain &= letter[starts]
        upper = np.flatnonzero((data - 65) < 26)
        data[upper[plain[np.searchsorted(starts, upper, side="right") - 1]]] += 32
        return data.tobytes(), starts, ends, plain


class WordCache:
    """The tokenizers library, asked for a word only if it is not remembered.

    For tokenizers that drop white space; others raise ``ValueError``. Special tokens in the text count
    as such, since none of them holds white space.
    """

    def __init__(self, description: str) -> None:
        self._library = Tokenizer.from_str(description)
        self._library.no_truncation()
        self._library.no_padding()
        ids = lambda text: self._library.encode(text, add_special_tokens=False).ids
        if ids(" ab\n\t\rc \x0b\x0c") != ids("ab") + ids("c"):
            raise ValueError("the tokenizer keeps white space")
        self._pieces = _Pieces(description)
        # Which ids end a plain word.
        suffix = json.loads(description)["model"].get("end_of_word_suffix") or ""
        vocab = self._library.get_vocab()
        self._final = np.zeros(1 + max(vocab.values()), bool)
        self._final[[number for token, number in vocab.items() if suffix and token.endswith(suffix)]] = True
        self._long = WordMemory(REMEMBERED_LONG)
        self._young, self._old = _Words(REMEMBERED_WORDS), None

    def _ask(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each of these words has, and all of them in order."""
        counts, ids = [], [np.zeros(0, np.int32)]
        for first in range(0, len(words), ASKED_AT_ONCE):
            own = b"\n".join(words[first : first + ASKED_AT_ONCE]).decode().split("\n")
            coded = [c.ids for c in self._library.encode_batch_fast(own, add_special_tokens=False)]
            counts += map(len, coded)
            ids.append(np.fromiter(chain.from_iterable(coded), np.int32))
        return np.array(counts, np.int64), np.concatenate(ids)

    def _ask_plain(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for plain words, which the library gets many in a text."""
        found = []
        for first in range(0, len(words), ASKED_AT_ONCE):
            own = words[first : first + ASKED_AT_ONCE]
            (coded,) = self._library.encode_batch_fast([b" ".join(own).decode()], add_special_tokens=False)
            ids = np.array(coded.ids, np.int32)
            ends = np.flatnonzero(self._final[ids])
            # Without a mark at each word's end, they are asked for one by one.
            whole = len(ends) == len(own) and ends[-1] == len(ids) - 1
            found.append((np.diff(ends, prepend=-1), ids) if whole else self._ask(own))
        counts, ids = zip(*found)
        return np.concatenate(counts), np.concatenate(ids)

    def _short_words(self, text: bytes, starts: np.ndarray, lengths: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each of these words of the text has, and all of them in order."""
        keys = []
        for kind, offset in _PARTS:
            eight = np.ndarray(len(text) - offset - 7, kind, text, offset, (1,))[starts]
            keys.append(eight & _MASKS[np.clip(lengths - offset, 0, 8)])
        keys.append(lengths.astype(np.uint8))
        pick = lambda at: [key[at] for key in keys]
        numbers = self._young.find(keys)
        missing = np.flatnonzero(numbers < 0)
        new = missing[_distinct(pick(missing))]
        if self._young.size + len(new) > REMEMBERED_WORDS:
            missing = np.arange(len(starts))
            new = _distinct(keys)
            self._old, self._young = self._young, _Words(max(REMEMBERED_WORDS, len(new)))
        if self._old is not None and len(new):
            known = self._old.find(pick(new))
            kept = known >= 0
            self._young.add(pick(new[kept]), *self._old.ids(known[kept]))
            new = new[~kept]
        for own, ask in ((new[plain[new]], self._ask_plain), (new[~plain[new]], self._ask)):
            if len(own):
                words = [text[a:b] for a, b in zip(starts[own].tolist(), (starts[own] + lengths[own]).tolist())]
                self._young.add(pick(own), *ask(words))
        numbers[missing] = self._young.find(pick(missing))
        return self._young.ids(numbers)

    def _long_words(self, words: list[bytes]) -> list[bytes]:
        new = self._long.missing(set(words))
        known = self._long.known
        if new:
            order = list(new)
            counts, ids = self._ask(order)
            ends = (4 * np.cumsum(counts)).tolist()
            packed = ids.tobytes()
            known.update((w, packed[a:b]) for w, a, b in zip(order, [0, *ends], ends))
        return [known[w] for w in words]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        out = []
        for first, last in steps(texts):
            joined = b"\n".join([b"", *texts[first:last], bytes(SHORT)])
            joined, starts, ends, plain = self._pieces.cut(joined, *word_spans(joined[:-SHORT]))
            lengths = ends - starts
            short = lengths <= SHORT
            counts = np.zeros(len(starts), np.int64)
            counts[short], ids = self._short_words(joined, starts[short], lengths[short], plain[short])
            place = np.flatnonzero(~short)
            if len(place):
                spans = zip(starts[place].tolist(), ends[place].tolist())
                found = self._long_words([joined[a:b] for a, b in spans])
                counts[place] = np.fromiter(map(len, found), np.int64, len(found)) >> 2
                own = np.repeat(short, counts)
                both = np.zeros(len(own), np.int32)
                both[own] = ids
                both[~own] = np.frombuffer(b"".join(found), np.int32)
                ids = both
            sums = np.concatenate(([0], np.cumsum(counts)))
            sizes = np.fromiter(map(len, texts[first:last]), np.int64, last - first) + 1
            bounds = sums[np.searchsorted(starts, 1 + np.concatenate(([0], np.cumsum(sizes))))]
            out += [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        return out


def _cache(description: str) -> WordCache:
    # A task has one core; threads of the library would only compete with those of other tasks.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return in_worker(("words", description), lambda: WordCache(description))


def write_token_blocks(docs: DataFrame, description: str, end_id: int, folder: str) -> None:
    """Write the ids of (doc_id, text), each document with ``end_id`` after it, to a new folder.

    Texts are shuffled once, by ranges of doc_id; tokenizing and coding follow in the same task.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(description)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, part = _cache(shared.value), TaskContext.get().partitionId()
        end = np.array([end_id], np.int32)
        names, held, size, segment = [], [], 0, 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"part": [part], "segment": [segment], "n_ids": [size], "payload": [idcoder.pack(names, held)]},
                pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("n_ids", pa.int64()), ("payload", pa.binary())]),
            )

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), cache.encode(text_bytes(batch.column(1)))):
                names.append(doc_id)
                held.append(np.concatenate((ids, end)))
                size += len(ids) + 1
                if size >= SEGMENT_IDS:
                    yield close()
                    names, held, size, segment = [], [], 0, segment + 1
        if names:
            yield close()

    (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(shuffle_partitions(spark), F.asc_nulls_first("doc_id"))
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
        .mapInArrow(run, "part int, segment int, n_ids bigint, payload binary")
        .write.parquet(folder)
    )


_SPANS = "part int, segment int, within bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"


def read_token_documents(files: DataFrame) -> DataFrame:
    """Documents of a written folder: doc_id and ids as an array, each block checked by its crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                doc_ids, documents = idcoder.unpack(payload)
                for first, last in steps([d.tobytes() for d in documents]):
                    yield pa.RecordBatch.from_pydict(
                        {"doc_id": pa.array(doc_ids[first:last], pa.int64()), "ids": pa.array(documents[first:last], pa.list_(pa.int32()))}
                    )

    return files.select("payload").mapInArrow(run, "doc_id bigint, ids array<int>")


def token_spans(files: DataFrame) -> DataFrame:
    """Per document of a written folder: where its ids start in the whole, how many, and their crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, segment, payload in zip(*[column.to_pylist() for column in batch.columns]):
                doc_ids, documents = idcoder.unpack(payload)
                sizes = np.fromiter(map(len, documents), np.int64, len(documents))
                n = len(documents)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, part, np.int32)),
                        pa.array(np.full(n, segment, np.int32)),
                        pa.array(np.cumsum(sizes) - sizes),
                        pa.array(doc_ids, pa.int64()),
                        pa.array(sizes),
                        pa.array([zlib.crc32(d.astype("<u4").tobytes()) for d in documents], pa.int64()),
                    ],
                    ["part", "segment", "within", "doc_id", "n_tokens", "ids_crc32"],
                )

    spark = files.sparkSession
    documents = files.select("part", "segment", "payload").mapInArrow(run, _SPANS)
    segments = files.select("part", "segment", "n_ids")
    # One row per written part, of which there are as many as tasks.
    totals = segments.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    before, parts = 0, []
    for row in totals:
        parts.append((row.part, before))
        before += row.n
    earlier = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = segments.select(
        "part", "segment", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("in_part")
    ).join(F.broadcast(spark.createDataFrame(parts, "part int, before bigint")), "part")
    return documents.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("before") + F.col("in_part") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_output(docs: DataFrame, description: str, end_id: int) -> DataFrame:
    """Write all documents as token blocks to the stage area and report what the files hold."""
    spark = docs.sparkSession
    folder = f"{Stage(spark).path}/tokens"
    write_token_blocks(docs, description, end_id, folder)
    schema = "part int, segment int, n_ids bigint, payload binary"
    return token_spans(spark.read.schema(schema).parquet(folder))
