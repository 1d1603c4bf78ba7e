"""Cross-tokenizer alignment (operator 11): tokenizer spans as coarse cuts, refined by decoded bytes.

Two tokenizers split the same string, a space and the text: a byte-level BPE (A) through its character
offsets, and a SentencePiece model (B) through the spans that its processor reports. A position where
tokens of both end is a cut; the tokens between two cuts are a group, and every A-B pair of occurrences in
a group is a link. The spans give the end of every token that ends with a whole character. They say
nothing about a token that ends inside a character: A's parts of one character share its offsets, and B's
byte-fallback tokens but the last have an empty span. Such a token ends where the one before it ends, plus
the length of its own decoded bytes.

Both tokenizers cut before a single space between two visible characters: A's splitter does, and no B
piece holds a space after another character (checked when the model is loaded). So a text is aligned in
chunks that start with such a space, each distinct chunk once, and workers remember frequent chunks.

Counting. A block is a few MB of consecutive documents. It keeps a table of its distinct id pairs, and
each document refers to them by place, so the corpus-wide counts are summed and sent back per block and
not per occurrence: a frequent pair is one row for each block, however often it occurs.

Defined results: NULL and empty texts, and texts that either tokenizer does not give back byte by byte,
have no tokens: zeros and an empty digest. Repeated rows count as documents of their own, ids may be NULL.
Other columns of ``docs`` are not looked at. Long texts are cut into chunks piece by piece; a single chunk
without such a space is aligned whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cratewise.llm.common import byte_letters, steps, text_bytes
from cratewise.sources.stage import Stage

# Chunks that a worker remembers from block to block, beyond those of the last block.
REMEMBERED_CHUNKS = 300_000
# Chunks that the tokenizers get at once, and as one string.
ENCODED_AT_ONCE = 20_000
JOINED_CHUNKS = 64
# Characters of a long text that are cut into chunks at once.
PIECE_CHARS = 1 << 20
# Text characters of a block: it is closed with the document that reaches them.
BLOCK_CHARS = 6 << 20
# One part in so many of all questions: pairs that are asked for more often are broadcast, so many at most.
HOT_PAIRS = 1 << 16
LEAST_HOT = 1_000

SPACE_MARK = "▁"
_CUT = re.compile(r"(?<=\S) (?=\S)")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


@dataclass
class Aligned:
    """Tokens and groups of a list of chunks, each after a space, as flat arrays."""

    a: np.ndarray  # ids of A
    b: np.ndarray
    a_group: np.ndarray  # group of each token
    b_group: np.ndarray
    cuts: np.ndarray  # byte end of each group
    chunk: np.ndarray  # chunk of each group


class Aligner:
    """Both tokenizers and the bytes of their tokens. Special tokens in a text are plain text."""

    def __init__(self, description: str, model: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self._a = Tokenizer.from_str(description)
        self._a.no_truncation()
        self._a.no_padding()
        self._a.encode_special_tokens = True
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        spec = json.loads(description)
        if (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["normalizer"]:
            raise ValueError("A must be a byte-level tokenizer without normalisation")
        special = {t["content"] for t in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        self.a_bytes = [b""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for entry, i in vocab.items():
            if entry not in special:
                self.a_bytes[i] = bytes(map(byte_of.__getitem__, entry))

        self._b = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        if any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", piece) for piece in pieces):
            raise ValueError("a piece of B reaches over a space")
        is_byte = [self._b.is_byte(i) for i in range(len(pieces))]
        self.b_bytes = [
            bytes([int(_BYTE_PIECE.fullmatch(piece)[1], 16)]) if byte else piece.replace(SPACE_MARK, " ").encode()
            for piece, byte in zip(pieces, is_byte)
        ]
        self._is_byte = np.array(is_byte)
        self._a_size, self._b_size = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))

    def _encode(self, chunks: list[str]) -> tuple[list, list, list[str]]:
        # Both cut before the spaces that join visible characters, so a few long strings serve for many chunks.
        # The first and the last chunk of a text may have white space at their ends and stay alone.
        strings, run = [], []
        for chunk in chunks:
            alone = chunk[0].isspace() or chunk[-1].isspace()
            if run and (alone or len(run) == JOINED_CHUNKS):
                strings.append(" ".join(run))
                run = []
            if alone:
                strings.append(chunk)
            else:
                run.append(chunk)
        if run:
            strings.append(" ".join(run))
        first = self._a.encode_batch([" " + x for x in strings], add_special_tokens=False)
        return first, self._b.encode(strings, return_type="offset_mapping", num_threads=1), strings

    def gives_back(self, chunk: str) -> bool:
        """Whether the tokens of both hold the bytes of the chunk."""
        first, second, _ = self._encode([chunk])
        whole = (" " + chunk).encode()
        a, b = first[0].ids, second[0]["ids"]
        return b"".join([self.a_bytes[i] for i in a]) == whole == b"".join([self.b_bytes[i] for i in b])

    def align(self, chunks: list[str]) -> Aligned | None:
        """Tokens and groups of chunks that are not empty as a list; None if the bytes of any differ."""
        first, second, strings = self._encode(chunks)
        text = (" " + " ".join(chunks)).encode()
        flat = chain.from_iterable
        a_lists, b_lists = [x.ids for x in first], [x["ids"] for x in second]
        a, b = np.fromiter(flat(a_lists), np.int64), np.fromiter(flat(b_lists), np.int64)
        for ids, table in ((a, self.a_bytes), (b, self.b_bytes)):
            if b"".join(map(table.__getitem__, ids.tolist())) != text:
                return None
        a_spans = np.fromiter(flat(flat(x.offsets for x in first)), np.int64).reshape(-1, 2)
        b_spans = np.fromiter(flat(flat(x["offsets"] for x in second)), np.int64).reshape(-1, 2)
        # Byte position of every character position.
        letters = np.frombuffer(text, np.uint8)
        places = np.append(np.flatnonzero((letters & 0xC0) != 0x80), len(letters))
        before = np.concatenate(([0], np.cumsum([len(x) + 1 for x in strings])))[:-1]

        base = np.repeat(before, [len(x) for x in a_lists])
        start, end = a_spans[:, 0] + base, a_spans[:, 1] + base
        # Parts of one character share its span; the last of them ends with it.
        whole = np.append(start[1:] >= end[:-1], True)
        a_ends = _ends(places[end], whole, self._a_size[a])
        base = np.repeat(before, [len(x) for x in b_lists])
        # Spans of B do not count the space in front. Of the bytes of one character the last has its span.
        end = b_spans[:, 1] + base + 1
        whole = ~self._is_byte[b] | (b_spans[:, 1] > b_spans[:, 0])
        b_ends = _ends(places[end], whole, self._b_size[b])

        at = np.searchsorted(b_ends, a_ends)
        cuts = a_ends[b_ends[np.minimum(at, len(b_ends) - 1)] == a_ends]
        sizes = np.fromiter((len(c) for c in chunks), np.int64, len(chunks))
        chunk_ends = places[np.cumsum(sizes + 1)]
        return Aligned(
            a, b, np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends), cuts, np.searchsorted(chunk_ends, cuts)
        )


def _ends(spanned: np.ndarray, whole: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Byte end of every token: that of its span if it ends with a whole character, else its own bytes
    after the end of the token before."""
    row = np.arange(len(whole))
    known = np.maximum.accumulate(np.where(whole, row, -1))
    total = np.cumsum(sizes)
    start = np.where(known >= 0, spanned[known] - total[known], 0)
    return np.where(whole, spanned, start + total)


def chunks_of(text: str) -> Iterator[list[str]]:
    """The chunks of a text in order, a list for each stretch of about ``PIECE_CHARS``."""
    start = 0
    while start < len(text):
        cut = _CUT.search(text, start + PIECE_CHARS) if len(text) - start > PIECE_CHARS else None
        stop = cut.start() if cut else len(text)
        yield _CUT.split(text[start:stop])
        start = stop + 1


class _Pool:
    """What blocks need of distinct chunks, remembered within a worker.

    At the beginning of a block, a pool that has grown too large keeps what the last block used.
    """

    def __init__(self, aligner: Aligner) -> None:
        self.aligner = aligner
        commas, ends = (",", "|"), (",", ";", "\n")
        self._a_base = 0
        self._b_base = len(commas) * len(aligner.a_bytes)
        self._texts = [f"{i}{c}" for i in range(len(aligner.a_bytes)) for c in commas]
        self._texts += [f"{i}{c}" for i in range(len(aligner.b_bytes)) for c in ends]
        self.place: dict[str, int] = {}
        self.digests: list[bytes] = []
        self.known = np.zeros(0, bool)
        self.counts = np.zeros((0, 4), np.int64)
        self.length = np.zeros(0, np.int64)  # distinct pairs of each chunk
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def trim(self, used: np.ndarray) -> None:
        """Keep the chunks of these numbers, if there are too many."""
        if len(self.place) <= REMEMBERED_CHUNKS:
            return
        keep = np.zeros(len(self.digests), bool)
        keep[used] = True
        number = (np.cumsum(keep) - 1).tolist()
        stays = keep.tolist()
        self.place = {chunk: number[i] for chunk, i in self.place.items() if stays[i]}
        self.digests = [d for d, k in zip(self.digests, stays) if k]
        of_pair = np.repeat(keep, self.length)
        self.pairs, self.times = self.pairs[of_pair], self.times[of_pair]
        self.known, self.counts, self.length = self.known[keep], self.counts[keep], self.length[keep]

    def learn(self, chunks: list[str]) -> None:
        """Add distinct new chunks."""
        for at in range(0, len(chunks), ENCODED_AT_ONCE):
            part = chunks[at : at + ENCODED_AT_ONCE]
            aligned = self.aligner.align(part)
            if aligned is None:
                good = [c for c in part if self.aligner.gives_back(c)]
                have = set(good)
                self._without_tokens([c for c in part if c not in have])
                part, aligned = good, self.aligner.align(good) if good else None
            if aligned is not None:
                self._add(part, aligned)

    def _without_tokens(self, chunks: list[str]) -> None:
        self.place.update(zip(chunks, range(len(self.digests), len(self.digests) + len(chunks))))
        self.digests += [b""] * len(chunks)
        zeros = np.zeros(len(chunks), np.int64)
        self.known = np.append(self.known, zeros > 0)
        self.counts = np.concatenate((self.counts, np.zeros((len(chunks), 4), np.int64)))
        self.length = np.append(self.length, zeros)

    def _add(self, chunks: list[str], x: Aligned) -> None:
        n, n_groups = len(chunks), len(x.cuts)
        a_of, b_of = np.bincount(x.a_group, minlength=n_groups), np.bincount(x.b_group, minlength=n_groups)
        per_chunk = lambda values: np.bincount(x.chunk, values, n).astype(np.int64)
        counts = np.column_stack((per_chunk(a_of), per_chunk(b_of), per_chunk(np.ones(n_groups)), per_chunk(a_of * b_of)))

        # Distinct ids of each group, and all pairs of them.
        a_key, a_times = np.unique(x.a_group << 32 | x.a, return_counts=True)
        b_key, b_times = np.unique(x.b_group << 32 | x.b, return_counts=True)
        b_size = np.bincount(b_key >> 32, minlength=n_groups)
        width = b_size[a_key >> 32]
        left = np.repeat(np.arange(len(a_key)), width)
        begin = (np.cumsum(b_size) - b_size)[a_key >> 32]
        right = np.repeat(begin - (np.cumsum(width) - width), width) + np.arange(len(left))
        pairs = (a_key[left] & 0xFFFFFFFF) << 32 | (b_key[right] & 0xFFFFFFFF)

        # The tokens in the order of the digest, each with the mark that follows it.
        a_last = np.append(x.a_group[1:] != x.a_group[:-1], True)
        b_last = np.append(x.b_group[1:] != x.b_group[:-1], True)
        chunk_last = np.append(x.chunk[1:] != x.chunk[:-1], True)[x.b_group]
        codes = np.empty(len(x.a) + len(x.b), np.int64)
        codes[np.arange(len(x.a)) + (np.cumsum(b_of) - b_of)[x.a_group]] = self._a_base + 2 * x.a + a_last
        codes[np.arange(len(x.b)) + np.cumsum(a_of)[x.b_group]] = self._b_base + 3 * x.b + b_last * (1 + chunk_last)
        digests = "".join(map(self._texts.__getitem__, codes.tolist())).encode().split(b"\n")[:-1]

        self.place.update(zip(chunks, range(len(self.digests), len(self.digests) + n)))
        self.digests += digests
        self.known = np.append(self.known, np.ones(n, bool))
        self.counts = np.concatenate((self.counts, counts))
        self.length = np.append(self.length, np.bincount(x.chunk[a_key >> 32], width, n).astype(np.int64))
        self.pairs = np.append(self.pairs, pairs)
        self.times = np.append(self.times, a_times[left] * b_times[right])


class _Block:
    """Documents whose links are counted together."""

    def __init__(self, pool: _Pool) -> None:
        self._pool = pool
        self._ids: list = []
        self._counts: list[np.ndarray] = []
        self._digests: list[str] = []
        self._chunks: list[np.ndarray] = []
        self.chars = 0

    def __len__(self) -> int:
        return len(self._ids)

    def add(self, rows: list[tuple[object, str | None]]) -> None:
        """Rows (doc_id, text) of a few MB, or one of any size."""
        self.chars += sum(len(text or "") for _, text in rows)
        small = [list(chunks_of(text or "")) for _, text in rows if len(text or "") <= PIECE_CHARS]
        self._learn([part for parts in small for part in parts])
        small.reverse()
        for doc_id, text in rows:
            parts = small.pop() if len(text or "") <= PIECE_CHARS else None
            self._add(doc_id, parts, text or "")

    def _learn(self, parts: list[list[str]]) -> None:
        # In order of first occurrence.
        place = self._pool.place
        self._pool.learn([c for c in dict.fromkeys(chain.from_iterable(parts)) if c not in place])

    def _add(self, doc_id: object, parts: list[list[str]] | None, text: str) -> None:
        pool, digest, numbers, counts = self._pool, hashlib.sha256(), [], np.zeros(4, np.int64)
        for n, part in enumerate(chunks_of(text) if parts is None else parts):
            if parts is None:
                self._learn([part])
            own = np.fromiter(map(pool.place.__getitem__, part), np.int32, len(part))
            if not pool.known[own].all():
                numbers = []
                break
            counts += pool.counts[own].sum(axis=0)
            digest.update((b";" if n else b"") + b";".join(map(pool.digests.__getitem__, own.tolist())))
            numbers.append(own)
        self._ids.append(doc_id)
        self._counts.append(counts if numbers else np.zeros(4, np.int64))
        self._digests.append(digest.hexdigest() if numbers else "")
        self._chunks.append(np.concatenate(numbers) if numbers else np.zeros(0, np.int32))

    def close(self, block: int, kind: pa.DataType) -> pa.RecordBatch:
        """Rows of the documents, then one that holds the distinct pairs."""
        pool, n_docs = self._pool, len(self)
        n_chunks = max(len(pool.digests), 1)
        owner = np.repeat(np.arange(n_docs), [len(x) for x in self._chunks])
        occurring, often = np.unique(owner * n_chunks + np.concatenate(self._chunks), return_counts=True)
        owner, number = occurring // n_chunks, occurring % n_chunks

        # The pairs of every chunk of a document, then the sums of equal ones.
        own = pool.length[number]
        begin = (np.cumsum(pool.length) - pool.length)[number]
        source = np.repeat(begin - (np.cumsum(own) - own), own) + np.arange(own.sum())
        used = np.unique(number)
        mine = np.zeros(n_chunks, bool)
        mine[used] = True
        in_use = np.repeat(mine[: len(pool.length)], pool.length)
        pairs, inverse = np.unique(pool.pairs[in_use], return_inverse=True)
        place_of = np.zeros(len(in_use), np.int64)
        place_of[in_use] = inverse
        n_pairs = max(len(pairs), 1)
        key = np.repeat(owner, own) * n_pairs + place_of[source]
        weight = pool.times[source] * np.repeat(often, own)
        order = np.argsort(key, kind="stable")
        key, weight = key[order], weight[order]
        edge = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        key, weight = key[edge], np.add.reduceat(weight, edge) if len(edge) else weight
        place = key % n_pairs
        bounds = np.searchsorted(key // n_pairs, np.arange(n_docs + 1)).astype(np.int32)
        linked = np.bincount(place, minlength=len(pairs))
        counts = np.array(self._counts, np.int64).reshape(n_docs, 4)
        pool.trim(used)

        def lists(values: np.ndarray, of: pa.DataType) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.append(bounds, bounds[-1])), pa.array(values, of))

        def last(values: np.ndarray) -> pa.Array:
            return pa.array([None] * n_docs + [values], pa.list_(pa.int32()))

        return pa.RecordBatch.from_arrays(
            [
                pa.array([block] * (n_docs + 1), pa.int64()),
                pa.array([*self._ids, None], kind),
                *[pa.array(np.append(counts[:, i], 0)) for i in range(4)],
                pa.array([*self._digests, None], pa.string()),
                lists(place.astype(np.int32), pa.int32()),
                lists(weight, pa.int64()),
                last((pairs >> 32).astype(np.int32)),
                last((pairs & 0xFFFFFFFF).astype(np.int32)),
                last(linked.astype(np.int32)),
            ],
            _BLOCK_NAMES,
        )


_BLOCK_NAMES = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times", "a", "b", "docs"]
_BLOCK_TYPES = (
    "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "places array<int>, times array<bigint>, a array<int>, b array<int>, docs array<int>"
)

_built: dict[tuple[int, int], _Pool] = {}


def _worker(description: str, model: bytes) -> _Pool:
    """The worker's pool and aligner; it keeps the last one."""
    name = (hash(description), hash(model))
    if name not in _built:
        _built.clear()
        _built[name] = _Pool(Aligner(description, model))
    return _built[name]


def document_groups(aligner: Aligner, text: str | None) -> list[dict] | None:
    """Byte positions, in a space and the text, and ids of every group; None where there are no tokens."""
    out, at = [], 0
    for part in chunks_of(text or ""):
        found = aligner.align(part)
        if found is None:
            return None
        starts = np.concatenate(([0], found.cuts[:-1])) + at
        a_of = np.searchsorted(found.a_group, np.arange(len(found.cuts) + 1)).tolist()
        b_of = np.searchsorted(found.b_group, np.arange(len(found.cuts) + 1)).tolist()
        a, b = found.a.tolist(), found.b.tolist()
        for g, (start, end) in enumerate(zip(starts.tolist(), (found.cuts + at).tolist())):
            ids = {"a": a[a_of[g] : a_of[g + 1]], "b": b[b_of[g] : b_of[g + 1]]}
            out.append({"start": start, "end": end, **ids})
        at += int(found.cuts[-1])
    return out or None


def align(docs: DataFrame, description: str, model: bytes) -> DataFrame:
    """(doc_id, groups) of (doc_id, text): byte positions and ids of every group; NULL where there are no tokens."""
    shared = docs.sparkSession.sparkContext.broadcast((description, model))  # two vocabulary files
    group = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _worker(*shared.value).aligner
        for batch in batches:
            for row in range(batch.num_rows):
                groups = pa.array([document_groups(aligner, batch.column(1)[row].as_py())], pa.list_(group))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, 1), groups], ["doc_id", "groups"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, groups array<struct<start: bigint, end: bigint, a: array<int>, b: array<int>>>"
    )


def aligned_blocks(docs: DataFrame, description: str, model: bytes) -> DataFrame:
    """Blocks of (doc_id, text): a row for each document and one with the id pairs of each block."""
    shared = docs.sparkSession.sparkContext.broadcast((description, model))  # two vocabulary files

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, number = _worker(*shared.value), TaskContext.get().partitionId() << 33
        block, kind = _Block(pool), None
        for batch in batches:
            kind = batch.column(0).type
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for first, last in steps(text_bytes(texts)):
                block.add(list(zip(ids[first:last], texts[first:last].to_pylist())))
                if block.chars >= BLOCK_CHARS:
                    yield block.close(number, kind)
                    block, number = _Block(pool), number + 1
        if len(block):
            yield block.close(number, kind)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"block bigint, doc_id {kind}, {_BLOCK_TYPES}")


def _questions(blocks: DataFrame) -> DataFrame:
    """(block, place, a, b, docs): the distinct pairs of every block."""
    return (
        blocks.filter("a is not null")
        .select("block", F.posexplode(F.arrays_zip("a", "b", "docs")).alias("place", "pair"))
        .select("block", "place", "pair.a", "pair.b", "pair.docs")
    )


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, count, best, blocks): the documents that hold a pair linked, and whether its A id has no
    more frequent one. An A id has one row for each id of B at most."""
    counts = _questions(blocks).filter("docs > 0").groupBy("a", "b").agg(
        F.sum("docs").alias("count"), F.count(F.lit(1)).alias("blocks")
    )
    most = F.max("count").over(Window.partitionBy("a"))
    return counts.select("a", "b", "count", (F.col("count") == most).alias("best"), "blocks")


_REPORT = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def alignment_report(docs: DataFrame, description: str, model: bytes) -> DataFrame:
    """Per document: tokens, groups, links, how many links are the best of their A id, the sum of the
    links' counts, and a digest of the groups."""
    stage = Stage(docs.sparkSession)
    blocks = stage.save("blocks", aligned_blocks(docs, description, model))
    counts = stage.save("counts", pair_counts(blocks))
    questions = _questions(blocks).filter("docs > 0").drop("docs")
    total = counts.agg(F.sum("blocks")).first()[0] or 0
    asked = max(LEAST_HOT, total / HOT_PAIRS)
    # Fewer than HOT_PAIRS pairs can have that many questions.
    hot = F.broadcast(counts.filter(F.col("blocks") > asked).drop("blocks"))
    rest = counts.filter(F.col("blocks") <= asked).drop("blocks")
    if total > LEAST_HOT and hot.limit(1).count():
        cold = questions.join(hot.select("a", "b"), ["a", "b"], "left_anti")
        answers = questions.join(hot, ["a", "b"]).unionByName(cold.join(rest, ["a", "b"]))
    else:
        answers = questions.join(rest, ["a", "b"])
    held = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times"]
    documents = blocks.filter("a is null").select("block", F.lit(1).alias("kind"), *held)
    both = documents.unionByName(
        answers.select("block", F.lit(0).alias("kind"), "place", "count", "best"), allowMissingColumns=True
    ).select("block", "kind", "place", "count", "best", *held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, counts, best = None, np.zeros(0, np.int64), np.zeros(0, bool)
        for batch in batches:
            ids, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero((ids[1:] != ids[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for first, stop in zip([0, *edges.tolist()], [*edges.tolist(), len(ids)]):
                rows = batch.slice(first, stop - first)
                if ids[first] != block:
                    block, counts, best = ids[first], np.zeros(0, np.int64), np.zeros(0, bool)
                if kinds[first] == 0:  # answers come first, in order of their places
                    place = rows.column(2).to_numpy()
                    grown = np.zeros(place[-1] + 1 - len(counts), np.int64)
                    counts, best = np.concatenate((counts, grown)), np.concatenate((best, grown > 0))
                    counts[place] = rows.column(3).to_numpy()
                    best[place] = rows.column(4).to_numpy(zero_copy_only=False)
                    continue
                places, times = rows.column(11), rows.column(12)
                bounds = places.offsets.to_numpy().astype(np.int64)
                own = places.values.to_numpy()[bounds[0] : bounds[-1]]
                weight = times.values.to_numpy()[times.offsets[0].as_py() : times.offsets[-1].as_py()]
                bounds -= bounds[0]
                sums = np.concatenate(([0], np.cumsum(weight * counts[own])))
                good = np.concatenate(([0], np.cumsum(weight * best[own])))
                yield pa.RecordBatch.from_arrays(
                    [
                        *rows.columns[5:10],
                        pa.array(good[bounds[1:]] - good[bounds[:-1]], pa.int64()),
                        pa.array(sums[bounds[1:]] - sums[bounds[:-1]], pa.int64()),
                        rows.column(10),
                    ],
                    ["doc_id", *_REPORT],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ", ".join(f"{name} {'string' if name == 'groups_sha256' else 'bigint'}" for name in _REPORT)
    return (
        both.repartition("block")
        .sortWithinPartitions("block", "kind", "place")
        .mapInArrow(run, f"doc_id {kind}, {names}")
    )
