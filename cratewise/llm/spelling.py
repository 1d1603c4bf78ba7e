"""Spelling variant grouping (operator 13): dense prefix-suffix tiling.

Two words of which the longer has M code points differ by one inserted, deleted or replaced code point if
and only if they are unlike and their common prefix and common suffix reach M - 1 together. Words that may
do so are dealt into cells: for each M, a word of M or M - 1 code points is in ``SEGMENTS`` cells, one for
each segment of the M places, which all words share that are alike before and after that segment. The edit
lies in some segment, so every near pair meets in the cell of that segment, and in that cell alone the pair
is reported (the place of the edit is the length of the common prefix).

Within a cell all words are compared, in tiles: words are rows of a padded matrix of code points, and
blocks of rows are compared with each other at once. A cell of more words than a tile holds is cut into
blocks, and its pairs of blocks are tiles of their own that different tasks take. A tile reports for each
word how many near words it found and the best of them, not the pairs.

Defined results: NULL texts hold no word and a NULL doc_id counts as empty in the hash of a run; repeated
rows count as often as they occur. The order of code points breaks ties between near words of equal n.
A word that no other is near has n_near 0, no form, and is its own root. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.sources.stage import Stage

LEAST_LENGTH = 7
LEAST_COUNT = 2
DAMAGED = 31
# A form has so many times the occurrences of its variant.
RATIO = 10

SEGMENTS = 4
# Words and code points of a block: half a tile.
BLOCK_WORDS = 512
BLOCK_POINTS = 1 << 18
# Pairs and code points that are compared at once.
COMPARED_PAIRS = 1 << 17
COMPARED_POINTS = 1 << 21
# Words whose cells a task gathers before it compares them.
GATHERED_WORDS = 1 << 14
# Code points from which on a word counts as long.
WIDE = 64

_RUN = rf"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(docs: DataFrame) -> DataFrame:
    """(word, n) of (doc_id, text): the runs of letters after lower-casing and damage, counted.

    Only runs of ``LEAST_LENGTH`` code points can give such words, and the pattern takes whole runs.
    """
    run = F.explode(F.regexp_extract_all(F.col("text"), F.lit(_RUN), F.lit(0)))
    runs = docs.select("doc_id", run.alias("run")).select(
        "doc_id", F.translate("run", _UPPER, _LOWER).alias("run")
    )
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    h = F.crc32(F.encode(name, "UTF-8"))
    size = F.char_length("run")
    at = F.pmod(h, size).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, size))
    word = F.when(h % DAMAGED == 0, shorter).otherwise(F.col("run"))
    return (
        runs.select(word.alias("word")).filter(F.char_length("word") >= LEAST_LENGTH)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT)
    )


def _bound(m: Column, segment: int) -> Column:
    """First place of a segment of ``m`` places."""
    return F.floor(m * segment / SEGMENTS).cast("int")


def _cells(words: DataFrame) -> DataFrame:
    """(cell, m, segment, word, n): every cell of every word. A cell is a hash, and cells that share one
    are compared in vain at worst."""
    size = F.char_length("word")
    found = []
    for longer in (0, 1):
        m = size + longer
        for segment in range(SEGMENTS):
            first, stop = _bound(m, segment), _bound(m, segment + 1)
            before = F.substring("word", F.lit(1), first)
            after = F.substring("word", size - (m - stop) + 1, m - stop)
            cell = F.xxhash64(m, F.lit(segment), before, after)
            found.append(F.struct(cell.alias("cell"), m.alias("m"), F.lit(segment).alias("segment")))
    return words.select("word", "n", F.explode(F.array(*found)).alias("c")).select("c.*", "word", "n")


def _tiles(cells: DataFrame) -> DataFrame:
    """The words of each tile: (cell, m, segment, one, two, block, word, n), block being ``one`` or ``two``.

    Words that are alone in their cell are left out: nothing is near them there.
    """
    sizes = cells.groupBy("cell", "m", "segment").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    blocks = F.greatest(
        F.ceil(F.col("size") / BLOCK_WORDS), F.ceil(F.col("size") * F.col("m") / BLOCK_POINTS)
    ).cast("int")
    # One block is a tile with itself; of more, a word is in a tile with every block.
    own = F.when(F.col("blocks") == 1, 0).otherwise(F.pmod(F.xxhash64("word", F.lit("block")), "blocks")).cast("int")
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (
        cells.join(sizes, ["cell", "m", "segment"])
        .select("cell", "m", "segment", "word", "n", blocks.alias("blocks"))
        .withColumn("block", own)
        .withColumn("partner", partner)
        .select(
            "cell", "m", "segment",
            F.least("block", "partner").alias("one"), F.greatest("block", "partner").alias("two"),
            "block", "word", "n",
        )
    )


def points(words: list[str]) -> np.ndarray:
    """Code points of the words as rows of a matrix padded with zeros."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    kind = np.uint8 if not len(flat) or flat.max() < 256 else np.uint32
    matrix = np.zeros((len(words), int(sizes.max(initial=0))), kind)
    matrix[np.arange(matrix.shape[1]) < sizes[:, None]] = flat
    return matrix


def single_edits(one: np.ndarray, two: np.ndarray, n_one: np.ndarray, n_two: np.ndarray) -> np.ndarray:
    """Of pairs of unlike padded rows: place of the single edit in the longer word, -1 where there is none.

    Rows are compared from the left and, shifted to end alike, from the right.
    """
    width = one.shape[1]
    longer = np.maximum(n_one, n_two)
    prefix = np.where((unlike := one != two).any(axis=1), unlike.argmax(axis=1), width)
    prefix = np.minimum(prefix, np.minimum(n_one, n_two))
    # The places of the shorter word, counted from the end of both.
    back = np.arange(width)[None, :]
    rows = np.arange(len(one))[:, None]
    left = one[rows, np.maximum(n_one[:, None] - 1 - back, 0)]
    right = two[rows, np.maximum(n_two[:, None] - 1 - back, 0)]
    differs = (left != right) | (back >= np.minimum(n_one, n_two)[:, None])
    suffix = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    near = (np.abs(n_one - n_two) <= 1) & (prefix + suffix >= longer - 1)
    return np.where(near, np.minimum(prefix, longer - 1), -1)


_NEAR = "word string, n_near bigint, top bigint, form string"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words within tiles, whose rows come together."""
    held: list[pa.RecordBatch] = []

    def key(batch: pa.RecordBatch) -> np.ndarray:
        return np.column_stack([batch.column(i).to_numpy().astype(np.int64) for i in range(5)])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < GATHERED_WORDS:
            continue
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        keys = key(rows)
        # The last tile may go on in the next batch.
        ends = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1))
        if len(ends):
            yield from _near(rows.slice(0, ends[-1] + 1), keys[: ends[-1] + 1])
            held = [rows.slice(ends[-1] + 1)]
        else:
            held = [rows]
    if held:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()
        if rows:
            yield from _near(rows[0], key(rows[0]))


def _near(rows: pa.RecordBatch, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per word of whole tiles: near words, and the best of them."""
    words, n, block = rows.column(6).to_pylist(), rows.column(7).to_numpy(), rows.column(5).to_numpy()
    total = len(words)
    edge = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [total]))
    stop_of = np.repeat(edge[1:], np.diff(edge))
    # Every row meets the later rows of its tile, in steps of a bounded number of pairs.
    later = stop_of - 1 - np.arange(total)
    sizes = np.fromiter(map(len, words), np.int64, total)
    width = np.maximum.reduceat(sizes, edge[:-1]) if total else sizes
    pairs_of = np.cumsum(later)
    # Tiles of long words are compared one by one, so that no matrix pads short words to their width.
    wide = width > WIDE
    apart = np.flatnonzero(wide[1:] | wide[:-1]) + 1
    firsts, seconds = [], []
    for first, end in zip(edge[[0, *apart]], edge[[*apart, -1]]):
        start = int(first)
        while start < end:
            asked = pairs_of[start] - later[start] + COMPARED_PAIRS
            stop = min(int(end), max(start + 1, int(np.searchsorted(pairs_of, asked, "right"))))
            count = later[start:stop]
            left = np.repeat(np.arange(start, stop), count)
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count)
            # Within a tile of two blocks, pairs of one block belong to that block's own tile.
            use = (keys[left, 3] == keys[left, 4]) | (block[left] != block[right])
            use &= np.abs(sizes[left] - sizes[right]) <= 1
            left, right = left[use], right[use]
            if len(left):
                matrix = points(words[start : int(right.max()) + 1])
                step = max(1, COMPARED_POINTS // matrix.shape[1])
                for at in range(0, len(left), step):
                    x, y = left[at : at + step], right[at : at + step]
                    m, segment = keys[x, 1], keys[x, 2]
                    place = single_edits(matrix[x - start], matrix[y - start], sizes[x], sizes[y])
                    hit = (place >= 0) & (np.maximum(sizes[x], sizes[y]) == m)
                    hit &= (place >= m * segment // SEGMENTS) & (place < m * (segment + 1) // SEGMENTS)
                    firsts.append(x[hit])
                    seconds.append(y[hit])
            start = stop
    if not firsts:
        return
    x, y = np.concatenate(firsts), np.concatenate(seconds)
    if not len(x):
        return
    word, other = np.concatenate((x, y)), np.concatenate((y, x))
    order = np.argsort(word, kind="stable")
    word, other = word[order], other[order]
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    count = np.diff(np.append(first, len(word)))
    top = np.maximum.reduceat(n[other], first)
    # Only the most frequent near words are looked at one by one.
    best: dict[int, str] = {}
    even = np.flatnonzero(n[other] == np.repeat(top, count))
    for w, o in zip(word[even].tolist(), other[even].tolist()):
        if w not in best or words[o] < best[w]:
            best[w] = words[o]
    own = word[first].tolist()
    yield pa.RecordBatch.from_arrays(
        [pa.array([words[w] for w in own], pa.string()), pa.array(count, pa.int64()), pa.array(top, pa.int64()), pa.array([best[w] for w in own], pa.string())],
        ["word", "n_near", "top", "form"],
    )


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, top, form) of the words (word, n) that have a near one: how many, the largest n
    among them, and the first word of that n."""
    parts = (
        _tiles(_cells(words))
        .repartition("cell", "m", "segment", "one", "two")
        .sortWithinPartitions("cell", "m", "segment", "one", "two", "word")
        .select("cell", "m", "segment", "one", "two", "block", "word", "n")
        .mapInArrow(_compare, _NEAR)
    )
    best = F.min(F.struct((-F.col("top")).alias("less"), F.col("form")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("top"), F.col("best.form").alias("form")
    )


def roots(forms: DataFrame, stage: Stage) -> DataFrame:
    """(word, root) of (word, form): the end of the chain of forms.

    Pointers are doubled, so the rounds are the logarithm of the longest chain, which is short: each form
    has ``RATIO`` times the occurrences of the one before.
    """
    state = stage.save("roots-0", forms.select("word", F.col("form").alias("root")))
    turn = 0
    while True:
        turn += 1
        step = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        state = stage.save(
            f"roots-{turn}",
            state.join(step, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
        )
        if not state.filter("moved").limit(1).count():
            return state.select("word", "root")
        state = state.select("word", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every frequent long word of (doc_id, text)."""
    stage = Stage(docs.sparkSession)
    words = stage.save("words", words_of(docs))
    near = stage.save("near", near_words(words))
    form = F.when(F.col("top") >= RATIO * F.col("n"), F.col("form"))
    known = stage.save(
        "known",
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            form.alias("form"), F.when(form.isNotNull(), F.col("top")).alias("form_n"),
        ),
    )
    chains = roots(known.filter("form is not null"), stage)
    return known.join(chains, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
