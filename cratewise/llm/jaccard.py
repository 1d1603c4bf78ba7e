"""N-gram Jaccard join (operator 7): grouped prefix join.

A document is the set of its distinct 3-word shingles, as 63-bit hashes. Two sets are linked when their
Jaccard similarity is 0.9 or more. In a common order of all shingles, linked sets share one of the first
``n - ceil(0.9 n) + 1`` shingles (their prefixes). Steps, all over stored tables:

1. Documents with equal sets form a class; classes with equal prefix and size form a group.
2. Groups meet at each shingle of their prefixes (a block). A pair is a candidate if sizes and the positions
   of the shingle allow the overlap.
3. First round: in every block, groups are compared with the smallest group that fits (a star), and the
   members of a group with its first member. What is linked becomes components.
4. Blocks and groups that still hold several components go on as cells of classes with their parity bitmaps,
   and a pair leaves its cell only if sizes, positions and bitmaps allow a link between two components. In the
   second round a cell yields no more pairs than connect its components (a forest), so mutual near copies do
   not meet all against all either. The third round yields every remaining pair: what the forest took for near
   and the whole sets were not. So every link between components is found. Near sets share most of their
   prefixes and so meet in many cells; the cell of the first shingle that they share yields the pair.
5. What leaves a cell is verified on the whole sets.

The order puts shingles that are frequent in a sample of documents last, which keeps blocks small. Any
order gives the same result; the sample decides about speed alone. Blocks of very frequent shingles are
dealt over salts, and pairs between salts over cells.

Defined results: a document without words (NULL, empty, white space) has size 0 and is its own component.
Repeated rows are equal sets. A NULL doc_id never becomes a component's id while the component has another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.llm.common import WORD, Words, leave_nothing, mix, own_names, steps, text_bytes
from cratewise.llm.components import components, lookup
from cratewise.sources.stage import Stage

# The contract's similarity, in hundredths.
SIMILARITY = 90

# Documents of which the order of shingles is drawn, the least documents of these that make a shingle
# frequent, and the most shingles that are told apart in this way (8 bytes each, in every task).
ORDER_SAMPLE = 8192
ORDER_LEAST = 3
ORDER_MOST = 1 << 19

# Classes of a block that one task holds in the later rounds, and pairs of one class per task.
BLOCK_ROWS = 20_000
PAIRS_PER_SALT = 2_000

# Widest bitmap; of larger sets it gives a weaker bound.
BITMAP_BUCKETS = 1 << 13

# Shingles before that of a block which its rows bring along. A pair that shares one of them has met in that
# block before; pairs whose shared shingles lie farther apart may come more than once.
EARLIER = 2

# Texts or prefixes of a batch that are handled together, which bounds what a task holds of them.
PORTION = 512

# Rows of cells that are handled together, pairs whose bitmaps are compared at once, and the rows from which
# a cell compares only its lesser components with the rest.
CELL_ROWS = 1 << 15
PAIRS_AT_ONCE = 1 << 15
LARGE_CELL = 64

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_TOP = np.uint64(1 << 63)


def shingles(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Of every text, the 63-bit hashes of its 3-word shingles, in text order."""
    for first, last in steps(texts):
        words = Words(texts[first:last])
        h, bounds = words.hashes, words.bounds
        three = mix(h[:-2] * _A + h[1:-1] * _B + h[2:] * _C) >> np.uint64(1) if len(h) > 2 else np.zeros(0, np.uint64)
        for i in range(last - first):
            a, b = int(bounds[i]), int(bounds[i + 1])
            if b - a > 2:
                yield three[a : b - 2]
            elif b - a == 2:
                yield mix(h[a : a + 1] * _B + h[a + 1 : b] * _C + _A) >> np.uint64(1)
            else:
                yield mix(h[a:b] * _C + _B) >> np.uint64(1)


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, few at a time."""
    leave_nothing()
    for batch in batches:
        for first in range(0, batch.num_rows, PORTION):
            yield batch.slice(first, PORTION)


def prefix_size(n: int, similarity: int = SIMILARITY) -> int:
    return n - -(-similarity * n // 100) + 1


def bitmap(tokens: np.ndarray) -> bytes:
    """Parity of the tokens per bucket, as bits; half as many buckets as tokens, 256 at least."""
    buckets = 256
    while 2 * buckets < len(tokens) and buckets < BITMAP_BUCKETS:
        buckets *= 2
    odd = np.bincount((tokens & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differ_at_least(x: bytes, y: bytes) -> int:
    """A lower bound of the tokens that only one of the sets has."""
    a, b = int.from_bytes(x, "little"), int.from_bytes(y, "little")
    la, lb = len(x), len(y)
    while la > lb:  # buckets modulo half as many
        la //= 2
        a = (a >> (8 * la)) ^ (a & ((1 << 8 * la) - 1))
    while lb > la:
        lb //= 2
        b = (b >> (8 * lb)) ^ (b & ((1 << 8 * lb) - 1))
    return (a ^ b).bit_count()


def _frequent(docs: DataFrame, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles in order, and their share of the sampled documents."""
    share = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    sample = docs.filter(share * rows < ORDER_SAMPLE).select("text").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(s) for s in shingles(text_bytes(batch.column(0)))]
            if found:
                tokens, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_pydict({"token": tokens.astype(np.int64), "n": counts})

    counts = sample.mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    top = counts.filter(F.col("n") >= ORDER_LEAST).orderBy(F.desc("n"), "token").limit(ORDER_MOST).toArrow()
    tokens = np.array(top.column(0), np.int64).astype(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.array(top.column(1), np.float64)[order] / max(1, min(rows, ORDER_SAMPLE))


def _ordered(found: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Distinct tokens in the common order; the top bit marks frequent ones."""
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
        found = found | ((frequent[at] == found).astype(np.uint64) << np.uint64(63))
    found = np.sort(found)
    return found[np.concatenate(([True], found[1:] != found[:-1]))] if len(found) else found


class JaccardJoin:
    """The join over one table of (doc_id, text)."""

    def __init__(self, docs: DataFrame, similarity: int = SIMILARITY, block_rows: int = BLOCK_ROWS) -> None:
        self.spark = docs.sparkSession
        self.stage = Stage(self.spark)
        self.similarity, self.block_rows = similarity, block_rows
        self.docs = docs.select(
            "doc_id", "text", F.xxhash64("text").alias("key"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key2")
        )
        self.n_docs = docs.count()
        frequent, shares = _frequent(docs, self.n_docs)
        self.frequent = self.spark.sparkContext.broadcast((frequent, shares))
        self.sets = self.stage.save("sets", self._sets())
        self._classes_and_groups()

    def _sets(self) -> DataFrame:
        shared, similarity = self.frequent, self.similarity

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            frequent = shared.value[0]
            for batch in _portions(batches):
                sizes, digests, groups, prefixes, bitmaps = [], [], [], [], []
                for found in shingles(text_bytes(batch.column(1))):
                    tokens = _ordered(found, frequent)
                    n = len(tokens)
                    prefix = tokens[: prefix_size(n, similarity)] if n else tokens
                    sizes.append(n)
                    digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest())
                    groups.append(hashlib.blake2b(prefix.tobytes() + n.to_bytes(8, "little"), digest_size=16).digest())
                    prefixes.append((prefix & ~_TOP).astype(np.int64))
                    bitmaps.append(bitmap(tokens))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), batch.column(2), batch.column(3),
                        pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(groups, pa.binary()),
                        pa.array(prefixes, pa.list_(pa.int64())), pa.array(bitmaps, pa.binary()),
                    ],
                    ["doc_id", "key", "key2", "n", "digest", "group", "prefix", "bits"],
                )

        narrow = self.docs.select(F.col("doc_id").cast("bigint"), "text", "key", "key2")
        return narrow.mapInArrow(
            run, "doc_id bigint, key bigint, key2 string, n bigint, digest binary, group binary, prefix array<bigint>, bits binary"
        )

    def _classes_and_groups(self) -> None:
        own = self.sets.filter("n > 0")
        classes = own.groupBy("digest").agg(
            F.first("n").alias("n"), F.first("group").alias("group"), F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"),
            F.min(F.struct("key", "key2")).alias("at"), F.first("bits").alias("bits"), F.first("prefix").alias("prefix"),
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("first"),
        )
        self.classes = self.stage.save("classes", classes.withColumn("cid", F.monotonically_increasing_id()), self.n_docs)
        self.n_classes = self.classes.count()
        groups = self.classes.groupBy("group").agg(
            F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.min("cid").alias("pivot"), F.count(F.lit(1)).alias("members")
        )
        self.groups = self.stage.save("groups", groups.withColumn("gid", F.monotonically_increasing_id()), self.n_classes)
        several = self.groups.filter("members > 1").select("group", "gid", "pivot")
        one = self.groups.filter("members = 1").select("gid", F.col("pivot").alias("cid"), "pivot")
        self.members = self.stage.save(
            "members", self.classes.select("cid", "group").join(several, "group").select("gid", "cid", "pivot").unionByName(one), self.n_classes
        )

    def _blocks(self) -> DataFrame:
        """Rows (token, salt, salts, n, place, gid, star) of blocks with two groups or more.

        ``star`` is the group that this one is compared with in the first round, if any.
        """
        shared, similarity, per_salt, n_docs = self.frequent, self.similarity, self.block_rows, self.n_docs

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            frequent, shares = shared.value
            hot = shares * n_docs > per_salt
            hot_tokens, hot_salts = frequent[hot].astype(np.int64), np.ceil(shares[hot] * n_docs / per_salt).astype(np.int32)
            for batch in _portions(batches):
                prefix = batch.column(2)
                lengths = np.diff(np.asarray(prefix.offsets))
                tokens = np.asarray(prefix.flatten())
                n, gid = np.repeat(np.asarray(batch.column(1)), lengths), np.repeat(np.asarray(batch.column(0)), lengths)
                place = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                salts = np.ones(len(tokens), np.int32)
                if len(hot_tokens):
                    at = np.minimum(np.searchsorted(hot_tokens, tokens), len(hot_tokens) - 1)
                    salts = np.where(hot_tokens[at] == tokens, hot_salts[at], salts)
                salt = (mix(gid.astype(np.uint64)) % salts.astype(np.uint64)).astype(np.int32)
                for a in range(0, len(tokens), 1 << 17):
                    cut = slice(a, a + (1 << 17))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x[cut]) for x in (tokens, salt, salts, n, place.astype(np.int32), gid)],
                        ["token", "salt", "salts", "n", "place", "gid"],
                    )

        def star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pending: np.ndarray | None = None  # the last row of the batch before, not yet yielded
            key, centre = None, None
            for batch in batches:
                rows = np.column_stack([np.asarray(c, dtype=np.int64) for c in batch.columns])
                if pending is not None:
                    rows = np.concatenate((pending, rows))
                if len(rows) < 2:
                    pending = rows
                    continue
                same = (rows[1:, 0] == rows[:-1, 0]) & (rows[1:, 1] == rows[:-1, 1])
                before = key is not None and (rows[0, 0], rows[0, 1]) == key
                with_left = np.concatenate(([before], same))
                # A row that is alone under its salt still meets the other salts of its block later.
                shared_rows = with_left[:-1] | same | (rows[:-1, 2] > 1)
                out = rows[:-1][shared_rows]
                stars = np.full(len(out), -1, np.int64)
                for i, (token, salt, _, n, place, gid) in enumerate(out.tolist()):
                    if (token, salt) != key or centre is None or similarity * n > 100 * centre[0]:
                        key, centre = (token, salt), (n, place, gid)
                    else:
                        stars[i] = centre[2]
                if not shared_rows[-1]:
                    key, centre = None, None
                pending = rows[-1:]
                if len(out):
                    yield _rows(out, stars)
            if pending is not None and len(pending):
                token, salt, salts, n, place, gid = pending[0].tolist()
                follows = key == (token, salt) and centre is not None
                if follows or salts > 1:
                    near = follows and similarity * n <= 100 * centre[0]
                    yield _rows(pending, np.array([centre[2] if near else -1]))

        tokens = self.groups.select("gid", "n", "prefix").mapInArrow(
            spread, "token bigint, salt int, salts int, n bigint, place int, gid bigint"
        )
        return (
            tokens.repartition("token", "salt").sortWithinPartitions("token", "salt", "n", "gid")
            .mapInArrow(star, "token bigint, salt int, salts int, n bigint, place int, gid bigint, star bigint")
        )

    def _needed(self, pairs: DataFrame) -> DataFrame:
        """Whole sets (cid, n, tokens) of the classes in the pairs, from one text of each."""
        wanted = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
        at = self.classes.join(wanted, "cid").select("cid", "n", F.col("at.key").alias("key"), F.col("at.key2").alias("key2"))
        texts = self.docs.select("key", "key2", "text").join(at, ["key", "key2"]).select("cid", "text")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _portions(batches):
                sets = [np.unique(s).astype(np.int64) for s in shingles(text_bytes(batch.column(1)))]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["cid", "tokens"])

        return texts.mapInArrow(run, "cid bigint, tokens array<bigint>").dropDuplicates(["cid"])

    def _verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """Of stored distinct pairs (a, b) of classes, those whose sets are similar enough, staged."""
        similarity = self.similarity
        small = lambda side: self.classes.select(F.col("cid").alias(side), F.col("n").alias(f"n{side}"), F.col("bits").alias(f"bits{side}"))

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                na, nb = np.asarray(batch.column(2)), np.asarray(batch.column(3))
                least = -(-similarity * (na + nb) // (100 + similarity))
                most = (na + nb - 2 * least).tolist()
                keep = [differ_at_least(x, y) <= d for x, y, d in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), most)]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        sized = pairs.join(small("a"), "a").join(small("b"), "b").select("a", "b", "na", "nb", "bitsa", "bitsb")
        sized = sized.filter((similarity * F.greatest("na", "nb")) <= (100 * F.least("na", "nb")))
        likely = self.stage.save(f"{name}-likely", sized.mapInArrow(near, "a bigint, b bigint"), pairs.count())
        n_likely = likely.count()
        sets = self.stage.save(f"{name}-sets", self._needed(likely), min(2 * n_likely, self.n_classes))
        salts = likely.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_SALT).cast("int").alias("salts"))
        left = (
            sets.select(F.col("cid").alias("a"), F.col("tokens").alias("x")).join(salts, "a")
            .select("a", "x", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        )
        dealt = likely.join(salts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"))
        both = dealt.join(sets.select(F.col("cid").alias("b"), F.col("tokens").alias("y")), "b").join(left, ["a", "salt"])
        common = F.size(F.array_intersect("x", "y"))
        counted = both.select("a", "b", common.alias("common"), (F.size("x") + F.size("y")).alias("sum"))
        near_enough = counted.filter(100 * F.col("common") >= similarity * (F.col("sum") - F.col("common"))).select("a", "b")
        return self.stage.save(f"{name}-links", near_enough, n_likely)

    def _components(self) -> DataFrame:
        """Staged (node, component) of the linked classes."""
        blocks = self.stage.save("blocks", self._blocks())
        pivot = lambda side: self.groups.select(F.col("gid").alias(side), F.col("pivot").alias("a" if side == "star" else "b"))
        n_stars = blocks.filter("star >= 0").count()
        stars = blocks.filter("star >= 0").select("star", "gid").distinct().join(pivot("star"), "star").join(pivot("gid"), "gid").select("a", "b")
        inside = self.members.filter("cid != pivot").select(F.col("pivot").alias("a"), F.col("cid").alias("b"))
        links = self._verified(self.stage.save("first-pairs", stars.union(inside), self.n_classes + n_stars), "first")
        known = components(links, self.stage, "first")
        for name, forest in (("second", True), ("third", False)):
            pairs = self.stage.save(f"{name}-pairs", self._others(blocks, known, name, forest))
            if not pairs.limit(1).count():
                break
            more = self._verified(pairs, name)
            if more.limit(1).count():
                links = links.union(more)
                known = components(links, self.stage, name)
        return known

    def _others(self, blocks: DataFrame, known: DataFrame, name: str, forest: bool) -> DataFrame:
        """Pairs (a, b) of classes that share a block or a group but not a component, and may be near."""
        similarity, block_rows = self.similarity, self.block_rows
        of_class = self.members.select("gid", "cid").join(self.classes.select("cid", "n", "bits"), "cid")
        labelled = self.stage.save(
            f"{name}-labelled",
            of_class.join(known.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid")),
            self.n_classes,
        )
        of_group = labelled.groupBy("gid").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members"))
        salts = lambda rows: F.ceil(F.col(rows) / block_rows).cast("int").alias("salts")
        rows = blocks.select("token", "place", "gid").join(of_group, "gid")
        mixed = (
            rows.groupBy("token").agg(F.min("low").alias("least"), F.max("high").alias("most"), F.sum("members").alias("rows"))
            .filter("least != most").select("token", salts("rows"))
        )
        # Tokens are not negative; a negative one stands for the inside of a group.
        own = of_group.filter("low != high").select((-1 - F.col("gid")).alias("token"), F.lit(0).alias("place"), "gid", salts("members"))
        of_block = rows.join(mixed, "token").select("token", "place", "gid", "salts").unionByName(own)
        # A cell holds two salts of a block; blocks with one salt are one cell.
        names = [f"before_{i}" for i in range(1, EARLIER + 1)]
        before = [F.coalesce(F.get("prefix", F.col("place") - i), F.lit(-1)).alias(name) for i, name in enumerate(names, 1)]
        of_block = of_block.join(self.groups.select("gid", "prefix"), "gid").select(*of_block.columns, *before)
        salted = of_block.join(labelled, "gid").withColumn("salt", F.pmod(F.xxhash64("cid"), F.col("salts")).cast("int"))
        cells = salted.select("*", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("other")).select(
            "token", F.least("salt", "other").alias("one"), F.greatest("salt", "other").alias("two"), "n", "place", "gid", "cid", "component",
            (F.col("salt") > F.col("other")).cast("int").alias("side"), *names, "bits",
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, bits in _whole_cells(batches):
                yield from _Cells(rows, bits, similarity, forest).pairs()

        dealt = cells.repartition("token", "one", "two").sortWithinPartitions("token", "one", "two", "n", "cid")
        return dealt.mapInArrow(run, "a bigint, b bigint").distinct()

    def _labelled(self) -> DataFrame:
        """Staged classes with their component."""
        labels = self._components().withColumnRenamed("node", "cid")
        labelled = self.classes.select("digest", "cid", "doc_id", "copies", "first").join(labels, "cid", "left").withColumn(
            "component", F.coalesce("component", "cid")
        )
        return self.stage.save("class-labels", labelled, self.n_classes)

    def kept(self) -> DataFrame:
        """Distinct (doc_id, key) of the row that stays of each component, and of all rows without words."""
        first = self._labelled().groupBy("component").agg(F.min("first").alias("first")).select("first.doc_id", "first.key")
        return first.unionByName(self.sets.filter("n = 0").select("doc_id", "key").distinct())

    def components(self) -> DataFrame:
        """Per document: doc_id, n_shingles, component_id."""
        labelled = self._labelled()
        ids = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
        whole = labelled.select("digest", "copies", "component").join(ids, "component")
        rows = lookup(
            self.sets.filter("n > 0").select("doc_id", "n", "digest"), whole.select("digest", "copies", "component_id"), "digest", "copies", self.n_docs
        )
        empty = self.sets.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
        return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(empty)


def _rows(rows: np.ndarray, stars: np.ndarray) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
    columns = [pa.array(rows[:, i], pa.int64()).cast(kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(stars, pa.int64())], ["token", "salt", "salts", "n", "place", "gid", "star"])


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Rows and bitmaps of whole cells, many small cells or a large one at once."""
    rows, bits = np.zeros((0, 9 + EARLIER), np.int64), []
    for batch in batches:
        rows = np.concatenate((rows, np.column_stack([np.asarray(c, dtype=np.int64) for c in batch.columns[:-1]])))
        bits += batch.column(9 + EARLIER).to_pylist()
        if len(rows) >= CELL_ROWS:
            cuts = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
            if len(cuts):
                yield rows[: cuts[-1]], bits[: cuts[-1]]
                rows, bits = rows[cuts[-1] :], bits[cuts[-1] :]
    if len(rows):
        yield rows, bits


class _Bitmaps:
    """Bitmaps of rows, as words by width."""

    def __init__(self, bits: list[bytes]) -> None:
        self.widths = np.fromiter(map(len, bits), np.int64, len(bits))
        self.at, self.words = np.zeros(len(bits), np.int64), {}
        for width in np.unique(self.widths).tolist():
            rows = np.flatnonzero(self.widths == width)
            self.at[rows] = np.arange(len(rows))
            self.words[width] = np.frombuffer(b"".join([bits[i] for i in rows.tolist()]), "<u8").reshape(len(rows), -1)

    def differ_at_least(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """:func:`differ_at_least` of many pairs of rows."""
        out = np.zeros(len(i), np.int64)
        kinds = self.widths[i] << 32 | self.widths[j]
        for kind in np.unique(kinds).tolist():
            chosen = np.flatnonzero(kinds == kind)
            x, y = self.words[kind >> 32][self.at[i[chosen]]], self.words[kind & 0xFFFFFFFF][self.at[j[chosen]]]
            if x.shape[1] < y.shape[1]:
                x, y = y, x
            while x.shape[1] > y.shape[1]:  # buckets modulo half as many
                half = x.shape[1] // 2
                x = x[:, :half] ^ x[:, half:]
            out[chosen] = np.bitwise_count(x ^ y).sum(axis=1)
        return out


class _Cells:
    """Whole cells: rows (token, one, two, n, place, gid, cid, component, side, shingles before), in order of
    size, with bitmaps."""

    def __init__(self, rows: np.ndarray, bits: list[bytes], similarity: int, forest: bool) -> None:
        self.similarity, self.forest = similarity, forest
        new = np.concatenate(([True], (rows[1:, :3] != rows[:-1, :3]).any(axis=1)))
        self.cell = np.cumsum(new) - 1
        self.first = np.append(np.flatnonzero(new), len(rows))
        self.inside, self.across = rows[:, 0] < 0, rows[:, 1] != rows[:, 2]
        self.n, self.place, self.gid, self.cid, self.component, self.side = rows[:, 3:9].T
        self.before = rows[:, 9:]
        self.bitmaps = _Bitmaps(bits)
        self._parent: dict[tuple[int, int], tuple[int, int]] = {}

    def _may_link(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of pairs of rows with compatible sizes: components, groups, salts and positions.

        Here the shingle has to be the first one that both sets share: what stands before it counts for nothing.
        """
        fits = self.component[i] != self.component[j]
        fits &= (self.gid[i] != self.gid[j]) | self.inside[i]
        fits &= (self.side[i] != self.side[j]) | ~self.across[i]
        fits &= np.minimum(self.n[i] - self.place[i], self.n[j] - self.place[j]) >= self._least(i, j)
        for x in self.before.T:
            for y in self.before.T:
                fits &= (x[i] != y[j]) | (x[i] < 0)
        return fits

    def _least(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return -(-self.similarity * (self.n[i] + self.n[j]) // (100 + self.similarity))

    def _candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        key, s = self.cell << 32 | self.n, self.similarity
        ends = np.searchsorted(key, self.cell << 32 | 100 * self.n // s, side="right")
        begins = np.searchsorted(key, self.cell << 32 | -(-s * self.n // 100), side="left")
        sizes = np.diff(self.first)
        # Rows of small cells, all with their next, second next and further neighbours.
        rows, step = np.flatnonzero(sizes[self.cell] < LARGE_CELL), 1
        while len(rows := rows[rows + step < ends[rows]]):
            for a in range(0, len(rows), PAIRS_AT_ONCE):
                yield rows[a : a + PAIRS_AT_ONCE], rows[a : a + PAIRS_AT_ONCE] + step
            step += 1
        for number in np.flatnonzero(sizes >= LARGE_CELL).tolist():
            here = np.arange(self.first[number], self.first[number + 1])
            found, counts = np.unique(self.component[here], return_counts=True)
            lesser = self.component != found[counts.argmax()]
            for i in here[lesser[here]].tolist():
                j = np.arange(begins[i], ends[i])
                j = j[(j > i) | ~lesser[j]]
                yield np.full(len(j), i), j

    def _connecting(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the pairs, those that join components of a cell that earlier ones have not joined."""
        low, high = np.minimum(self.component[i], self.component[j]), np.maximum(self.component[i], self.component[j])
        order = np.lexsort((high, low, self.cell[i]))
        keys = np.column_stack((self.cell[i], low, high))[order]
        order = order[np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1)))]
        parent, kept = self._parent, []

        def root(node: tuple[int, int]) -> tuple[int, int]:
            top = node
            while (above := parent.get(top, top)) != top:
                top = above
            while node != top:
                parent[node], node = top, parent[node]
            return top

        for at, cell, one, two in zip(order.tolist(), self.cell[i[order]].tolist(), low[order].tolist(), high[order].tolist()):
            x, y = root((cell, one)), root((cell, two))
            if x != y:
                parent[x] = y
                kept.append(at)
        return i[kept], j[kept]

    def pairs(self) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        total = 0
        for i, j in self._candidates():
            fits = self._may_link(i, j)
            if fits.any():
                held.append((i[fits], j[fits]))
                total += len(held[-1][0])
            if total >= PAIRS_AT_ONCE:
                yield self._near(held)
                held, total = [], 0
        if held:
            yield self._near(held)

    def _near(self, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        i, j = (np.concatenate(x) for x in zip(*held))
        near = self.bitmaps.differ_at_least(i, j) <= self.n[i] + self.n[j] - 2 * self._least(i, j)
        i, j = i[near], j[near]
        if self.forest and len(i):
            i, j = self._connecting(i, j)
        a, b = self.cid[i], self.cid[j]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Per document: size of its shingle set and the smallest doc_id that links lead to."""
    return JaccardJoin(docs.select("doc_id", "text")).components()


def jaccard_filter(docs: DataFrame) -> DataFrame:
    """One row of each component stays, with its columns: the smallest doc_id, NULL last; of several texts
    of that id, any fixed one.

    Rows without words stay, but of equal texts of an id, one. An id may occur on rows with different texts;
    each is judged by its own component. Further columns may have any name.
    """
    docs, back = own_names(docs, "doc_id", "text")
    alone = F.col("doc_id").isNull() & ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    stay = JaccardJoin(docs.select("doc_id", "text")).kept().select(F.col("doc_id").alias("_kept_id"), F.col("key").alias("_kept_key"))
    own = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_kept_id")) & (F.xxhash64("text") == F.col("_kept_key"))
    kept = docs.filter(~alone).join(stay, own, "left_semi").dropDuplicates(["doc_id", "text"])
    return back(kept.unionByName(docs.filter(alone)))
