"""Adaptive context-mixing range coder for token ids.

Ids are cut into blocks of ``BLOCK``; every block starts from an empty model and carries a crc32, so a
damaged block harms no other. Three predictions meet in one interval of the range coder: the id that
last followed the two ids before (order 2), the one that last followed the id before (order 1), each with
a share that adapts to how often such predictions came true at that confidence, and the counts of the
block so far (order 0) for the rest, with an escape for ids that are new in the block.

Blocks do not depend on each other, so all blocks of a segment are coded in lockstep: step ``t`` handles
the t-th id of every block with array operations. All numbers are integers below 2**53 held in 64-bit
floats, whose basic operations are exact there and alike on every machine.

Segment: magic, counts, ids and lengths of its documents, a header per block, then 16-bit code words.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 4096
MAGIC = b"CWTI0002"
_HEAD = struct.Struct("<8sIIQQ")  # magic, block size, wide ids, documents, blocks

_SCALE = 2.0**20  # of all probabilities
_STATE = 2.0**48  # of range and code
_LOW = 2.0**32  # renormalised below
_WORD = 2.0**16
_SLOTS1, _SLOTS2 = 1 << 12, 1 << 13
_SURE = 3  # highest confidence of a prediction
_RATE = 2.0**-4  # at which shares adapt
_MOST = 7 * 2.0**17  # of 2**20: what a share may reach
_MULTIPLY = np.array([[0xC2B2AE3D27D4EB4F], [0x9E3779B97F4A7C15]], np.uint64)
_DOWN = np.array([[51], [52]], np.uint64)
_ROWS = 32  # lanes counted at once


def _sort_steps(longest: int) -> set[int]:
    """Before which ids the order-0 counts are brought up to date."""
    at, out = 16, set()
    while at < longest:
        out.add(at)
        at += max(16, at // 2)
    return out


class _Mixer:
    """Predictions of all lanes (blocks). Lanes are in descending order of length.

    Row 0 of every pair of rows is order 2, row 1 order 1. A prediction is id * 4 + confidence, and -4
    (an id that never comes, without confidence) where there is none.
    """

    def __init__(self, lanes: int) -> None:
        lane = np.arange(lanes, dtype=np.int64)
        self._table = np.full(lanes * (_SLOTS2 + _SLOTS1), -4, np.int32)
        self._offset = np.stack((lane * _SLOTS2, lanes * _SLOTS2 + lane * _SLOTS1))
        share = np.empty((2, lanes, _SURE + 1))
        share[0], share[1] = 2.0**18, 2.0**17
        share[:, :, 0] = 0
        self._share = share.ravel()
        self._lane = np.stack((lane, lanes + lane)) * (_SURE + 1)
        self._key = np.zeros((2, lanes), np.uint64)  # both ids before, the id before

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Predicted ids of both orders, and the upper bounds of their intervals."""
        self._at = ((self._key[:, :n] * _MULTIPLY) >> _DOWN).view(np.int64)
        self._at += self._offset[:, :n]
        self._value = self._table.take(self._at)
        self._sure = self._value & 3
        self._slot = self._lane[:, :n] + self._sure
        self._old = self._share.take(self._slot)
        self._guess = self._value >> 2
        bounds = np.minimum(self._old, _MOST)
        rest = _SCALE - bounds[0]
        rest *= self._guess[0] != self._guess[1]
        rest *= bounds[1]
        rest *= 1 / _SCALE
        np.floor(rest, out=rest)
        np.add(rest, bounds[0], out=bounds[1])
        return self._guess, bounds

    def update(self, n: int, ids: np.ndarray, hit: np.ndarray) -> None:
        """``hit``: which predictions were right. Masks are applied by arithmetic, since they are hard to foresee.

        A hit gains confidence and a miss loses one; at the lowest, the id takes the prediction's place.
        """
        change = hit.view(np.int8) * np.int8(2)
        change -= np.int8(1)
        change -= (hit & (self._sure == _SURE)).view(np.int8)
        self._value += change
        gone = self._sure < 2
        gone &= ~hit
        other = self._value ^ (ids * 4 + 1)
        other &= -gone.view(np.int8)
        self._value ^= other
        self._table[self._at] = self._value
        aim = hit * _SCALE
        aim -= self._old
        aim *= _RATE
        np.floor(aim, out=aim)
        aim += self._old
        self._share[self._slot] = aim
        one = (ids + 1).astype(np.uint64)
        self._key[0, :n] = one + (self._key[1, :n] << np.uint64(20))
        self._key[1, :n] = one


def _lanes(lengths: np.ndarray) -> np.ndarray:
    """At each step, how many lanes still have an id; lengths descend."""
    longest = int(lengths[0])
    return np.searchsorted(-lengths, -np.arange(longest), side="left")


def _ranks(rows: np.ndarray) -> np.ndarray:
    """Place of every id among the distinct ids of its row."""
    ranks = np.empty(rows.shape, np.int32)
    # Each id is sorted along with its place, in one number.
    width = rows.shape[1]
    bits = width.bit_length()
    kind = np.int32 if int(rows.max()) < 1 << (31 - bits) else np.int64
    for first in range(0, len(rows), _ROWS):
        own = np.left_shift(rows[first : first + _ROWS], bits, dtype=kind)
        own |= np.arange(width, dtype=kind)
        own.sort(axis=1)
        place = np.zeros(own.shape, np.int32)
        ordered = own >> bits
        np.cumsum(ordered[:, 1:] != ordered[:, :-1], axis=1, out=place[:, 1:])
        own &= (1 << bits) - 1
        np.put_along_axis(ranks[first : first + _ROWS], own.astype(np.int64), place, axis=1)
    return ranks


def _counts_before(ranks: np.ndarray, t: int, later: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the first ``t`` ids of every row: how many lie below, and not above, each id from ``t`` to
    ``later``, and the total with the escape. Ids that are new have -1 in place of the second."""
    n = len(ranks)
    below, upto, total = np.empty((later - t, n)), np.empty((later - t, n)), np.empty(n)
    for first in range(0, n, _ROWS):
        here = slice(first, first + _ROWS)
        own = ranks[here]
        width = int(own.max()) + 1
        base = np.arange(len(own), dtype=np.int64)[:, None] * width
        sums = np.bincount((own[:, :t] + base).ravel(), minlength=len(own) * width).reshape(len(own), width)
        total[here] = t + np.count_nonzero(sums, axis=1)
        # One row per step, whose ids lie side by side.
        ask = own[:, t:later].T + base.T
        count = sums.ravel().take(ask)
        end = np.cumsum(sums, axis=1).ravel().take(ask)
        new = count == 0
        below[:, here] = np.where(new, t, end - count)
        upto[:, here] = np.where(new, -1, end)
    return below, upto, total


def _counted(seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids so far of every lane in order, and the total of each lane with its escape.

    An entry holds an id and the start and end of its run, 14 bits each; the last one of a lane is the escape.
    """
    n, width = seen.shape
    packed, total = np.empty((n, width + 1), np.int64), np.empty(n)
    for first in range(0, n, _ROWS):
        rows = np.sort(seen[first : first + _ROWS], axis=1)
        new = np.ones(rows.shape, bool)
        new[:, 1:] = rows[:, 1:] != rows[:, :-1]
        at = np.flatnonzero(new)
        size = np.diff(at, append=rows.size)
        start = at % width
        run = (rows.ravel()[at].astype(np.int64) << 28) + (start << 14) + start + size
        here = slice(first, first + len(rows))
        packed[here, :-1] = np.repeat(run, size).reshape(rows.shape)
        total[here] = width + np.count_nonzero(new, axis=1)
    packed[:, -1] = (-1 << 28) + (width << 14) + total.astype(np.int64)
    return packed.ravel(), total


def _encode_lanes(rows: np.ndarray, lengths: np.ndarray, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    """Code words of every lane (a matrix) and how many there are. ``rows``: ids, padded."""
    lanes, longest = rows.shape
    mixer = _Mixer(lanes)
    capacity = (2 + wide) * longest + 8
    out = np.zeros(lanes * capacity, np.int32)
    base = np.arange(lanes, dtype=np.int64) * capacity
    place = base + 1  # word 0 takes a carry, which never comes
    low, span = np.zeros(lanes), np.full(lanes, _STATE)
    resort, going = _sort_steps(longest), _lanes(lengths)
    ranks, steps = _ranks(rows), np.ascontiguousarray(rows.T)
    counted_from = 0
    c0, c1, total = np.zeros((min(16, longest), lanes)), np.ones((min(16, longest), lanes)), np.ones(lanes)
    novels = np.ones(c1.shape, bool)

    def moved_up(low, place, by):
        """These lower ends moved up; a carry goes to the word before."""
        lo = low + by
        (over,) = (lo >= _STATE).nonzero()
        if len(over):
            out[place[over] - 1] += 1
            lo[over] -= _STATE
        return lo

    def put(low, place, unit, start, size):
        """Narrow these ranges to [start, start + size) units: the new state."""
        lo = moved_up(low, place, unit * start)
        width = unit * size
        short = width < _LOW
        word = np.floor(lo * (1 / _LOW))
        out[place] = word  # stays only where the place moves on
        moved = short.astype(np.float64)
        word *= _LOW
        word *= moved
        lo -= word
        moved *= _WORD - 1
        moved += 1.0
        lo *= moved
        width *= moved
        return lo, width, place + short

    for t in range(longest):
        n = int(going[t])
        if t in resort:
            later = min([x for x in resort if x > t], default=longest)
            counted_from = t
            c0, c1, total = _counts_before(ranks[:n], t, later)
            novels = c1 < 0
            np.copyto(c1, total, where=novels)  # so that the escape ends the interval
        ids = steps[t, :n]
        guess, bounds = mixer.predict(n)
        b2, b1 = bounds
        hit = guess == ids
        by2, by1 = hit & (bounds > 0)
        by1 &= b1 > b2
        rest = _SCALE - b1
        start = c0[t - counted_from, :n] * rest
        end = c1[t - counted_from, :n] * rest
        for edge in (start, end):
            edge /= total[:n]
            np.floor(edge, out=edge)
            edge += b1
        (first,), (second,) = by1.nonzero(), by2.nonzero()
        start[first], end[first] = b2[first], b1[first]
        start[second], end[second] = 0.0, b2[second]
        end -= start
        unit = np.floor(span[:n] * (1 / _SCALE))
        low[:n], span[:n], place[:n] = put(low[:n], place[:n], unit, start, end)
        by1 |= by2
        (raw,) = (novels[t - counted_from, :n] > by1).nonzero()
        if len(raw):
            for down in (16, 0) if wide else (0,):
                part = ((ids[raw] >> down) & 0xFFFF).astype(np.float64)
                unit = np.floor(span[raw] * (1 / _WORD))
                # One of 2**16 units is always below _LOW.
                at = place[raw]
                lo = moved_up(low[raw], at, unit * part)
                word = np.floor(lo * (1 / _LOW))
                out[at] = word
                lo -= word * _LOW
                low[raw], span[raw], place[raw] = lo * _WORD, unit * _WORD, at + 1
        mixer.update(n, ids, hit)
    for _ in range(3):
        word = np.floor(low * (1 / _LOW))
        # A carry that is still to come cannot be: low is below the state here.
        out[place] = word
        low = (low - word * _LOW) * _WORD
        place = place + 1
    over = np.flatnonzero(out > 0xFFFF)
    while len(over):
        out[over] &= 0xFFFF
        out[over - 1] += 1
        over = over[out[over - 1] > 0xFFFF] - 1
    return out.reshape(lanes, capacity), place - base


def _decode_lanes(words: np.ndarray, begins: np.ndarray, lengths: np.ndarray, wide: bool) -> np.ndarray:
    lanes, longest = len(lengths), int(lengths[0])
    mixer = _Mixer(lanes)
    steps = np.zeros((longest, lanes), np.int32)
    words = np.concatenate((words, np.zeros(8, words.dtype)))
    place = begins.astype(np.int64)
    code = np.zeros(lanes)
    for _ in range(3):
        code = code * _WORD + words.take(place, mode="clip")
        place = place + 1
    span = np.full(lanes, _STATE)
    resort, going = _sort_steps(longest), _lanes(lengths)
    counted, total, width = np.full(lanes, (-1 << 28) + 1), np.ones(lanes), 0
    own = np.arange(lanes, dtype=np.int64)

    def take(code, place, unit, start, size):
        code = code - unit * start
        size = unit * size
        short = size < _LOW
        moved = short.astype(np.float64)
        longer = words.take(place, mode="clip") * moved
        moved *= _WORD - 1
        moved += 1.0
        code *= moved
        code += longer
        size *= moved
        return code, size, place + short

    for t in range(longest):
        n = int(going[t])
        if t in resort:
            counted, total = _counted(steps[:t, :n].T)
            width = t
            own = np.arange(n, dtype=np.int64) * (width + 1)
        guess, bounds = mixer.predict(n)
        b2, b1 = bounds
        sums = total[:n]
        unit = np.floor(span[:n] * (1 / _SCALE))
        value = code[:n] / unit
        np.floor(value, out=value)
        np.minimum(value, _SCALE - 1, out=value)
        by2, by1 = value < bounds
        rest = _SCALE - b1
        value -= b1
        np.maximum(value, 0.0, out=value)
        # The largest count whose start is not above the value.
        share = value + 1.0
        share *= sums
        share /= rest
        np.floor(share, out=share)
        below = share * rest
        below /= sums
        np.floor(below, out=below)
        share -= below > value
        place_of = np.minimum(share, width).astype(np.int64)
        place_of += own[:n]
        entry = counted.take(place_of)
        ids = entry >> 28
        edges = np.empty((2, n))
        edges[1] = entry & 0x3FFF
        entry >>= 14
        entry &= 0x3FFF
        edges[0] = entry
        edges *= rest
        edges /= sums
        np.floor(edges, out=edges)
        edges += b1
        start, end = edges
        (first,), (second,) = by1.nonzero(), by2.nonzero()
        start[first], end[first], ids[first] = b2[first], b1[first], guess[1, first]
        start[second], end[second], ids[second] = 0.0, b2[second], guess[0, second]
        end -= start
        code[:n], span[:n], place[:n] = take(code[:n], place[:n], unit, start, end)
        (raw,) = (ids < 0).nonzero()
        if len(raw):
            found = np.zeros(len(raw), np.int64)
            for _ in range(1 + wide):
                unit = np.floor(span[raw] * (1 / _WORD))
                part = np.minimum(np.floor(code[raw] / unit), _WORD - 1)
                # One of 2**16 units is always below _LOW.
                at = place[raw]
                code[raw] = (code[raw] - unit * part) * _WORD + words.take(at, mode="clip")
                span[raw], place[raw] = unit * _WORD, at + 1
                found = (found << 16) + part.astype(np.int64)
            ids[raw] = found
        steps[t, :n] = ids
        ids = ids.astype(np.int32)
        mixer.update(n, ids, guess == ids)
    return np.ascontiguousarray(steps.T)


def pack(doc_ids: list[int | None], documents: list[np.ndarray], block: int = BLOCK) -> bytes:
    """One segment with these documents' ids, each below 2**29."""
    lengths = np.array([len(d) for d in documents], "<i8")
    ids = np.concatenate([np.zeros(0, np.int32), *documents]).astype(np.int32)
    wide = bool(len(ids) and ids.max() >= 1 << 16)
    blocks = -(-len(ids) // block)
    head = _HEAD.pack(MAGIC, block, wide, len(documents), blocks)
    null = np.array([d is None for d in doc_ids], np.uint8).tobytes()
    keys = np.array([d or 0 for d in doc_ids], "<i8").tobytes()
    if not blocks:
        return head + null + keys + lengths.tobytes()
    sizes = np.full(blocks, block, np.int64)
    sizes[-1] = len(ids) - block * (blocks - 1)
    rows = np.zeros(blocks * block, np.int32)
    rows[: len(ids)] = ids
    rows = rows.reshape(blocks, block)[:, : int(sizes[0])]
    matrix, counts = _encode_lanes(rows, sizes, wide)
    checks = [zlib.crc32(r[:s].astype("<u4").tobytes()) for r, s in zip(rows, sizes)]
    table = np.column_stack((sizes, counts - 1, checks)).astype("<u4")
    code = [m[1:c].astype("<u2").tobytes() for m, c in zip(matrix, counts)]
    return b"".join([head, null, keys, lengths.tobytes(), table.tobytes(), *code])


def unpack(segment: bytes) -> tuple[list[int | None], list[np.ndarray]]:
    """Documents of a segment; ``ValueError`` if a checksum or the layout does not hold."""
    magic, block, wide, n_docs, blocks = _HEAD.unpack_from(segment)
    if magic != MAGIC:
        raise ValueError("not a segment of token ids")
    at = _HEAD.size
    null = np.frombuffer(segment, np.uint8, n_docs, at)
    keys = np.frombuffer(segment, "<i8", n_docs, at + n_docs)
    lengths = np.frombuffer(segment, "<i8", n_docs, at + 9 * n_docs)
    at += 17 * n_docs
    ids = np.zeros(0, np.int32)
    if blocks:
        sizes, counts, checks = np.frombuffer(segment, "<u4", 3 * blocks, at).reshape(blocks, 3).T.astype(np.int64)
        words = np.frombuffer(segment, "<u2", int(counts.sum()), at + 12 * blocks)
        rows = _decode_lanes(words, np.concatenate(([0], np.cumsum(counts)[:-1])), sizes, bool(wide))
        for number, (row, size, check) in enumerate(zip(rows, sizes, checks)):
            if zlib.crc32(row[:size].astype("<u4").tobytes()) != check:
                raise ValueError(f"block {number} is damaged")
        ids = np.concatenate([row[:size] for row, size in zip(rows, sizes)])
    if int(lengths.sum()) != len(ids):
        raise ValueError("lengths of the documents do not match the ids")
    ends = np.cumsum(lengths)
    documents = [ids[e - n : e] for e, n in zip(ends, lengths)]
    return [None if x else int(k) for x, k in zip(null, keys)], documents
