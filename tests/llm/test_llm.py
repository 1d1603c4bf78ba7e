"""The operators against brute force, on small tables with NULLs, empty and long texts, ties and copies."""

from __future__ import annotations

import gc
import hashlib
import math
import random
import re
import time
import tracemalloc
import weakref
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from cratewise.llm import bpe, components, fingerprints, idcoder, jaccard, language, licenses, mixing, ppm, quality, token_output, toxicity
from cratewise.llm.queries import TOKENIZER
from cratewise.sources.stage import Stage
from verification.compare import differences, oracle_connection

PATH = public_tokenizers.path(TOKENIZER)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, score string, ids string"


def lower(text):
    return text.translate({c: c + 32 for c in range(65, 91)})


def texts():
    rng = random.Random(5)
    syllables = "an er in on th re st the of Und der ño é ß".split()
    made = [" ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(1, 90))) for _ in range(40)]
    long = " ".join(made) * 3
    near = long.split(" ")
    near[7] = "changed"
    odd = ["", " \n\t ", None, "a", "A b", "a B\n\na b", "<|endoftext|>x İΣ 日本 éá̧ x²\x1cy a\x85b it's I'LL 👍🏽", "q" * 5000, "x\x00y"]
    return [*made, made[0], made[0], made[0].upper(), long, " ".join(near), *odd]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3, t, ["en", "de", None][i % 3], ["s1", "s2", "s1", None, ""][i % 5], 0, 1, "x", "y") for i, t in enumerate(texts())]
    rows += [rows[3], rows[3], (None, "no id here", None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark, docs):
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    rows = [(i, n % 2, n % 3 == 0 and 1 or 0) for n, i in enumerate(ids)] + [(0, None, None), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def empty(docs):
    return docs.filter("false")


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


# Token output


def test_id_blocks_round_trip_and_notice_damage():
    rng = np.random.default_rng(3)
    for ids in ([], [[]], [[5], [], [7] * 9000], [rng.integers(0, 1 << 16, 9000)], [[1 << 20, 3, 1 << 28]]):
        held = [np.array(x, np.int32) for x in ids]
        segment = idcoder.pack([None if i == 1 else i for i in range(len(held))], held)
        names, back = idcoder.unpack(segment)
        assert names == [None if i == 1 else i for i in range(len(held))]
        assert all(np.array_equal(a, b) for a, b in zip(held, back))
    damaged = bytearray(idcoder.pack([1], [rng.integers(0, 9000, 5000).astype(np.int32)]))
    damaged[-1000] ^= 8
    with pytest.raises(ValueError, match="damaged"):
        idcoder.unpack(bytes(damaged))


def test_id_counts_equal_brute_force():
    rng = np.random.default_rng(4)
    rows = rng.integers(0, 30, (70, 60)).astype(np.int32)
    for t, later in ((1, 2), (16, 32), (59, 60)):
        below, upto, total = idcoder._counts_before(idcoder._ranks(rows), t, later)
        packed, same_total = idcoder._counted(rows[:, :t])
        packed = packed.reshape(70, t + 1)
        for lane, row in enumerate(rows.tolist()):
            seen = row[:t]
            assert total[lane] == same_total[lane] == t + len(set(seen))
            runs = [(i, sum(x < i for x in seen), sum(x <= i for x in seen)) for i in sorted(seen)]
            assert [(e >> 28, e >> 14 & 0x3FFF, e & 0x3FFF) for e in packed[lane].tolist()] == [*runs, (-1, t, total[lane])]
            for i, asked in enumerate(row[t:later]):
                expected = (sum(x < asked for x in seen), sum(x <= asked for x in seen)) if asked in seen else (t, -1)
                assert (below[i, lane], upto[i, lane]) == expected


def test_words_are_asked_for_once():
    """Half a million distinct words, twice: what a worker remembers holds them all."""
    cache, asked = token_output.WordCache(bpe.read_description(PATH)), []

    class Library:
        def encode_batch_fast(self, words, add_special_tokens):
            asked.append(len(words))
            return [type("Ids", (), {"ids": [int(w)]}) for w in words]

    cache._library = Library()
    texts = [b" ".join(b"%d" % n for n in range(first, first + 50_000)) for first in range(0, 500_000, 50_000)]
    for _ in range(2):
        assert np.concatenate(cache.encode(texts)).tolist() == list(range(500_000))
    assert sum(asked) == 500_000


def test_remembered_words_change_no_ids(monkeypatch):
    monkeypatch.setattr(token_output, "REMEMBERED_WORDS", 7)
    monkeypatch.setattr(token_output, "REMEMBERED_LONG", 2)
    cache, library = token_output.WordCache(bpe.read_description(PATH)), Tokenizer.from_file(PATH)
    ends = ["a" * n for n in range(1, 20)] + ["é" * 8, "é" * 9, "x", "x\x00", "x\x00\x00", "\x00", "b" * 8 + "a", "b" * 8]
    many = [*[t or "" for t in texts()], *ends, " ".join(ends), " ".join(ends[::-1]), "", " "]
    for _ in range(2):
        for size in (1, 3, len(many)):
            for first in range(0, len(many), size):
                part = many[first : first + size]
                expected = [library.encode(t, add_special_tokens=False).ids for t in part]
                assert [ids.tolist() for ids in cache.encode([t.encode() for t in part])] == expected


def test_pieces_of_words_are_asked_for_once():
    """Case and trailing punctuation cost no further question, and plain words go many in a text."""
    cache, texts_asked = token_output.WordCache(bpe.read_description(PATH)), []
    library = cache._library

    class Library:
        def encode_batch_fast(self, words, add_special_tokens):
            texts_asked.extend(words)
            return library.encode_batch_fast(words, add_special_tokens=add_special_tokens)

    cache._library = Library()
    text = "Abc abc ABC. abc, \u00c9t\u00e9! \u00c9t\u00e9 abc!! don't <|endoftext|> <|ENDOFTEXT|> abc.net"
    for _ in range(2):
        assert [i.tolist() for i in cache.encode([text.encode()])] == [library.encode(text, add_special_tokens=False).ids]
    assert sorted(sum((t.split() for t in texts_asked), [])) == sorted(["abc", "\u00c9t\u00e9", "abc.net", "don't", *[".", ",", "!", "!!"], "<|endoftext|>", "<|ENDOFTEXT|>"])
    many = [b" ".join(b"%c%c%c" % (a, b, c) for a in range(97, 123) for b in range(97, 123)) for c in range(97, 123)]
    texts_asked.clear()
    cache.encode(many)
    assert 0 < len(texts_asked) < 100


def test_odd_words_equal_the_library():
    rng, library = np.random.default_rng(8), Tokenizer.from_file(PATH)
    letters = [*"abAZsStTmMdD'.,;:!?\"()[]*#$%&@~^`_-+=/\\<|>019 ", "\u2019", "\u00e9", "\u00c9", "\u0301", "\u0338", "\u0130", "\u00df", "\u212b", "\u2026", "\u00a0", "\u0085", "\x00", "\u4e2d", "\u00d7", "\u00f7", "\u00ff", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'LL"]
    odd = ["".join(letters[i] for i in rng.integers(0, len(letters), n)) for n in rng.integers(0, 30, 5000)]
    expected = [library.encode(t, add_special_tokens=False).ids for t in odd]
    cache = token_output.WordCache(bpe.read_description(PATH))
    assert [i.tolist() for i in cache.encode([t.encode() for t in odd])] == expected
    cache = token_output.WordCache(bpe.read_description(PATH))
    cache._final[:] = False  # no mark of a word's end: words are asked for one by one
    assert [i.tolist() for i in cache.encode([t.encode() for t in odd])] == expected


def test_other_splitters_leave_words_whole():
    other = Tokenizer.from_file(PATH)
    other.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    cache, text = token_output.WordCache(other.to_str()), "Abc abc. abc, ABC!! \u00e9t\u00e9."
    assert cache.encode([text.encode()])[0].tolist() == other.encode(text, add_special_tokens=False).ids
    assert other.encode("abc.").ids != other.encode("abc .").ids


def test_segments_keep_their_bytes():
    """Faster arithmetic may not change the format: segments of earlier versions stay readable."""
    ids = np.arange(40_000, dtype=np.int64)
    for documents, crc in (([ids * ids % 977, ids[:9000] % 7], 2485067946), ([ids * 7919 % 131_071], 1349730234)):
        assert zlib.crc32(idcoder.pack(list(range(len(documents))), [d.astype(np.int32) for d in documents])) == crc


def test_token_output(spark, docs):
    library = Tokenizer.from_file(PATH)
    got = token_output.token_output(docs, bpe.read_description(PATH), 2).orderBy("start").collect()
    at, expected = 0, []
    for doc_id, text in sorted(rows_of(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        expected.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert [tuple(r) for r in got] == expected
    assert token_output.token_output(empty(docs), bpe.read_description(PATH), 2).count() == 0
    folder = f"{Stage(spark).path}/t"
    token_output.write_token_blocks(docs, bpe.read_description(PATH), 2, folder)
    whole = token_output.read_token_documents(spark.read.parquet(folder))
    assert whole.selectExpr("sum(size(ids))").first()[0] == at


# BPE


def test_bpe_equals_the_library(docs):
    library = Tokenizer.from_file(PATH)
    got = sorted(map(tuple, bpe.bpe_digests(docs, bpe.read_description(PATH)).collect()), key=repr)
    expected = []
    for doc_id, text in rows_of(docs):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected.append((doc_id, len(ids), digest, hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(expected, key=repr)
    assert bpe.bpe_digests(empty(docs), bpe.read_description(PATH)).count() == 0


def test_bpe_keeps_columns_and_forgets_words(docs, monkeypatch):
    coded = bpe.bpe_encode(docs, bpe.read_description(PATH))
    assert coded.columns == [*[c for c in docs.columns if c != "ids"], "ids"]
    assert coded.count() == docs.count()
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 5)
    engine = bpe.TrieBpe(bpe.read_description(PATH))
    whole = [(t or "").encode() for t in texts()]
    assert engine.encode(whole) == [engine.encode([t])[0] for t in whole]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.TrieBpe(bpe.read_description(public_tokenizers.path("byte_bpe_50k.json")))


# Fingerprints


def test_fingerprint_report(docs):
    order = sorted([r for r in rows_of(docs) if r[0] is not None], key=lambda r: (-r[0], r[1] or "")) + [r for r in rows_of(docs) if r[0] is None]
    got = {}
    for r in fingerprints.fingerprint_report(docs).collect():
        got.setdefault((r.doc_id, r.n_chars, r.edited_sha256), []).append(r)
    assert sum(map(len, got.values())) == len(order)
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        n = len(text) // 3
        edit = text[: len(text) - n] + following[:n]
        (r, *_) = got[doc_id, len(text), hashlib.sha256(edit.encode()).hexdigest()]
        assert r.fingerprint == fingerprints.printed(fingerprints.vectors([text.encode()])[0])
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert text != following or r.near_next == 1
    assert fingerprints.fingerprint_report(empty(docs)).count() == 0
    assert fingerprints.fingerprint_report(docs.filter("doc_id = 6")).first().near_next == 1


def test_fingerprints_are_homomorphic():
    of = lambda t: fingerprints.printed(fingerprints.vectors([t.encode()])[0])
    assert of("one two\nthree") == of("three\n\none two\n") != of("one three\ntwo")
    assert fingerprints.added(of("one two"), "three") == of("one two\nthree")
    assert fingerprints.removed(of("one two\nthree"), "three") == of("one two")


def test_likeness_of_many_equal_lines():
    long, short = "aa bb\n" * 48_000, "aa bb\n" * 32_000 + "cc dd\n" * 10
    x, y = fingerprints.vectors([long.encode(), short.encode()])
    assert fingerprints.likeness(x[None], y[None])[0] > 0.99
    assert np.array_equal(fingerprints.parsed(fingerprints.printed(x)), x)
    assert fingerprints.added(fingerprints.printed(x), short) == fingerprints.printed(fingerprints.vectors([(long + short).encode()])[0])
    assert fingerprints.removed(fingerprints.printed(y), long) == fingerprints.removed(fingerprints.removed(fingerprints.printed(y), "aa bb\n" * 47_999), "aa bb")
    assert fingerprints.removed(fingerprints.printed(x), "aa bb\n" * 47_999) == fingerprints.printed(fingerprints.vectors([b"aa bb"])[0])


# Mixing


def test_mixing(docs):
    many = docs
    for _ in range(5):
        many = many.union(many)
    rows = mixing.mix_report(many).collect()
    assert len(rows) == many.count() and all(0 <= r.taken <= 2 * r.size for r in rows)
    source = {r.doc_id: r.source for r in docs.collect()}
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        s = source[r.doc_id]
        sizes[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
        assert r.size is not None
    order = sorted([s for s in sizes if s is not None]) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, expected = 1.5 * sum(sizes.values()), set(order), {}
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 2 * sizes[s]}
        if not full:
            expected |= {s: weight[s] * level for s in open_}
            break
        for s in full:
            expected[s] = 2.0 * sizes[s]
            left -= expected[s]
        open_ -= full
    for s in order:
        assert target[s] == pytest.approx(expected[s])
        assert taken[s] == pytest.approx(expected[s], rel=0.01, abs=20)
    assert sorted(map(tuple, mixing.mix_report(many).collect()), key=repr) == sorted(map(tuple, rows), key=repr)
    assert mixing.mix_report(empty(docs)).count() == 0
    mix = mixing.mix_documents(docs)
    assert mix.columns == docs.columns


# Toxicity


def test_maximal_segments_by_definition():
    rng = random.Random(1)
    for _ in range(200):
        words = {w: rng.uniform(-1, 1.5) for w in "abcdef"}
        tokens = rng.choices("abcdefg", k=rng.randint(0, 25))
        values = [words.get(t, 0.0) - toxicity.DRIFT for t in tokens]

        def split(a, b):
            best = max(((sum(values[i:j]), -(j - i), i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0,))
            if best[0] <= 1e-12:
                return []
            return [*split(a, best[2]), (best[2], best[3]), *split(best[3], b)]

        found = toxicity.ToxicityModel(words).segments(tokens)
        assert [(a, b) for a, b, _ in found] == split(0, len(tokens))


def test_segments_of_long_texts_take_linear_time():
    drift = toxicity.DRIFT
    model = toxicity.ToxicityModel({"up": 1.5 * drift, "top": 11 * drift})
    n = 100_000
    falling = ["up", "x"] * n  # each gain starts below all before it
    rising = ["top", *"x" * 5, *["up", "x"] * 4] * (n // 4)  # each group starts above all before it
    began = time.process_time()
    assert [(a, b) for a, b, _ in model.segments(falling)] == [(2 * i, 2 * i + 1) for i in range(n)]
    last = len(rising) - 13  # the last top ends the long segment; four gains follow
    assert [(a, b) for a, b, _ in model.segments(rising)] == [(0, last), *((last + i, last + i + 1) for i in (5, 7, 9, 11))]
    assert time.process_time() - began < 10


def test_toxicity_learns_and_holds_out(spark):
    rng = random.Random(2)
    plain = ["w%s" % "".join(rng.choices("abcd", k=3)) for _ in range(60)]
    rows, marks = [], []
    for i in range(900):
        toxic = i % 5 == 0
        words = rng.choices(plain, k=40)
        for _ in range(4 * toxic):
            words.insert(rng.randrange(40), rng.choice(["nasty", "vile", "grim"]))
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    rows += [(1000, None), (1001, ""), (None, "vile"), (0, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in held) >= 0.97 * len(held)
    # Labels of the held-out fold change nothing.
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity.toxicity(docs, flipped).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score) for r in got)
    kept = toxicity.toxicity_filter(docs, labels)
    assert kept.columns == docs.columns and 650 < kept.count() < 760
    assert toxicity.toxicity(docs, labels.filter("false")).filter("score > 0").count() == 0
    assert toxicity.toxicity(docs.filter("false"), labels).count() == 0


# Language


def test_language_id(spark):
    rng = random.Random(4)
    en, de = "the and with thing house water".split(), "und der schön haus wasser mit".split()
    train = [(i, " ".join(rng.choices(w, k=30)), l) for i in range(20) for l, w in (("en", en), ("de", de))] + [(99, None, "en"), (98, "x", None)]
    docs = spark.createDataFrame(train, "doc_id bigint, text string, lang string")
    page = lambda words, lang: f"<html lang='{lang}'><body><script>und</script><p>{' '.join(rng.choices(words, k=20))}</p></body></html>"
    rows = [(i, f"http://a{i % 3}.de/x", page(de, "de"), 1) for i in range(30)] + [(100 + i, f"https://b.com:80/{i}", page(en, "en"), 1) for i in range(30)]
    rows += [(200, "http://a1.de/y", "<p></p>", 1), (201, None, None, 1), (202, "no url", "", 1), (203, "http://b.com", page(en, "de"), 1), (0, *rows[0][1:])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, lang int")
    got = language.language_id(pages, docs).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    assert all(by_id[i].lang == "de" for i in range(30)) and all(by_id[100 + i].lang == "en" for i in range(30))
    assert by_id[200].lang == "de" and by_id[203].lang == "en" and by_id[201].host == ""
    assert all(0 < r.probability <= 1 for r in got)
    assert language.language_id(pages.filter("false"), docs).count() == 0
    assert {r.lang for r in language.language_id(pages, docs.filter("false")).collect()} == {None}


# Jaccard


def brute_components(rows):
    sets = []
    for _, text in rows:
        w = WORD.findall(lower(text or ""))
        sets.append(frozenset(zip(w, w[1:], w[2:])) if len(w) > 2 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(doc_id, least.get(root(i), doc_id))
    return Counter((d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def near_copies():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    shared = rng.choices(words, k=60)
    out = []
    for family in range(6):
        base = rng.choices(words, k=rng.randint(40, 120)) + shared * (family % 2)
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("block_rows", [jaccard.BLOCK_ROWS, 4])
def test_jaccard_components(spark, docs, block_rows):
    rows = rows_of(docs) + [(10_000 + i, t) for i, t in enumerate(near_copies())]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = jaccard.JaccardJoin(table, block_rows=block_rows).components().collect()
    assert Counter(map(tuple, got)) == brute_components(rows)


def test_jaccard_filter_and_empty_table(docs):
    kept = jaccard.jaccard_filter(docs)
    assert kept.columns == docs.columns
    groups = {c for (d, _, c) in brute_components(rows_of(docs)) if d is not None}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(groups)
    assert jaccard.jaccard_components(empty(docs)).count() == 0


def test_jaccard_filter_judges_rows_of_an_id_by_their_text(spark):
    x, y, z = ("the quick brown fox jumps over it", "an unlike text that has its own words", "a third one of other things")
    rows = [(3, x), (5, x), (5, y), (5, y), (None, y), (None, z), (None, z), (7, ""), (7, None), (None, " "), (None, " ")]
    for n in (1, 4):  # whichever row comes first
        kept = jaccard.jaccard_filter(spark.createDataFrame(rows[::-1] if n > 1 else rows, "doc_id bigint, text string").repartition(n))
        expected = [(3, x), (5, y), (None, z), (7, ""), (7, None), (None, " "), (None, " ")]
        assert Counter(map(tuple, kept.collect())) == Counter(expected)


def test_jaccard_large_cell_yields_a_forest_and_then_only_near_pairs():
    rng = np.random.default_rng(3)
    draw = lambda n: np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
    family = draw(100)
    sets = [draw(100) for _ in range(2000)] + [np.unique(np.append(family[:-1], draw(1))) for _ in range(60)]
    bits = [jaccard.bitmap(x) for x in sets]
    rows = np.array([(7, 0, 0, 100, 0, i, i, i, 0) for i in range(len(sets))], np.int64)
    found = {}
    for forest in (True, False):
        cells = jaccard._Cells(rows, bits, 90, forest)
        found[forest] = {(a, b) for batch in cells.pairs() for a, b in zip(*batch.to_pydict().values())}
        assert all(a >= 2000 for a, _ in found[forest])
    assert len(found[True]) == 59 and len(found[False]) == 60 * 59 // 2
    # Once the family is one component, nothing is left.
    rows[2000:, 7] = 2000
    assert not sum(batch.num_rows for batch in jaccard._Cells(rows, bits, 90, False).pairs())


def test_jaccard_pair_leaves_the_cell_of_its_first_shared_shingle_only():
    rng = np.random.default_rng(4)
    draw = lambda n: np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
    family = draw(400)
    sets = [np.sort(np.append(np.delete(family, rng.integers(0, len(family), 8)), draw(8))) for _ in range(30)]
    linked = {
        (a, b)
        for a in range(30) for b in range(a + 1, 30)
        if 100 * len(np.intersect1d(sets[a], sets[b])) >= 90 * len(np.union1d(sets[a], sets[b]))
    }
    rows = []
    for i, tokens in enumerate(sets):
        prefix = tokens[: jaccard.prefix_size(len(tokens))].astype(np.int64).tolist()
        for place, token in enumerate(prefix):
            before = [prefix[place - k] if place >= k else -1 for k in range(1, jaccard.EARLIER + 1)]
            rows.append((token, 0, 0, len(tokens), place, i, i, i, 0, *before))
    rows.sort()
    cells = jaccard._Cells(np.array(rows, np.int64), [jaccard.bitmap(sets[row[6]]) for row in rows], 90, False)
    found = [pair for batch in cells.pairs() for pair in zip(*batch.to_pydict().values())]
    # Every pair shares about 37 shingles of its prefixes.
    assert len(linked) > 400 and linked <= set(found) and len(found) < 1.5 * len(set(found))


def test_jaccard_batches_are_handled_in_portions():
    batch = jaccard.pa.RecordBatch.from_pydict({"a": list(range(1300)), "b": [[i, i + 1] for i in range(1300)]})
    got = list(jaccard._portions(iter([batch, batch.slice(0, 0)])))
    assert [x.num_rows for x in got] == [512, 512, 276]
    assert [row for x in got for row in x.to_pylist()] == batch.to_pylist()


def test_bitmaps_of_many_pairs_agree_with_single_ones():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64)) for n in (3, 500, 600, 1100, 5000, 40_000)]
    bits = [jaccard.bitmap(x) for x in sets]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(6), np.arange(6)))
    got = jaccard._Bitmaps(bits).differ_at_least(i, j).tolist()
    assert got == [jaccard.differ_at_least(bits[a], bits[b]) for a, b in zip(i, j)]


def test_bitmap_bounds_the_difference():
    rng = np.random.default_rng(0)
    for n, m in ((5, 9), (600, 640), (500, 540), (3000, 1100)):
        x, y = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64)), np.unique(rng.integers(0, 1 << 62, m).astype(np.uint64))
        y = np.unique(np.concatenate((x[: n // 2], y[: m // 2])))
        assert jaccard.differ_at_least(jaccard.bitmap(x), jaccard.bitmap(y)) <= len(np.setxor1d(x, y))
        assert jaccard.differ_at_least(jaccard.bitmap(x), jaccard.bitmap(x)) == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.component for r in components.components(edges, Stage(spark), "chain").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


# Licences


def test_license_scan(spark, docs):
    mit = "MIT License\n\nCopyright (c) 2020 Somebody\n\n" + licenses.KNOWN["MIT"].split("\n\n", 1)[1].upper().replace(",", " ,")
    rows = [(1, mit), (2, "x\nReleased under the MIT Licence\ny"), (3, None), (4, ""), (1, mit)]
    got = sorted(map(tuple, licenses.license_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).select("doc_id", "license", "notices").collect()), key=repr)
    assert got == [(1, "MIT", ""), (1, "MIT", ""), (2, None, "MIT notice"), (3, None, ""), (4, None, "")]
    assert licenses.license_scan(docs).count() == docs.count() and licenses.license_scan(empty(docs)).count() == 0
    plan = licenses.license_scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_license_scan_equals_sql(spark):
    from cratewise.llm.queries import ORACLE_SQL, QUERIES

    sf = "/root/testdata/sf0.001"
    assert differences(QUERIES["op8_licenses"](spark, sf), oracle_connection(sf), ORACLE_SQL["op8_licenses"]) == []


def test_staged_tables_of_the_join_are_few_files(spark, docs, tmp_path, monkeypatch):
    """Many partitions: the staged tables of a known size get files by their rows, and ids stay distinct."""
    kept = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    expected = sorted(map(tuple, jaccard.jaccard_components(docs).collect()), key=repr)
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "97")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        join = jaccard.JaccardJoin(docs.select("doc_id", "text"))
        join.stage = Stage(spark, str(tmp_path))
        join._classes_and_groups()
        assert sorted(map(tuple, join.components().collect()), key=repr) == expected
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    cores = spark.sparkContext.defaultParallelism
    files = {t.name: len(list(t.glob("part-*"))) for t in Path(join.stage.path).iterdir()}
    assert {"classes", "groups", "members", "first-pairs", "first-likely", "first-sets", "first-links", "first-edges", "first-1", "class-labels"} <= set(files)
    assert all(n <= cores + 1 for name, n in files.items() if name != "blocks" and not name.endswith(("-pairs"))), files
    for table, key in ((join.classes, "cid"), (join.groups, "gid")):
        assert table.count() == table.select(key).distinct().count()
    more = Stage(spark, str(tmp_path)).save("more", spark.range(0, 9000, 1, 50), 9000)
    assert len(list(tmp_path.glob("*/more/part-*"))) == max(cores, 3) and more.count() == 9000


def test_join_leaves_no_tokenizer_in_the_worker():
    description = Path(PATH).read_text(encoding="utf-8")
    first = bpe.tokenizer(description)
    assert bpe.tokenizer(description) is first
    held = weakref.ref(first)
    token_output._cache(description)  # of two operators' things, the worker holds the last one
    del first
    gc.collect()
    assert held() is None
    held = weakref.ref(bpe.tokenizer(description))
    assert held() is not None
    batch = pa.RecordBatch.from_pydict({"text": ["a b c"] * 3})
    assert [b.num_rows for b in jaccard._portions(iter([batch]))] == [3]
    gc.collect()
    assert held() is None
    assert len(bpe.tokenizer(description).encode([b"word"])) == 1


# Language model


def brute_scores(rows):
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    counts, trie = Counter(), {}
    for d, t in rows:
        if not held(d):
            counts.update([*WORD.findall(lower(t or "")), None])
            b = b"\xfe" * 4 + (t or "").encode().lower() + b"\xff"
            for k in range(4, len(b)):
                for o in range(5):
                    trie.setdefault(b[k - o : k], Counter())[b[k]] += 1
    total, kinds, out = sum(counts.values()), len(counts), []
    for d, t in rows:
        tokens = [*WORD.findall(lower(t or "")), None]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens)
        b, score = b"\xfe" * 4 + (t or "").encode().lower() + b"\xff", 0.0
        for k in range(4, len(b)):
            p, out_of = 1.0, set()
            for o in (4, 3, 2, 1, 0):
                seen = {s: c for s, c in trie.get(b[k - o : k], {}).items() if s not in out_of}
                if b[k] in seen:
                    p *= (2 * seen[b[k]] - 1) / (2 * sum(seen.values()))
                    break
                if seen:
                    p *= len(seen) / (2 * sum(seen.values()))
                    out_of |= set(seen)
            else:
                p /= 256 - len(out_of)
            score += math.log10(p)
        out.append((d, held(d), len(tokens), sum(counts[w] > 0 for w in tokens), total, base, score))
    return out


@pytest.mark.parametrize("block_bytes", [ppm.BLOCK_BYTES, 2000])
def test_lm_scores(spark, docs, block_bytes, monkeypatch):
    monkeypatch.setattr(ppm, "BLOCK_BYTES", block_bytes)
    got = sorted(map(tuple, ppm.lm_scores(docs).collect()), key=repr)
    expected = sorted(brute_scores(rows_of(docs)), key=repr)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    for g, e in zip(got, expected):
        assert g[5:] == pytest.approx(e[5:])
    assert ppm.lm_scores(empty(docs)).count() == 0


def test_lookup_holds_little_beside_its_keys():
    rng = np.random.default_rng(3)
    keys = rng.permutation(np.unique(rng.integers(0, 1 << 63, 300_000, np.uint64)))
    values = rng.random(len(keys))
    tracemalloc.start()
    found = ppm._Lookup(keys, values)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 * len(keys)  # 16 of them are the given keys and values; the tables once took 224
    at = rng.integers(0, len(keys), 1_000_000)
    assert (found(keys[at]) == values[at]).all()
    # Keys that share a slot in both tables, and a table of one.
    one = ppm._Lookup(keys[:1], values[:1])
    assert one(keys[[0, 0]]).tolist() == [values[0]] * 2
    crowded = ppm._Lookup(keys[:2000], values[:2000])
    assert len(crowded._rest) and (crowded(keys[:2000]) == values[:2000]).all()


# Quality


def test_quality_counts(docs, labels):
    got = sorted(map(tuple, quality.quality_rules(docs, labels).collect()), key=repr)
    expected = []
    for doc_id, text in rows_of(docs):
        text = text or ""
        w = WORD.findall(text)
        windows = Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        expected.append((doc_id, len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed))
    assert [g[:7] for g in got] == sorted(expected, key=repr)
    assert all(not g[7] or not g[6] for g in got)
    assert quality.quality_rules(empty(docs), labels).count() == 0
    assert quality.quality_rules(docs, labels.filter("false")).filter("kept = base_failed").count() == 0
    assert quality.quality_filter(docs, labels).columns == docs.columns


def test_binomial_bound(spark):
    def tail(n, a, k):
        return sum(math.comb(n, i) * a**i * (1 - a) ** (n - i) for i in range(k + 1))

    cases = [(n, a, d) for n in (0, 1, 50, 300, 900) for a in (0.01, 0.2) for d in (0.05, 0.3)]
    for n, a, d in cases:
        k = spark.range(1).select(quality.allowed_above(F.lit(n), a, F.lit(d))).first()[0]
        assert k == max([i for i in range(n) if tail(n, a, i) <= d], default=-1), (n, a, d)
    assert spark.range(1).select(quality.allowed_above(F.lit(2_000_000), 0.01, F.lit(0.05))).first()[0] > 19_000


def test_cutoffs_spare_good_documents(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(f"w{rng.randrange(999)}" + ("$%&" if i % 4 == 0 else "") for _ in range(60)), "en") for i in range(2400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(2400)], "doc_id bigint, quality int")
    kept = {r.doc_id for r in quality.quality_rules(docs, labels).filter("kept").collect()}
    assert not any(i % 4 == 0 for i in kept) and len(kept) >= 0.98 * 1800
    plan = quality.measures(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_cutoffs_count_all_good_documents(spark):
    n = 120_000
    value = lambda rule: F.pmod(F.xxhash64("id", F.lit(rule)), F.lit(9 if rule == "capital_share" else 1 << 40)).cast("double")
    lang = F.when(F.col("id") % 4 > 0, "en").when(F.col("id") % 100 == 0, "xx")  # NULL is a stratum, xx too small to certify
    measured = spark.range(n).select(
        F.col("id").alias("doc_id"), lang.alias("lang"),
        F.struct(F.lit(False).alias("base_failed"), *[value(r).alias(r) for r in quality.RULES]).alias("_quality"),
    ).repartition(5)
    got = {r.stratum: r for r in quality.cutoffs(measured, spark.range(n).selectExpr("id as doc_id", "1 as quality")).collect()}
    held = {}
    for r in measured.select("lang", "_quality.*").collect():
        held.setdefault(r.lang, []).append(r)
    assert set(got) == set(held) == {"en", "xx", None}
    for lang, rows in held.items():
        k = _allowed(len(rows), quality.FALSE_REJECTION / 6, quality.FAILURE / 18)
        assert (k < 0) == (lang == "xx")
        for rule in quality.RULES:
            expected = sorted((r[rule] for r in rows), reverse=True)[k] if k >= 0 else None
            assert got[lang][f"_cut_{rule}"] == expected, (lang, rule)


def _allowed(n, alpha, delta):
    total, k = 0.0, -1
    for i in range(n):
        total += math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(alpha) + (n - i) * math.log1p(-alpha))
        if total > delta:
            return k
        k = i
    return k


def test_binomial_bound_of_many_documents(spark):
    for n in (2_999_000, 3_001_000, 1_000_000_000):
        alpha, delta = quality.FALSE_REJECTION / 6, 0.001
        k = spark.range(1).select(quality.allowed_above(F.lit(n), alpha, F.lit(delta))).first()[0]
        assert k == _allowed(n, alpha, delta) if n < 1e7 else abs(k - (n * alpha - 3.09 * (n * alpha) ** 0.5)) < 20, n


def test_pipeline_runs(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxic_passages", "near_duplicates", "source_mix", "token_ids"]
    assert Path(sf).exists() and corpus_pipeline.run(spark, sf).count() > 0
