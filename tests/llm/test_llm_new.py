"""Operators 11 to 13 against brute force, on small tables with NULLs, empty and long texts, ties and copies."""

from __future__ import annotations

import functools
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cratewise.llm import alignment, classifier, spelling
from cratewise.llm.common import TwoGenerations
from cratewise.llm.queries import BYTE_TOKENIZER, PIECE_TOKENIZER, QUERIES

SCHEMA = "doc_id bigint, text string, lang string, word string, block string, groups string, quality_score string"


def frame(spark, texts, first=0):
    rows = [(first + i, t, "en", "x", "y", "z", "w") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def test_generations_keep_what_is_in_use():
    memory = TwoGenerations(2)
    memory.update({1: "a", 2: "b"})
    memory.update({3: "c"})
    assert memory.find([1, 3, 9]) == {1: "a", 3: "c"}
    memory.update({4: "d"})
    assert memory.find([1, 2, 4]) == {1: "a", 4: "d"}


# Alignment


@pytest.fixture(scope="module")
def tokenizers():
    description = Path(public_tokenizers.path(BYTE_TOKENIZER)).read_text(encoding="utf-8")
    return description, Path(public_tokenizers.path(PIECE_TOKENIZER)).read_bytes()


@functools.lru_cache
def loaded(tokenizers):
    description, model = tokenizers
    a = Tokenizer.from_str(description)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_proto=model), alignment.Aligner(*tokenizers)


def brute_groups(text, tokenizers):
    """Groups of a whole text from the byte lengths of its tokens; None without tokens."""
    a, b, both = loaded(tokenizers)
    if not text:
        return None
    one, two = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_one, bytes_two = [both.a_bytes[i] for i in one], [both.b_bytes[i] for i in two]
    whole = (" " + text).encode()
    if b"".join(bytes_one) != whole or b"".join(bytes_two) != whole:
        return None
    ends_one = list(itertools.accumulate(map(len, bytes_one)))
    ends_two = list(itertools.accumulate(map(len, bytes_two)))
    out, i, j, start = [], 0, 0, 0
    for cut in sorted(set(ends_one) & set(ends_two)):
        k, n = ends_one.index(cut) + 1, ends_two.index(cut) + 1
        out.append((start, cut, tuple(one[i:k]), tuple(two[j:n])))
        start, i, j = cut, k, n
    return out


ODD = [
    "", None, " lead", "tail ", "a\n b c", "a▁b", "é ﬁ ２ 👍🏽 👍🏽🏽 日本語 x\x00y", "<s> </s> <|endoftext|> <unk>",
    "　 x   y  z", "q" * 5000, "a b " * 3, "a b " * 3, "\x1c a b\x85c d", "don't we'll I'M", "   ", "\n\n a",
    "é ​ z", "x <0x41> y", "日本語のテキスト " * 40, "🏽" * 50, "İstanbul ça va ñandú",
]


def test_groups_are_those_of_whole_texts(spark, tokenizers, monkeypatch):
    monkeypatch.setattr(alignment, "PIECE_CHARS", 40)
    aligner = alignment.Aligner(*tokenizers)
    for text in ODD:
        got = alignment.document_groups(aligner, text)
        assert (got and [(g["start"], g["end"], tuple(g["a"]), tuple(g["b"])) for g in got]) == brute_groups(text, tokenizers), repr(text)
    shown = alignment.align(frame(spark, ODD), *tokenizers).collect()
    for row in shown:
        want = brute_groups(ODD[row.doc_id], tokenizers)
        assert (row.groups and [(g.start, g.end, tuple(g.a), tuple(g.b)) for g in row.groups]) == want


def test_alignment_counts_over_all_documents(spark, tokenizers, monkeypatch):
    rng = random.Random(11)
    parts = "the an er ing tion és 日 x1 -- ... don't".split()
    texts = ODD + [" ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts.append(" ".join(t for t in texts[-9:]) * 30)
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 500)
    monkeypatch.setattr(alignment, "LEAST_HOT", 3)
    monkeypatch.setattr(alignment, "HOT_PAIRS", 200)
    docs = frame(spark, texts).unionByName(frame(spark, ["the er the"]).withColumn("doc_id", F.lit(None).cast("bigint")))
    got = {r.doc_id: r for r in alignment.alignment_report(docs.repartition(3), *tokenizers).collect()}
    groups = {i: brute_groups(t, tokenizers) or [] for i, t in [*enumerate(texts), (None, "the er the")]}
    links = {i: Counter((x, y) for g in found for x in g[2] for y in g[3]) for i, found in groups.items()}
    count = Counter(key for found in links.values() for key in found)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    assert got.keys() == groups.keys()
    for i, found in groups.items():
        digest = ";".join(",".join(map(str, g[2])) + "|" + ",".join(map(str, g[3])) for g in found)
        want = (
            sum(len(g[2]) for g in found), sum(len(g[3]) for g in found), len(found), sum(links[i].values()),
            sum(n for key, n in links[i].items() if count[key] == most[key[0]]),
            sum(n * count[key] for key, n in links[i].items()),
            hashlib.sha256(digest.encode()).hexdigest() if found else "",
        )
        r = got[i]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == want


def test_empty_tables(spark, tokenizers):
    none = frame(spark, ["a"]).filter("false")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert alignment.alignment_report(none, *tokenizers).count() == 0
    assert alignment.align(none, *tokenizers).count() == 0
    assert spelling.spelling_variants(none).count() == 0
    assert classifier.classify(none, labels).count() == 0
    unread = alignment.alignment_report(frame(spark, ["", None, "▁"]), *tokenizers).collect()
    assert [tuple(r)[1:] for r in unread] == [(0, 0, 0, 0, 0, 0, "")] * 3


# Classifier


def labelled(n):
    rng = random.Random(4)
    texts, classes = [], []
    for i in range(n):
        words = ["".join(rng.choices(["ba", "lo", "mi", "ter", "un"], k=rng.randint(1, 4))) for _ in range(rng.randint(5, 80))]
        bad = i % 5 == 0
        kind = rng.randrange(3)
        if bad and kind == 0:
            words = [w.upper() + "!!" for w in words]
        elif bad and kind == 1:
            words = [w + "$$$" for w in words]
        elif bad:
            words = [w for w in words for _ in range(8)]
        texts.append(" ".join(words))
        classes.append(int(not bad))
    return texts, classes


def test_features_match_their_definition():
    texts = ["ab abc", "", " x\tx ", "né né né"]
    bucket, owner = classifier.feature_buckets(texts)
    want = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        names = [("w", w) for w in words]
        names += [("=",) if a == b else ("2", a, b) for a, b in zip(words, words[1:])]
        names += [(n, f" {w} "[i : i + n]) for w in words for n in classifier.NGRAMS for i in range(len(w) + 3 - n)]
        want.append(Counter(names))
    for i, names in enumerate(want):
        assert sorted(Counter(bucket[owner == i].tolist()).values()) == sorted(names.values())
    same, _ = classifier.feature_buckets(["zz zz"])
    assert set(same) & set(bucket[owner == 3])


def test_long_texts_are_scored_whole(monkeypatch):
    texts, classes = labelled(60)
    bags = classifier.bags(texts)
    ids = [np.flatnonzero(b) for b in bags]
    vectors, layer = classifier.train(ids, [b[i] / b[i].sum() for b, i in zip(bags, ids)], np.array(classes))
    model = classifier.QualityModel(vectors, layer, constant=None)
    long = [" ".join(texts), "", "q" * 3000, *texts[:3]]
    mean = model.vectors_of(long)
    by_hand = mean @ (layer[:-1, 1] - layer[:-1, 0]) + layer[-1, 1] - layer[-1, 0]
    assert np.allclose(model.raw(long), by_hand, atol=1e-4)
    whole = model.raw(long)
    monkeypatch.setattr(classifier, "STRETCH_CHARS", 200)
    # A cut between two words costs that pair of words only.
    assert np.allclose(model.raw(long), whole, atol=0.2)


def test_classifier_on_held_out_labels(spark):
    texts, classes = labelled(400)
    odd = ["", None, " \n ", "a " * 40_000]
    docs = frame(spark, texts + odd).unionByName(frame(spark, ["no id"]).withColumn("doc_id", F.lit(None).cast("bigint")))
    docs = docs.unionByName(docs.limit(3))
    rows = [*enumerate(classes), (0, None), (None, 1), (3, 1)]
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int").withColumn("lang", F.lit("clash"))
    found = classifier.classify(docs.repartition(3), labels).collect()
    assert len(found) == len(texts) + 8 and all(0 <= r.score <= 1 for r in found)
    assert all(r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0) for r in found)
    assert all(r.predicted == int(r.score >= 0.3) for r in found)
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < len(classes)]
    right = sum(r.predicted == classes[r.doc_id] for r in held)
    assert right >= 0.95 * len(held)
    again = classifier.classify(docs.repartition(2), labels).collect()
    assert sorted((r.doc_id or -1, r.score) for r in again) == sorted((r.doc_id or -1, r.score) for r in found)
    # Labels of the held-out fold change nothing.
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = classifier.classify(docs, flipped).collect()
    assert sorted((r.doc_id or -1, r.score) for r in other) == sorted((r.doc_id or -1, r.score) for r in found)


def test_labels_of_one_class_or_none(spark):
    docs = frame(spark, ["a b", "", None])
    for rows, want in (([], 0.5), ([(1, 1)], 1.0), ([(1, 0)], 0.0), ([(77, 0), (78, 1)], 0.5)):
        labels = spark.createDataFrame(rows, "doc_id bigint, quality int")
        model = classifier.fit(docs, labels)
        assert {r.quality_score for r in classifier.score(docs, model).collect()} == {want}


def test_score_replaces_its_column_and_keeps_the_others(spark):
    docs = frame(spark, ["a", None])
    out = classifier.score(docs, classifier.QualityModel())
    assert set(out.columns) == set(docs.columns)
    assert [r.quality_score for r in out.collect()] == [0.5, 0.5]


# Spelling variants


def edits(a, b):
    """Whether one inserted, deleted or replaced code point makes ``b`` of ``a``."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    counts = Counter()
    lower = {c: c + 32 for c in range(65, 91)}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            if len(word) >= 7:
                counts[word] += 1
    n = {w: c for w, c in counts.items() if c >= 2}
    near = {w: [v for v in n if edits(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n}


@pytest.fixture(scope="module")
def misspelt():
    rng = random.Random(8)
    base = ["".join(rng.choices("abcéß×", k=rng.randint(6, 12))) for _ in range(40)] + ["straßen" * 40, "aaaaaaaa", "aaaaaaab"]
    texts, often = [], []
    for word in base:
        often += [word] * rng.choice([2, 3, 40, 200])
        for _ in range(6):
            i, kind, c = rng.randrange(len(word)), rng.randrange(3), rng.choice("abcÉ")
            other = word[:i] + (c if kind else "") + word[i + (kind < 2) :]
            often += [other] * rng.choice([1, 2, 2, 3, 25])
    often += ["chainone"] * 900 + ["chainonf"] * 60 + ["chaiponf"] * 3
    rng.shuffle(often)
    for i in range(0, len(often), 25):
        texts.append(" ".join(w.upper() if rng.random() < 0.2 else w for w in often[i : i + 25]))
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [rows[0], rows[1], (None, texts[2]), (900, None), (901, ""), (902, "q" * 5_000 + " " + "q" * 5_000), (903, "q" * 4_999 + "-" + "q" * 4_999)]


@pytest.mark.parametrize("block", [512, 3, 1])
def test_spelling_variants(spark, misspelt, monkeypatch, block):
    monkeypatch.setattr(spelling, "BLOCK_WORDS", block)
    monkeypatch.setattr(spelling, "GATHERED_WORDS", 64)
    monkeypatch.setattr(spelling, "COMPARED_PAIRS", 50)
    rows = [(i, t, "x", "word", "n", "form", "root") for i, t in misspelt]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, cell string, word string, n string, form string, root string")
    found = [tuple(r) for r in spelling.spelling_variants(docs.repartition(3)).collect()]
    want = brute_variants(misspelt)
    assert len(found) == len(want) and set(found) == want
    assert any(r[1] is not None and r[2] != r[1] for r in want)


def test_single_edits_by_definition():
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("ab", k=rng.randint(1, 6))) for _ in range(60)})
    pairs = [(i, j) for i in range(len(words)) for j in range(len(words)) if i != j]
    matrix = spelling.points(words)
    sizes = np.array([len(w) for w in words])
    i, j = (np.array(x) for x in zip(*pairs))
    places = spelling.single_edits(matrix[i], matrix[j], sizes[i], sizes[j])
    for (a, b), place in zip(pairs, places.tolist()):
        assert (place >= 0) == edits(words[a], words[b])


def test_the_queries_are_registered():
    assert {"op11_alignment", "op12_classifier", "op13_spelling"} <= QUERIES.keys()
