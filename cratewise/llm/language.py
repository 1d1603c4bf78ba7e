"""Language ID (operator 5): Bayesian evidence fusion.

Four sources of evidence meet in the log posterior of a page's language:

* text: a multinomial model of hashed byte trigrams, learned from all documents with a known language.
  Trigrams overlap, so their sum is tempered: n trigrams weigh like ``EVIDENCE * n / (n + EVIDENCE)``;
* markup: how often pages of a language declare this or that language (or none);
* host and address suffix: a prior that is smoothed hierarchically, all pages -> suffix -> host.

The last two are learned from the pages themselves by grouped sums of text posteriors; a page's own
contribution is taken out of its host's counts, so it does not confirm itself.

Markup is cut out in one scan, whatever its length; what is left open runs to the end of the page. Entities are
decoded.

Defined results: NULL or empty html has no text evidence; a missing or strange url has the host ''. Pages are
judged by what is left then. Repeated pages are separate pages. Without any document of a known language
every result is NULL.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.llm.common import steps, text_bytes
from cratewise.llm.components import lookup
from cratewise.sources.stage import Stage

BUCKETS = 1 << 15
SMOOTHING = 0.5
EVIDENCE = 40.0

# Pages' worth of belief in the level above: suffix for a host, all pages for a suffix, all for a declaration.
HOST_BELIEF = 5.0
SUFFIX_BELIEF = 20.0
DECLARED_BELIEF = 5.0

# Languages that the model can tell apart; its size is that times BUCKETS.
MOST_LANGUAGES = 256

# What is left open runs to the end of the page, so every byte is looked at once.
_CUT = re.compile(rb"(?is)<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<[^>]*(?:>|\Z)")
_ENTITY = re.compile(rb"&#?\w{1,31};")
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[*range(33), *range(33, 65), *range(91, 97), *range(123, 128)]] = 32


def _character(entity: re.Match[bytes]) -> bytes:
    """What an entity stands for; space and unknown ones separate words."""
    name = entity.group().decode("ascii")
    value = unescape(name)
    return b" " if value == name or value.isspace() else value.encode("utf-8", "replace")


def visible_text(html: bytes) -> bytes:
    """Text without markup; an unclosed tag, comment, script or style has none after it."""
    return _ENTITY.sub(_character, _CUT.sub(b" ", html))


def _trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all trigrams of the texts, and the text that each belongs to."""
    joined = b"  ".join(texts) + b"  "
    data = _FOLD[np.frombuffer(joined, np.uint8)]
    key = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
    keep = ~((data[:-2] == 32) & (data[1:-1] == 32) | (data[1:-1] == 32) & (data[2:] == 32))
    bucket = (key * np.uint32(2654435761)) >> np.uint32(17)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 2)
    owner = np.searchsorted(ends, np.flatnonzero(keep), side="right")
    return bucket[keep].astype(np.int64), owner


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS, np.int64))
    for batch in batches:
        rows: dict[str, list[bytes]] = defaultdict(list)
        for lang, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
            rows[lang].append(text)
        for lang, texts in rows.items():
            for first, last in steps(texts):
                totals[lang] += np.bincount(_trigrams(texts[first:last])[0], minlength=BUCKETS)
        while len(totals) > MOST_LANGUAGES:
            yield _count_rows(*totals.popitem())
    for lang, counts in totals.items():
        yield _count_rows(lang, counts)


def _count_rows(lang: str, counts: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(counts)
    return pa.RecordBatch.from_pydict(
        {"lang": pa.array([lang] * len(at), pa.string()), "bucket": pa.array(at, pa.int64()), "n": pa.array(counts[at], pa.int64())}
    )


def text_model(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order, and log probabilities (bucket, language), learned from all (lang, text)."""
    rows = docs.filter("lang is not null and text is not null").select("lang", "text")
    counts = rows.mapInArrow(_counts, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = Stage(docs.sparkSession).save("trigrams", counts)
    langs = [r.lang for r in counts.select("lang").distinct().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    # BUCKETS rows per language at most.
    table = counts.toArrow()
    matrix = np.full((BUCKETS, len(langs)), SMOOTHING)
    place = {lang: i for i, lang in enumerate(langs)}
    at = np.array([place[x] for x in table.column("lang").to_pylist()], np.int64)
    matrix[np.asarray(table.column("bucket")), at] += np.asarray(table.column("n"))
    return langs, np.log(matrix / matrix.sum(axis=0))


def text_evidence(pages: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """(page_id, url, declared, evidence): tempered log likelihood of each language."""
    shared = pages.sparkSession.sparkContext.broadcast(model.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [visible_text(h) for h in text_bytes(batch.column(3))]
            out = []
            for first, last in steps(texts):
                bucket, owner = _trigrams(texts[first:last])
                n = np.bincount(owner, minlength=last - first)
                weight = EVIDENCE / (n + EVIDENCE)
                sums = [np.bincount(owner, weights=model[bucket, i], minlength=last - first) for i in range(model.shape[1])]
                out += (np.column_stack(sums) * weight[:, None]).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(out, pa.list_(pa.float64()))], ["page_id", "url", "declared", "evidence"]
            )

    html = F.coalesce(F.col("html"), F.lit(""))
    declared = F.lower(F.regexp_extract(html, r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,3})\b", 1))
    narrow = pages.select(F.col("page_id").cast("bigint"), "url", declared.alias("declared"), "html")
    return narrow.mapInArrow(run, "page_id bigint, url string, declared string, evidence array<double>")


def _posterior(scores: Column) -> Column:
    most = F.array_max(scores)
    weights = F.transform(scores, lambda x: F.exp(x - most))
    return F.transform(weights, lambda w: w / F.aggregate(weights, F.lit(0.0), lambda a, b: a + b))


def _sums(rows: DataFrame, key: str, n: int, extra: list[Column] | None = None) -> DataFrame:
    """Per key: number of pages and the sum of their posteriors."""
    total = F.array(*[F.sum(F.get("posterior", F.lit(i))) for i in range(n)])
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias(f"{key}_pages"), total.alias(f"{key}_sum"), *(extra or []))


def language_id(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """Per page: page_id, host, suffix, declared, text_lang, lang, probability."""
    spark = pages.sparkSession
    stage = Stage(spark)
    langs, model = text_model(docs)
    n = len(langs)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    suffix = F.regexp_extract("host", r"([^.]+)$", 1)
    if not n:
        none = F.lit(None)
        return pages.select(F.col("page_id").cast("bigint"), host.alias("host")).select(
            "page_id", "host", suffix.alias("suffix"), none.cast("string").alias("declared"), none.cast("string").alias("text_lang"),
            none.cast("string").alias("lang"), none.cast("double").alias("probability"),
        )
    scored = text_evidence(pages, langs, model).select("page_id", host.alias("host"), "declared", "evidence")
    rows = stage.save("evidence", scored.select("page_id", "host", suffix.alias("suffix"), "declared", "evidence", _posterior(F.col("evidence")).alias("posterior")))

    at = lambda column, i: F.get(column, F.lit(i))
    each = lambda f: F.array(*[f(i) for i in range(n)])
    total = rows.agg(F.count(F.lit(1)).alias("pages"), *[F.sum(at("posterior", i)).alias(f"s{i}") for i in range(n)]).first()
    pages_total = total.pages
    overall = [((total[f"s{i}"] or 0.0) + 1.0) / (pages_total + n) for i in range(n)]

    suffixes = _sums(rows, "suffix", n)
    suffixes = suffixes.select(
        "suffix", "suffix_pages",
        each(lambda i: (at("suffix_sum", i) + SUFFIX_BELIEF * overall[i]) / (F.col("suffix_pages") + SUFFIX_BELIEF)).alias("suffix_prior"),
    )
    suffixes = stage.save("suffixes", suffixes)
    hosts = _sums(rows, "host", n, [F.first("suffix").alias("suffix")])
    hosts = stage.save("hosts", lookup(hosts, suffixes, "suffix", "suffix_pages", pages_total).drop("suffix", "suffix_pages"))
    declared = _sums(rows, "declared", n)
    n_declared = max(1, declared.count())
    declared = stage.save(
        "declared",
        declared.select(
            "declared", "declared_pages",
            each(lambda i: F.log((at("declared_sum", i) + DECLARED_BELIEF / n_declared) / ((total[f"s{i}"] or 0.0) + DECLARED_BELIEF))).alias("declared_odds"),
        ),
    )
    joined = lookup(lookup(rows, declared, "declared", "declared_pages", pages_total), hosts, "host", "host_pages", pages_total)
    prior = lambda i: (
        F.greatest(at("host_sum", i) - at("posterior", i), F.lit(0.0)) + HOST_BELIEF * at("suffix_prior", i)
    ) / (F.col("host_pages") - 1 + HOST_BELIEF)
    fused = each(lambda i: at("evidence", i) + at("declared_odds", i) + F.log(prior(i)))
    names = F.array(*[F.lit(x) for x in langs])
    best = lambda column: F.get(names, (F.array_position(column, F.array_max(column)) - 1).cast("int"))
    result = joined.select("page_id", "host", "suffix", "declared", best(F.col("posterior")).alias("text_lang"), _posterior(fused).alias("fused"))
    return result.select(
        "page_id", "host", "suffix", "declared", "text_lang", best(F.col("fused")).alias("lang"), F.round(F.array_max("fused"), 9).alias("probability")
    )
