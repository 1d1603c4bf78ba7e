"""Quality rules (operator 10): cutoffs whose risk of rejecting good documents is bounded.

Native: DataFrame functions only. A rule rejects a document whose measure is above the rule's cutoff in
the document's stratum. The cutoff is an order statistic of labelled good documents: if ``k`` of ``n`` lie
above it, then at most a share ``alpha`` of all good documents does, unless an event of probability
P(Bin(n, alpha) <= k) occurred. So the exact binomial bound picks the largest ``k`` for which that
probability is at most ``delta``; both are divided by the number of rules, and ``delta`` also by the number
of strata (Bonferroni). A rule that cannot be certified in a stratum rejects nothing there. All labelled good
documents count, however many there are: equal values are counted, distinct ones dealt to ranges, and only the
range that holds the order statistic is summed up.

Defined results: NULL and empty texts have no words and fail the base check. Repeated rows and ids are
judged each by itself; labels of a repeated id count as good only if all of them are. A NULL stratum is
a stratum. No labels: only the base check rejects.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratewise.llm.common import SPACES, WORD, own_names, words
from cratewise.sources.stage import Stage

# Share of the good documents of a stratum that all rules together may reject, and the probability that
# this fails in any stratum.
FALSE_REJECTION = 0.02
FAILURE = 0.05

# Above this expected count, the binomial tail is summed from BAND standard deviations below it; what lies
# further down has a probability below exp(-BAND**2 / 2).
LONG_TAIL = 10_000
BAND = 20

# Strata up to this number are broadcast as one table of cutoffs.
BROADCAST_STRATA = 10_000

# What a rule compares with its cutoff. Higher is worse.
RULES = (
    "symbols_per_word",
    "repeated_share",
    "duplicate_line_share",
    "capital_share",
    "mean_word_length",
    "same_word_share",
)


def measures(docs: DataFrame, text: str = "text", into: str = "_quality") -> DataFrame:
    """Add the struct ``into`` with the counts and rule measures of every text.

    Repeated windows are found by the hashes of a document's 3-word windows. Only if some hash occurs
    twice are they sorted, to mark the windows with an equal neighbour.
    """
    kept = docs.drop(into)
    base = [F.col(f"`{c}`") for c in kept.columns]
    whole = F.coalesce(F.col(text), F.lit(""))
    step = kept.select(*base, words(text).alias("_w"))
    step = step.select(
        "*",
        F.when(
            F.size("_w") > 2,
            F.transform(
                F.sequence(F.lit(0), F.size("_w") - 3),
                lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)),
            ),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("_h"),
    )
    step = step.select(
        "*",
        F.when(
            F.size(F.array_distinct("_h")) < F.size("_h"),
            F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("_s"),
    )
    repeated = F.filter(
        "_s",
        lambda w, i: (w["h"] == F.get("_s", i - 1)["h"]) | (w["h"] == F.get("_s", i + 1)["h"]),
    )
    covered = F.flatten(F.transform(repeated, lambda w: F.array(w["i"], w["i"] + 1, w["i"] + 2)))
    lines = F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(WORD))
    without = lambda pattern: F.length(F.regexp_replace(whole, pattern, ""))
    counted = step.select(
        *base,
        F.struct(
            F.size("_w").cast("long").alias("n_words"),
            without(SPACES).cast("long").alias("word_chars"),
            (F.length(whole) - without("[#*$%&|<>]+")).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.when(F.col("_s").isNull(), 0).otherwise(F.size(F.array_distinct(covered))).cast("long").alias("n_repeat_words"),
            (F.length(whole) - without(r"\p{Lu}+")).cast("long").alias("n_capitals"),
            F.size(F.array_distinct("_w")).cast("long").alias("n_distinct"),
        ).alias(into),
    )
    q = lambda name: F.col(into)[name]
    of = lambda part, all_: F.when(q(all_) > 0, q(part) / q(all_)).otherwise(F.lit(0.0))
    return counted.withColumn(
        into,
        F.struct(
            f"{into}.*",
            ((q("n_words") < 50) | (100 * q("n_repeat_words") > 50 * q("n_words"))).alias("base_failed"),
            of("n_symbols", "n_words").alias("symbols_per_word"),
            of("n_repeat_words", "n_words").alias("repeated_share"),
            of("n_dup_lines", "n_lines").alias("duplicate_line_share"),
            of("n_capitals", "word_chars").alias("capital_share"),
            of("word_chars", "n_words").alias("mean_word_length"),
            (1 - of("n_distinct", "n_words")).alias("same_word_share"),
        ),
    )


def allowed_above(n: Column, alpha: float, delta: Column) -> Column:
    """Largest k with P(Bin(n, alpha) <= k) <= delta; -1 if there is none.

    The tail is summed in logarithms, so that no count underflows.
    """
    n = n.cast("double")
    mean = n * alpha
    log_add = lambda a, b: F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))
    odds = F.lit(alpha / (1 - alpha))

    def step(acc: Column, i: Column) -> Column:
        ok = acc["total"] <= F.log(delta)
        term = acc["term"] + F.log(F.greatest(n - i, F.lit(1e-300)) / (i + 1) * odds)
        return F.struct(
            term.alias("term"),
            log_add(acc["total"], term).alias("total"),
            F.when(ok, i.cast("long")).otherwise(acc["k"]).alias("k"),
        )

    low = F.when(mean > LONG_TAIL, F.floor(mean - BAND * F.sqrt(mean))).otherwise(0).cast("long")
    x = low.cast("double")
    # Probability of exactly ``low``, by Stirling's series where ``low`` is not 0.
    stirling = (
        x * F.log(mean / x) + (n - x) * F.log(n * (1 - alpha) / (n - x))
        + F.log(n / (2 * math.pi * x * (n - x))) / 2 + (1 / n - 1 / x - 1 / (n - x)) / 12
    )
    first = F.when(x > 0, stirling).otherwise(n * math.log1p(-alpha))
    start = F.struct(first.alias("term"), first.alias("total"), (low - 1).alias("k"))
    return F.aggregate(F.sequence(low, F.ceil(mean).cast("long")), start, step, lambda acc: acc["k"])


def cutoffs(
    measured: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    alpha: float = FALSE_REJECTION,
    delta: float = FAILURE,
) -> DataFrame:
    """One row (stratum, cutoff of each rule) per stratum with labelled good documents.

    ``measured`` has doc_id, the stratum and ``_quality``; ``labels`` has doc_id and quality.
    """
    good = (
        labels.filter("quality is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .filter("quality = 1")
        .select("doc_id")
    )
    kept = measured.filter(~F.col("_quality.base_failed")).select(
        "doc_id", F.col(stratum).alias("stratum"), *[F.col(f"_quality.{r}").alias(r) for r in RULES]
    )
    stage = Stage(measured.sparkSession)
    labelled = stage.save("labelled", kept.join(good, "doc_id"))
    sizes = stage.save("sizes", labelled.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")))
    n_strata = sizes.count()
    few = lambda frame: F.broadcast(frame) if n_strata <= BROADCAST_STRATA else frame
    k = allowed_above(F.col("n"), alpha / len(RULES), F.lit(delta / (len(RULES) * max(n_strata, 1))))
    ranks = stage.save("ranks", sizes.select("stratum", k.alias("k")))
    values = labelled.select("stratum", F.explode(F.map_from_arrays(F.array(*map(F.lit, RULES)), F.array(*RULES))).alias("rule", "value"))
    counted = values.groupBy("stratum", "rule", "value").agg(F.count(F.lit(1)).alias("n"))
    dealt = stage.save(
        "values", counted.repartitionByRange("stratum", "rule", F.desc("value")).withColumn("part", F.spark_partition_id())
    )
    # Rows (stratum, rule, part): one per range and where a group begins. Of each group, one part holds rank k.
    parts = dealt.groupBy("stratum", "rule", "part").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy("stratum", "rule").orderBy("part")) - F.col("n")
    own = lambda frame: frame.withColumnRenamed("stratum", "_stratum")
    same = F.col("stratum").eqNullSafe(F.col("_stratum"))
    holds = (
        parts.withColumn("before", before)
        .join(few(own(ranks)), same)
        .filter((F.col("before") <= F.col("k")) & (F.col("k") < F.col("before") + F.col("n")))
        .select("_stratum", F.col("rule").alias("_rule"), F.col("part").alias("_part"), "before", "k")
    )
    at = dealt.join(few(holds), same & (F.col("rule") == F.col("_rule")) & (F.col("part") == F.col("_part")))
    # The largest value is the first; rank k is the first value that more than k values reach.
    reach = F.col("before") + F.sum("n").over(Window.partitionBy("stratum", "rule").orderBy(F.desc("value")))
    chosen = at.withColumn("reach", reach).filter("reach > k").groupBy("stratum", "rule").agg(F.max("value").alias("cutoff"))
    # Strata in which no rule is certified keep their row.
    every = chosen.unionByName(sizes.select("stratum", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("double").alias("cutoff")))
    return every.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_cut_{r}") for r in RULES])


def verdicts(measured: DataFrame, limits: DataFrame, stratum: str = "lang") -> DataFrame:
    """Add ``_kept``: neither the base check nor a certified cutoff of the stratum rejects the row."""
    limits = Stage(measured.sparkSession).save("cutoffs", limits.coalesce(1)).withColumnRenamed("stratum", "_stratum")
    small = limits.count() <= BROADCAST_STRATA
    joined = measured.join(F.broadcast(limits) if small else limits, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    above = F.lit(False)
    for rule in RULES:
        above = above | F.coalesce(F.col(f"_quality.{rule}") > F.col(f"_cut_{rule}"), F.lit(False))
    return joined.select(*[f"`{c}`" for c in measured.columns], (~F.col("_quality.base_failed") & ~above).alias("_kept"))


def judged(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with ``_quality`` (of :func:`measures`), staged, and ``_kept``."""
    staged = Stage(measured.sparkSession).save("measured", measured)
    return verdicts(staged, cutoffs(staged, labels))


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts and verdict per document."""
    rows = judged(measures(docs.select("doc_id", "lang", "text")).drop("text"), labels)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return rows.select("doc_id", *[F.col(f"_quality.{c}").alias(c) for c in counts], F.col("_kept").alias("kept"))


def quality_filter(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, as they were; further columns may have any name."""
    inner, back = own_names(docs, "doc_id", "lang", "text")
    return back(judged(measures(inner), labels).filter("_kept"))
