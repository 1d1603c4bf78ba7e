"""Mixing sources to target weights (operator 3): entropy balancing.

Of all document rates between 0 and ``MOST_COPIES`` with which every source's tokens meet its target, the
one closest to taking every document once (least relative entropy, each document counts once) is
min(MOST_COPIES, exp(l_s x_d)): x_d is the document's size in units of its source's mean, and the
multiplier l_s of source s minimises the convex dual  sum_d phi(l_s x_d) - l_s t_s . phi(z) is exp(z) up to
the copy limit and continues there as a straight line; t_s is the target in the same units. So a
source that must grow takes its long documents twice before it repeats short ones, and one that must shrink
gives up its long documents first: that changes the fewest documents.

The dual is solved by Newton's method over stored tables. Documents of equal source and size have equal rates,
so they are counted once; every step is one aggregation of gradient and curvature over these counts by source,
combined before the shuffle. Steps are taken in the logarithm of the tokens, where the gradient is nearly
straight, and stay within the bracket of the values tried; they end when every source's tokens are within
``TOLERANCE`` of its target. A source whose target is its limit takes every document ``MOST_COPIES`` times.

Rates become whole copies by error diffusion: in groups of a source, documents go from large to small
and what rounding has left over is carried to the next, so a group misses its share by about half of its
smallest document. Large sources are cut into many groups by a hash of the document, so no task depends
on how large a source is, and a group is passed through as a stream, never held.

Defined results: NULL and empty texts have size 0, so no target touches them, and are taken once; NULL is a
source of its own, the last one. Repeated rows are separate documents. Other columns pass through, whatever
their names. An empty table gives an empty mix.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.llm.common import own_names, words
from cratewise.operators.skew import HotKeys
from cratewise.sources.sinks import with_surrogate_id
from cratewise.sources.stage import Stage

# Fixed values of the mix: weights by order of the sources, tokens wanted as a share of those there are,
# and the most copies of anything.
WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST_COPIES = 2

# Documents that round to copies together.
GROUP_ROWS = 1_000

# Tables of sources up to this number of rows are broadcast.
BROADCAST_SOURCES = 100_000

# Relative miss of a source's target at which its multiplier is found, and the most Newton steps.
TOLERANCE = 1e-6
NEWTON_STEPS = 100

# Multiplier of sources at their limit: all documents with a word reach the most copies.
_UNBOUNDED = 1e300


def _key(source: Column) -> Column:
    """A source as a join key that is never NULL; NULL sorts last, after every real source."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def _rate(tilt: Column, x: Column) -> Column:
    """Rate of a document of size ``x``, in units of its source's mean."""
    return F.least(F.exp(tilt * x), F.lit(float(MOST_COPIES)))


def _with_sources(rows: DataFrame, sources: DataFrame, small: bool, stage: Stage, spread: list[str]) -> DataFrame:
    """Rows (_source, ...) joined to the table of sources; hot sources are split where that is not broadcast."""
    if small:
        return rows.join(F.broadcast(sources), "_source")
    hot = HotKeys.find({"source": rows.select("_source")})
    return hot.join("source", rows, sources, "_source", spread=spread)


def tilted(sizes: DataFrame, sources: DataFrame, stage: Stage) -> DataFrame:
    """``sources`` (_source, _source_size, _docs, _target) with the multiplier ``_tilt`` of the dual.

    ``sizes`` has (_source, _size, _n), one row per source and size. Raises if a source is not within
    ``TOLERANCE`` after ``NEWTON_STEPS`` steps.
    """
    x = F.col("_size") * F.col("_docs") / F.col("_source_size")
    wanted = F.try_divide(F.col("_target") * F.col("_docs"), F.col("_source_size"))
    open_ = (F.col("_source_size") > 0) & (F.col("_target") > 0)
    full = open_ & (F.col("_target") >= F.col("_source_size") * (MOST_COPIES * (1 - 1e-12)))
    none = F.lit(None).cast("double")
    state = sources.select(
        "*",
        F.when(full, _UNBOUNDED).when((F.col("_target") <= 0) & (F.col("_source_size") > 0), -_UNBOUNDED).otherwise(0.0).alias("_tilt"),
        none.alias("_low"),
        none.alias("_high"),
        (full | ~open_).alias("_met"),
    )
    state = stage.save("tilt_0", state)
    small = state.count() <= BROADCAST_SOURCES
    words_only = sizes.filter("_size > 0")
    for step in range(1, NEWTON_STEPS + 1):
        left = state.agg(F.count_if(~F.col("_met")).alias("n")).first().n
        if not left:
            return state.select(*sources.columns, "_tilt")
        asked = state.filter(~F.col("_met")).select("_source", "_source_size", "_docs", "_tilt")
        rows = _with_sources(words_only, asked, small, stage, ["_size"])
        grown = F.exp(F.col("_tilt") * x)
        sums = rows.groupBy("_source").agg(
            F.sum(F.col("_n") * x * _rate(F.col("_tilt"), x)).alias("_mass"),
            F.sum(F.when(grown < MOST_COPIES, F.col("_n") * x * x * grown).otherwise(0.0)).alias("_curve"),
        )
        sums = F.broadcast(sums) if small else sums
        mass, tilt = F.col("_mass"), F.col("_tilt")
        near = F.abs(mass - wanted) <= TOLERANCE * wanted
        low = F.when(mass < wanted, tilt).otherwise(F.col("_low"))
        high = F.when(mass < wanted, F.col("_high")).otherwise(tilt)
        newton = tilt + F.try_divide(F.log(F.try_divide(wanted, mass)) * mass, F.col("_curve"))
        # Where one side is still open, a step about doubles the multiplier at most.
        reach = 2 * F.abs(tilt) + 1
        bounded = F.greatest(-reach, F.least(reach, F.coalesce(newton, F.when(mass < wanted, reach).otherwise(-reach))))
        inside = (F.col("_low").isNull() | (bounded > F.col("_low"))) & (F.col("_high").isNull() | (bounded < F.col("_high")))
        moved = F.when(inside, bounded).otherwise((F.col("_low") + F.col("_high")) / 2)
        held = state.columns
        state = (
            state.join(sums, "_source", "left")
            .withColumn("_hit", F.col("_met") | near)
            .withColumns({"_low": F.when(F.col("_hit"), F.col("_low")).otherwise(low), "_high": F.when(F.col("_hit"), F.col("_high")).otherwise(high)})
            .withColumns({"_tilt": F.when(F.col("_hit"), tilt).otherwise(moved), "_met": F.col("_hit")})
        )
        state = stage.save(f"tilt_{step}", state.select(*held))
    if state.filter(~F.col("_met")).isEmpty():
        return state.select(*sources.columns, "_tilt")
    raise ValueError(f"the dual is not solved after {NEWTON_STEPS} steps")


def balanced_sources(sized: DataFrame, stage: Stage, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET) -> DataFrame:
    """Staged table (_source, _source_size, _docs, _target, _tilt) of frame with (_source, _size)."""
    sizes = stage.save("counts", sized.groupBy("_source", "_size").agg(F.count(F.lit(1)).alias("_n")))
    totals = stage.save(
        "sources", sizes.groupBy("_source").agg(F.sum(F.col("_size") * F.col("_n")).alias("_source_size"), F.sum("_n").alias("_docs"))
    )
    ranked = stage.save("ranked", with_surrogate_id(totals, ("_source",), stage))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("id") - 1, F.lit(len(weights))).cast("int"))
    ranked = ranked.withColumn("_weight", weight).withColumn("_most", F.col("_source_size") * float(MOST_COPIES))

    # Sources whose weighted share is above their limit get the limit; the others share what is left.
    # Every round sends three sums to the driver and ends when no further source reaches its limit.
    whole = ranked.agg(F.coalesce(F.sum("_source_size"), F.lit(0)).alias("s")).first().s * budget
    level, capped = 0.0, -1
    full = F.lit(False)
    while True:
        row = ranked.agg(
            F.coalesce(F.sum(F.when(full, F.col("_most"))), F.lit(0.0)).alias("used"),
            F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0.0)).alias("open"),
            F.count_if(full).alias("capped"),
        ).first()
        if row.capped == capped or not row.open:
            break
        capped, level = row.capped, (whole - row.used) / row.open
        full = F.col("_weight") * F.lit(level) >= F.col("_most")
    target = F.when(full, F.col("_most")).otherwise(F.col("_weight") * F.lit(level))

    solved = ranked.withColumn("_target", target).select("_source", "_source_size", "_docs", "_target")
    return stage.save("balanced", tilted(sizes, stage.save("targets", solved), stage))


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, budget: float = BUDGET) -> DataFrame:
    """Rows of ``docs`` (doc_id, source, ``_size`` and others without a leading underscore) with
    ``_source_size``, ``_target``, ``_rate`` and ``_copies``, 0 to 2."""
    spark = docs.sparkSession
    stage = Stage(spark)
    sized = docs.withColumn("_source", _key(F.col("source")))
    sources = balanced_sources(sized.select("_source", "_size"), stage, weights, budget)
    joined = _with_sources(sized, sources, sources.count() <= BROADCAST_SOURCES, stage, ["doc_id", "_size"])
    groups = F.ceil(F.col("_docs") / GROUP_ROWS)
    x = F.when(F.col("_source_size") > 0, F.col("_size") * F.col("_docs") / F.col("_source_size")).otherwise(0.0)
    rows = joined.withColumns({"_group": F.pmod(F.xxhash64("doc_id", "_size"), groups), "_rate": _rate(F.col("_tilt"), x)}).drop("_docs", "_tilt")
    order = ["_source", "_group", F.desc("_size"), "doc_id"]
    names = rows.columns
    at = {c: names.index(c) for c in ("_source", "_group", "_size", "_rate")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, owed = None, 0.0
        for batch in batches:
            copies = []
            columns = [batch.column(at[c]).to_pylist() for c in ("_source", "_group", "_size", "_rate")]
            for source, number, size, rate in zip(*columns):
                if (source, number) != group:
                    group, owed = (source, number), 0.0
                if size:
                    owed += rate * size
                    n = min(MOST_COPIES, max(0, math.floor(owed / size + 0.5)))
                    owed -= n * size
                else:
                    n = min(MOST_COPIES, math.floor(rate + 0.5))
                copies.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(copies, pa.int32())], [*names, "_copies"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    return (
        rows.repartition("_source", "_group")
        .sortWithinPartitions(*order)
        .mapInArrow(run, ", ".join([*fields, "`_copies` int"]))
        .drop("_source", "_group")
    )


def mix_report(docs: DataFrame) -> DataFrame:
    """Per document: its size, its source's size and target, and the words that the mix takes of it."""
    narrow = docs.select("doc_id", "source", F.size(words("text")).cast("long").alias("_size"))
    staged = Stage(docs.sparkSession).save("sizes", narrow)
    return mixed(staged).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
        F.col("_copies").alias("copies"),
        F.col("_rate").alias("rate"),
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    inner, back = own_names(docs, "doc_id", "source", "text")
    sized = inner.withColumn("_size", F.size(words("text")).cast("long"))
    taken = mixed(Stage(docs.sparkSession).save("sized", sized))
    copies = F.array_repeat(F.lit(1), F.col("_copies"))
    return back(taken.select("*", F.explode(copies).alias("_copy")))
