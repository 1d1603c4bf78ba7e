"""Joins that stay balanced when one key holds a large share of the rows.

A hot key (the empty title, the "various artists" credit, a hit song) would send its rows to one
task. :meth:`HotKeys.find` looks for such keys with pre-aggregated counts over 8-byte hashes, for any
number of fact columns at once. A join whose fact side has none is a plain join, which Spark may
also broadcast; otherwise the rows of hot keys are spread over as many tasks as they need, and all
other rows are shuffled once as before. No row is dropped, capped or sampled.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

# Rows of one key that a single task is expected to join without strain.
ROWS_PER_SALT = 4_000_000

# Hash buckets of the first count, and the most keys of one fact column that can count as hot. Both are
# held as a few bytes each. A table of MAX_HOT * ROWS_PER_SALT rows (4 * 10^12) is the first in which a key
# needs more than ROWS_PER_SALT rows to count.
BUCKETS = 1 << 18
MAX_HOT = 1 << 20

# Salts for rows without a key, which need no partner; more than any sensible number of tasks.
NULL_SALTS = 1 << 20


class HotKeys:
    """Which keys of which fact columns are hot, and the joins that take this into account."""

    def __init__(self, keys: DataFrame | None = None, facts: Mapping[str, int] | None = None) -> None:
        self._keys = keys
        self._facts = dict(facts or {})

    @classmethod
    def none(cls) -> HotKeys:
        """Plain joins only, for streams and for small inputs."""
        return cls()

    @classmethod
    def find(
        cls, facts: Mapping[str, DataFrame], rows_per_salt: int = ROWS_PER_SALT
    ) -> HotKeys:
        """Hot keys of every named frame, which holds just the key columns.

        A frame may be the joined facts themselves or the table they come from, whose counts are an
        upper bound. Rows with a NULL in the key match nothing and are not counted: :meth:`join` spreads
        them in any case.

        A key is hot above ``rows_per_salt`` rows and one part in ``MAX_HOT`` of its table, and then gets
        a salt for every ``rows_per_salt`` rows. So
        tables of fewer rows are done with after a row count, which for stored tables reads file
        footers. The rows of the others are counted per hash bucket, which tasks combine to
        ``BUCKETS`` rows each at most, and only keys in overfull buckets are counted one by one.
        The overfull buckets cannot exceed ``BUCKETS`` nor the hot keys ``MAX_HOT`` rows of a dozen bytes
        for each frame, which is why they may be broadcast.
        """
        number = {name: i for i, name in enumerate(facts)}
        every_row = [keys.select(F.lit(number[name]).alias("fact")) for name, keys in facts.items()]
        counts = reduce(DataFrame.union, every_row).groupBy("fact").count()
        # One row for each named frame at most.
        totals = {row["fact"]: row["count"] for row in counts.collect()}
        large = {n: df for n, df in facts.items() if totals.get(number[n], 0) > rows_per_salt}
        if not large:
            return cls()

        hashes = [
            keys.dropna().select(
                F.lit(number[name]).alias("fact"),
                F.lit(max(rows_per_salt, math.ceil(totals[number[name]] / MAX_HOT))).cast("bigint").alias("unit"),
                F.xxhash64(*keys.columns).alias("key_hash"),
            )
            for name, keys in large.items()
        ]
        rows = reduce(DataFrame.union, hashes).select(
            "*", F.pmod("key_hash", F.lit(BUCKETS)).alias("bucket")
        )
        overfull = rows.groupBy("fact", "unit", "bucket").count().filter(F.col("count") > F.col("unit"))
        hot = (
            rows.join(F.broadcast(overfull.select("fact", "bucket")), ["fact", "bucket"], "left_semi")
            .groupBy("fact", "unit", "key_hash")
            .count()
            .select("fact", "key_hash", F.ceil(F.col("count") / rows_per_salt).cast("int").alias("salts"), "count", "unit")
            .filter("salts > 1 and count > unit")
            .drop("count", "unit")
            .persist()
        )
        # One row for each named frame at most.
        found = {row.fact for row in hot.select("fact").distinct().collect()}
        return cls(hot, {name: i for name, i in number.items() if i in found})

    def __contains__(self, fact: str) -> bool:
        return fact in self._facts

    def join(
        self,
        fact: str,
        facts: DataFrame,
        dim: DataFrame,
        on: str | Sequence[str],
        how: str = "inner",
        *,
        spread: Sequence[str],
    ) -> DataFrame:
        """Equi-join on the columns ``on``, named alike on both sides; ``how`` is inner or left.

        ``fact`` is the name the fact column had in :meth:`find`. The result is that of the plain
        join whatever the hot keys are. ``spread`` names fact columns that tell the rows of one key
        apart. Salts are hashes of them and of the task number, which tells exact copies apart, not
        random numbers: a task that is run again after an executor is lost assigns every row as
        before.
        """
        keys = [on] if isinstance(on, str) else list(on)
        if how not in ("inner", "left"):
            raise ValueError(f"only inner and left joins can be salted, not {how!r}")
        for key in keys:
            left, right = facts.schema[key].dataType, dim.schema[key].dataType
            if left != right:
                if not (isinstance(left, IntegralType) and isinstance(right, IntegralType)):
                    raise TypeError(f"key {key!r} is {left} on one side and {right} on the other")
                facts = facts.withColumn(key, F.col(key).cast("bigint"))
                dim = dim.withColumn(key, F.col(key).cast("bigint"))
        if fact not in self._facts:
            if how == "inner":
                return facts.join(dim, keys, how)
            no_key, anywhere, _ = _salts(keys, spread)
            spread_facts = facts.withColumn("_salt", F.when(no_key, anywhere).otherwise(0))
            one_salt = dim.withColumn("_salt", F.when(no_key, -1).otherwise(0))
            return spread_facts.join(one_salt, [*keys, "_salt"], how).drop("_salt")
        if how == "inner":
            facts = facts.dropna(subset=keys)
        salted = self._salted(fact, facts, keys, spread)
        return salted.join(self._replicated(fact, dim, keys), [*keys, "_salt"], how).drop("_salt")

    def place(self, fact: str, facts: DataFrame, on: str, *, spread: Sequence[str]) -> tuple[DataFrame, list[str]]:
        """``facts`` as :meth:`join_placed` wants them stored, and the columns to deal them out by.

        Rows without a key are left out, as in any inner join.
        """
        kept = facts.dropna(subset=[on])
        if fact not in self._facts:
            return kept, [on]
        return self._salted(fact, kept, [on], spread), [on, "_salt"]

    def join_placed(self, fact: str, placed: DataFrame, dim: DataFrame, on: str) -> DataFrame:
        """Inner join of facts that were stored by the columns of :meth:`place`: they are not shuffled again.

        A key of another type on the other side is cast there; a cast of the stored one would cost the shuffle.
        """
        if fact not in self._facts:
            return placed.join(dim.withColumn(on, F.col(on).cast(placed.schema[on].dataType)), on)
        typed = dim.withColumn(on, F.col(on).cast(placed.schema[on].dataType))
        return placed.join(self._replicated(fact, typed, [on]), [on, "_salt"]).drop("_salt")

    def _hot(self, fact: str) -> DataFrame:
        found = self._keys.filter(F.col("fact") == self._facts[fact])
        return F.broadcast(found.select("key_hash", "salts"))

    def _salted(self, fact: str, facts: DataFrame, keys: list[str], spread: Sequence[str]) -> DataFrame:
        no_key, anywhere, row_hash = _salts(keys, spread)
        own = F.coalesce(F.pmod(row_hash, F.col("salts")), F.lit(0)).cast("int")
        return facts.join(self._hot(fact), F.xxhash64(*keys) == F.col("key_hash"), "left").select(
            *facts.columns, F.when(no_key, anywhere).otherwise(own).alias("_salt")
        )

    def _replicated(self, fact: str, dim: DataFrame, keys: list[str]) -> DataFrame:
        """The other side, once for each salt of its key."""
        every = F.when(F.col("salts").isNull(), F.array(F.lit(0))).otherwise(
            F.sequence(F.lit(0), F.col("salts") - 1)
        )
        return dim.join(self._hot(fact), F.xxhash64(*keys) == F.col("key_hash"), "left").select(
            *dim.columns, F.explode(every).alias("_salt")
        )


def _salts(keys: Sequence[str], spread: Sequence[str]) -> tuple[Column, Column, Column]:
    """Whether a key is missing, the salt of such a row, and the hash that tells rows apart.

    No row of the other side matches a NULL, so rows without a key may go anywhere.
    """
    row_hash = F.xxhash64(*spread, F.spark_partition_id())
    no_key = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    return no_key, F.pmod(row_hash, F.lit(NULL_SALTS)).cast("int"), row_hash
