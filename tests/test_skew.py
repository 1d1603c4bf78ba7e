from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cratewise.operators.skew import HotKeys


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def facts(spark):
    # A third of the rows has key 0, some have none, the rest is spread thin.
    ids = spark.range(0, 30_000, numPartitions=8)
    key = (
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 900 + 1)
    )
    return ids.select("id", key.cast("int").alias("k"), (F.col("id") % 2).cast("int").alias("j"))


@pytest.fixture(scope="module")
def dim(spark):
    # Two rows for the hot key, none for every tenth key, one without a key.
    return (
        spark.range(0, 900)
        .filter("id % 10 != 5")
        .select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
        .unionByName(spark.createDataFrame([(0, "again"), (None, "void")], "k int, name string"))
    )


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(facts, dim, how):
    hot = HotKeys.find({"facts.k": facts.select("k")}, rows_per_salt=1000)
    assert "facts.k" in hot
    salted = hot.join("facts.k", facts, dim, "k", how, spread=["id"])
    plain = facts.join(dim, "k", how)
    assert salted.columns == plain.columns
    assert rows_of(salted) == rows_of(plain)


def test_two_part_keys(facts, dim):
    wide = dim.withColumn("j", F.lit(1))
    hot = HotKeys.find({"facts": facts.select("k", "j")}, rows_per_salt=1000)
    salted = hot.join("facts", facts, wide, ["k", "j"], spread=["id"])
    assert rows_of(salted) == rows_of(facts.join(wide, ["k", "j"]))


def test_hot_rows_and_rows_without_key_are_spread(spark, facts, dim):
    hot = HotKeys.find({"facts.k": facts.select("k")}, rows_per_salt=500)
    # Keep the layout of the join in sight: no broadcast, no merging of small partitions.
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        salted = hot.join("facts.k", facts, dim, "k", "left", spread=["id"])
        task = F.spark_partition_id().alias("task")
        per_task = salted.select("k", task).groupBy("k", "task").count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for key, total in ((0, 20_000), (None, facts.filter("k IS NULL").count())):
        shares = [r["count"] for r in per_task if r.k == key]
        assert sum(shares) == total
        assert max(shares) < total / 3


def test_exact_copies_are_spread(spark, dim):
    copies = spark.range(0, 8000, numPartitions=8).select(F.lit(0).alias("k"), F.lit("same").alias("x"))
    hot = HotKeys.find({"copies": copies.select("k")}, rows_per_salt=500)
    joined = hot.join("copies", copies, dim, "k", spread=["x"])
    assert joined.count() == 16_000
    assert joined.dropDuplicates().count() == 2


def test_no_hot_key_means_a_plain_join(facts, dim, capsys):
    hot = HotKeys.find({"facts.k": facts.select("k")})
    assert "facts.k" not in hot
    hot.join("facts.k", facts, dim, "k", spread=["id"]).explain()
    assert "_salt" not in capsys.readouterr().out


def test_several_facts_in_one_pass(facts):
    hot = HotKeys.find({"k": facts.select("k"), "id": facts.select("id")}, rows_per_salt=1000)
    assert "k" in hot and "id" not in hot


def test_key_types_count_alike_whether_hot_or_not(facts, dim):
    wide = dim.withColumn("k", F.col("k").cast("bigint"))
    text = dim.withColumn("k", F.col("k").cast("string"))
    for hot in (HotKeys.find({"facts.k": facts.select("k")}, rows_per_salt=1000), HotKeys.none()):
        joined = hot.join("facts.k", facts, wide, "k", spread=["id"])
        assert joined.count() == facts.join(dim, "k").count()
        with pytest.raises(TypeError, match="StringType"):
            hot.join("facts.k", facts, text, "k", spread=["id"])


def test_salts_follow_rows_per_salt(spark, monkeypatch):
    monkeypatch.setattr("cratewise.operators.skew.MAX_HOT", 2)
    rows = spark.range(40_000).select(F.lit(1).alias("k"))
    hot = HotKeys.find({"rows": rows}, rows_per_salt=1000)
    assert hot._keys.collect()[0].salts == 40


def test_rows_without_key_are_spread_without_any_hot_key(spark, dim):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 10 == 0, F.col("id").cast("int")).alias("k"))
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        hot = HotKeys.find({"rows": rows.select("k")})
        assert "rows" not in hot
        left = hot.join("rows", rows, dim.dropDuplicates(["k"]), "k", "left", spread=["id"])
        shares = [r["count"] for r in left.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(shares) == 20_000 and max(shares) < 20_000 / 4


def test_other_joins_are_refused(facts, dim):
    hot = HotKeys.none()
    with pytest.raises(ValueError, match="salted"):
        hot.join("facts.k", facts, dim, "k", "left_semi", spread=["id"])
