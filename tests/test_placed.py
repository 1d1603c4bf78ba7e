"""Tracks stored by their recording: read by election and text lookup without another shuffle."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from cratewise.operators import canonical
from cratewise.operators.skew import HotKeys
from cratewise.plans.build import Catalogue
from cratewise.sources.stage import Stage
from verification.adapters import catalogue_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, old)


def path_to_bucketed_scan(df):
    """Names of the plan's operators from the bucketed scan upwards."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(re.match(r"[\s:+\-|*]*(\(\d+\))?\s*", line)[0]) for line in lines]
    at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    path, level = [], depth[at] + 1
    for i in range(at, -1, -1):
        if depth[i] < level:
            path.append(re.sub(r"^[\s:+\-|*]*(\(\d+\))?\s*", "", lines[i]))
            level = depth[i]
    return path


@pytest.mark.parametrize("rows_per_salt", [4_000_000, 30])
def test_no_exchange_between_stored_tracks_and_their_join(spark, no_broadcast, rows_per_salt):
    catalogue = Catalogue(catalogue_tables(spark, SF), Stage(spark), rows_per_salt)
    assert ("track.recording" in catalogue.hot) == (rows_per_salt == 30)
    elected = canonical.elect_placed(catalogue.recordings, catalogue.placed, catalogue.hot)
    for df in (elected, catalogue.text_lookup()):
        path = path_to_bucketed_scan(df)
        joins = [i for i, node in enumerate(path) if node.startswith(("SortMergeJoin", "ShuffledHashJoin"))]
        assert joins and not any(node.startswith("Exchange") for node in path[: joins[0]])


def test_stored_tracks_give_the_rows_of_plain_joins(spark):
    tables = catalogue_tables(spark, SF)
    plain = Catalogue(tables, Stage(spark))
    salted = Catalogue(tables, Stage(spark), rows_per_salt=30)
    assert "_salt" in salted.placed.columns and "_salt" not in plain.placed.columns
    for name in ("text_lookup", "recording"):
        a, b = getattr(plain, name)(), getattr(salted, name)()
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    scored = canonical.score_candidates(
        plain.recordings,
        *[tables[t] for t in ("track", "medium", "release")],
        plain.dates,
        tables["release_group"],
        tables["rg_type"],
    )
    rank = canonical.canonical_rank(scored).drop(*canonical.TITLE_COLUMNS)
    assert rank.exceptAll(plain.rank).count() == plain.rank.exceptAll(rank).count() == 0


def test_a_hot_recording_is_stored_in_several_buckets(spark):
    rows = spark.range(5_000).select(
        F.when(F.col("id") < 4_000, F.lit(7)).otherwise(F.col("id")).alias("recording"),
        F.col("id").alias("release"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("track_title"),
        F.lit("r").alias("release_title"),
    )
    missing = rows.limit(3).withColumn("recording", F.lit(None).cast("bigint"))
    rows = rows.unionByName(missing)
    hot = HotKeys.find({"track.recording": rows.select("recording")}, rows_per_salt=500)
    placed, keys = hot.place("track.recording", rows, "recording", spread=canonical.PLACED_SPREAD)
    assert keys == ["recording", "_salt"]
    stored = Stage(spark).save_bucketed("placed", placed, keys)
    files = stored.groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in files) < 3_000
    # Keys of another type on the other side are cast there.
    named = spark.range(5_000).select(F.col("id").cast("int").alias("recording"), F.col("id").alias("name"))
    joined = hot.join_placed("track.recording", stored, named, "recording")
    assert joined.count() == 5_000 and joined.filter("name = 7").count() == 4_001 - 1 and "_salt" not in joined.columns


def test_lookups_need_only_the_titles_of_stored_tracks(spark, no_broadcast):
    catalogue = Catalogue(catalogue_tables(spark, SF), Stage(spark))
    plan = catalogue.text_lookup()._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "Bucketed: true" in line)
    schema = re.search(r"ReadSchema: struct<([^>]*)", scan)[1]
    assert {field.split(":")[0] for field in schema.split(",")} == {"recording", "track_title", "release_title"}
