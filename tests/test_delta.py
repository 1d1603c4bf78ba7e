"""Delta builds against whole builds, and how far a change reaches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cratewise.plans import delta
from cratewise.plans.build import Catalogue, build
from cratewise.sources.manifest import catalogue_manifest
from cratewise.sources.sinks import TARGETS, read_target
from cratewise.sources.stage import Stage
from cratewise.sources.tsv import write_tsv
from verification.adapters import catalogue_tables
from verification.registry import earlier_tables, write_dump

SF = "/root/testdata/sf0.001"


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def later(spark):
    catalogue = Catalogue(catalogue_tables(spark, SF), Stage(spark))
    return catalogue, catalogue.stage.save_all(catalogue.outputs())


def test_changed_rows_count_repeats_and_nulls(spark):
    schema = "id bigint, name string"
    old = spark.createDataFrame([(1, "a"), (2, None), (2, None), (3, "c"), (None, "n")], schema)
    new = spark.createDataFrame([(1, "a"), (2, None), (3, "d"), (None, "n"), (4, "")], schema)
    found = {(r.id, r.name) for r in delta.changed_rows(old, new).collect()}
    assert found == {(2, None), (3, "c"), (3, "d"), (4, "")}
    assert delta.changed_rows(new, new).isEmpty() and delta.changed_rows(new.limit(0), new.limit(0)).isEmpty()


def test_changed_rows_come_once_after_one_shuffle(spark):
    schema = "id bigint, name string"
    old = spark.createDataFrame([(1, "a"), (2, None), (2, None), (3, "c")], schema)
    new = spark.createDataFrame([(1, "a"), (2, None), (4, "d"), (4, "d")], schema)
    changed = delta.changed_rows(old, new)
    assert sorted((r.id, r.name) for r in changed.collect()) == [(2, None), (3, "c"), (4, "d")]
    plan = changed._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and plan.count("LocalTableScan") + plan.count("ExistingRDD") == 2


def test_delta_gives_the_outputs_of_a_whole_build(spark, later):
    catalogue, expected = later
    first = Catalogue(earlier_tables(dict(catalogue.tables)), Stage(spark))
    outputs = first.stage.save_all(first.outputs())
    assert not same(outputs["text_lookup"], expected["text_lookup"])
    found, rank = delta.delta_outputs(first.tables, catalogue.tables, outputs, first.rank, Stage(spark))
    assert set(found) == set(TARGETS)
    for name, df in Stage(spark).save_all(found).items():
        assert same(df, expected[name]), name
    assert same(rank, catalogue.rank)


@pytest.mark.parametrize("table", ["medium", "release_group", "rg_type", "artist", "url", "release_country"])
def test_a_change_of_one_table_is_followed(spark, later, table):
    catalogue, expected = later
    tables = dict(catalogue.tables)
    tables[table] = earlier_tables(tables)[table] if table != "rg_type" else tables[table].filter("id <> 4")
    first = Catalogue(tables, Stage(spark))
    outputs = first.stage.save_all(first.outputs())
    found, _ = delta.delta_outputs(tables, catalogue.tables, outputs, first.rank, Stage(spark))
    for name, df in Stage(spark).save_all(found).items():
        assert same(df, expected[name]), name


def test_one_track_reaches_one_cluster(spark, later):
    catalogue, _ = later
    tables = dict(catalogue.tables)
    one = tables["track"].join(tables["recording"].filter("length is not null").select(F.col("id").alias("recording")), "recording", "left_semi")
    track = one.orderBy("id").first()
    tables["track"] = tables["track"].filter(F.col("id") != track.id)
    stage = Stage(spark)
    found = delta.reach(tables, catalogue.tables, stage)
    assert found.clusters.count() == 1
    cut = delta.cut_down(catalogue.tables, found.clusters, stage)
    assert 0 < cut["track"].count() < catalogue.tables["track"].count() / 5
    assert cut["recording"].count() == found.mbids.count()
    unchanged = delta.reach(catalogue.tables, catalogue.tables, Stage(spark))
    assert unchanged.clusters.isEmpty() and unchanged.mbids.isEmpty()


def test_update_commits_the_tables_of_the_new_dump(spark, tmp_path):
    old, new, out = f"{tmp_path}/old", f"{tmp_path}/new", f"{tmp_path}/out"
    write_dump(spark, SF, new)
    manifest = catalogue_manifest()
    tables = earlier_tables(catalogue_tables(spark, SF))
    tables["track"] = tables["track"].drop("id")
    for name, spec in manifest.items():
        write_tsv(tables[name], f"{old}/{spec.file_name}", spec)
    build(spark, old, out, "a")
    delta.update(spark, old, new, out, "a", "b")
    whole = build(spark, new, f"{tmp_path}/whole")
    for name in TARGETS:
        assert same(whole.outputs[name], read_target(spark, out, name, "b")), name
    assert not same(read_target(spark, out, "recording", "a"), read_target(spark, out, "recording", "b"))
