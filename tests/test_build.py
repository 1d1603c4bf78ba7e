from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cratewise.operators import checks
from cratewise.plans.build import Catalogue, assert_integrity, build
from cratewise.plans.sample_dump import sample_dump
from cratewise.sources.manifest import catalogue_manifest
from cratewise.sources.sinks import TARGETS, read_target, read_versions, with_surrogate_id
from cratewise.sources.stage import Stage
from cratewise.sources.tsv import load_all
from verification.adapters import catalogue_tables
from verification.registry import write_dump

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def dump(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("dump")
    write_dump(spark, SF, str(folder))
    return str(folder)


@pytest.fixture(scope="module")
def built(spark, dump, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    return out, build(spark, dump, out, dump_version="20260101-000000")


@pytest.fixture(scope="module")
def expected(spark):
    catalogue = Catalogue(catalogue_tables(spark, SF), Stage(spark))
    return catalogue.stage.save_all(catalogue.outputs())


def test_build_writes_all_tables(built, expected):
    _, report = built
    assert set(report.outputs) == set(TARGETS)
    for name, df in expected.items():
        written = report.outputs[name].drop("dump_version", "id").select(*df.columns)
        assert rows_of(written) == rows_of(df), name


def test_written_tables_have_the_declared_columns(spark, built):
    out, report = built
    for name, target in TARGETS.items():
        fields = [(f.name, f.dataType.simpleString()) for f in target.schema.fields]
        assert report.outputs[name].drop("dump_version").dtypes == fields
        assert read_versions(spark, out, name).first().dump_version == "20260101-000000"


def test_a_failing_check_leaves_the_old_tables(spark, dump, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    old = build(spark, dump, out).outputs["recording"].count()

    def broken(outputs):
        raise ValueError("broken")

    monkeypatch.setattr("cratewise.plans.build.assert_integrity", broken)
    with pytest.raises(ValueError, match="broken"):
        build(spark, dump, out)
    assert read_target(spark, out, "recording").count() == old


def test_text_lookup_files_are_sorted_ranges(spark, built):
    _, report = built
    rows = report.outputs["text_lookup"].select("id", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("at"))
    files = {}
    for row in rows.orderBy("at").collect():
        files.setdefault(row.f, []).append(row.id)
    assert all(ids == list(range(ids[0], ids[0] + len(ids))) for ids in files.values())


def test_surrogate_ids_are_dense_and_follow_the_layout(built):
    _, report = built
    rows = report.outputs["text_lookup"].orderBy("id").collect()
    assert [r.id for r in rows] == list(range(1, len(rows) + 1))
    keys = [tuple(r[c] for c in TARGETS["text_lookup"].layout) for r in rows]
    assert keys == sorted(keys, key=lambda k: [t.encode() for t in k])


def test_surrogate_ids_over_many_tasks(spark):
    rows = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 37 % 5000).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = with_surrogate_id(rows, ("k",), Stage(spark))
        assert numbered.filter("id != k + 1").count() == 0
        assert numbered.count() == 5000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_audit_counts_loaded_rows(spark, built):
    counts = {r.table_name: r.row_count for r in built[1].audit.collect()}
    assert counts == {n: df.count() for n, df in catalogue_tables(spark, SF).items()}


def test_salted_build_gives_the_same_tables(spark, expected):
    catalogue = Catalogue(catalogue_tables(spark, SF), Stage(spark), rows_per_salt=3)
    for name, df in catalogue.stage.save_all(catalogue.outputs()).items():
        assert rows_of(df) == rows_of(expected[name]), name


def test_integrity_of_the_build(built):
    outputs = built[1].outputs
    assert checks.pk_violations(outputs).filter("violations > 0").isEmpty()
    assert checks.not_null_violations(outputs).filter("violations > 0").isEmpty()
    by_design = {"recording_artists.recording_mbid", "text_lookup.recording_mbid", "link_lookup.recording_mbid"}
    broken = {r.rule.split(" in ")[0] for r in checks.orphans(outputs).filter("orphan_rows > 0").collect()}
    assert broken <= by_design
    per_recording = checks.lookup_cardinality(outputs)
    assert per_recording.filter("texts < 1").isEmpty()


def test_violations_are_found(spark, built):
    outputs = dict(built[1].outputs)
    groups = outputs["release_group"].drop("dump_version")
    twice = groups.unionByName(groups.limit(1)).withColumn(
        "release_group_title", F.lit(None).cast("string")
    )
    outputs["release_group"] = twice
    found = {r.table_name: r.violations for r in checks.pk_violations(outputs).collect()}
    assert found["release_group"] == 1 and found["recording"] == 0
    nulls = checks.not_null_violations(outputs).filter("violations > 0").collect()
    assert [(r.table_name, r.column_name, r.violations) for r in nulls] == [
        ("release_group", "release_group_title", twice.count())
    ]
    with pytest.raises(ValueError, match="release_group"):
        assert_integrity(outputs)
    outputs["artists"] = outputs["artists"].limit(0)
    broken = {r.rule: r for r in checks.orphans(outputs).collect()}
    rule = broken["recording.primary_artist_mbid in artists"]
    assert rule.orphan_rows >= rule.orphan_keys > 0


def test_sample_dump_is_closed_and_keeps_lines(spark, dump, tmp_path):
    out = str(tmp_path / "sample")
    stats = {r.key_set: r.key_count for r in sample_dump(spark, dump, out, n_releases=20).collect()}
    assert stats["releases"] == 20
    manifest = catalogue_manifest()
    whole, part = load_all(spark, dump, manifest), load_all(spark, out, manifest)
    for name in manifest:
        assert part[name].exceptAll(whole[name]).isEmpty(), name
    assert part["rg_type"].count() == whole["rg_type"].count()
    assert part["recording"].count() == stats["recordings"]
    assert part["url"].count() == stats["urls"]
    references = [
        ("medium", "release", "release", "id"),
        ("track", "medium", "medium", "id"),
        ("track", "recording", "recording", "id"),
        ("artist_credit_name", "artist", "artist", "id"),
        ("l_recording_url", "entity0", "recording", "id"),
        ("l_recording_url", "entity1", "url", "id"),
        ("l_artist_url", "entity0", "artist", "id"),
        ("l_artist_url", "entity1", "url", "id"),
        ("recording", "artist_credit", "artist_credit_name", "artist_credit"),
        ("release_country", "release", "release", "id"),
    ]
    for child, column, parent, key in references:
        missing = part[child].join(part[parent], part[child][column] == part[parent][key], "left_anti")
        assert missing.isEmpty(), (child, column)
    lines = {line for file in _files(dump, "recording") for line in file.read_bytes().splitlines()}
    kept = [line for file in _files(out, "recording") for line in file.read_bytes().splitlines()]
    assert kept and set(kept) <= lines


def _files(folder, table):
    from pathlib import Path

    return sorted(Path(folder, table).glob("part-*"))


def test_sample_of_a_sample_builds(spark, dump, tmp_path):
    sample_dump(spark, dump, str(tmp_path / "sample"), n_releases=400)
    report = build(spark, str(tmp_path / "sample"), str(tmp_path / "out"))
    assert report.outputs["recording"].count() > 0
    layout = list((tmp_path / "out" / "data").glob("*/link_lookup/provider=*"))
    assert layout and all(p.name.split("=")[1] in {"spotify", "applemusic", "tidal"} for p in layout)
