from __future__ import annotations

import bz2

import pytest
from pyspark.sql import types as T

from cratewise.sources.manifest import Column, TableSpec, catalogue_manifest
from cratewise.sources.tsv import load_all, load_audit, scan_tsv, with_dump_version, write_tsv


@pytest.fixture
def spec(spark):
    return TableSpec.from_ddl("t", "id INT, name STRING, n INT, flag BOOLEAN", keep=["id", "name", "n"])


def scan(spark, tmp_path, spec, text, **options):
    path = tmp_path / "t"
    path.write_text(text, encoding="utf-8", newline="")
    return [tuple(r) for r in scan_tsv(spark, str(path), spec, **options).collect()]


def test_dialect(spark, tmp_path, spec):
    text = (
        "1\t\\N\t\\N\tt\n"  # NULL text and number
        "2\t\t7\tf\n"  # the empty text is not NULL
        "3\tshort\n"
        "4\tx\t5\tt\textra\n"
        '5\t"q\t1\tt\n'
        "6\ta\\tb\\\\\t1\tt\n"  # escapes stay as they are
        "\n"
        "7\tpruned\t1\tnot a flag\n"
    )
    assert scan(spark, tmp_path, spec, text) == [
        (1, None, None),
        (2, "", 7),
        (3, "short", None),
        (4, "x", 5),
        (5, '"q', 1),
        (6, "a\\tb\\\\", 1),
        (7, "pruned", 1),
    ]


def test_bad_value_in_kept_column_fails(spark, tmp_path, spec):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        scan(spark, tmp_path, spec, "1\tx\tmany\tt\n")


def test_keep_override_and_raw_line(spark, tmp_path, spec):
    rows = scan(spark, tmp_path, spec, "1\tx\t2\tt\n", keep=["flag", "id"], raw_line="line")
    assert rows == [(True, 1, "1\tx\t2\tt")]


@pytest.mark.parametrize("positions", [(0, 2), (0, 0), (1, 2)])
def test_positions_must_be_contiguous(positions):
    columns = tuple(Column(f"c{i}", T.StringType(), p) for i, p in enumerate(positions))
    with pytest.raises(ValueError, match="0..n-1"):
        TableSpec("t", "t", columns, ())


def test_kept_columns_must_be_declared(spark):
    with pytest.raises(ValueError, match="undeclared"):
        TableSpec.from_ddl("t", "id INT", keep=["gid"])


def test_manifest_matches_the_dump(spark):
    manifest = catalogue_manifest()
    widths = {name: len(spec.columns) for name, spec in manifest.items()}
    assert widths == {
        "artist": 19,
        "artist_credit_name": 5,
        "recording": 9,
        "track": 12,
        "medium": 9,
        "release": 14,
        "release_group": 8,
        "release_country": 5,
        "release_unknown_country": 4,
        "url": 5,
        "l_recording_url": 7,
        "l_artist_url": 7,
        "rg_type": 6,
    }
    assert manifest["release"].column("status").position == 5
    assert manifest["track"].column("medium").position == 3


def test_load_all_with_missing_file_and_round_trip(spark, tmp_path):
    manifest = catalogue_manifest()
    rows = spark.createDataFrame([(1, "g", 'a "b"'), (2, "h", None)], "id int, gid string, name string")
    write_tsv(rows, str(tmp_path / "artist"), manifest["artist"])
    others = [name for name in manifest if name != "artist"]
    with pytest.raises(FileNotFoundError, match="l_artist_url"):
        load_all(spark, str(tmp_path), manifest)
    tables = load_all(spark, str(tmp_path), manifest, absent=others)
    assert sorted(map(tuple, tables["artist"].collect())) == [(1, "g", 'a "b"'), (2, "h", None)]
    assert tables["url"].dtypes == [("id", "int"), ("url", "string")]
    counts = {r.table_name: r.row_count for r in load_audit(tables).collect()}
    assert counts == {name: 2 if name == "artist" else 0 for name in manifest}


def test_compressed_files_are_found(spark, tmp_path):
    manifest = catalogue_manifest()
    (tmp_path / "url.bz2").write_bytes(bz2.compress(b"7\tx\thttp://a.example\n"))
    others = [name for name in manifest if name != "url"]
    assert load_all(spark, str(tmp_path), manifest, absent=others)["url"].first().id == 7


def test_bad_values_fail_without_ansi(spark, tmp_path, spec):
    (tmp_path / "t").write_text("x1\tx\t2\tt\n")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="is no"):
            scan_tsv(spark, str(tmp_path / "t"), spec, keep=["id"]).collect()
        kept = [c.name for c in spec.columns if c.name != "id" and str(c.dtype).lower() in ("string", "stringtype()")][:1]
        assert scan_tsv(spark, str(tmp_path / "t"), spec, keep=kept).count() == 1
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_dump_version(spark):
    assert with_dump_version(spark.range(1), "v1").first().dump_version == "v1"


def test_scan_reads_only_kept_columns(spark, tmp_path, spec, capsys):
    (tmp_path / "t").write_text("1\tx\t2\tt\n")
    scan_tsv(spark, str(tmp_path / "t"), spec, keep=["id"]).explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan
    assert plan.count("split(") <= 2  # the line is split once, not per column
