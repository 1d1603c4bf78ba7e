"""Integrity rules of the output tables, as queries that report violations."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.sources.sinks import TARGETS


def _count(name: str = "violations"):
    return F.count(F.lit(1)).alias(name)


def _refuse_missing(outputs: Mapping[str, DataFrame], wanted: Mapping[str, Sequence[str]]) -> None:
    missing = [f"{n}.{c}" for n, columns in wanted.items() for c in columns if c not in outputs[n].columns]
    if missing:
        raise ValueError(f"columns to check are missing: {missing}")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*key).agg(_count("row_count")).filter("row_count > 1")


def pk_violations(outputs: Mapping[str, DataFrame], absent: Collection[str] = ()) -> DataFrame:
    """``(table_name, violations)``: keys that are not unique, for every table that has a key.

    A table without its key columns raises, unless ``absent`` names the table.
    """
    _refuse_missing(outputs, {n: t.key for n, t in TARGETS.items() if n not in absent})
    reports = [
        duplicate_keys(outputs[name], target.key)
        .agg(_count())
        .select(F.lit(name).alias("table_name"), "violations")
        for name, target in TARGETS.items()
        if target.key and name not in absent
    ]
    return reduce(DataFrame.unionByName, reports)


def not_null_violations(outputs: Mapping[str, DataFrame], absent: Collection[str] = ()) -> DataFrame:
    """``(table_name, column_name, violations)`` of every required column, one pass per table.

    A missing column raises, unless ``absent`` names it as ``table.column``.
    """
    wanted = {n: [c for c in t.required if f"{n}.{c}" not in absent] for n, t in TARGETS.items()}
    _refuse_missing(outputs, wanted)
    reports = []
    for name, columns in wanted.items():
        counts = outputs[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        reports.append(
            counts.unpivot([], columns, "column_name", "violations").select(
                F.lit(name).alias("table_name"), "column_name", "violations"
            )
        )
    return reduce(DataFrame.unionByName, reports)


def _orphans(
    rule: str, child: DataFrame, column: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Rows of ``child`` whose reference is missing, counted per distinct value before the join."""
    references = child.groupBy(F.col(column).alias("_ref")).agg(_count("row_count"))
    known = parent.select(F.col(parent_key).alias("_ref"))
    missing = references.filter(F.col("_ref").isNotNull()).join(known, "_ref", "left_anti")
    return missing.agg(
        _count("orphan_keys"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_rows")
    ).select(F.lit(rule).alias("rule"), "orphan_keys", "orphan_rows")


def orphans(outputs: Mapping[str, DataFrame]) -> DataFrame:
    """``(rule, orphan_keys, orphan_rows)`` of every reference between output tables.

    Orphans of the lookups and of the recording credits are by design: recordings whose winner has no
    release group are left out of ``recording`` only.
    """
    # (child table, column, parent table, key)
    references = [
        ("recording", "primary_artist_mbid", "artists", "artist_mbid"),
        ("recording", "release_group_mbid", "release_group", "release_group_mbid"),
        ("recording_artists", "artist_mbid", "artists", "artist_mbid"),
        ("release_group_artists", "artist_mbid", "artists", "artist_mbid"),
        ("recording_artists", "recording_mbid", "recording", "recording_mbid"),
        ("release_group_artists", "release_group_mbid", "release_group", "release_group_mbid"),
        ("text_lookup", "recording_mbid", "recording", "recording_mbid"),
        ("link_lookup", "recording_mbid", "recording", "recording_mbid"),
        ("release_group", "release_group_mbid", "recording", "release_group_mbid"),
    ]
    reports = []
    for child, column, parent, key in references:
        rule = f"{child}.{column} in {parent}"
        reports.append(_orphans(rule, outputs[child], column, outputs[parent], key))
    return reduce(DataFrame.unionByName, reports)


def lookup_cardinality(outputs: Mapping[str, DataFrame]) -> DataFrame:
    """Per recording, its number of link rows (0 to n) and of text rows (1 to n)."""

    def per_recording(name: str, alias: str) -> DataFrame:
        return outputs[name].groupBy("recording_mbid").agg(_count(alias))

    return (
        outputs["recording"]
        .select("recording_mbid")
        .join(per_recording("link_lookup", "links"), "recording_mbid", "left")
        .join(per_recording("text_lookup", "texts"), "recording_mbid", "left")
        .select(
            "recording_mbid",
            F.coalesce("links", F.lit(0)).alias("links"),
            F.coalesce("texts", F.lit(0)).alias("texts"),
        )
    )


def stored_layout(outputs: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, folder, codec, row_count)`` of written tables: their partition folders, empty where
    they have none, and the codec, both as Spark names its files."""
    parts = [
        df.select(
            F.lit(name).alias("table_name"),
            F.regexp_extract(F.input_file_name(), r"/([^/]+=[^/]+)/[^/]+$", 1).alias("folder"),
            F.regexp_extract(F.input_file_name(), r"\.([a-z0-9]+)\.parquet$", 1).alias("codec"),
        )
        for name, df in outputs.items()
    ]
    return reduce(DataFrame.unionByName, parts).groupBy("table_name", "folder", "codec").agg(
        F.count(F.lit(1)).alias("row_count")
    )
