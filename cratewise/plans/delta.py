"""Delta build: the outputs of a new dump from those of the old one and what changed between the dumps.

The kept columns of both versions, which are few and narrow, are shuffled once to compare them. A changed row reaches the recordings whose
cluster, titles, links or credits it may touch, and those reach their clusters. Only these clusters are
elected again, from tables that are cut down to what they refer to; the rows of all other clusters are
taken over. The three tables that hold one row for each elected group or credited artist are not tied to
one cluster: they are made anew from the whole rank, which is narrow and far smaller than the tracks.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.operators import dimensions
from cratewise.operators.canonical import CLUSTER_KEY, normalize_recordings
from cratewise.operators.skew import ROWS_PER_SALT
from cratewise.plans.build import RANK, BuildReport, Catalogue, ingest, publish
from cratewise.sources.sinks import read_targets
from cratewise.sources.snapshots import SnapshotStore
from cratewise.sources.stage import Stage
from cratewise.sources.tsv import load_audit

# Outputs whose rows belong to one cluster each, named by its canonical recording.
OF_CLUSTERS = ("recording", "recording_artists", "link_lookup", "text_lookup")


def changed_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """The rows that one of two versions of a table holds more often than the other, of both versions, each once.

    The whole rows are compared, so they are read and shuffled once; NULLs are equal.
    """
    columns = new.columns

    def sides(version: DataFrame, side: int) -> DataFrame:
        return version.select(*columns, F.lit(side).alias("_side"))

    counted = sides(old, -1).unionByName(sides(new, 1)).groupBy(*columns).agg(F.sum("_side").alias("_more"))
    return counted.filter("_more != 0").select(*columns)


def _keys(*columns: DataFrame) -> DataFrame:
    """Distinct non-NULL values of one-column frames, as column ``key``."""
    return reduce(DataFrame.union, [c.toDF("key") for c in columns]).dropna().distinct()


def _among(table: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    return table.join(keys, table[column] == keys["key"], "left_semi")


def _in_clusters(recordings: DataFrame, clusters: DataFrame, how: str = "left_semi") -> DataFrame:
    """Recordings of the clusters; unknown parts of a key are alike."""
    same = [recordings[c].eqNullSafe(clusters[c]) for c in CLUSTER_KEY]
    return recordings.join(clusters, reduce(lambda a, b: a & b, same), how)


@dataclass(frozen=True)
class Reach:
    """What a change reaches: the clusters, and the recordings of both versions in them."""

    clusters: DataFrame
    mbids: DataFrame


def reach(old: Mapping[str, DataFrame], new: Mapping[str, DataFrame], stage: Stage) -> Reach:
    """Follow the changed rows of every table to the clusters whose outputs may differ.

    A reference is looked up among the new rows and the changed ones, which together hold the rows of
    both versions. Each set is staged, since the next ones start from it.
    """
    changed = stage.save_all({f"changed_{name}": changed_rows(old[name], new[name]) for name in new})

    def of(name: str, column: str) -> DataFrame:
        return changed[f"changed_{name}"].select(column)

    def referring(name: str, column: str, keys: DataFrame, wanted: str) -> DataFrame:
        both = new[name].unionByName(changed[f"changed_{name}"])
        return _among(both, column, keys).select(wanted)

    types = _keys(of("rg_type", "id"))
    groups = stage.save(
        "reached_groups", _keys(of("release_group", "id"), referring("release_group", "type", types, "id"))
    )
    releases = stage.save(
        "reached_releases",
        _keys(
            of("release", "id"),
            of("release_country", "release"),
            of("release_unknown_country", "release"),
            referring("release", "release_group", groups, "id"),
        ),
    )
    media = stage.save("reached_media", _keys(of("medium", "id"), referring("medium", "release", releases, "id")))
    credits = stage.save(
        "reached_credits",
        _keys(
            of("artist_credit_name", "artist_credit"),
            referring("artist_credit_name", "artist", _keys(of("artist", "id")), "artist_credit"),
        ),
    )
    recordings = stage.save(
        "reached_recordings",
        _keys(
            of("recording", "id"),
            of("track", "recording"),
            of("l_recording_url", "entity0"),
            referring("track", "medium", media, "recording"),
            referring("l_recording_url", "entity1", _keys(of("url", "id")), "entity0"),
            referring("recording", "artist_credit", credits, "id"),
        ),
    )
    both = normalize_recordings(new["recording"].unionByName(changed["changed_recording"]))
    clusters = stage.save("reached_clusters", _among(both, "id", recordings).select(*CLUSTER_KEY).distinct())
    mbids = stage.save("reached_mbids", _in_clusters(both, clusters).select("gid").dropna().distinct())
    return Reach(clusters, mbids)


def cut_down(tables: Mapping[str, DataFrame], clusters: DataFrame, stage: Stage) -> dict[str, DataFrame]:
    """The tables with what the recordings of some clusters refer to, down to artists and links."""
    t, cut = tables, dict(tables)

    def keep(name: str, column: str, keys: DataFrame) -> DataFrame:
        cut[name] = stage.save(f"cut_{name}", _among(t[name], column, keys))
        return cut[name]

    own = _keys(_in_clusters(normalize_recordings(t["recording"]), clusters).select("id"))
    own = stage.save("cut_ids", own)
    recordings = keep("recording", "id", own)
    tracks = keep("track", "recording", own)
    media = keep("medium", "id", _keys(tracks.select("medium")))
    releases = keep("release", "id", _keys(media.select("release")))
    of_release = _keys(releases.select("id"))
    keep("release_country", "release", of_release)
    keep("release_unknown_country", "release", of_release)
    keep("release_group", "id", _keys(releases.select("release_group")))
    names = keep("artist_credit_name", "artist_credit", _keys(recordings.select("artist_credit")))
    keep("artist", "id", _keys(names.select("artist")))
    links = keep("l_recording_url", "entity0", own)
    keep("url", "id", _keys(links.select("entity1")))
    return cut


def delta_outputs(
    old: Mapping[str, DataFrame],
    new: Mapping[str, DataFrame],
    old_outputs: Mapping[str, DataFrame],
    old_rank: DataFrame,
    stage: Stage,
    rows_per_salt: int = ROWS_PER_SALT,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Outputs and rank of the new tables, the text lookup without its surrogate id.

    ``old_outputs`` and ``old_rank`` must be those of the old tables. The results are those of a whole build.
    """
    found = reach(old, new, stage)
    part = Catalogue(cut_down(new, found.clusters, stage), stage, rows_per_salt)
    names = ["normalized_rec_name", *CLUSTER_KEY[1:]]
    same = [old_rank[a].eqNullSafe(found.clusters[b]) for a, b in zip(names, CLUSTER_KEY)]
    untouched = old_rank.join(found.clusters, reduce(lambda a, b: a & b, same), "left_anti")
    rank = stage.save("delta_rank", untouched.unionByName(part.rank))

    outputs = {}
    for name in OF_CLUSTERS:
        made = getattr(part, name)()
        kept = old_outputs[name].select(*made.columns)
        kept = kept.join(found.mbids, kept["recording_mbid"] == found.mbids["gid"], "left_anti")
        outputs[name] = kept.unionByName(made)
    credits = new["artist_credit_name"], new["artist"]
    wikidata = dimensions.artist_wikidata(new["l_artist_url"], new["url"])
    outputs["release_group"] = dimensions.dim_release_group(rank, new["release_group"], new["rg_type"])
    outputs["artists"] = dimensions.dim_artist(rank, *credits, wikidata)
    outputs["release_group_artists"] = dimensions.release_group_credits(rank, *credits)
    return outputs, rank


def update(
    spark: SparkSession,
    old_dump: str,
    new_dump: str,
    output_dir: str,
    old_version: str | None = None,
    new_version: str | None = None,
    compression: str = "zstd",
    check: bool = True,
    rows_per_salt: int = ROWS_PER_SALT,
    keep_snapshots: int = 2,
) -> BuildReport:
    """The tables of ``new_dump`` from those that ``output_dir`` holds for ``old_dump``, committed as
    :func:`cratewise.plans.build.build` does."""
    stage = Stage(spark)
    store = SnapshotStore(spark, output_dir)
    snapshot = store.latest()
    old_rank = spark.read.parquet(store.table_path(snapshot, RANK, old_version))
    old_outputs = read_targets(spark, output_dir, dump_version=old_version)
    old = ingest(spark, old_dump, Stage(spark))
    new = ingest(spark, new_dump, stage)
    outputs, rank = delta_outputs(old, new, old_outputs, old_rank, stage, rows_per_salt)
    written = publish(spark, outputs, rank, stage, output_dir, new_version, compression, check, keep_snapshots)
    return BuildReport(written, load_audit(new))
