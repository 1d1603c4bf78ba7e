"""The full build: dump in, seven lookup and dimension tables out."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.operators import canonical, checks, dimensions, lookups
from cratewise.operators.skew import ROWS_PER_SALT, HotKeys
from cratewise.sources.manifest import TableSpec, catalogue_manifest
from cratewise.sources.sinks import TARGETS, laid_out, read_written, with_surrogate_id, write_target
from cratewise.sources.snapshots import SnapshotStore
from cratewise.sources.stage import Stage, run_together
from cratewise.sources.tsv import load_all, load_audit, with_dump_version


# The elected rank, which is stored with the outputs but is none of them.
RANK = "_rank"


@dataclass
class Catalogue:
    """Shared intermediates and outputs over one set of catalogue tables.

    The four frames that several outputs read are staged on first use: normalised recordings, tracks on
    official releases, rank and cluster members. Everything else stays lazy.
    """

    tables: Mapping[str, DataFrame]
    stage: Stage
    rows_per_salt: int = ROWS_PER_SALT

    @cached_property
    def recordings(self) -> DataFrame:
        return self.stage.save(
            "recordings", canonical.normalize_recordings(self.tables["recording"])
        )

    @cached_property
    def dates(self) -> DataFrame:
        return canonical.earliest_dates(
            self.tables["release_country"], self.tables["release_unknown_country"]
        )

    @cached_property
    def hot(self) -> HotKeys:
        """Hot keys of every fact column, counted in one job over narrow projections."""
        t = self.tables
        return HotKeys.find(
            {
                **canonical.track_keys(t["track"], t["medium"], t["release"]),
                **canonical.cluster_keys(self.recordings),
                **dimensions.credit_keys(self.recordings, t["artist_credit_name"]),
                "release_group.artist_credit": t["release_group"].select("artist_credit"),
                **dimensions.credit_row_keys(t["artist_credit_name"]),
                **dimensions.artist_link_keys(t["l_artist_url"]),
                **lookups.recording_link_keys(t["l_recording_url"]),
            },
            self.rows_per_salt,
        )

    @cached_property
    def placed(self) -> DataFrame:
        """Tracks on official releases, stored by their recording for the election and the text lookup."""
        t = self.tables
        groups = canonical.typed_release_groups(t["release_group"], t["rg_type"])
        rows = canonical.placed_tracks(
            t["track"],
            t["medium"],
            t["release"],
            self.dates,
            groups.drop(*canonical.TITLE_COLUMNS),
            self.hot,
        )
        rows = rows.withColumn("recording", F.col("recording").cast(self.recordings.schema["id"].dataType))
        placed, keys = self.hot.place("track.recording", rows, "recording", spread=canonical.PLACED_SPREAD)
        return self.stage.save_bucketed("placed", placed, keys)

    @cached_property
    def rank(self) -> DataFrame:
        return self.stage.save("rank", canonical.elect_placed(self.recordings, self.placed, self.hot))

    @cached_property
    def members(self) -> DataFrame:
        return self.stage.save(
            "members",
            canonical.cluster_members(self.recordings, self.rank, self.hot),
        )

    @cached_property
    def wikidata(self) -> DataFrame:
        t = self.tables
        return dimensions.artist_wikidata(t["l_artist_url"], t["url"], self.hot)

    @property
    def _credit_tables(self) -> tuple[DataFrame, DataFrame]:
        return self.tables["artist_credit_name"], self.tables["artist"]

    def release_group(self) -> DataFrame:
        return dimensions.dim_release_group(
            self.rank, self.tables["release_group"], self.tables["rg_type"]
        )

    def recording(self) -> DataFrame:
        return dimensions.dim_recording(self.rank, *self._credit_tables, self.hot)

    def artists(self) -> DataFrame:
        return dimensions.dim_artist(self.rank, *self._credit_tables, self.wikidata, self.hot)

    def recording_artists(self) -> DataFrame:
        return dimensions.recording_credits(self.rank, *self._credit_tables, self.hot)

    def release_group_artists(self) -> DataFrame:
        return dimensions.release_group_credits(self.rank, *self._credit_tables, self.hot)

    def text_lookup(self) -> DataFrame:
        return lookups.text_lookup(self.members, self.placed, *self._credit_tables, self.hot)

    def link_lookup(self) -> DataFrame:
        return lookups.link_lookup(
            self.members, self.tables["url"], self.tables["l_recording_url"], self.hot
        )

    def outputs(self) -> dict[str, DataFrame]:
        """All seven tables, the text lookup still without its surrogate id."""
        return {name: getattr(self, name)() for name in TARGETS}


def ingest(
    spark: SparkSession,
    input_dir: str,
    stage: Stage,
    manifest: Mapping[str, TableSpec] | None = None,
) -> dict[str, DataFrame]:
    """The kept columns of every dump table, parsed once and staged as Parquet."""
    raw = load_all(spark, input_dir, manifest or catalogue_manifest())
    staged = stage.save_all({f"raw_{name}": df for name, df in raw.items()})
    return dict(zip(raw, staged.values()))


@dataclass(frozen=True)
class BuildReport:
    outputs: dict[str, DataFrame]
    audit: DataFrame


def build(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    dump_version: str | None = None,
    compression: str = "zstd",
    check: bool = True,
    rows_per_salt: int = ROWS_PER_SALT,
    keep_snapshots: int = 2,
) -> BuildReport:
    """Run the whole job and return the written tables with the row counts of the loaded ones.

    The tables are written to a new folder and checked there; then one commit makes all seven of them
    current at once (:mod:`cratewise.sources.snapshots`). With a ``dump_version`` they become that version,
    which lives beside the others, and the returned tables carry the tag as a column. ``check`` fails
    the job on a duplicate key or a missing required value, as declared constraints would. Sets that were
    replaced more than ``keep_snapshots - 1`` commits ago are removed; until then readers may finish.
    """
    stage = Stage(spark)
    tables = ingest(spark, input_dir, stage)
    catalogue = Catalogue(tables, stage, rows_per_salt)
    written = publish(
        spark, catalogue.outputs(), catalogue.rank, stage, output_dir, dump_version, compression, check, keep_snapshots
    )
    return BuildReport(written, load_audit(tables))


def publish(
    spark: SparkSession,
    outputs: Mapping[str, DataFrame],
    rank: DataFrame,
    stage: Stage,
    output_dir: str,
    dump_version: str | None,
    compression: str,
    check: bool,
    keep_snapshots: int,
) -> dict[str, DataFrame]:
    """Write, check and commit the outputs, and the rank beside them for the next delta build."""
    store = SnapshotStore(spark, output_dir)
    fresh = store.new_folder()

    def write(output: tuple[str, DataFrame]) -> None:
        name, df = output
        if name == RANK:
            df.write.option("compression", compression).parquet(f"{fresh}/{name}")
            return
        target = TARGETS[name]
        if name == "text_lookup":
            # Ids follow the layout order, so ranges of ids are ranges of the layout.
            df = laid_out(with_surrogate_id(df, target.layout, stage), "id")
        write_target(df, f"{fresh}/{name}", target, compression, sort=name != "text_lookup")

    tables = {**outputs, RANK: rank}
    try:
        run_together(write, tables.items())
        written = {name: read_written(spark, f"{fresh}/{name}", name) for name in outputs}
        if check:
            assert_integrity(written)
    except Exception:
        store.discard(fresh)
        raise
    store.commit(fresh, tables, dump_version)
    store.expire(keep_snapshots)
    if dump_version:
        written = {name: with_dump_version(df, dump_version) for name, df in written.items()}
    return written


def assert_integrity(outputs: Mapping[str, DataFrame]) -> None:
    """Raise when a primary key repeats or a required column is NULL."""
    # Both reports hold one row for each declared key or column.
    broken = checks.pk_violations(outputs).filter("violations > 0").collect()
    broken += checks.not_null_violations(outputs).filter("violations > 0").collect()
    if broken:
        raise ValueError(f"output tables break their constraints: {broken}")
