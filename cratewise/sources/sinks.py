"""Target tables: declared schemas, lookup-friendly layout, Parquet writers."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cratewise.sources.snapshots import SnapshotStore
from cratewise.sources.stage import Stage


@dataclass(frozen=True)
class Target:
    """Schema, primary key and sort order of one output table."""

    schema: T.StructType
    key: tuple[str, ...] = ()
    layout: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(*f) for f in fields])


_TEXT, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()

TARGETS = {
    "release_group": Target(
        _schema(
            ("release_group_mbid", _TEXT, True),
            ("release_group_title", _TEXT, False),
            ("release_group_type", _TEXT, True),
        ),
        key=("release_group_mbid",),
        layout=("release_group_mbid",),
    ),
    "recording": Target(
        _schema(
            ("recording_mbid", _TEXT, True),
            ("release_group_mbid", _TEXT, False),
            ("length", _INT, True),
            ("primary_artist_mbid", _TEXT, True),
        ),
        key=("recording_mbid",),
        layout=("recording_mbid",),
    ),
    "artists": Target(
        _schema(
            ("artist_mbid", _TEXT, True),
            ("artist_name", _TEXT, False),
            ("artist_wikidata_id", _TEXT, True),
        ),
        key=("artist_mbid",),
        layout=("artist_mbid",),
    ),
    "recording_artists": Target(
        _schema(
            ("recording_mbid", _TEXT, False),
            ("artist_mbid", _TEXT, False),
            ("position", _INT, False),
        ),
        layout=("recording_mbid", "position", "artist_mbid"),
    ),
    "release_group_artists": Target(
        _schema(
            ("release_group_mbid", _TEXT, False),
            ("artist_mbid", _TEXT, False),
            ("position", _INT, False),
        ),
        layout=("release_group_mbid", "position", "artist_mbid"),
    ),
    "link_lookup": Target(
        _schema(
            ("url_identifier", _TEXT, False),
            ("provider", _TEXT, False),
            ("recording_mbid", _TEXT, False),
        ),
        key=("provider", "url_identifier", "recording_mbid"),
        layout=("provider", "url_identifier", "recording_mbid"),
        partition_by=("provider",),
    ),
    "text_lookup": Target(
        _schema(
            ("id", _LONG, False),
            ("track_title", _TEXT, False),
            ("release_title", _TEXT, False),
            ("artist_name", _TEXT, False),
            ("recording_mbid", _TEXT, False),
        ),
        key=("id",),
        layout=("track_title", "artist_name", "release_title", "recording_mbid"),
    ),
}


def conform(df: DataFrame, target: Target) -> DataFrame:
    """The declared columns in the declared order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in target.schema.fields])


def laid_out(df: DataFrame, *keys: str) -> DataFrame:
    """Range-partitioned and sorted by ``keys``, so that file statistics prune key lookups.

    The keys reach down to the last column of a table's identity: one frequent leading value, such as
    a common title, is cut across tasks instead of filling one.
    """
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def with_surrogate_id(df: DataFrame, keys: tuple[str, ...], stage: Stage) -> DataFrame:
    """Dense ids 1..n in the order of ``keys``, which must identify the rows.

    The sorted rows are staged with their position inside the task, then shifted by the rows of the
    tasks before. Only the per-task counts, one row for each, meet in a single window.
    """
    numbered = laid_out(df, *keys).withColumn("_mark", F.monotonically_increasing_id())
    staged = stage.save("numbered", numbered)
    # The mark holds the task number above bit 33 and the row number below it.
    task = F.shiftright("_mark", 33)
    row = F.col("_mark").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy(task.alias("_task"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # One offset for each task of the staged write bounds the broadcast.
    placed = staged.withColumn("_task", task).join(F.broadcast(offsets), "_task")
    ids = (F.col("_offset") + row + 1).alias("id")
    return placed.select(ids, *df.columns)


def write_target(
    df: DataFrame,
    path: str,
    target: Target,
    compression: str = "zstd",
    sort: bool = True,
) -> None:
    """Write one output table; ``sort=False`` when the rows already come in layout order."""
    shaped = conform(df, target)
    if sort and target.layout:
        shaped = laid_out(shaped, *target.layout)
    writer = shaped.write.mode("overwrite").option("compression", compression)
    if target.partition_by:
        writer = writer.partitionBy(*target.partition_by)
    writer.parquet(path)


def read_written(spark: SparkSession, path: str, name: str) -> DataFrame:
    """An output table from its own folder, in declared order."""
    schema = TARGETS[name].schema
    # Reading puts partition columns last.
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_targets(
    spark: SparkSession, folder: str, names: Iterable[str] = tuple(TARGETS), dump_version: str | None = None
) -> dict[str, DataFrame]:
    """Output tables of one snapshot: the current one, or the current one of ``dump_version``."""
    store = SnapshotStore(spark, folder)
    snapshot = store.latest()
    return {name: read_written(spark, store.table_path(snapshot, name, dump_version), name) for name in names}


def read_target(spark: SparkSession, folder: str, name: str, dump_version: str | None = None) -> DataFrame:
    """One output table; tables that belong together are read by one call of :func:`read_targets`."""
    return read_targets(spark, folder, [name], dump_version)[name]


def read_versions(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """All tagged versions of an output table side by side, with the tag as a column."""
    store = SnapshotStore(spark, folder)
    snapshot = store.latest()
    tags = sorted(tag for tag in snapshot.versions if tag) if snapshot else []
    if not tags:
        raise FileNotFoundError(f"{folder} has no tagged version of {name}")
    tagged = [
        read_written(spark, store.table_path(snapshot, name, tag), name).withColumn("dump_version", F.lit(tag))
        for tag in tags
    ]
    return reduce(DataFrame.unionByName, tagged)
