"""Listening-history files: JSON arrays of play records, or one record per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The fields of a play record.
HISTORY_SCHEMA = (
    "ts STRING, platform STRING, ms_played BIGINT, conn_country STRING, ip_addr STRING, "
    "master_metadata_track_name STRING, master_metadata_album_artist_name STRING, "
    "master_metadata_album_album_name STRING, spotify_track_uri STRING, episode_name STRING, "
    "episode_show_name STRING, spotify_episode_uri STRING, audiobook_title STRING, "
    "audiobook_uri STRING, audiobook_chapter_uri STRING, audiobook_chapter_title STRING, "
    "reason_start STRING, reason_end STRING, shuffle BOOLEAN, skipped BOOLEAN, offline BOOLEAN, "
    "offline_timestamp BIGINT, incognito_mode BOOLEAN"
)


def read_history(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Play records of one file or a folder of files.

    An array spans lines, so its file is one task. ``lines`` reads one record per line; such files split.
    A damaged record or a value of another type fails the job, so that no play vanishes.
    """
    return spark.read.schema(HISTORY_SCHEMA).options(multiLine=not lines, mode="FAILFAST").json(path)


def stream_history(spark: SparkSession, folder: str) -> DataFrame:
    """The same records as a stream of the files that arrive in a folder."""
    return spark.readStream.schema(HISTORY_SCHEMA).options(multiLine=True, mode="FAILFAST").json(folder)
