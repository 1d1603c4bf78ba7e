"""Election of one release group per cluster of recordings, and its way back to every recording.

Frames are catalogue-shaped: the kept columns of :mod:`cratewise.sources.manifest`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cratewise.functions import (
    UNKNOWN_DATE,
    credit_bonus,
    length_bucket,
    norm,
    repair_date,
    type_score,
)
from cratewise.operators.skew import HotKeys

OFFICIAL = 1

CLUSTER_KEY = ["normalized_name", "artist_credit", "length_bucket"]

SCORED_COLUMNS = [
    "recording_mbid",
    "raw_length",
    "release_group_mbid",
    "release_group_title",
    "release_group_type",
    "release_group_artist_credit",
    "normalized_rec_name",
    "artist_credit",
    "length_bucket",
    "evaluation_score",
    "normalized_release_date",
]

TITLE_COLUMNS = ["release_group_title", "release_group_type"]

RANK_COLUMNS = [
    "normalized_rec_name",
    "artist_credit",
    "length_bucket",
    "canonical_recording_mbid",
    "release_group_mbid",
    "release_group_title",
    "release_group_type",
    "release_group_artist_credit",
    "length",
]


def normalize_recordings(recording: DataFrame) -> DataFrame:
    """Recordings with the two computed parts of the cluster key."""
    return recording.select(
        "id",
        "gid",
        "artist_credit",
        "length",
        norm("name").alias("normalized_name"),
        length_bucket("length").alias("length_bucket"),
    )


def official_releases(release: DataFrame) -> DataFrame:
    """Official releases only; an unknown status is not official."""
    return release.filter(F.col("status") == OFFICIAL).select(
        "id", "release_group", "artist_credit"
    )


def release_names(release: DataFrame) -> DataFrame:
    return release.select("id", "name")


def official_release_names(release: DataFrame) -> DataFrame:
    """:func:`release_names` of :func:`official_releases`, in one pass instead of a self-join."""
    return release.filter(F.col("status") == OFFICIAL).select("id", "name")


def earliest_dates(release_country: DataFrame, release_unknown_country: DataFrame) -> DataFrame:
    """Earliest repaired date of every release that has any date row."""
    parts = ["release", "date_year", "date_month", "date_day"]
    events = release_country.select(*parts).unionByName(release_unknown_country.select(*parts))
    repaired = repair_date(F.col("date_year"), F.col("date_month"), F.col("date_day"))
    return events.groupBy("release").agg(F.min(repaired).alias("normalized_release_date"))


def typed_release_groups(release_group: DataFrame, rg_type: DataFrame) -> DataFrame:
    """Release groups with the name and the score of their type.

    No hint: whether the dictionary is small enough to broadcast is for Spark's size check to say.
    """
    types = rg_type.select(F.col("id").alias("type"), F.col("name").alias("release_group_type"))
    return release_group.join(types, "type", "left").select(
        F.col("id").alias("release_group"),
        F.col("gid").alias("release_group_mbid"),
        F.col("name").alias("release_group_title"),
        "release_group_type",
        F.col("artist_credit").alias("release_group_artist_credit"),
        type_score("release_group_type").alias("type_score"),
    )


def track_keys(track: DataFrame, medium: DataFrame, release: DataFrame) -> dict[str, DataFrame]:
    """Fact columns of the joins from tracks to release groups, for :meth:`HotKeys.find`."""
    return {
        "medium.release": medium.select("release"),
        "release.release_group": release.select("release_group"),
        "track.medium": track.select("medium"),
        "track.recording": track.select("recording"),
    }


def official_tracks(
    track: DataFrame, medium: DataFrame, releases: DataFrame, hot: HotKeys
) -> DataFrame:
    """Tracks on the given releases: the ``track`` columns but ``medium``, plus those of ``releases``.

    ``releases`` is keyed by ``release``. Media and releases meet first, so that the tracks, the
    largest table, are shuffled once here.
    """
    media = hot.join(
        "medium.release",
        medium.select(F.col("id").alias("medium"), "release"),
        releases,
        "release",
        spread=["medium"],
    )
    rest = [c for c in track.columns if c != "medium"]
    return hot.join("track.medium", track, media, "medium", spread=rest).drop("medium")


def placed_tracks(
    track: DataFrame,
    medium: DataFrame,
    release: DataFrame,
    dates: DataFrame,
    groups: DataFrame,
    hot: HotKeys,
) -> DataFrame:
    """One row per track on an official release, with what the outputs need of both.

    These are the recording, the normalised titles of track and release, the earliest date, and the
    columns of ``groups`` (:func:`typed_release_groups`). Election and text lookup read the same rows, so
    the track table is shuffled once for its medium, and once more for its recording where these rows are
    stored.
    """
    official = release.filter(F.col("status") == OFFICIAL).select(
        F.col("id").alias("release"), "release_group", norm("name").alias("release_title")
    )
    grouped = hot.join(
        "release.release_group", official, groups, "release_group", "left", spread=["release"]
    )
    # Dates come last: media are joined on the release too, and find the rows placed for it.
    dated = grouped.join(dates, "release", "left").drop("release_group")
    tracks = official_tracks(track.select("recording", "medium", "name"), medium, dated, hot)
    return tracks.withColumn("track_title", norm("name")).drop("name")


# Columns that tell the placed tracks of one recording apart.
PLACED_SPREAD = ["release", "track_title"]


def _candidates(recordings: DataFrame, placed: DataFrame, hot: HotKeys) -> DataFrame:
    """One row per track of a recording on an official release, with its score."""
    own = recordings.select(
        F.col("id").alias("recording"),
        F.col("gid").alias("recording_mbid"),
        F.col("length").alias("raw_length"),
        F.col("normalized_name").alias("normalized_rec_name"),
        "artist_credit",
        "length_bucket",
    )
    pairs = hot.join_placed("track.recording", placed.drop("track_title", "release_title"), own, "recording")
    bonus = credit_bonus(F.col("release_group_artist_credit"), F.col("artist_credit"))
    date = F.coalesce("normalized_release_date", F.lit(UNKNOWN_DATE))
    # A release without a release group has no type, and an unknown type scores 0.
    score = F.coalesce("type_score", F.lit(0)) + bonus
    return pairs.withColumns({"evaluation_score": score, "normalized_release_date": date})


def score_candidates(
    recordings: DataFrame,
    track: DataFrame,
    medium: DataFrame,
    release: DataFrame,
    dates: DataFrame,
    release_group: DataFrame,
    rg_type: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Every candidate with its score and date: the input of :func:`canonical_rank`.

    ``recordings`` come from :func:`normalize_recordings`, ``dates`` from :func:`earliest_dates`.
    """
    hot = hot or HotKeys.find(track_keys(track, medium, release))
    groups = typed_release_groups(release_group, rg_type)
    rows = placed_tracks(track, medium, release, dates, groups, hot)
    placed, _ = hot.place("track.recording", rows, "recording", spread=PLACED_SPREAD)
    return _candidates(recordings, placed, hot).select(*SCORED_COLUMNS)


def _best_of_cluster(scored: DataFrame) -> DataFrame:
    """First candidate of every cluster.

    The recording id closes the order, so that a plan that is run twice elects the same rows. Spark
    cuts every task to one row per cluster before the shuffle, hence a hot cluster costs nothing.
    """
    order = Window.partitionBy("normalized_rec_name", "artist_credit", "length_bucket").orderBy(
        F.col("evaluation_score").desc(),
        F.col("normalized_release_date").asc(),
        F.col("release_group_mbid").asc_nulls_last(),
        F.col("recording_mbid").asc_nulls_last(),
    )
    return (
        scored.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")
    )


def canonical_rank(scored: DataFrame) -> DataFrame:
    """Elected release group and recording of every cluster."""
    winners = _best_of_cluster(scored).withColumnsRenamed(
        {"recording_mbid": "canonical_recording_mbid", "raw_length": "length"}
    )
    return winners.select(*[c for c in RANK_COLUMNS if c in winners.columns])


def elect_placed(recordings: DataFrame, placed: DataFrame, hot: HotKeys) -> DataFrame:
    """The columns of ``canonical_rank(score_candidates(...))`` but for title and type.

    ``placed`` holds :func:`placed_tracks` as :meth:`HotKeys.place` wants them for ``track.recording``. Title
    and type follow from the release group, so the outputs fetch them once per elected group.
    """
    slim = [c for c in SCORED_COLUMNS if c not in TITLE_COLUMNS]
    return canonical_rank(_candidates(recordings, placed, hot).select(*slim))


def elect(
    recordings: DataFrame,
    track: DataFrame,
    medium: DataFrame,
    release: DataFrame,
    dates: DataFrame,
    release_group: DataFrame,
    rg_type: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """:func:`elect_placed` from the catalogue tables, without storing the tracks in between."""
    hot = hot or HotKeys.find(track_keys(track, medium, release))
    groups = typed_release_groups(release_group, rg_type).drop(*TITLE_COLUMNS)
    rows = placed_tracks(track, medium, release, dates, groups, hot)
    placed, _ = hot.place("track.recording", rows, "recording", spread=PLACED_SPREAD)
    return elect_placed(recordings, placed, hot)


def cluster_keys(recordings: DataFrame) -> dict[str, DataFrame]:
    """Fact columns of :func:`cluster_members`, for :meth:`HotKeys.find`."""
    return {"recording.cluster": recordings.select(*CLUSTER_KEY)}


def cluster_members(
    recordings: DataFrame, rank: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """Every recording of an elected cluster with the cluster's canonical recording and credit.

    Recordings with an unknown part in their key belong to no cluster. Untitled recordings of unknown
    length share one key, which makes this the most skewed join of the build.
    """
    hot = hot or HotKeys.find(cluster_keys(recordings))
    winners = rank.select(
        F.col("normalized_rec_name").alias("normalized_name"),
        "artist_credit",
        "length_bucket",
        "canonical_recording_mbid",
    )
    members = hot.join(
        "recording.cluster",
        recordings.select("id", "gid", *CLUSTER_KEY),
        winners,
        CLUSTER_KEY,
        spread=["id"],
    )
    return members.select(
        F.col("id").alias("recording_id"),
        F.col("gid").alias("recording_mbid"),
        "canonical_recording_mbid",
        "artist_credit",
    )


def canonical_map(
    recordings: DataFrame, rank: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """``(recording_id, recording_mbid, canonical_recording_mbid)``, one row for each recording.

    A recording id is unique and so is the cluster key of the rank, so the rows are distinct as they are.
    """
    members = cluster_members(recordings, rank, hot)
    return members.select("recording_id", "recording_mbid", "canonical_recording_mbid")
