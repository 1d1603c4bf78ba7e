"""Lookup tables a consumer searches: normalised text and streaming links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.functions import has_provider, norm, url_identifier, url_provider
from cratewise.operators.dimensions import primary_artists
from cratewise.operators.skew import HotKeys


def text_lookup(
    members: DataFrame,
    placed: DataFrame,
    artist_credit_name: DataFrame,
    artist: DataFrame,
    hot: HotKeys,
) -> DataFrame:
    """Distinct ``(track_title, release_title, artist_name, recording_mbid)``, titles normalised.

    ``members`` comes from :func:`cratewise.operators.canonical.cluster_members` and ``placed`` from
    :func:`cratewise.operators.canonical.placed_tracks`, stored for ``track.recording``. Titles of official
    releases only. Release and artist names are normalised once per release and artist, and artists
    meet the recordings before the far more numerous tracks do.
    """
    names = primary_artists(artist_credit_name, artist, hot).select(
        "artist_credit", norm("artist_name").alias("artist_name")
    )
    named = hot.join(
        "owner.artist_credit",
        members.select(
            F.col("recording_id").alias("recording"),
            F.col("canonical_recording_mbid").alias("recording_mbid"),
            "artist_credit",
        ),
        names,
        "artist_credit",
        spread=["recording"],
    )
    titles = [c for c in placed.columns if c in ("recording", "_salt", "track_title", "release_title")]
    return (
        hot.join_placed("track.recording", placed.select(*titles), named, "recording")
        .select("track_title", "release_title", "artist_name", "recording_mbid")
        .distinct()
    )


def recording_link_keys(l_recording_url: DataFrame) -> dict[str, DataFrame]:
    """Fact columns of :func:`link_lookup`, for :meth:`HotKeys.find`."""
    return {
        "l_recording_url.entity1": l_recording_url.select("entity1"),
        "l_recording_url.entity0": l_recording_url.select("entity0"),
    }


def link_lookup(
    members: DataFrame, url: DataFrame, l_recording_url: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """Distinct ``(url_identifier, provider, recording_mbid)`` of links to the known providers."""
    hot = hot or HotKeys.find(recording_link_keys(l_recording_url))
    links = url.filter(has_provider("url")).select(
        F.col("id").alias("entity1"),
        url_identifier("url").alias("url_identifier"),
        url_provider("url").alias("provider"),
    )
    linked = hot.join(
        "l_recording_url.entity1",
        l_recording_url.select("entity0", "entity1"),
        links,
        "entity1",
        spread=["entity0"],
    )
    canonical = members.select(
        F.col("recording_id").alias("entity0"),
        F.col("canonical_recording_mbid").alias("recording_mbid"),
    )
    return (
        hot.join(
            "l_recording_url.entity0", linked, canonical, "entity0", spread=["url_identifier"]
        )
        .select("url_identifier", "provider", "recording_mbid")
        .distinct()
    )
