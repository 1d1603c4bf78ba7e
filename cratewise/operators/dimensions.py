"""Dimension tables and credit bridges of the elected clusters.

``rank`` is the output of :func:`cratewise.operators.canonical.canonical_rank` or ``elect``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.functions.links import is_wikidata, wikidata_id
from cratewise.operators.canonical import typed_release_groups
from cratewise.operators.skew import HotKeys

PRIMARY_POSITION = 0


def artist_link_keys(l_artist_url: DataFrame) -> dict[str, DataFrame]:
    return {"l_artist_url.entity1": l_artist_url.select("entity1")}


def artist_wikidata(
    l_artist_url: DataFrame, url: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """``(artist_id, wikidata_id)`` of every knowledge-base link; an artist may have several."""
    hot = hot or HotKeys.find(artist_link_keys(l_artist_url))
    pages = url.filter(is_wikidata("url")).select(
        F.col("id").alias("entity1"), wikidata_id("url").alias("wikidata_id")
    )
    return hot.join(
        "l_artist_url.entity1",
        l_artist_url.select("entity0", "entity1"),
        pages,
        "entity1",
        spread=["entity0"],
    ).select(F.col("entity0").alias("artist_id"), "wikidata_id")


def elected_release_groups(rank: DataFrame) -> DataFrame:
    """Distinct release groups of the rank with their credit; clusters without one drop out."""
    return (
        rank.filter(F.col("release_group_mbid").isNotNull())
        .groupBy("release_group_mbid")
        .agg(F.min("release_group_artist_credit").alias("artist_credit"))
    )


def dim_release_group(rank: DataFrame, release_group: DataFrame, rg_type: DataFrame) -> DataFrame:
    """Title and type of every elected release group.

    The rank is reduced to distinct groups before anything is joined, so a group elected by very many
    clusters is one row by then.
    """
    elected = elected_release_groups(rank).select("release_group_mbid")
    return (
        typed_release_groups(release_group, rg_type)
        .join(elected, "release_group_mbid", "left_semi")
        .groupBy("release_group_mbid")
        .agg(
            F.min("release_group_title").alias("release_group_title"),
            F.min("release_group_type").alias("release_group_type"),
        )
    )


def credit_keys(owners: DataFrame, artist_credit_name: DataFrame) -> dict[str, DataFrame]:
    """Fact columns of the joins from owners of a credit to artists, for :meth:`HotKeys.find`.

    ``owners`` is any frame with an ``artist_credit`` whose rows contain those of the join: the
    recordings stand in for the rank.
    """
    return {
        "owner.artist_credit": owners.select("artist_credit"),
        "artist_credit_name.artist": artist_credit_name.select("artist"),
    }


def credited_artists(
    artist_credit_name: DataFrame, artist: DataFrame, hot: HotKeys
) -> DataFrame:
    """Credit rows with the artist's public id and name: ``(artist_credit, position, ...)``."""
    names = artist.select(
        F.col("id").alias("artist"),
        F.col("gid").alias("artist_mbid"),
        F.col("name").alias("artist_name"),
    )
    return hot.join(
        "artist_credit_name.artist",
        artist_credit_name.select("artist_credit", "position", "artist"),
        names,
        "artist",
        spread=["artist_credit", "position"],
    ).select("artist_credit", "position", "artist_mbid", "artist_name")


def recording_credits(
    rank: DataFrame,
    artist_credit_name: DataFrame,
    artist: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Credit rows of the canonical recordings.

    A canonical recording's own credit is part of its cluster key, so the rank supplies it and the
    recording table is not read again.
    """
    hot = hot or HotKeys.find(credit_keys(rank, artist_credit_name))
    owners = rank.select(
        F.col("canonical_recording_mbid").alias("recording_mbid"), "artist_credit"
    )
    return hot.join(
        "owner.artist_credit",
        owners,
        credited_artists(artist_credit_name, artist, hot),
        "artist_credit",
        spread=["recording_mbid"],
    ).select("recording_mbid", "artist_mbid", "position")


def elected_group_keys(
    rank: DataFrame, artist_credit_name: DataFrame
) -> dict[str, DataFrame]:
    """Fact columns of :func:`release_group_credits`, for :meth:`HotKeys.find`."""
    return {
        "release_group.artist_credit": elected_release_groups(rank).select("artist_credit"),
        "artist_credit_name.artist": artist_credit_name.select("artist"),
    }


def release_group_credits(
    rank: DataFrame,
    artist_credit_name: DataFrame,
    artist: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Credit rows of the elected release groups."""
    hot = hot or HotKeys.find(elected_group_keys(rank, artist_credit_name))
    return hot.join(
        "release_group.artist_credit",
        elected_release_groups(rank),
        credited_artists(artist_credit_name, artist, hot),
        "artist_credit",
        spread=["release_group_mbid"],
    ).select("release_group_mbid", "artist_mbid", "position")


def credit_row_keys(artist_credit_name: DataFrame) -> dict[str, DataFrame]:
    """Fact column of :func:`dim_artist`, for :meth:`HotKeys.find`."""
    return {"artist_credit_name.artist_credit": artist_credit_name.select("artist_credit")}


def _lowest_id(column: str) -> Column:
    """The lowest id that is not empty, or else what there is."""
    return F.coalesce(F.min(F.nullif(F.col(column), F.lit(""))), F.min(column))


def dim_artist(
    rank: DataFrame,
    artist_credit_name: DataFrame,
    artist: DataFrame,
    wikidata: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Every artist credited on a canonical recording or an elected release group.

    Both kinds of owner are reduced to their distinct credits, and those to distinct artists, before
    the artist table is touched. ``wikidata`` comes from :func:`artist_wikidata` and is reduced to the
    lowest id of each artist; the empty id counts only if there is no other.
    """
    hot = hot or HotKeys.find(credit_row_keys(artist_credit_name))
    recording_side = rank.select("artist_credit")
    group_side = elected_release_groups(rank).select("artist_credit")
    credits = recording_side.union(group_side).distinct()
    credited = (
        hot.join(
            "artist_credit_name.artist_credit",
            artist_credit_name.select("artist_credit", "artist"),
            credits,
            "artist_credit",
            spread=["artist"],
        )
        .select(F.col("artist").alias("id"))
        .distinct()
    )
    ids = wikidata.groupBy(F.col("artist_id").alias("id")).agg(
        _lowest_id("wikidata_id").alias("wikidata_id")
    )
    return (
        artist.select("id", "gid", "name")
        .join(credited, "id", "left_semi")
        .join(ids, "id", "left")
        .groupBy(F.col("gid").alias("artist_mbid"))
        .agg(
            F.min("name").alias("artist_name"),
            _lowest_id("wikidata_id").alias("artist_wikidata_id"),
        )
    )


def primary_artists(
    artist_credit_name: DataFrame, artist: DataFrame, hot: HotKeys
) -> DataFrame:
    """Position-0 rows of every credit, restricted before any join."""
    first = artist_credit_name.filter(F.col("position") == PRIMARY_POSITION)
    return credited_artists(first, artist, hot).drop("position")


def dim_recording(
    rank: DataFrame,
    artist_credit_name: DataFrame,
    artist: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Canonical recordings that have a release group, with their primary artist if there is one."""
    hot = hot or HotKeys.find(credit_keys(rank, artist_credit_name))
    owners = rank.filter(
        F.col("canonical_recording_mbid").isNotNull() & F.col("release_group_mbid").isNotNull()
    ).select("canonical_recording_mbid", "release_group_mbid", "length", "artist_credit")
    primary = (
        primary_artists(artist_credit_name, artist, hot)
        .groupBy("artist_credit")
        .agg(F.min("artist_mbid").alias("primary_artist_mbid"))
    )
    return (
        hot.join(
            "owner.artist_credit",
            owners,
            primary,
            "artist_credit",
            "left",
            spread=["canonical_recording_mbid"],
        )
        .groupBy(F.col("canonical_recording_mbid").alias("recording_mbid"))
        .agg(
            F.min("release_group_mbid").alias("release_group_mbid"),
            F.min("length").alias("length"),
            F.min("primary_artist_mbid").alias("primary_artist_mbid"),
        )
    )
