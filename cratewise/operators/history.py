"""Consumer side: resolve plays against the lookups, count them, read credits and details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratewise.functions import history_identifier, norm, url_provider
from cratewise.operators.skew import HotKeys

LINK_KEY = ["provider", "url_identifier"]
TEXT_KEY = ["track_title", "release_title", "artist_name"]


def with_lookup_keys(history: DataFrame) -> DataFrame:
    """Plays with the link key and the normalised text key of their track."""
    return history.withColumns(
        {
            "provider": url_provider("spotify_track_uri"),
            "url_identifier": history_identifier("spotify_track_uri"),
            "track_title": norm("master_metadata_track_name"),
            "release_title": norm("master_metadata_album_album_name"),
            "artist_name": norm("master_metadata_album_artist_name"),
        }
    )


def one_per_key(lookup: DataFrame, key: list[str]) -> DataFrame:
    """A key may stand for several recordings; one is taken, so that no play doubles.

    It is the lowest one that has an album (:func:`_with_albums`), or else the lowest of all.
    """
    missing = F.col("release_group_mbid").isNull().alias("missing")
    best = F.min(F.struct(missing, "recording_mbid", "release_group_mbid"))
    return lookup.groupBy(*key).agg(best.alias("best")).select(
        *key, "best.recording_mbid", "best.release_group_mbid"
    )


def _with_albums(lookup: DataFrame, recording: DataFrame, name: str, hot: HotKeys) -> DataFrame:
    albums = recording.select("recording_mbid", "release_group_mbid")
    spread = [c for c in lookup.columns if c != "recording_mbid"]
    return hot.join(name, lookup, albums, "recording_mbid", "left", spread=spread)


def history_keys(
    keyed: DataFrame | None, link_lookup: DataFrame, text_lookup: DataFrame
) -> dict[str, DataFrame]:
    """Fact columns of :func:`resolve`, for :meth:`HotKeys.find`; without plays, those of the lookups."""
    plays = {} if keyed is None else {
        "history.link": keyed.select(*LINK_KEY),
        "history.text": keyed.select(*TEXT_KEY),
    }
    return {
        **plays,
        "link_lookup.recording_mbid": link_lookup.select("recording_mbid"),
        "text_lookup.recording_mbid": text_lookup.select("recording_mbid"),
    }


def resolve(
    keyed: DataFrame,
    link_lookup: DataFrame,
    text_lookup: DataFrame,
    recording: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Rows of :func:`with_lookup_keys` with their recording, release group and ``matched_by``.

    Links come first, also if their recording has no album. Text is the fallback: rows that have found
    their link carry no text key into the second join. Rows without a match stay, with NULLs. Release groups are put on the lookups,
    not on the plays, which saves the plays a third shuffle. A stream passes ``HotKeys.none()``, for
    it cannot count its keys.
    """
    hot = hot or HotKeys.find(history_keys(keyed, link_lookup, text_lookup))
    return resolve_reduced(keyed, *reduced_lookups(link_lookup, text_lookup, recording, hot), hot)


def reduced_lookups(
    link_lookup: DataFrame, text_lookup: DataFrame, recording: DataFrame, hot: HotKeys
) -> tuple[DataFrame, DataFrame]:
    """Links and texts with one recording, and its album, for each key."""
    links = _with_albums(link_lookup, recording, "link_lookup.recording_mbid", hot)
    texts = _with_albums(text_lookup, recording, "text_lookup.recording_mbid", hot)
    return one_per_key(links, LINK_KEY), one_per_key(texts, TEXT_KEY)


def resolve_reduced(keyed: DataFrame, links: DataFrame, texts: DataFrame, hot: HotKeys) -> DataFrame:
    """:func:`resolve` against what :func:`reduced_lookups` returns."""
    by_link = hot.join(
        "history.link",
        keyed,
        links.select(*LINK_KEY, *_renamed("link")),
        LINK_KEY,
        "left",
        spread=keyed.columns,
    )
    resolved = F.col("_link_recording").isNotNull()
    text_key = [f"_{k}" for k in TEXT_KEY]
    fallback = by_link.select(
        "*", *[F.when(~resolved, F.col(k)).alias(f"_{k}") for k in TEXT_KEY]
    )
    by_text = hot.join(
        "history.text",
        fallback,
        texts.select(*[F.col(k).alias(f"_{k}") for k in TEXT_KEY], *_renamed("text")),
        text_key,
        "left",
        spread=keyed.columns,
    )
    matched_by = F.when(resolved, "link").when(F.col("_text_recording").isNotNull(), "text")
    return by_text.select(
        *keyed.columns,
        F.when(resolved, F.col("_link_recording"))
        .otherwise(F.col("_text_recording"))
        .alias("recording_mbid"),
        matched_by.alias("matched_by"),
        F.when(resolved, F.col("_link_album"))
        .otherwise(F.col("_text_album"))
        .alias("release_group_mbid"),
    )


def _renamed(source: str) -> list[Column]:
    return [
        F.col("recording_mbid").alias(f"_{source}_recording"),
        F.col("release_group_mbid").alias(f"_{source}_album"),
    ]


def resolve_history(
    history: DataFrame,
    link_lookup: DataFrame,
    text_lookup: DataFrame,
    recording: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Every play with its canonical recording and release group."""
    resolved = resolve(with_lookup_keys(history), link_lookup, text_lookup, recording, hot)
    return resolved.select(*history.columns, "recording_mbid", "matched_by", "release_group_mbid")


def plays_per_release_group(
    history: DataFrame,
    link_lookup: DataFrame,
    text_lookup: DataFrame,
    recording: DataFrame,
    release_group: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Plays and listening time of every album; plays without one are counted on a NULL row.

    Plays are added up per distinct key before any join, so a hit song is one row from then on.
    """
    totals = [F.sum("plays").alias("plays"), F.sum("ms_played").alias("ms_played")]
    single = with_lookup_keys(history).withColumn("plays", F.lit(1).cast("bigint"))
    # Counted on the plays themselves, an upper bound, so that they are not added up once more.
    hot = hot or HotKeys.find(history_keys(single, link_lookup, text_lookup))
    per_key = single.groupBy(*LINK_KEY, *TEXT_KEY).agg(*totals)
    resolved = resolve(per_key, link_lookup, text_lookup, recording, hot)
    per_group = resolved.groupBy("release_group_mbid").agg(*totals)
    titles = release_group.select("release_group_mbid", "release_group_title")
    return per_group.join(titles, "release_group_mbid", "left").select(
        "release_group_mbid", "release_group_title", "plays", "ms_played"
    )


def ordered_credits(
    credits: DataFrame, artists: DataFrame, owner: str, hot: HotKeys | None = None
) -> DataFrame:
    """Credit rows of every owner in billing order, with names and knowledge-base ids.

    One row per credit, range-sorted: an owner with very many credits spans tasks instead of becoming
    one oversized list.
    """
    hot = hot or HotKeys.find({"credits.artist_mbid": credits.select("artist_mbid")})
    named = hot.join(
        "credits.artist_mbid",
        credits.select(owner, "position", "artist_mbid"),
        artists,
        "artist_mbid",
        spread=[owner, "position"],
    )
    return named.select(
        owner, "position", "artist_mbid", "artist_name", "artist_wikidata_id"
    ).orderBy(owner, "position", "artist_mbid")


def track_details(
    recording: DataFrame,
    release_group: DataFrame,
    artists: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Length, album and primary artist's knowledge-base id of every canonical recording."""
    keys = ["release_group_mbid", "primary_artist_mbid"]
    hot = hot or HotKeys.find({f"recording.{k}": recording.select(k) for k in keys})
    with_album = hot.join(
        "recording.release_group_mbid",
        recording,
        release_group.select("release_group_mbid", "release_group_title"),
        "release_group_mbid",
        "left",
        spread=["recording_mbid"],
    )
    primary = artists.select(
        F.col("artist_mbid").alias("primary_artist_mbid"),
        F.col("artist_wikidata_id").alias("primary_artist_wikidata_id"),
    )
    return hot.join(
        "recording.primary_artist_mbid",
        with_album,
        primary,
        "primary_artist_mbid",
        "left",
        spread=["recording_mbid"],
    ).select(
        "recording_mbid",
        "length",
        "release_group_mbid",
        "release_group_title",
        "primary_artist_mbid",
        "primary_artist_wikidata_id",
    )
