"""A small dump in which every reference of the chosen releases still resolves."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratewise.sources.sinks import with_surrogate_id
from cratewise.sources.stage import Stage

SAMPLE_RELEASES = 50

# Table -> (its column, the key set it must be in). The type dictionary is kept whole.
_KEPT_BY = {
    "release": ("id", "releases"),
    "medium": ("release", "releases"),
    "track": ("medium", "mediums"),
    "recording": ("id", "recordings"),
    "release_group": ("id", "release_groups"),
    "artist_credit_name": ("artist_credit", "artist_credits"),
    "artist": ("id", "artists"),
    "url": ("id", "urls"),
    "l_recording_url": ("entity0", "recordings"),
    "l_artist_url": ("entity0", "artists"),
    "release_country": ("release", "releases"),
    "release_unknown_country": ("release", "releases"),
}


def _keys(*columns: DataFrame) -> DataFrame:
    """Distinct non-NULL values of one-column frames, as column ``key``."""
    return reduce(DataFrame.union, [c.toDF("key") for c in columns]).dropna().distinct()


def _among(table: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    return table.join(keys, table[column] == keys["key"], "left_semi")


def sample_keys(
    tables: Mapping[str, DataFrame], n_releases: int, stage: Stage
) -> dict[str, DataFrame]:
    """The key sets the first ``n_releases`` releases reach, each in a column ``key``.

    Tables need their identity and reference columns, the tracks also ``artist_credit``. Each step
    narrows a large table by the sets before it, so its result is staged for the steps after it. The
    sets grow with the sample only, and Spark broadcasts them while they are small.
    """
    rows = tables["release"].select(F.col("id").alias("release"), "release_group", "artist_credit")
    # Numbered in the order of the ids, so that no task has to sort all of the first ones.
    first = with_surrogate_id(rows, ("release",), stage).filter(F.col("id") <= n_releases)
    seed = stage.save("seed", first.drop("id").withColumnRenamed("release", "id"))
    releases, groups = _keys(seed.select("id")), _keys(seed.select("release_group"))
    mediums = stage.save(
        "mediums", _keys(_among(tables["medium"], "release", releases).select("id"))
    )
    tracks = stage.save(
        "sampled_tracks",
        _among(tables["track"], "medium", mediums).select("id", "recording", "artist_credit"),
    )
    recordings = _keys(tracks.select("recording"))
    credits = stage.save(
        "artist_credits",
        _keys(
            seed.select("artist_credit"),
            tracks.select("artist_credit"),
            _among(tables["recording"], "id", recordings).select("artist_credit"),
            _among(tables["release_group"], "id", groups).select("artist_credit"),
        ),
    )
    credit_names = _among(tables["artist_credit_name"], "artist_credit", credits)
    artists = stage.save("artists", _keys(credit_names.select("artist")))
    urls = stage.save(
        "urls",
        _keys(
            _among(tables["l_recording_url"], "entity0", recordings).select("entity1"),
            _among(tables["l_artist_url"], "entity0", artists).select("entity1"),
        ),
    )
    return {
        "releases": releases,
        "release_groups": groups,
        "mediums": mediums,
        "tracks": _keys(tracks.select("id")),
        "recordings": recordings,
        "artist_credits": credits,
        "artists": artists,
        "urls": urls,
    }


def closed_sample(
    tables: Mapping[str, DataFrame], sets: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """The rows of every table that belong to the sample of :func:`sample_keys`."""
    return {
        name: _among(df, _KEPT_BY[name][0], sets[_KEPT_BY[name][1]]) if name in _KEPT_BY else df
        for name, df in tables.items()
    }


def sample_statistics(sets: Mapping[str, DataFrame]) -> DataFrame:
    """``(key_set, key_count)`` of every set."""
    counts = [
        df.agg(F.count_distinct("key").alias("key_count")).select(
            F.lit(name).alias("key_set"), "key_count"
        )
        for name, df in sets.items()
    ]
    return reduce(DataFrame.unionByName, counts)
