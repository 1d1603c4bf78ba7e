from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from cratewise.operators import history as h
from cratewise.operators.skew import HotKeys
from cratewise.sources.history import read_history, stream_history
from cratewise.streaming.resolve import resolve_batches, resolve_stream, write_resolved
from verification import adapters

PLAY = {
    "ts": "2024-05-02T08:00:00Z",
    "ms_played": 201500,
    "master_metadata_track_name": "Don't Leave (Not Yet)",
    "master_metadata_album_artist_name": "Nora Vale",
    "master_metadata_album_album_name": "Paper Harbour",
    "spotify_track_uri": "spotify:track:7aXk",
    "shuffle": False,
}
PLAYS = [
    PLAY,
    # The deluxe edition, known by its names only.
    {
        **PLAY,
        "ts": "2024-03-01T07:00:00Z",
        "master_metadata_album_album_name": "Paper Harbour: the long edition",
        "spotify_track_uri": "spotify:track:9bYm",
    },
    # An episode has neither link nor names.
    {"ts": "2024-04-01T00:00:00Z", "ms_played": 5, "episode_name": "news"},
]


@pytest.fixture(scope="module")
def lookups(spark):
    track = "dont leave not yet"
    links = [("7aXk", "spotify", "rec-1"), ("7aXk", "spotify", "rec-9"), ("7aXk", "tidal", "rec-0")]
    texts = [
        (track, "paper harbour", "nora vale", "rec-1"),
        (track, "paper harbour the long edition", "nora vale", "rec-1"),
    ]
    return (
        spark.createDataFrame(links, "url_identifier string, provider string, recording_mbid string"),
        spark.createDataFrame(
            texts,
            "track_title string, release_title string, artist_name string, recording_mbid string",
        ),
        spark.createDataFrame(
            [("rec-1", "rg-1", 201500, "art-1"), ("rec-9", "rg-9", None, None)],
            "recording_mbid string, release_group_mbid string, length int, "
            "primary_artist_mbid string",
        ),
    )


@pytest.fixture(scope="module")
def groups(spark):
    return spark.createDataFrame(
        [("rg-1", "Paper Harbour")], "release_group_mbid string, release_group_title string"
    )


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "history"
    source.mkdir()
    (source / "a.json").write_text(json.dumps(PLAYS, indent=2))
    return str(source)


def test_both_editions_count_for_one_album(spark, folder, lookups, groups):
    history = read_history(spark, folder)
    assert len(history.columns) == 23
    resolved = h.resolve_history(history, *lookups).orderBy("ts").collect()
    assert [(r.matched_by, r.recording_mbid, r.release_group_mbid) for r in resolved] == [
        ("text", "rec-1", "rg-1"),
        (None, None, None),
        ("link", "rec-1", "rg-1"),
    ]
    albums = h.plays_per_release_group(history, *lookups, groups).collect()
    assert {tuple(r) for r in albums} == {
        ("rg-1", "Paper Harbour", 2, 403000),
        (None, None, 1, 5),
    }


def test_salted_resolution_changes_nothing(spark, folder, lookups):
    history = read_history(spark, folder)
    many = history.union(history).union(history.limit(1))
    keyed = h.with_lookup_keys(many)
    hot = HotKeys.find(h.history_keys(keyed, *lookups[:2]), rows_per_salt=1)
    assert "history.link" in hot and "history.text" in hot
    salted = h.resolve_history(many, *lookups, hot).collect()
    plain = h.resolve_history(many, *lookups, HotKeys.none()).collect()
    assert sorted(salted, key=repr) == sorted(plain, key=repr)
    assert len(salted) == many.count()


def test_stream(spark, folder, lookups, tmp_path):
    resolved = resolve_stream(stream_history(spark, folder), *lookups)
    assert resolved.isStreaming
    out = str(tmp_path / "resolved")
    for _ in range(2):  # a second run finds nothing new
        write_resolved(resolved, out, str(tmp_path / "progress")).awaitTermination(120)
    rows = spark.read.parquet(out).orderBy("ts").collect()
    assert [r.matched_by for r in rows] == ["text", None, "link"]


def test_batches_of_a_stream_are_salted(spark, folder, lookups, tmp_path):
    """Nine in ten plays have one link; the tasks of the batch's joins share them, and no row changes."""
    many = [{**PLAY, "ms_played": i} if i % 10 else {**PLAYS[0], "ms_played": i} for i in range(2_000)]
    (tmp_path / "history" / "b.json").write_text(json.dumps(many))
    out, progress = str(tmp_path / "resolved"), str(tmp_path / "progress")
    for _ in range(2):  # a second run finds nothing new
        resolve_batches(stream_history(spark, folder), *lookups, out, progress, rows_per_salt=100).awaitTermination(240)
    plain = h.resolve_history(read_history(spark, folder), *lookups, HotKeys.none())
    found = spark.read.parquet(out).select(*plain.columns)
    assert found.count() == 2_000 + len(PLAYS)
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    keyed = h.with_lookup_keys(read_history(spark, folder))
    hot = HotKeys.find({"history.link": keyed.select(*h.LINK_KEY)}, rows_per_salt=100)
    salted = hot._salted("history.link", keyed, list(h.LINK_KEY), keyed.columns)
    shares = [r["count"] for r in salted.groupBy(*h.LINK_KEY, "_salt").count().collect()]
    assert len(shares) > 10 and max(shares) < 400


def test_ordered_credits_and_details(spark, lookups, groups):
    artists = spark.createDataFrame(
        [("art-1", "A", "Q1"), ("art-2", "B", None)],
        "artist_mbid string, artist_name string, artist_wikidata_id string",
    )
    credits = spark.createDataFrame(
        [("rec-1", "art-2", 1), ("rec-1", "art-1", 0), ("rec-9", "art-2", 0)],
        "recording_mbid string, artist_mbid string, position int",
    )
    for rows_per_salt in (1, 1000):
        hot = HotKeys.find({"credits.artist_mbid": credits.select("artist_mbid")}, rows_per_salt)
        ordered = h.ordered_credits(credits, artists, "recording_mbid", hot).collect()
        assert [tuple(r) for r in ordered] == [
            ("rec-1", 0, "art-1", "A", "Q1"),
            ("rec-1", 1, "art-2", "B", None),
            ("rec-9", 0, "art-2", "B", None),
        ]
    details = h.track_details(lookups[2], groups, artists).orderBy("recording_mbid").collect()
    assert [tuple(r) for r in details] == [
        ("rec-1", 201500, "rg-1", "Paper Harbour", "art-1", "Q1"),
        ("rec-9", None, "rg-9", None, None, None),
    ]


def test_the_recording_with_an_album_is_taken(spark, folder, lookups):
    links, texts, recording = lookups
    lower = spark.createDataFrame([("7aXk", "spotify", "rec-0")], links.schema)
    resolved = h.resolve_history(read_history(spark, folder), links.union(lower), texts, recording)
    found = {(r.matched_by, r.recording_mbid, r.release_group_mbid) for r in resolved.collect()}
    assert ("link", "rec-1", "rg-1") in found and not any(r == "rec-0" for _, r, _ in found)


def test_damaged_files_fail(spark, tmp_path):
    (tmp_path / "cut.json").write_text(json.dumps(PLAYS)[:-30])
    (tmp_path / "typed.json").write_text(json.dumps([{**PLAY, "ms_played": "long"}]))
    for name in ("cut.json", "typed.json"):
        with pytest.raises(Exception, match="FAILFAST|MALFORMED|Malformed"):
            read_history(spark, str(tmp_path / name)).collect()


def test_plays_without_a_key_are_spread(spark):
    """Two thirds of the plays have no order; they must not share the task of the NULLs."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        plays = adapters.history(spark, "/root/testdata/sf0.001")
        rows = [r["count"] for r in plays.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(rows) > 1 and max(rows) < sum(rows) / 2
