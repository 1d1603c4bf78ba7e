from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from cratewise.operators import canonical
from cratewise.operators.skew import HotKeys
from verification.adapters import catalogue_tables

SF = "/root/testdata/sf0.001"

SCORED = (
    "recording_mbid string, raw_length int, release_group_mbid string, release_group_title string, "
    "release_group_type string, release_group_artist_credit int, normalized_rec_name string, "
    "artist_credit int, length_bucket double, evaluation_score int, normalized_release_date date"
)
EARLY, LATE = datetime.date(1990, 1, 1), datetime.date(2000, 1, 1)


def candidate(recording, group, score, date, name="song", credit=1, bucket=1.0):
    title = group and f"title {group}"
    return (recording, 5000, group, title, "Album", 1, name, credit, bucket, score, date)


def winners(spark, *rows):
    rank = canonical.canonical_rank(spark.createDataFrame(rows, SCORED))
    return sorted((r.canonical_recording_mbid, r.release_group_mbid) for r in rank.collect())


def test_score_beats_date(spark):
    rows = candidate("a", "g1", 800, EARLY), candidate("b", "g2", 1000, LATE)
    assert winners(spark, *rows) == [("b", "g2")]


def test_date_beats_group_id(spark):
    rows = candidate("a", "g1", 800, LATE), candidate("b", "g2", 800, EARLY)
    assert winners(spark, *rows) == [("b", "g2")]


def test_lowest_group_id_then_lowest_recording_id(spark):
    rows = [candidate(r, g, 800, EARLY) for r in "cba" for g in ("g2", "g1")]
    assert winners(spark, *rows) == [("a", "g1")]


def test_missing_group_comes_last_but_can_win_alone(spark):
    rows = candidate("a", None, 0, EARLY), candidate("b", "g1", 0, EARLY)
    assert winners(spark, *rows) == [("b", "g1")]
    assert winners(spark, candidate("a", None, 0, EARLY)) == [("a", None)]


def test_unknown_type_beats_live(spark):
    rows = candidate("a", None, 0, LATE), candidate("b", "g1", -1000, EARLY)
    assert winners(spark, *rows) == [("a", None)]


def test_null_keys_form_one_cluster_but_get_no_members(spark):
    rows = [candidate(r, "g1", 800, EARLY, name=None) for r in "ab"]
    rank = canonical.canonical_rank(spark.createDataFrame(rows, SCORED))
    assert rank.count() == 1
    recordings = spark.createDataFrame(
        [(1, "a", 1, 5000, None, 1.0)],
        "id int, gid string, artist_credit int, length int, normalized_name string, "
        "length_bucket double",
    )
    assert canonical.canonical_map(recordings, rank).count() == 0


def test_earliest_dates(spark):
    schema = "release int, date_year int, date_month int, date_day int"
    country = spark.createDataFrame([(1, 2001, 2, 30), (1, 2002, None, None), (2, None, None, None)], schema)
    unknown = spark.createDataFrame([(1, 2001, 5, 0), (3, 2001, 2, 30)], schema)
    got = {r[0]: r[1] for r in canonical.earliest_dates(country, unknown).collect()}
    assert got == {
        1: datetime.date(2001, 5, 1),
        2: datetime.date(9999, 1, 1),
        3: datetime.date(9999, 12, 31),
    }


def test_official_releases_reject_unknown_status(spark):
    rows = spark.createDataFrame(
        [(1, 1), (2, 2), (3, None)], "id int, status int"
    ).withColumns({"release_group": F.lit(1), "artist_credit": F.lit(1), "name": F.lit("n")})
    assert [r.id for r in canonical.official_releases(rows).collect()] == [1]
    assert [r.id for r in canonical.official_release_names(rows).collect()] == [1]
    assert canonical.release_names(rows).count() == 3


@pytest.fixture(scope="module")
def tables(spark):
    return catalogue_tables(spark, SF)


def election_inputs(t):
    return (
        canonical.normalize_recordings(t["recording"]),
        t["track"],
        t["medium"],
        t["release"],
        canonical.earliest_dates(t["release_country"], t["release_unknown_country"]),
        t["release_group"],
        t["rg_type"],
    )


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_elect_is_the_rank_without_titles(spark, tables):
    full = canonical.canonical_rank(canonical.score_candidates(*election_inputs(tables)))
    slim = canonical.elect(*election_inputs(tables))
    assert slim.columns == [c for c in full.columns if c not in canonical.TITLE_COLUMNS]
    assert rows_of(slim) == rows_of(full.drop(*canonical.TITLE_COLUMNS))


def test_election_ignores_input_order_and_partitioning(spark, tables):
    expected = rows_of(canonical.elect(*election_inputs(tables)))
    for seed, parts in ((1, 3), (2, 13)):
        shuffled = {n: df.repartition(parts).orderBy(F.rand(seed)) for n, df in tables.items()}
        assert rows_of(canonical.elect(*election_inputs(shuffled))) == expected


def test_one_winner_per_cluster_and_every_member_mapped(spark, tables):
    recordings = canonical.normalize_recordings(tables["recording"])
    rank = canonical.elect(*election_inputs(tables)).persist()
    key = ["normalized_rec_name", "artist_credit", "length_bucket"]
    assert rank.count() == rank.select(*key).distinct().count()
    members = canonical.canonical_map(recordings, rank)
    assert members.count() == members.select("recording_id").distinct().count()
    clusters = {tuple(r[:3]): r[3] for r in rank.select(*key, "canonical_recording_mbid").collect()}
    mapped = {r.recording_id: r.canonical_recording_mbid for r in members.collect()}
    for r in recordings.collect():
        cluster = (r.normalized_name, r.artist_credit, r.length_bucket)
        assert mapped.get(r.id) == clusters.get(cluster)


def test_salted_election_and_map_change_nothing(spark, tables):
    inputs = election_inputs(tables)
    recordings = inputs[0]
    keys = {
        **canonical.track_keys(tables["track"], tables["medium"], tables["release"]),
        **canonical.cluster_keys(recordings),
    }
    hot = HotKeys.find(keys, rows_per_salt=2)
    for name in ("track.recording", "track.medium", "release.release_group", "recording.cluster"):
        assert name in hot
    plain = canonical.elect(*inputs, HotKeys.none()).persist()
    salted = canonical.elect(*inputs, hot)
    assert rows_of(salted) == rows_of(plain)
    assert rows_of(canonical.cluster_members(recordings, plain, hot)) == rows_of(
        canonical.cluster_members(recordings, plain, HotKeys.none())
    )
