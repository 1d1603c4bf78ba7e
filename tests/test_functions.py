from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from cratewise import functions as cf
from cratewise.functions.links import is_wikidata


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Hello, World!", "hello world"),
        ("ΟΔΟΣ", "οδοσ"),
        ("İ", "i"),
        ("e\u0301", "e"),
        ("\u00e9", "\u00e9"),
        ("a\u000bb", "ab"),
        ("a\u00a0b", "ab"),
        ("???", ""),
        ("! a", " a"),
        ("a \t\r\n\f b", "a b"),
        ("a - b", "a b"),
        ("  x  ", " x "),
        ("№ 5 \U0001d7d9", " 5 \U0001d7d9"),
        ("你好，世界", "你好世界"),
        ("", ""),
        (None, None),
    ],
)
def test_norm(spark, text, expected):
    assert values(spark, [(text,)], "s string", cf.norm("s")) == [(expected,)]


@pytest.mark.parametrize(
    ("length", "bucket"),
    [(None, 0.0), (0, 0.0), (2499, 0.0), (2500, 1.0), (7500, 2.0), (7499, 1.0), (228639, 46.0)],
)
def test_length_bucket(spark, length, bucket):
    assert values(spark, [(length,)], "n int", cf.length_bucket("n")) == [(bucket,)]


@pytest.mark.parametrize(
    ("parts", "expected"),
    [
        ((1978, None, None), datetime.date(1978, 1, 1)),
        ((1978, 2, 3), datetime.date(1978, 2, 3)),
        ((None, None, None), datetime.date(9999, 1, 1)),
        ((None, 3, None), datetime.date(9999, 3, 1)),
        ((0, 0, 0), datetime.date(9999, 1, 1)),
        ((2001, 2, 30), datetime.date(9999, 12, 31)),
        ((1999, 13, 1), datetime.date(9999, 12, 31)),
        ((2000, 2, 29), datetime.date(2000, 2, 29)),
        ((1900, 2, 29), datetime.date(9999, 12, 31)),
        ((999_999_999, 1, 1), datetime.date(9999, 12, 31)),
        ((2000, 2, 29), datetime.date(2000, 2, 29)),
        ((2000, -1, 1), datetime.date(9999, 12, 31)),
    ],
)
def test_repair_date(spark, parts, expected):
    repaired = cf.repair_date(F.col("y"), F.col("m"), F.col("d"))
    assert values(spark, [parts], "y int, m int, d int", repaired) == [(expected,)]


def test_repaired_date_before_the_common_era_sorts_first(spark):
    repaired = cf.repair_date(F.col("y"), F.lit(1), F.lit(1))
    rows = spark.createDataFrame([(-5,), (1,)], "y int").select(repaired.alias("d"))
    assert rows.agg((F.min("d") < F.lit("0001-01-01").cast("date")).alias("x")).first().x


def test_type_score(spark):
    rows = [(name,) for name in [*cf.TYPE_SCORES, "album", "", None]]
    got = [r[0] for r in values(spark, rows, "t string", cf.type_score("t"))]
    assert got == [*cf.TYPE_SCORES.values(), 0, 0, 0]


def test_credit_bonus(spark):
    rows = [(1, 1), (1, 2), (None, 1), (1, None), (None, None)]
    bonus = cf.credit_bonus(F.col("a"), F.col("b"))
    assert [r[0] for r in values(spark, rows, "a int, b int", bonus)] == [50, 0, 0, 0, 0]


LINKS = [
    ("https://music.apple.com/us/album/x/1440?i=1441", "1441", "applemusic"),
    ("https://music.apple.com/us/album/x/1440?i=1441#top", "1441", "applemusic"),
    ("https://music.apple.com/us/album/x/1440?app=y&i=1441", "1441", "applemusic"),
    ("https://music.apple.com/us/song/1441?app=y", "1441", "applemusic"),
    ("https://music.apple.com/us/song/1441?i=abc", "1441", "applemusic"),
    ("https://open.spotify.com/track/51Z?si=token", "51Z", "spotify"),
    ("https://tidal.com/track/77/", "", "tidal"),
    ("https://tidal.com/track/77#a/b", "77", "tidal"),
    ("https://open.spotify.com/x/apple?i=9", "9", "spotify"),
    ("https://open.spotify.com/track/a?b\nc/d", "d", "spotify"),
    ("https://Spotify.example/x", "x", "unknown"),
]


@pytest.mark.parametrize(("url", "identifier", "provider"), LINKS)
def test_links(spark, url, identifier, provider):
    columns = cf.url_identifier("u"), cf.url_provider("u"), cf.has_provider("u")
    expected = [(identifier, provider, provider != "unknown")]
    assert values(spark, [(url,)], "u string", *columns) == expected


def test_history_identifier(spark):
    rows = [("spotify:track:51Z",), ("https://tidal.com/track/77",), ("https://a/apple?i=5",), (None,)]
    got = [r[0] for r in values(spark, rows, "u string", cf.history_identifier("u"))]
    assert got == ["51Z", "77", "5", None]


def test_wikidata(spark):
    rows = [("https://www.wikidata.org/wiki/Q42",), ("https://www.wikidata.org/wiki/x",), ("Q7",)]
    got = values(spark, rows, "u string", cf.wikidata_id("u"), is_wikidata("u"))
    assert got == [("Q42", True), ("", True), ("Q7", False)]


def test_late_years_are_dates(spark):
    row = spark.sql("select 300000 as y, 2 as m, 29 as d")
    repaired = cf.repair_date(F.col("y"), F.col("m"), F.col("d"))
    assert row.select(repaired.cast("string")).first()[0] == "+300000-02-29"
