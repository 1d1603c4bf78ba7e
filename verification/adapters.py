"""Catalogue-shaped views of the star-schema tables (design: FIXTURES.md, section 3).

:mod:`verification.oracle` states the same views in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise.operators.skew import HotKeys


def _ids_with_twin(key: Column, count: int) -> Column:
    """Every fifth part stands for two recordings that differ in id only, which forces ties."""
    return F.explode(F.when(key % 5 == 0, F.array(key, key + count)).otherwise(F.array(key)))


def _part_credit() -> Column:
    return ((F.length("p_name") + F.col("p_size") % 2) % 10).cast("bigint")


def _medium_id() -> Column:
    return F.col("l_orderkey") * 2 + F.when(F.col("l_linestatus") == "F", 1).otherwise(0)


def _suffix() -> Column:
    return F.regexp_replace("url", "^[a-z]+://[^/]+", "")


def _path() -> Column:
    return F.regexp_replace(_suffix(), "[?#].*", "")


# Schemas of the star-schema tables the views read. Stating them spares one
# schema-inference job for each read.
_SCHEMAS = {
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


class Star:
    """Lazy access to the tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir
        self._counts: dict[str, int] = {}

    def __getattr__(self, table: str) -> DataFrame:
        if table not in _SCHEMAS:
            raise AttributeError(table)
        reader = self.spark.read.schema(_SCHEMAS[table])
        return reader.parquet(f"{self.sf_dir}/{table}.parquet")

    def count(self, table: str) -> int:
        """Row count, which reads file footers only."""
        if table not in self._counts:
            self._counts[table] = getattr(self, table).count()
        return self._counts[table]


def recording(star: Star) -> DataFrame:
    part = star.part
    key = F.col("p_partkey")
    name = (
        F.when(key % 4 == 0, F.col("p_name"))
        .when(key % 4 == 1, F.upper("p_name"))
        .when(key % 4 == 2, F.concat("p_name", F.lit("!")))
        .otherwise(F.replace(F.col("p_name"), F.lit(" "), F.lit("  ")))
    )
    length = F.when(F.col("p_size") != 50, F.round(F.col("p_retailprice") * 250).cast("int"))
    return part.select(
        _ids_with_twin(key, star.count("part")).alias("id"),
        name.alias("name"),
        _part_credit().alias("artist_credit"),
        length.alias("length"),
    ).withColumn("gid", F.md5(F.concat(F.lit("rec"), F.col("id").cast("string"))))


def medium(star: Star) -> DataFrame:
    return star.lineitem.select(
        _medium_id().alias("id"), F.col("l_orderkey").alias("release")
    ).distinct()


def track(star: Star) -> DataFrame:
    part = star.part
    count = star.count("part")
    lines = star.lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"))
    rows = lines.select(
        "l_orderkey",
        "l_linenumber",
        _ids_with_twin(F.col("p_partkey"), count).alias("recording"),
        _medium_id().alias("medium"),
        F.concat("p_name", F.lit(" ("), "l_returnflag", F.lit(")")).alias("name"),
        (F.col("l_suppkey") % 10).alias("artist_credit"),
    )
    line = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return rows.select(
        (line * (count * 2) + F.col("recording")).alias("id"),
        "recording",
        "medium",
        "name",
        "artist_credit",
    )


def release(star: Star) -> DataFrame:
    status = F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 8 == 0), 1).when(
        F.col("o_orderstatus") == "O", 2
    )
    return star.orders.select(
        F.col("o_orderkey").alias("id"),
        F.concat(
            F.lit("Vol. "), (F.col("o_custkey") % 50).cast("string"), F.lit(": "), "o_orderpriority"
        ).alias("name"),
        (F.col("o_custkey") % 10).alias("artist_credit"),
        F.col("o_custkey").alias("release_group"),
        status.alias("status"),
    )


def release_group(star: Star) -> DataFrame:
    key = F.col("c_custkey")
    types = {"MACHINERY": 1, "BUILDING": 2, "AUTOMOBILE": 3, "FURNITURE": 4, "HOUSEHOLD": 5}
    type_id = F.lit(None).cast("int")
    for segment, number in types.items():
        type_id = F.when(F.col("c_mktsegment") == segment, number).otherwise(type_id)
    return star.customer.filter(key % 11 != 0).select(
        key.alias("id"),
        F.md5(F.concat(F.lit("rg"), key.cast("string"))).alias("gid"),
        F.col("c_name").alias("name"),
        (key % 10).alias("artist_credit"),
        F.when(key % 13 != 0, type_id).alias("type"),
    )


def rg_type(star: Star) -> DataFrame:
    return star.spark.sql(
        "SELECT * FROM VALUES (1, 'Album'), (2, 'EP'), (3, 'Single'), (4, 'Live'), "
        "(5, 'Compilation') AS t(id, name)"
    )


def release_country(star: Star) -> DataFrame:
    key = F.col("o_orderkey")
    day = F.when(key % 13 == 0, 31).when(key % 5 == 0, 0).otherwise(F.day("o_orderdate"))
    return star.orders.filter(key % 3 != 1).select(
        key.alias("release"),
        F.when(key % 17 != 0, F.year("o_orderdate")).alias("date_year"),
        F.when(key % 7 != 0, F.month("o_orderdate")).alias("date_month"),
        day.alias("date_day"),
    )


def release_unknown_country(star: Star) -> DataFrame:
    return star.orders.filter(F.col("o_orderkey") % 4 == 0).select(
        F.col("o_orderkey").alias("release"),
        F.year("o_orderdate").alias("date_year"),
        F.month("o_orderdate").alias("date_month"),
        F.lit(None).cast("int").alias("date_day"),
    )


def artist(star: Star) -> DataFrame:
    return star.supplier.select(
        F.col("s_suppkey").alias("id"),
        F.md5(F.concat(F.lit("art"), F.col("s_suppkey").cast("string"))).alias("gid"),
        F.col("s_name").alias("name"),
    )


def artist_credit_name(star: Star) -> DataFrame:
    supplier = star.supplier
    key = F.col("s_suppkey")
    first = supplier.select(
        key.alias("artist_credit"),
        F.lit(0).alias("position"),
        key.alias("artist"),
        F.col("s_name").alias("name"),
    )
    second = supplier.filter(key % 2 == 0).select(
        key.alias("artist_credit"),
        F.lit(1).alias("position"),
        ((key * 7 + 3) % star.count("supplier")).alias("artist"),
        F.col("s_name").alias("name"),
    )
    return first.unionByName(second)


def url(star: Star) -> DataFrame:
    key = F.col("page_id")
    number = key.cast("string")
    item = F.when(key % 3 == 0, number).otherwise(F.concat(F.lit("Q"), number))
    apple = F.lit("https://music.apple.com")
    link = (
        F.when(key % 5 == 0, F.concat(F.lit("https://open.spotify.com"), _suffix()))
        .when(key % 5 == 1, F.concat(apple, _path(), F.lit("?i="), number, F.lit("&app=x")))
        .when(key % 5 == 2, F.concat(apple, _suffix()))
        .when(key % 5 == 3, F.concat(F.lit("https://tidal.com"), _suffix()))
        .otherwise(F.concat(F.lit("https://www.wikidata.org/wiki/"), item))
    )
    return star.pages.select(key.alias("id"), link.alias("url"))


def l_recording_url(star: Star) -> DataFrame:
    key, count = F.col("page_id"), star.count("part")
    first = star.pages.select(((key * 7) % count).alias("entity0"), key.alias("entity1"))
    second = star.pages.filter(key % 3 == 0).select(
        ((key * 11 + 1) % count).alias("entity0"), key.alias("entity1")
    )
    return first.unionByName(second)


def l_artist_url(star: Star) -> DataFrame:
    key = F.col("page_id")
    fifth = F.floor(key / 5)
    first = star.pages.select(
        (fifth % star.count("supplier")).alias("entity0"), key.alias("entity1")
    )
    second = star.pages.filter(key % 2 == 0).select(
        ((fifth * 3) % 10).alias("entity0"), key.alias("entity1")
    )
    return first.unionByName(second)


VIEWS = {
    view.__name__: view
    for view in (
        artist,
        artist_credit_name,
        recording,
        track,
        medium,
        release,
        release_group,
        release_country,
        release_unknown_country,
        url,
        l_recording_url,
        l_artist_url,
        rg_type,
    )
}


def catalogue_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    star = Star(spark, sf_dir)
    return {name: view(star) for name, view in VIEWS.items()}


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays made of the events: a third with a link, a third with names, a third with neither."""
    star = Star(spark, sf_dir)
    event = F.col("event_id")
    plays = star.events.select(
        "event_id",
        "user_id",
        F.round(F.col("value") * 1000).cast("int").alias("ms_played"),
        F.when(event % 3 == 0, event % star.count("pages")).alias("page_id"),
        F.when(event % 3 == 1, (event * 8) % star.count("orders")).alias("o_orderkey"),
    )
    key = F.col("page_id")
    last = F.regexp_extract(_path(), r"([^/]+)\z", 1)
    as_uri = F.concat(F.lit("spotify:track:"), last)
    links = star.pages.select("page_id", as_uri.alias("uri")).filter(key % 5 == 0).unionByName(
        url(star).select(F.col("id").alias("page_id"), F.col("url").alias("uri")).filter(key % 5 != 0)
    )
    # The line of an order with the lowest part, and its flag: it names a track of that release.
    line = F.concat(F.lpad(F.col("l_partkey").cast("string"), 12, "0"), "l_returnflag")
    lines = star.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min(line).alias("line")
    )
    names = (
        release(star)
        .select(F.col("id").alias("o_orderkey"), F.col("name").alias("album"))
        .join(lines, "o_orderkey")
        .withColumn("p_partkey", F.substring("line", 1, 12).cast("bigint"))
        .join(star.part.withColumn("s_suppkey", _part_credit()), "p_partkey")
        .join(star.supplier, "s_suppkey")
        .select(
            "o_orderkey",
            F.upper(
                F.concat("p_name", F.lit(" ("), F.substring("line", 13, 1), F.lit(")"))
            ).alias("track"),
            "album",
            F.col("s_name").alias("artist"),
        )
    )
    # Two thirds of the plays lack either key: these rows are spread, not sent to the task of the NULLs.
    spread = HotKeys.none().join("page_id", plays, links, "page_id", "left", spread=["event_id"])
    return (
        HotKeys.none()
        .join("o_orderkey", spread, names, "o_orderkey", "left", spread=["event_id"])
        .select(
            "event_id",
            "user_id",
            "ms_played",
            F.col("uri").alias("spotify_track_uri"),
            F.col("track").alias("master_metadata_track_name"),
            F.col("album").alias("master_metadata_album_album_name"),
            F.col("artist").alias("master_metadata_album_artist_name"),
        )
    )
