"""Every registered query: name -> callable of (spark, directory of the star-schema tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratewise import functions as cf
from cratewise.operators import canonical, checks, dimensions, history, sample
from cratewise.operators.skew import ROWS_PER_SALT
from cratewise.plans.build import BuildReport, Catalogue, build
from cratewise.plans.delta import delta_outputs
from cratewise.plans.sample_dump import sample_dump
from cratewise.sources.history import read_history
from cratewise.sources.manifest import catalogue_manifest
from cratewise.sources.sinks import TARGETS
from cratewise.sources.stage import Stage, run_together
from cratewise.sources.tsv import load_all, load_audit, write_tsv
from verification import adapters
from verification.adapters import Star, catalogue_tables

Query = Callable[[SparkSession, str], DataFrame]


# Rows per salt at which the joins of small tables are salted too, and the tag of the built versions.
SALTED_ROWS = 200
DUMP_VERSION = "20260101-000000"

# Outputs that are registered by way of a delta build too.
DELTA_OUTPUTS = ("recording", "text_lookup", "link_lookup", "artists")

# Plays per file where the history is written as JSON arrays.
FILE_PLAYS = 1_000


def _catalogue(spark: SparkSession, sf_dir: str, rows_per_salt: int = ROWS_PER_SALT) -> Catalogue:
    stage = Stage(spark)
    views = catalogue_tables(spark, sf_dir)
    staged = stage.save_all({f"view_{name}": df for name, df in views.items()})
    return Catalogue(dict(zip(views, staged.values())), stage, rows_per_salt)


def norm_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = Star(spark, sf_dir)
    documents = star.documents.select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("text_id"), "text"
    )
    turns = star.conversations.select(
        F.concat_ws("-", F.lit("c"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
        .alias("text_id"),
        "text",
    )
    return documents.unionByName(turns).select("text_id", cf.norm("text").alias("normalized"))


def length_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.recording(Star(spark, sf_dir))
    return rows.select("id", "length", cf.length_bucket("length").alias("length_bucket"))


def repair_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ["date_year", "date_month", "date_day"]
    rows = adapters.release_country(Star(spark, sf_dir))
    repaired = cf.repair_date(*[F.col(p) for p in parts])
    return rows.select("release", *parts, repaired.alias("repaired_date"))


def earliest_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = Star(spark, sf_dir)
    return canonical.earliest_dates(
        adapters.release_country(star), adapters.release_unknown_country(star)
    )


def official_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.official_releases(adapters.release(Star(spark, sf_dir)))


def release_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.release_names(adapters.release(Star(spark, sf_dir)))


def type_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every release against its group: type score plus credit bonus."""
    star = Star(spark, sf_dir)
    groups = canonical.typed_release_groups(adapters.release_group(star), adapters.rg_type(star))
    releases = adapters.release(star).select("id", "release_group", "artist_credit")
    bonus = cf.credit_bonus(F.col("release_group_artist_credit"), F.col("artist_credit"))
    return releases.join(groups, "release_group", "left").select(
        "id",
        "release_group_type",
        F.coalesce("type_score", F.lit(0)).alias("base_score"),
        bonus.alias("bonus"),
    )


def url_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.url(Star(spark, sf_dir))
    return rows.select("id", cf.url_identifier("url").alias("url_identifier"))


def url_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.url(Star(spark, sf_dir))
    return rows.select(
        "id",
        cf.url_provider("url").alias("provider"),
        cf.has_provider("url").alias("known"),
    )


def wikidata_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = Star(spark, sf_dir)
    return dimensions.artist_wikidata(adapters.l_artist_url(star), adapters.url(star))


def normalize_recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.normalize_recordings(adapters.recording(Star(spark, sf_dir)))


def scored_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = catalogue_tables(spark, sf_dir)
    return canonical.score_candidates(
        canonical.normalize_recordings(t["recording"]),
        t["track"],
        t["medium"],
        t["release"],
        canonical.earliest_dates(t["release_country"], t["release_unknown_country"]),
        t["release_group"],
        t["rg_type"],
    )


def canonical_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical.canonical_rank(scored_candidates(spark, sf_dir))


def canonical_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalogue = _catalogue(spark, sf_dir)
    return canonical.canonical_map(catalogue.recordings, catalogue.rank, catalogue.hot)


def _output(name: str, rows_per_salt: int = ROWS_PER_SALT) -> Query:
    return lambda spark, sf_dir: getattr(_catalogue(spark, sf_dir, rows_per_salt), name)()


def _build(spark: SparkSession, sf_dir: str) -> BuildReport:
    """The views written as a dump, and the whole build from it, read back."""
    folder = Stage(spark).path
    write_dump(spark, sf_dir, f"{folder}/dump")
    return build(spark, f"{folder}/dump", f"{folder}/out", DUMP_VERSION)


def _built(name: str) -> Query:
    return lambda spark, sf_dir: _build(spark, sf_dir).outputs[name]


def built_load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _build(spark, sf_dir).audit


def built_pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.pk_violations(_build(spark, sf_dir).outputs)


def built_not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.not_null_violations(_build(spark, sf_dir).outputs)


def built_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.stored_layout(_build(spark, sf_dir).outputs)


def earlier_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """An earlier version of the views: rows of every table that differ, are missing or are more."""
    t = dict(tables)
    key = F.col("id")
    t["recording"] = t["recording"].filter(key % 89 != 3).withColumns(
        {
            "name": F.when(key % 97 == 0, F.concat("name", F.lit(" early"))).otherwise(F.col("name")),
            "length": F.when(key % 83 == 5, F.col("length") + 90_000).otherwise(F.col("length")),
        }
    )
    more = t["track"].filter(key % 101 == 0).withColumn("id", -key)
    t["track"] = t["track"].filter(key % 71 != 0).unionByName(more)
    t["medium"] = t["medium"].withColumn("release", F.when(key % 73 == 0, F.col("release") + 1).otherwise(F.col("release")))
    status = F.when(key % 67 == 0, F.lit(1)).otherwise(F.col("status"))
    t["release"] = t["release"].withColumn("status", status.cast(t["release"].schema["status"].dataType))
    kind = F.when(key % 59 == 0, F.lit(1)).otherwise(F.col("type"))
    t["release_group"] = t["release_group"].withColumn("type", kind.cast(t["release_group"].schema["type"].dataType))
    t["release_country"] = t["release_country"].filter("release % 53 != 0")
    t["release_unknown_country"] = t["release_unknown_country"].filter("release % 47 != 0")
    t["artist"] = t["artist"].withColumn("name", F.when(key % 29 == 0, F.lit("Early")).otherwise(F.col("name")))
    t["artist_credit_name"] = t["artist_credit_name"].filter("artist_credit % 31 != 0 or position = 0")
    t["url"] = t["url"].withColumn("url", F.when(key % 37 == 0, F.lit("https://early.example/")).otherwise(F.col("url")))
    t["l_recording_url"] = t["l_recording_url"].filter("entity1 % 41 != 0")
    t["l_artist_url"] = t["l_artist_url"].filter("entity1 % 43 != 0")
    return t


def _delta(name: str) -> Query:
    """An output of the views by way of an earlier version of them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        later = _catalogue(spark, sf_dir)
        first = Catalogue(earlier_tables(dict(later.tables)), Stage(spark))
        outputs = first.stage.save_all(first.outputs())
        return delta_outputs(first.tables, later.tables, outputs, first.rank, later.stage)[0][name]

    return run


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_audit(catalogue_tables(spark, sf_dir))


def write_dump(spark: SparkSession, sf_dir: str, directory: str) -> None:
    """The views as a dump. Track ids outgrow its 32-bit column, so they are NULL in the file."""
    manifest = catalogue_manifest()
    tables = catalogue_tables(spark, sf_dir)
    tables["track"] = tables["track"].drop("id")
    paths = {name: f"{directory}/{spec.file_name}" for name, spec in manifest.items()}
    run_together(lambda name: write_tsv(tables[name], paths[name], manifest[name]), tables)


def tsv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the views as a dump, read it back by the manifest, and join what was read."""
    directory = f"{Stage(spark).path}/dump"
    manifest = catalogue_manifest()
    write_dump(spark, sf_dir, directory)
    tables = load_all(spark, directory, manifest)
    tracks = tables["track"].groupBy(F.col("recording").alias("id")).agg(
        F.count(F.lit(1)).alias("tracks"), F.min("name").alias("first_track")
    )
    return tables["recording"].join(tracks, "id", "left")


def _staged_outputs(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The named output tables, written once because the checks and consumers read them often."""
    catalogue = _catalogue(spark, sf_dir)
    wanted = names or tuple(TARGETS)
    return catalogue.stage.save_all({n: getattr(catalogue, n)() for n in wanted})


def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.pk_violations(_staged_outputs(spark, sf_dir), absent=["text_lookup"])


def not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.not_null_violations(_staged_outputs(spark, sf_dir), absent=["text_lookup.id"])


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.orphans(_staged_outputs(spark, sf_dir))


def lookup_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.lookup_cardinality(
        _staged_outputs(spark, sf_dir, "recording", "link_lookup", "text_lookup")
    )


def _sample_sets(spark: SparkSession, sf_dir: str) -> tuple[dict, dict]:
    tables = catalogue_tables(spark, sf_dir)
    return tables, sample.sample_keys(tables, sample.SAMPLE_RELEASES, Stage(spark))


def closed_sample_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.sample_statistics(_sample_sets(spark, sf_dir)[1])


def closed_sample_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_audit(sample.closed_sample(*_sample_sets(spark, sf_dir)))


def closed_sample_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.closed_sample(*_sample_sets(spark, sf_dir))["track"]


def sampled_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table of a sample that was written as a dump and is read back by the manifest."""
    folder, manifest = Stage(spark).path, catalogue_manifest()
    write_dump(spark, sf_dir, f"{folder}/dump")
    sample_dump(spark, f"{folder}/dump", f"{folder}/sample")
    return load_audit(load_all(spark, f"{folder}/sample", manifest))


def _read_plays(spark: SparkSession, folder: str, lines: bool) -> DataFrame:
    return read_history(spark, folder, lines).select(
        F.col("ts").cast("bigint").alias("event_id"),
        F.col("platform").cast("bigint").alias("user_id"),
        "ms_played",
        F.col("spotify_track_uri").alias("uri"),
        F.col("master_metadata_track_name").alias("track"),
        F.col("master_metadata_album_album_name").alias("album"),
        F.col("master_metadata_album_artist_name").alias("artist"),
    )


def _play_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plays with the fields of a record; ids travel in two of its text fields."""
    plays = adapters.history(spark, sf_dir)
    texts = {"ts": F.col("event_id").cast("string"), "platform": F.col("user_id").cast("string")}
    return plays.withColumns(texts)


def history_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the plays as JSON arrays, a file for each range of event ids, and read them back."""
    folder = f"{Stage(spark).path}/history"
    plays = _play_records(spark, sf_dir)
    record = F.struct(*[c for c in plays.columns if c not in ("event_id", "user_id")])
    files = plays.groupBy(F.floor(F.col("event_id") / FILE_PLAYS).alias("file")).agg(
        F.to_json(F.collect_list(record)).alias("value")
    )
    files.write.partitionBy("file").text(folder)
    return _read_plays(spark, folder, lines=False)


def history_scan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the plays as JSON lines and read them back."""
    folder = f"{Stage(spark).path}/history"
    _play_records(spark, sf_dir).drop("event_id", "user_id").write.json(folder)
    return _read_plays(spark, folder, lines=True)


def _staged_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plays as a stored table, which they are in practice."""
    return Stage(spark).save("history", adapters.history(spark, sf_dir))


def history_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _staged_outputs(spark, sf_dir, "link_lookup", "text_lookup", "recording")
    plays = _staged_history(spark, sf_dir)
    return history.resolve_history(
        plays, out["link_lookup"], out["text_lookup"], out["recording"]
    ).select(
        "event_id", "user_id", "ms_played", "recording_mbid", "matched_by", "release_group_mbid"
    )


def plays_per_release_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _staged_outputs(
        spark, sf_dir, "link_lookup", "text_lookup", "recording", "release_group"
    )
    return history.plays_per_release_group(
        _staged_history(spark, sf_dir),
        out["link_lookup"],
        out["text_lookup"],
        out["recording"],
        out["release_group"],
    )


def ordered_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalogue = _catalogue(spark, sf_dir)
    credits = catalogue.stage.save("credits", catalogue.recording_artists())
    return history.ordered_credits(credits, catalogue.artists(), "recording_mbid")


def release_group_ordered_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalogue = _catalogue(spark, sf_dir)
    credits = catalogue.stage.save("credits", catalogue.release_group_artists())
    return history.ordered_credits(credits, catalogue.artists(), "release_group_mbid")


def track_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalogue = _catalogue(spark, sf_dir)
    recording = catalogue.stage.save("recording", catalogue.recording())
    return history.track_details(recording, catalogue.release_group(), catalogue.artists())


QUERIES: dict[str, Query] = {
    "norm_text": norm_text,
    "length_bucket": length_bucket,
    "repair_date": repair_date,
    "earliest_dates": earliest_dates,
    "official_releases": official_releases,
    "release_names": release_names,
    "type_score": type_score,
    "url_identifier": url_identifier,
    "url_provider": url_provider,
    "wikidata_ids": wikidata_ids,
    "normalize_recordings": normalize_recordings,
    "scored_candidates": scored_candidates,
    "canonical_rank": canonical_rank,
    "canonical_map": canonical_map,
    "dim_release_group": _output("release_group"),
    "dim_artist": _output("artists"),
    "dim_recording": _output("recording"),
    "recording_credits": _output("recording_artists"),
    "release_group_credits": _output("release_group_artists"),
    "text_lookup": _output("text_lookup"),
    "link_lookup": _output("link_lookup"),
    "load_audit": audit,
    "tsv_scan": tsv_scan,
    "pk_violations": pk_violations,
    "not_null_violations": not_null_violations,
    "orphans": orphans,
    "lookup_cardinality": lookup_cardinality,
    "closed_sample_stats": closed_sample_stats,
    "closed_sample_counts": closed_sample_counts,
    "closed_sample_track": closed_sample_track,
    "history_resolve": history_resolve,
    "plays_per_release_group": plays_per_release_group,
    "ordered_credits": ordered_credits,
    "release_group_ordered_credits": release_group_ordered_credits,
    "track_details": track_details,
    **{f"built_{name}": _built(name) for name in TARGETS},
    "built_load_audit": built_load_audit,
    "built_layout": built_layout,
    "built_pk_violations": built_pk_violations,
    "built_not_null_violations": built_not_null_violations,
    **{f"salted_{name}": _output(name, SALTED_ROWS) for name in TARGETS},
    **{f"delta_{name}": _delta(name) for name in DELTA_OUTPUTS},
    "sampled_dump": sampled_dump,
    "history_scan": history_scan,
    "history_scan_lines": history_scan_lines,
}
