"""Cut a referentially closed sample out of a dump, line by line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cratewise.operators.sample import (
    SAMPLE_RELEASES,
    closed_sample,
    sample_keys,
    sample_statistics,
)
from cratewise.sources.manifest import catalogue_manifest
from cratewise.sources.stage import Stage, run_together
from cratewise.sources.tsv import load_all

# Columns the closure follows, where they differ from those the build keeps.
_FOLLOWED = {
    "artist": ["id"],
    "artist_credit_name": ["artist_credit", "artist"],
    "recording": ["id", "artist_credit"],
    "track": ["id", "recording", "medium", "artist_credit"],
    "release": ["id", "artist_credit", "release_group"],
    "release_group": ["id", "artist_credit"],
    "release_country": ["release"],
    "release_unknown_country": ["release"],
    "url": ["id"],
    "rg_type": ["id"],
}


def sample_dump(
    spark: SparkSession, input_dir: str, output_dir: str, n_releases: int = SAMPLE_RELEASES
) -> DataFrame:
    """Write the sampled lines, untouched, under the dump's file names; return the statistics.

    Every table is written, also without a row, so that nothing of an earlier sample stays.
    """
    manifest = catalogue_manifest()
    tables = load_all(spark, input_dir, manifest, _FOLLOWED, raw_line="line")
    sets = sample_keys(tables, n_releases, Stage(spark))

    def write(sampled: tuple[str, DataFrame]) -> None:
        name, rows = sampled
        target = f"{output_dir}/{manifest[name].file_name}"
        rows.select("line").write.mode("overwrite").text(target)

    run_together(write, closed_sample(tables, sets).items())
    return sample_statistics(sets)
