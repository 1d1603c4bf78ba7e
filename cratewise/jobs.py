"""Jobs for ``spark-submit``: build the lookup tables, tidy their folder, cut a sample, resolve listening history.

    spark-submit --py-files cratewise.zip cratewise/jobs.py build DUMP OUT --dump-version 20260101-000000
    spark-submit --py-files cratewise.zip cratewise/jobs.py update OLD_DUMP DUMP OUT --old-version A --new-version B
    spark-submit --py-files cratewise.zip cratewise/jobs.py tidy OUT --keep 2
    spark-submit --py-files cratewise.zip cratewise/jobs.py sample DUMP OUT --releases 50
    spark-submit --py-files cratewise.zip cratewise/jobs.py history HISTORY TABLES OUT

Master, memory and ``spark.checkpoint.dir`` belong to the cluster's configuration, not to the jobs.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from cratewise.operators.history import plays_per_release_group, resolve_history
from cratewise.operators.sample import SAMPLE_RELEASES
from cratewise.plans.build import build
from cratewise.plans.delta import update
from cratewise.plans.sample_dump import sample_dump
from cratewise.sources.history import read_history
from cratewise.sources.sinks import read_targets
from cratewise.sources.snapshots import SnapshotStore
from cratewise.sources.stage import Stage


def build_job(spark: SparkSession, args: argparse.Namespace) -> None:
    build(spark, args.dump, args.out, args.dump_version).audit.show(truncate=False)


def sample_job(spark: SparkSession, args: argparse.Namespace) -> None:
    sample_dump(spark, args.dump, args.out, args.releases).show(truncate=False)


def history_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """Write ``plays``, every play with its recording and album, and ``albums``, the plays of each album."""
    names = ("link_lookup", "text_lookup", "recording", "release_group")
    links, texts, recording, groups = read_targets(spark, args.tables, names, args.dump_version).values()
    plays = Stage(spark).save("plays", read_history(spark, args.history, args.lines))
    resolve_history(plays, links, texts, recording).write.mode("overwrite").parquet(f"{args.out}/plays")
    albums = plays_per_release_group(plays, links, texts, recording, groups)
    albums.write.mode("overwrite").parquet(f"{args.out}/albums")


def update_job(spark: SparkSession, args: argparse.Namespace) -> None:
    report = update(spark, args.old_dump, args.new_dump, args.out, args.old_version, args.new_version)
    report.audit.show(truncate=False)


def tidy_job(spark: SparkSession, args: argparse.Namespace) -> None:
    """Remove replaced sets of tables, and what killed builds left behind."""
    store = SnapshotStore(spark, args.out)
    gone = store.expire(args.keep) + store.remove_orphans(args.hours)
    print(f"removed {len(gone)} sets of tables")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cratewise", description=__doc__.splitlines()[0])
    jobs = top.add_subparsers(required=True)

    job = jobs.add_parser("build", help="dump in, seven tables out")
    job.add_argument("dump")
    job.add_argument("out")
    job.add_argument("--dump-version", help="tag of the dump; versions live side by side")
    job.set_defaults(run=build_job)

    job = jobs.add_parser("update", help="the tables of a new dump from those of the old one")
    job.add_argument("old_dump")
    job.add_argument("new_dump")
    job.add_argument("out")
    job.add_argument("--old-version", help="tag of the tables of the old dump")
    job.add_argument("--new-version", help="tag of the new tables")
    job.set_defaults(run=update_job)

    job = jobs.add_parser("tidy", help="remove replaced and abandoned sets of tables")
    job.add_argument("out")
    job.add_argument("--keep", type=int, default=2, help="snapshots that stay readable")
    job.add_argument("--hours", type=float, default=72, help="age from which an uncommitted set is abandoned")
    job.set_defaults(run=tidy_job)

    job = jobs.add_parser("sample", help="a referentially closed sample of a dump")
    job.add_argument("dump")
    job.add_argument("out")
    job.add_argument("--releases", type=int, default=SAMPLE_RELEASES)
    job.set_defaults(run=sample_job)

    job = jobs.add_parser("history", help="resolve plays against built tables")
    job.add_argument("history")
    job.add_argument("tables")
    job.add_argument("out")
    job.add_argument("--dump-version", help="the version of the tables to use")
    job.add_argument("--lines", action="store_true", help="one record per line instead of arrays")
    job.set_defaults(run=history_job)
    return top


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(SparkSession.builder.appName("cratewise").getOrCreate(), args)


if __name__ == "__main__":
    main()
