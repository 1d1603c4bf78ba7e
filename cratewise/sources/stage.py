"""Stage area: intermediates that several outputs read are written once and read back."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return tempfile.mkdtemp(prefix="cratewise-")


_Item = TypeVar("_Item")
_Result = TypeVar("_Result")

# Jobs submitted side by side: the tail of one then overlaps with the start of the next.
CONCURRENT_JOBS = 8


def run_together(job: Callable[[_Item], _Result], items: Iterable[_Item]) -> list[_Result]:
    """Run independent Spark actions from several driver threads; results in the order of items."""
    with ThreadPoolExecutor(CONCURRENT_JOBS) as pool:
        return list(pool.map(job, items))


# Rows for which a file of a staged table is worth a task, where a caller knows how many rows there may be.
FILE_ROWS = 4096


class Stage:
    """A fresh folder per run. A staged table has no lineage, so a lost executor costs one re-read."""

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self.spark = spark
        self.path = f"{folder or shared_folder(spark)}/stage-{uuid.uuid4().hex}"

    def save(self, name: str, df: DataFrame, rows: int | None = None) -> DataFrame:
        """Write a frame and read it back.

        With ``rows``, a bound of its rows that the caller knows, its last tasks are merged until each may write
        ``FILE_ROWS``; every core keeps one. So a small table is not many tiny files, each with its own open,
        commit and later read, and the number of files grows with the table.
        """
        if rows is not None:
            df = df.coalesce(max(self.spark.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))
        target = f"{self.path}/{name}"
        df.write.parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def save_bucketed(self, name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """:meth:`save` as a table dealt out by ``keys``, as shuffles are.

        Joins on exactly these keys read it as it lies; only their other side is shuffled. There are as many
        buckets as shuffle partitions, with one sorted file for each. The table's name lives in the session's
        catalogue and its files in the stage folder.
        """
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        table = re.sub(r"\W", "_", f"{self.path.rsplit('/', 1)[-1]}_{name}")
        (
            df.repartition(buckets, *keys)
            .write.format("parquet")
            .bucketBy(buckets, *keys)
            .sortBy(*keys)
            .option("path", f"{self.path}/{name}")
            .saveAsTable(table)
        )
        return self.spark.table(table)

    def save_all(self, frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """:meth:`save` of independent frames, side by side."""
        return dict(zip(frames, run_together(lambda item: self.save(*item), frames.items())))
