"""Resolve listening history as its files arrive: as a stateless stream-static join, or batch by batch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from cratewise.operators.history import (
    LINK_KEY,
    TEXT_KEY,
    history_keys,
    reduced_lookups,
    resolve_reduced,
    with_lookup_keys,
)
from cratewise.operators.skew import ROWS_PER_SALT, HotKeys
from cratewise.sources.stage import Stage


def resolve_stream(
    history: DataFrame, link_lookup: DataFrame, text_lookup: DataFrame, recording: DataFrame
) -> DataFrame:
    """Plays of a stream with recording, release group and ``matched_by``. Keeps no state.

    The lookups are reduced to one recording per key and stored before the stream starts; its batches
    only join them. They hold what the lookups held then: start the stream anew after a build. Each key
    has one row there, and plays without a key are spread, but the keys of plays that are yet to come
    cannot be counted: adaptive execution does not split a batch, so keep batches small, or use
    :func:`resolve_batches`.
    """
    stored = _stored_lookups(link_lookup, text_lookup, recording, Stage(link_lookup.sparkSession))
    return resolve_reduced(with_lookup_keys(history), stored["links"], stored["texts"], HotKeys.none())


def _stored_lookups(
    link_lookup: DataFrame, text_lookup: DataFrame, recording: DataFrame, stage: Stage
) -> dict[str, DataFrame]:
    counted = history_keys(None, link_lookup, text_lookup)
    links, texts = reduced_lookups(link_lookup, text_lookup, recording, HotKeys.find(counted))
    return stage.save_all({"links": links, "texts": texts})


def resolve_batches(
    history: DataFrame,
    link_lookup: DataFrame,
    text_lookup: DataFrame,
    recording: DataFrame,
    path: str,
    checkpoint: str,
    rows_per_salt: int = ROWS_PER_SALT,
) -> StreamingQuery:
    """Write the rows of :func:`resolve_stream` so that a key with most of a batch's plays stays balanced.

    Each micro-batch is stored and its keys are counted, as those of a stored history are; the joins of that
    batch are salted accordingly. A batch goes to a folder ``batch=<number>`` of its own, which a batch that
    runs again after a failure replaces, so no play is lost or doubled. Stops once all files present at the
    start are done.
    """
    stage = Stage(link_lookup.sparkSession)
    stored = _stored_lookups(link_lookup, text_lookup, recording, stage)

    def resolve_batch(plays: DataFrame, number: int) -> None:
        keyed = stage.save(f"plays-{number}-{uuid.uuid4().hex}", with_lookup_keys(plays))
        counted = {"history.link": keyed.select(*LINK_KEY), "history.text": keyed.select(*TEXT_KEY)}
        resolved = resolve_reduced(
            keyed, stored["links"], stored["texts"], HotKeys.find(counted, rows_per_salt)
        )
        resolved.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        history.writeStream.foreachBatch(resolve_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_resolved(resolved: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet and stop once all files present at the start are done."""
    return (
        resolved.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
