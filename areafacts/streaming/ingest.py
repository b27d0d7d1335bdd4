"""File streams into keyed tables, and bounded-state de-duplication."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from areafacts.plans.feeds import FEEDS, Feed, load
from areafacts.sources.keyed import KeyedTable


def ingest(
    stream: DataFrame,
    clean: Callable[[DataFrame], DataFrame],
    store: KeyedTable,
    checkpoint: str,
    null_safe: bool = False,
    evolve: bool = False,
) -> StreamingQuery:
    """Merge everything that has arrived since the last run into ``store``.

    ``clean`` must leave one row per key in a micro-batch. The last arrival wins
    as with successive batch merges. A micro-batch that is replayed after a failure
    leaves the table as it is, rows with null keys included: they carry the batch's
    name, and no streaming state is kept. Stops when the available input is used
    up; run it again (daily, weekly) for the next files.
    """

    def apply(batch: DataFrame, name: str) -> None:
        store.merge(clean(batch), null_safe=null_safe, evolve=evolve, batch=name)

    return _each_batch(stream, apply, checkpoint)


def _each_batch(stream: DataFrame, apply: Callable[[DataFrame, str], None], checkpoint: str) -> StreamingQuery:
    """``apply`` to each micro-batch, with a name that it has in every replay."""
    return (
        stream.writeStream.foreachBatch(
            lambda batch, number: apply(batch, f"{_query_id(batch.sparkSession, checkpoint)}-{number}")
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the checkpoint gives its query for good; a new checkpoint is a new query."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").head()[0])["id"]


def ingest_feed(
    spark: SparkSession,
    feed: str | Feed,
    folder: str,
    like: str,
    store: KeyedTable,
    checkpoint: str,
    max_files: int | None = None,
    **options,
) -> StreamingQuery:
    """Ingest the deliveries of a feed that have been dropped into ``folder``.

    ``like`` is a file with the layout of the deliveries (wide tables are each read
    by their own header), and ``options`` go to the feed's cleaning function. Where
    files of one micro-batch bring the same key, the one written last wins, just as
    if they had been merged one by one. Rejects go to ``rejects/`` under the table's
    root, a folder for each micro-batch.
    """
    spec = FEEDS[feed] if isinstance(feed, str) else feed
    stream = spec.stream(spark, folder, like, max_files)

    def apply(batch: DataFrame, name: str) -> None:
        load(spec, spec.groups(batch), store, name, batch=name, **options)

    return _each_batch(stream, apply, checkpoint)


def dedupe(stream: DataFrame, keys: Sequence[str], time_col: str, delay: str) -> DataFrame:
    """First row per key among copies that arrive within ``delay`` of each other.

    State is dropped once the watermark passes, so it does not grow with the
    stream. A time column without zone is read in the session's zone.
    """
    timed = stream.withColumn(time_col, stream[time_col].cast("timestamp"))
    return timed.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(list(keys))
