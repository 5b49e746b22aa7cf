"""Incremental ingest of landed review files with Structured Streaming.

Each micro-batch drops reviews at or before the processed time of their game,
removes duplicates, replaces stored rows with the same key and then moves the
processed times. Every write is numbered by the micro-batch, so a batch that is
run again after a failure replaces its own output and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludolytics import schemas
from ludolytics.operators.keyed import latest_per_key, total_order
from ludolytics.plans.ingest import drop_seen, newest_per_game
from ludolytics.sources.readers import load_watermarks, read_if_present
from ludolytics.sources.versioned import VersionedTable
from ludolytics.sources.writers import replace_batch, staged, upsert_watermarks


def stream_reviews(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files: str | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """Landed Parquet files as a stream; ``files`` limits it by a name pattern."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if files:
        reader = reader.option("pathGlobFilter", files)
    return reader.parquet(path)


def ingest_batch(
    batch: DataFrame,
    batch_no: int,
    target: str,
    state: str,
    key: str = "rec_id",
    game: str = "appid",
    seconds: str = "timestamp_created",
) -> None:
    """Write one micro-batch and advance the processed times.

    The state is read as of the batches before this one, so a repeated batch sees
    what it saw the first time. Rows are written before the state moves: a failure
    in between repeats the rows instead of losing them.
    """
    seen = load_watermarks(batch.sparkSession, state, before=batch_no)
    order = [F.col(seconds).desc_nulls_last(), *total_order(batch, skip=(key, seconds))]
    fresh = staged(latest_per_key(drop_seen(batch, seen, game, seconds), [key], order))
    replace_batch(fresh, target, key, batch_no)
    upsert_watermarks(newest_per_game(fresh, game, seconds), state, batch_no)


def merge_batch(
    batch: DataFrame,
    batch_no: int,
    target: str,
    state: str,
    key: str = "rec_id",
    game: str = "appid",
    seconds: str = "timestamp_created",
) -> None:
    """``ingest_batch`` with rows and processed times in versioned tables, keyed by review and by game.

    Only the buckets of the batch's games are read for the processed times, and only those of its reviews to replace
    rows, so what a batch costs follows the batch. The rows are committed before the times: a batch that is repeated after
    a failure between the two finds the times as they were, leaves the rows alone and moves the times.
    """
    spark = batch.sparkSession
    rows, times = VersionedTable(spark, target, key), VersionedTable(spark, state, "game_id")
    batch = staged(batch)
    known = times.manifest()
    if known is None:
        seen = spark.createDataFrame([], schemas.WATERMARKS)
    else:
        seen = times.lookup(batch.select(F.col(game).alias("game_id")))
    order = [F.col(seconds).desc_nulls_last(), *total_order(batch, skip=(key, seconds))]
    fresh = staged(latest_per_key(drop_seen(batch, seen, game, seconds), [key], order))
    rows.merge(fresh, batch_no=batch_no)
    times.merge(newest_per_game(fresh, game, seconds), batch_no=batch_no)


def run_ingest(
    reviews: DataFrame,
    target: str,
    state: str,
    checkpoint: str,
    key: str = "rec_id",
    game: str = "appid",
    seconds: str = "timestamp_created",
    load: Callable[..., None] = ingest_batch,
) -> None:
    """Process everything landed so far and stop; ``load`` is ``ingest_batch`` or ``merge_batch``."""
    query = (
        reviews.writeStream.foreachBatch(
            lambda batch, no: load(batch, no, target, state, key, game, seconds)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_ingested(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """All ingested reviews (without the batch number)."""
    stored = read_if_present(spark, target, schema)
    return spark.createDataFrame([], schema) if stored is None else stored.select(*schema.names)
