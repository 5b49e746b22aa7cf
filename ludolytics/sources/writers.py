"""Sinks. Feature, state and incremental tables replace whole partitions, so that
repeating a write after a failure leaves the same table as writing once."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyarrow.fs import FileSystem
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludolytics import schemas
from ludolytics.plans.quality import unique
from ludolytics.session import scratch_path
from ludolytics.sources.readers import load_watermarks, read_if_present

GAMES_PER_FILE = 10_000
REVIEWS_PER_FILE = 100_000
#: Keys, at most, that a join of a batch with its table may send to every task.
BROADCAST_KEYS = 100_000


def _overwrite_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replace the partitions present in ``df``.

    Rebalancing gathers the rows of a small partition into one file and splits a
    large one over many tasks, instead of every task writing to every partition.
    """
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def write_batches(df: DataFrame, path: str, rows_per_file: int, scrape_date: date) -> None:
    """Append landed rows below their ``scrape_date=`` folder in files of bounded size.

    All rows go to the one folder, so none are sorted by it.
    """
    (
        df.drop("scrape_date")
        .write.mode("append")
        .option("maxRecordsPerFile", rows_per_file)
        .parquet(f"{path.rstrip('/')}/scrape_date={scrape_date}")
    )


def write_month(df: DataFrame, path: str, month_col: str) -> None:
    """Replace the months present in ``df`` and leave the other months alone."""
    _overwrite_partitions(df.withColumn(month_col, F.col(month_col).cast("date")), path, month_col)


def materialize(df: DataFrame, kind: str, name: str, path: str | None = None) -> DataFrame:
    """A model as a lazy ``view`` or as a ``table`` written to ``path``."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        if path is None:
            raise ValueError("a table needs a path")
        df.write.mode("overwrite").parquet(path)
        spark.read.schema(df.schema).parquet(path).createOrReplaceTempView(name)
    else:
        raise ValueError(f"unknown kind of model: {kind}")
    return spark.table(name)


def _stored_schema(spark: SparkSession, path: str, merge: bool) -> T.StructType | None:
    """Schema of the table at ``path``; None when it has no data files yet."""
    try:
        return spark.read.option("mergeSchema", merge).parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _drop_folders(folders: list[str]) -> None:
    """Delete partition folders, named as Spark's scans name their files; a folder that is not there is an error."""
    for folder in folders:
        files, path = FileSystem.from_uri(folder)
        files.delete_dir(path)


def staged(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` written to the shared folder, in partitions by ``columns`` if given, and read back.

    Used where a frame is needed several times. Its size is then known before the
    next join, so the keys of a small batch are broadcast to a large table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "staged")
    if columns:
        df.hint("rebalance", *columns).write.partitionBy(*columns).parquet(path)
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def batch_keys(batch: DataFrame, key: str) -> DataFrame:
    """The keys of a ``staged`` batch as a side of joins with the stored table.

    Spark takes the size of their compressed files for that of the rows, which can be fifty times as large; so many keys
    are counted (in the files' footers) and shuffled.
    """
    keys = batch.select(key)
    return keys.hint("merge") if keys.count() > BROADCAST_KEYS else keys


def _replace_stored(current: DataFrame, keys: DataFrame, key: str, part: str, path: str) -> None:
    """Remove the stored rows with one of ``keys``, rewriting only their partitions."""
    # partitions by their folders: a NULL or escaped value has another name there than in the rows
    placed = current.withColumn("_folder", F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1))
    losing = staged(placed.join(keys, key, "left_semi").select("_folder").distinct())
    if losing.isEmpty():
        return
    kept = placed.join(losing, "_folder", "left_semi").join(keys, key, "left_anti")
    kept = staged(kept)
    _overwrite_partitions(kept.drop("_folder"), path, part)
    # one value per stored partition that has no row left
    left = {row[0] for row in kept.select("_folder").distinct().collect()}
    _drop_folders([row[0] for row in losing.collect() if row[0] not in left])


def replace_batch(batch: DataFrame, path: str, key: str, batch_no: int) -> None:
    """Store a ``staged`` batch as its own partition; its rows replace earlier ones by key."""
    schema = T.StructType([*batch.schema.fields, T.StructField("batch_no", T.LongType())])
    current = read_if_present(batch.sparkSession, path, schema)
    if current is not None:
        _replace_stored(current.where(F.col("batch_no") < batch_no), batch_keys(batch, key), key, "batch_no", path)
    _overwrite_partitions(batch.withColumn("batch_no", F.lit(batch_no).cast("long")), path, "batch_no")


def incremental_append(
    new: DataFrame,
    path: str,
    key: str = "review_id",
    mark: str = "scrape_date",
    resolve: Callable[[DataFrame], DataFrame] | None = None,
    on_schema_change: str = "ignore",
    full_refresh: bool = False,
) -> None:
    """Keyed incremental load of a table partitioned by its high-water mark column.

    The first load takes every row. Later loads take rows with ``mark`` strictly
    above the largest one stored (none if the table is there but empty), reduce
    them to one row per key with ``resolve``, and replace stored rows with the same
    key. With ``on_schema_change="append"`` columns the table lacks are added to it;
    ``"ignore"`` leaves them out.

    New rows always fall into new partitions. Only stored partitions that lose a
    row to the new batch are rewritten, and first: should the job die between the
    two writes, the mark has not moved and the next run completes the load.
    """
    if on_schema_change not in ("ignore", "append"):
        raise ValueError(f"unknown schema change mode: {on_schema_change}")
    spark = new.sparkSession
    resolve = resolve or (lambda df: df)
    current = None if full_refresh else read_if_present(spark, path, new.schema)
    if current is None:
        mode = "static" if full_refresh else "dynamic"
        (
            resolve(new)
            .hint("rebalance", mark)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", mode)
            .partitionBy(mark)
            .parquet(path)
        )
        return
    stored = _stored_schema(spark, path, on_schema_change == "append") or new.schema
    current = spark.read.schema(stored).parquet(path)
    high = current.agg(F.max(mark)).first()[0]
    if high is None:
        return
    batch = staged(resolve(new.where(F.col(mark) > F.lit(high))))
    if on_schema_change == "ignore":
        batch = batch.select(*[c for c in batch.columns if c in stored.names])
    _replace_stored(current, batch_keys(batch, key), key, mark, path)
    _overwrite_partitions(batch, path, mark)


def upsert_watermarks(updates: DataFrame, path: str, update_no: int) -> None:
    """Record processed times; for a key the last update wins, later or not.

    Updates are a log with one partition per number: nothing stored is rewritten,
    and repeating update ``n`` replaces update ``n``.
    """
    if updates.isEmpty():
        return
    numbered = updates.select(*schemas.WATERMARKS.names, F.lit(update_no).cast("long").alias("update_no"))
    _overwrite_partitions(numbered, path, "update_no")


def save_model(ranking: DataFrame, path: str) -> None:
    ranking.write.mode("overwrite").parquet(path)


def export_serving_games(dim_games: DataFrame, path: str | None = None, **jdbc: str) -> DataFrame:
    """The serving copy of the game dimension, keyed by ``game_id``.

    Refuses a table with repeated keys, since the serving side needs them unique.
    """
    serving = dim_games.select(*schemas.SERVING_GAME_COLUMNS)
    if not unique(serving, "game_id").isEmpty():
        raise ValueError("game_id is not unique")
    if path is not None:
        serving.write.mode("overwrite").parquet(path)
    if jdbc:
        serving.write.format("jdbc").options(**jdbc).mode("overwrite").save()
    return serving


def compact_watermarks(spark: SparkSession, source: str, target: str) -> None:
    """Write the current state of a watermark log as a one-update log elsewhere."""
    upsert_watermarks(load_watermarks(spark, source), target, 0)
