"""Scans with fixed schemas and month-pruned feature loads."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludolytics import schemas
from ludolytics.operators.keyed import latest_per_key


def scan_reviews(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.REVIEWS).parquet(path)


def scan_games(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.GAMES).parquet(path)


def scan_app_ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.APP_IDS).parquet(path)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def register_view_if_absent(spark: SparkSession, name: str, path: str) -> bool:
    """Create a view over a Parquet glob; False when the name is already taken."""
    if table_exists(spark, name):
        return False
    spark.read.parquet(path).createTempView(name)
    return True


def read_if_present(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The Parquet table at ``path``, or None when nothing has been written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


# which month column each feature table is partitioned by
MONTH_COLUMN = {"game": "game_review_month", "user": "current_month", "reviews": "current_month"}


def load_data(spark: SparkSession, paths: dict[str, str], cutoff: str, dataset_type: str) -> DataFrame:
    """Rows of a feature table up to and including ``cutoff`` (``YYYY-MM-DD``).

    The comparison is on the partition column, so later months are not read.
    """
    if dataset_type not in MONTH_COLUMN:
        raise ValueError(f"unknown dataset type: {dataset_type}")
    day = datetime.strptime(cutoff, "%Y-%m-%d").date()
    column = MONTH_COLUMN[dataset_type]
    return spark.read.parquet(paths[dataset_type]).where(F.col(column) <= F.lit(day))


def load_watermarks(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Newest processed time per game: the last write of each key, if not NULL.

    ``before`` ignores updates numbered ``before`` or later.
    """
    schema = T.StructType([*schemas.WATERMARKS.fields, T.StructField("update_no", T.LongType())])
    log = read_if_present(spark, path, schema)
    if log is None:
        return spark.createDataFrame([], schemas.WATERMARKS)
    if before is not None:
        log = log.where(F.col("update_no") < before)
    latest = latest_per_key(log, ["game_id"], [F.col("update_no").desc()])
    return latest.where(F.col("last_processed_timestamp").isNotNull()).select(*schemas.WATERMARKS.names)


def load_model(spark: SparkSession, path: str) -> DataFrame:
    """A saved ranking (see ``save_model``)."""
    return spark.read.parquet(path)
