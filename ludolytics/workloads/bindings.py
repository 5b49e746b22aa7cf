"""The given tables in the roles the plans expect.

Reviews are line items with their orders, games are parts (landed twice, the first
time before some were reclassified), vectors, pages, documents, events and
conversations play themselves.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolytics import schemas
from ludolytics.plans import warehouse
from ludolytics.session import scratch_path


@lru_cache(maxsize=None)
def _schema(path: str):
    """Schema of a given table; these never change, so the footer is read once."""
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(_schema(path)).parquet(path)


def _as_schema(df: DataFrame, schema) -> DataFrame:
    present = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f.name if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schema.fields
        ]
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = joined.selectExpr(
        "l_orderkey * 10 + l_linenumber AS rec_id",
        "nullif(o_custkey, 0) AS author_id",
        "l_partkey AS appid",
        "o_orderpriority AS review",
        "unix_seconds(CAST(l_shipdate AS timestamp)) AS timestamp_created",
        "l_returnflag <> 'R' AS voted_up",
        "l_quantity AS votes_up",
        "l_discount AS weighted_vote_score",
        "l_linenumber AS comment_count",
        "o_orderstatus = 'P' AS written_during_early_access",
        "trunc(o_orderdate, 'MM') AS scrape_date",
    )
    return _as_schema(rows, schemas.REVIEWS)


_RELEASE = "date_add(DATE'1994-01-01', p_size * 50)"


def raw_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS appid",
        "CASE WHEN p_size <> 13 THEN concat(p_name, ' ', p_brand) END AS name",
        "CASE WHEN p_type = 'PROMO' THEN 'dlc' ELSE 'game' END AS type",
        "p_retailprice < 920 AS is_free",
        "concat_ws(' ', p_name, p_brand, p_type) AS detailed_description",
        "p_brand AS about_the_game",
        "p_name AS short_description",
        "CASE WHEN p_size = 1 THEN cast(array() AS array<string>) ELSE array(p_brand) END AS developers",
        "array(p_brand, p_type) AS publishers",
        "split(p_name, ' ') AS categories",
        "array(p_type, p_brand) AS genres",
        f"""CASE WHEN p_type IN ('STANDARD', 'ECONOMY') THEN date_format({_RELEASE}, 'MMM d, yyyy')
                 WHEN p_type IN ('MEDIUM', 'LARGE') THEN date_format({_RELEASE}, 'd MMM, yyyy')
                 ELSE 'Coming soon' END AS release_date""",
        "p_size > 48 AS coming_soon",
        "cast(nullif(p_size, 7) AS bigint) AS review_score",
        """CASE WHEN p_size >= 40 THEN 'Very Positive' WHEN p_size >= 25 THEN 'Mostly Positive'
                WHEN p_size >= 10 THEN 'Mixed' ELSE 'Unrated' END AS review_score_desc""",
        "p_size",
    )
    first = games.where("p_size <= 25").withColumn("type", F.lit("game")).withColumn(
        "scrape_date", F.lit("2001-01-01").cast("date")
    )
    second = games.withColumn("scrape_date", F.lit("2001-06-01").cast("date"))
    return _as_schema(first.unionByName(second), schemas.GAMES)


def app_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("appid"), F.col("p_name").alias("name"))
    others = table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1_000_000_000).alias("appid"), F.col("s_name").alias("name")
    )
    return parts.unionByName(others)


def models(spark: SparkSession, sf_dir: str) -> warehouse.Models:
    """The layer graph with only its game-level models written."""
    return warehouse.Models(
        raw_games(spark, sf_dir),
        raw_reviews(spark, sf_dir),
        scratch_path(spark, "games"),
        warehouse.Models.GAME_LEVEL,
    )


def stored_models(spark: SparkSession, sf_dir: str) -> warehouse.Models:
    """The layer graph with all shared models written once."""
    return warehouse.Models(raw_games(spark, sf_dir), raw_reviews(spark, sf_dir), scratch_path(spark, "warehouse"))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("game_id"), "embedding")


def label_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(query_id, embedding): the mean vector of each label; one row per label."""
    parts = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("x"))
    packed = F.sort_array(F.collect_list(F.struct("i", "x")))
    return means.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(packed, lambda e: e["x"]).alias("embedding")
    )
