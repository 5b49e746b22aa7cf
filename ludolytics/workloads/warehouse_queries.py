"""Staging, deduplication, dimensions, facts and marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ludolytics.plans import recommend, warehouse
from ludolytics.workloads import bindings as b
from ludolytics.workloads.oracle import FACT_SELECT, GAME_SELECT, NULLABLE, day, items, layered, ts
from ludolytics.workloads.registry import workload

_STG_GAMES = f"""
game_id, game_name, game_is_free, {items('game_developers')} AS game_developers,
{items('game_publishers')} AS game_publishers, {items('game_categories')} AS game_categories,
{items('game_genres')} AS game_genres, {ts('game_release_date')} AS game_release_date, game_about,
game_short_description, game_detailed_description, CAST(game_review_score AS VARCHAR) AS game_review_score,
game_review_score_description,
{day('game_scrape_date')} AS game_scrape_date
"""


@workload("stg_reviews", "S01 S07 P01 P02 F07", layered(f"SELECT {FACT_SELECT} FROM stg_reviews"), NULLABLE)
def _(spark, d):
    return warehouse.stg_reviews(b.raw_reviews(spark, d))


@workload("stg_games", "S02 S06 P03 P04 P05 F01 F06", layered(f"SELECT {_STG_GAMES} FROM stg_games"), NULLABLE)
def _(spark, d):
    return warehouse.stg_games(b.raw_games(spark, d))


@workload("non_game_ids", "R03", layered("SELECT appid FROM non_game_ids"))
def _(spark, d):
    return warehouse.non_game_ids(b.raw_games(spark, d))


@workload(
    "new_ids_to_scrape",
    "S03 J04",
    layered("""
SELECT appid FROM app_ids a
WHERE NOT EXISTS (SELECT 1 FROM stg_games g WHERE g.game_id = a.appid)
  AND NOT EXISTS (SELECT 1 FROM non_game_ids n WHERE n.appid = a.appid)"""),
)
def _(spark, d):
    games = b.raw_games(spark, d)
    return warehouse.new_ids_to_scrape(
        b.app_ids(spark, d), warehouse.stg_games(games), warehouse.non_game_ids(games)
    )


@workload("int_deduplicated_games", "R01", layered(f"SELECT {_STG_GAMES} FROM int_deduplicated_games"), NULLABLE)
def _(spark, d):
    return b.models(spark, d)["int_deduplicated_games"]


@workload("int_canonical_game_ids", "J01", layered("SELECT * FROM int_canonical_game_ids"))
def _(spark, d):
    return b.models(spark, d)["int_canonical_game_ids"]


@workload(
    "int_reviews_with_canonical_id",
    "J02 J03 F01",
    layered(f"SELECT {FACT_SELECT} FROM int_reviews_with_canonical_id"),
    NULLABLE,
)
def _(spark, d):
    m = b.models(spark, d)
    return warehouse.int_reviews_with_canonical_id(
        m["stg_reviews"], m["int_canonical_game_ids"], m["int_deduplicated_games"]
    )


@workload("int_deduplicated_reviews", "R02", layered(f"SELECT {FACT_SELECT} FROM int_deduplicated_reviews"), NULLABLE)
def _(spark, d):
    return b.models(spark, d)["int_deduplicated_reviews"]


@workload("dim_games", "X01 G01 J05 P06 P07 P08 F02", layered(f"SELECT {GAME_SELECT} FROM dim_games"), NULLABLE)
def _(spark, d):
    return b.models(spark, d)["dim_games"]


@workload(
    "dim_users",
    "G02",
    layered(f"""
SELECT CAST(user_id AS VARCHAR) AS user_id, {ts('first_review_timestamp')} AS first_review_timestamp
FROM dim_users"""),
    NULLABLE,
)
def _(spark, d):
    return b.models(spark, d)["dim_users"]


@workload("fact_reviews", "J06", layered(f"SELECT {FACT_SELECT} FROM fact_reviews"), NULLABLE)
def _(spark, d):
    return b.stored_models(spark, d)["fact_reviews"]


@workload(
    "fact_reviews_from_stored_dims",
    "J06 S10",
    layered(f"SELECT {FACT_SELECT} FROM fact_reviews"),
    NULLABLE,
)
def _(spark, d):
    m = b.stored_models(spark, d)
    return warehouse.fact_reviews(m["int_deduplicated_reviews"], m["dim_games"], m["dim_users"])


@workload(
    "mart_entity_daily_counts",
    "G03 G04 G05 J07 U01 P09 F03",
    layered(f"""
SELECT {day('review_day')} AS review_day, daily_reviews_count, new_users, daily_games_count
FROM mart_entity_daily_counts"""),
)
def _(spark, d):
    return b.stored_models(spark, d)["mart_entity_daily_counts"]


_CUMULATIVE = f"""
SELECT {day('review_day')} AS review_day, cumulative_review_count, cumulative_user_count, cumulative_game_count
FROM mart_entities_cumulative"""


@workload("mart_entities_cumulative", "W01", layered(_CUMULATIVE))
def _(spark, d):
    return b.stored_models(spark, d)["mart_entities_cumulative"]


@workload("entities_on_day", "P17", layered(_CUMULATIVE + " WHERE review_day = DATE '1999-12-31'"))
def _(spark, d):
    return warehouse.entities_on(b.stored_models(spark, d)["mart_entities_cumulative"], date(1999, 12, 31))


@workload(
    "vocabulary_sizes",
    "M05",
    layered("""
SELECT cumulative_user_count AS num_users, cumulative_game_count AS num_games
FROM mart_entities_cumulative WHERE review_day = DATE '1999-12-31'"""),
)
def _(spark, d):
    return recommend.vocabulary_sizes(b.stored_models(spark, d)["mart_entities_cumulative"], date(1999, 12, 31))


@workload(
    "newest_app_rows",
    "R03 K09",
    layered(f"""
SELECT appid, type, {day('scrape_date')} AS scrape_date
FROM raw_games QUALIFY row_number() OVER (PARTITION BY appid ORDER BY scrape_date DESC) = 1"""),
)
def _(spark, d):
    games = b.raw_games(spark, d).select("appid", "type", "scrape_date")
    return warehouse.latest_per_key(games, ["appid"], [F.col("scrape_date").desc_nulls_last()])
