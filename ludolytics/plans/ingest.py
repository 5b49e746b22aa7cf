"""Landed JSON bodies to typed rows, and the per-game cutoff of new reviews."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolytics import schemas
from ludolytics.functions.arrays import no_longs
from ludolytics.functions.text import clean_html, first_integer, language_list, strip_chars, strip_tags


def _json(text: Column | str, schema) -> Column:
    return F.from_json(text, schema)


def _stamp(scrape_date: date | None) -> Column:
    return F.lit(scrape_date) if scrape_date else F.current_date()


def parse_app_list(landed: DataFrame, body: str = "body") -> DataFrame:
    """Distinct (appid, name); names are trimmed after the duplicates are removed."""
    apps = landed.select(F.explode(_json(body, schemas.APP_LIST)["applist"]["apps"]).alias("app"))
    pairs = apps.select("app.appid", "app.name").dropDuplicates(["appid", "name"])
    return pairs.withColumn("name", strip_chars("name"))


def _filled(text: Column) -> Column:
    return F.coalesce(text != "", F.lit(False))


def _not_empty(items: Column) -> Column:
    return F.coalesce(F.size(items) > 0, F.lit(False))


def flatten_game_payload(
    landed: DataFrame,
    appid: str = "appid",
    details: str = "details",
    reviews: str = "reviews",
    scrape_date: date | None = None,
) -> DataFrame:
    """The 28 game columns from a details body and a reviews body per app.

    Keeps apps whose request succeeded, that have a review list, a short
    description, languages, requirements, genres and categories.
    """
    parsed = landed.select(
        appid,
        _json(details, schemas.GAME_BODY).alias("d"),
        _json(reviews, schemas.REVIEW_PAGE).alias("r"),
    ).select(
        appid,
        F.col("d.success").alias("success"),
        F.col("d.data").alias("a"),
        _json(F.col("d.data.pc_requirements"), schemas.PC_REQUIREMENTS).alias("pc"),
        F.col("r.reviews").alias("review_list"),
        F.col("r.query_summary").alias("summary"),
    )
    # an empty object and an empty list both mean "no requirements"
    has_pc = ~F.coalesce(F.regexp_replace("a.pc_requirements", r"\s", ""), F.lit("")).isin("", "[]", "{}", "null")
    complete = parsed.where(
        F.coalesce(F.col("success"), F.lit(False))
        & F.col("review_list").isNotNull()
        & F.coalesce(F.col("a.short_description") != "", F.lit(True))
        & _filled(F.col("a.supported_languages"))
        & has_pc
        & _not_empty(F.col("a.genres"))
        & _not_empty(F.col("a.categories"))
    )
    texts = F.array().cast("array<string>")

    def labels(column: str) -> Column:
        return F.transform(column, lambda x: x["description"])

    return complete.select(
        F.col(appid).cast("long").alias("appid"),
        F.col("a.name"),
        F.col("a.type"),
        first_integer(F.col("a.required_age")).alias("required_age"),
        F.col("a.is_free"),
        strip_tags(F.col("pc.minimum")).alias("minimum_pc_requirements"),
        strip_tags(F.col("pc.recommended")).alias("recommended_pc_requirements"),
        F.col("a.controller_support"),
        clean_html(F.col("a.detailed_description")).alias("detailed_description"),
        clean_html(F.col("a.about_the_game")).alias("about_the_game"),
        F.col("a.short_description"),
        language_list(F.col("a.supported_languages")).alias("supported_languages"),
        F.col("a.header_image"),
        F.coalesce("a.developers", texts).alias("developers"),
        F.coalesce("a.publishers", texts).alias("publishers"),
        (F.col("a.price_overview.initial") / 100.0).alias("price"),
        labels("a.categories").alias("categories"),
        labels("a.genres").alias("genres"),
        F.col("a.platforms.windows").alias("windows_support"),
        F.col("a.platforms.mac").alias("mac_support"),
        F.col("a.platforms.linux").alias("linux_support"),
        F.col("a.release_date.date").alias("release_date"),
        F.col("a.release_date.coming_soon").alias("coming_soon"),
        F.col("a.recommendations.total").alias("recommendations"),
        F.coalesce("a.dlc", no_longs()).alias("dlc"),
        F.col("summary.review_score"),
        F.col("summary.review_score_desc"),
        _stamp(scrape_date).alias("scrape_date"),
    )


def flatten_review_payload(
    landed: DataFrame, appid: str = "appid", body: str = "body", scrape_date: date | None = None
) -> DataFrame:
    """The 23 review columns; author numbers that are 0 or missing become NULL."""
    parsed = landed.select(F.col(appid).cast("long").alias("appid"), _json(body, schemas.REVIEW_BODY).alias("r"))
    known = [
        "playtime_forever",
        "playtime_last_two_weeks",
        "playtime_at_review",
        "num_games_owned",
        "num_reviews",
        "last_played",
    ]
    plain = ["timestamp_created", "timestamp_updated", "voted_up", "votes_up", "votes_funny"]
    flags = ["steam_purchase", "received_for_free", "written_during_early_access", "primarily_steam_deck"]
    return parsed.select(
        F.col("r.recommendationid").cast("long").alias("rec_id"),
        F.col("r.author.steamid").cast("long").alias("author_id"),
        "appid",
        *[F.nullif(F.col(f"r.author.{c}"), F.lit(0).cast("long")).alias(c) for c in known],
        "r.language",
        "r.review",
        *[F.col(f"r.{c}") for c in plain],
        F.col("r.weighted_vote_score").cast("double").alias("weighted_vote_score"),
        "r.comment_count",
        *[F.col(f"r.{c}") for c in flags],
        _stamp(scrape_date).alias("scrape_date"),
    )


def _with_cutoff(reviews: DataFrame, watermarks: DataFrame, game: str) -> DataFrame:
    state = watermarks.select(F.col("game_id").alias("_g"), F.col("last_processed_timestamp").alias("_cutoff"))
    return reviews.join(state, F.col(game) == F.col("_g"), "left").drop("_g")


def drop_seen(
    reviews: DataFrame, watermarks: DataFrame, game: str = "appid", seconds: str = "timestamp_created"
) -> DataFrame:
    """Reviews newer than the processed time of their game, in whole seconds."""
    cutoff = F.coalesce(F.unix_seconds("_cutoff"), F.lit(0).cast("long"))
    return _with_cutoff(reviews, watermarks, game).where(F.col(seconds) > cutoff).drop("_cutoff")


def newest_per_game(
    reviews: DataFrame, game: str = "appid", seconds: str = "timestamp_created"
) -> DataFrame:
    """Watermark rows: the newest review time of each game."""
    newest = reviews.groupBy(F.col(game).alias("game_id")).agg(F.max(seconds).alias("_s"))
    return newest.select("game_id", F.timestamp_seconds("_s").alias("last_processed_timestamp"))


def games_with_new_reviews(reviews: DataFrame, watermarks: DataFrame, game: str = "appid") -> DataFrame:
    """Games whose newest review is later than their processed time, or that have none."""
    newest = newest_per_game(reviews, game)
    seen = watermarks.select("game_id", F.col("last_processed_timestamp").alias("_cutoff"))
    fresh = F.col("_cutoff").isNull() | (F.col("last_processed_timestamp") > F.col("_cutoff"))
    return newest.join(seen, "game_id", "left").where(fresh).drop("_cutoff")


def backfill_watermarks(stg_reviews: DataFrame) -> DataFrame:
    """Watermark rows from already staged reviews."""
    return stg_reviews.groupBy("game_id").agg(F.max("timestamp_created").alias("last_processed_timestamp"))
