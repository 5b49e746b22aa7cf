"""Monthly game and user features and point-in-time training rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolytics import schemas
from ludolytics.functions.arrays import no_longs, without
from ludolytics.functions.dates import as_month, in_month, in_range, month_of, shift_month
from ludolytics.operators.asof import asof_at
from ludolytics.operators.keyed import multiset_list
from ludolytics.operators.ordering import running_totals
from ludolytics.sources.readers import read_if_present
from ludolytics.sources.writers import staged, write_month

COUNTS = [
    "game_num_reviews",
    "game_num_positive_reviews",
    "game_num_negative_reviews",
    "game_cum_num_reviews",
    "game_cum_num_positive_reviews",
    "game_cum_num_negative_reviews",
]


def monthly_game_metrics(facts: DataFrame) -> DataFrame:
    """Per game and month: counts, counts so far, and the weighted score so far.

    The first exchange carries one partial row per (game, month) and task, the
    running sums one row per (game, month): a hot game stays small.
    """
    liked = F.col("voted_up").cast("int")
    monthly = facts.groupBy("game_id", month_of("timestamp_created").alias("game_review_month")).agg(
        F.count(F.lit(1)).alias("game_num_reviews"),
        F.sum(liked).alias("game_num_positive_reviews"),
        F.sum((~F.col("voted_up")).cast("int")).alias("game_num_negative_reviews"),
        F.sum(liked * F.col("weighted_vote_score")).alias("_votes"),
        F.sum("weighted_vote_score").alias("_weights"),
    )
    totals = {
        "game_cum_num_reviews": "game_num_reviews",
        "game_cum_num_positive_reviews": "game_num_positive_reviews",
        "game_cum_num_negative_reviews": "game_num_negative_reviews",
        "_cum_votes": "_votes",
        "_cum_weights": "_weights",
    }
    cumulative = running_totals(monthly, "game_review_month", totals, ["game_id"])
    return cumulative.select(
        "game_id", "game_review_month", *COUNTS, F.try_divide("_cum_votes", "_cum_weights").alias("game_weighted_score")
    )


def game_features(metrics: DataFrame, games: DataFrame, month: str | date) -> DataFrame:
    """Game attributes with the metrics of one month."""
    of_month = metrics.where(F.col("game_review_month") == F.lit(as_month(month)))
    return games.join(of_month, "game_id").select(
        *games.columns, "game_review_month", *COUNTS, "game_weighted_score"
    )


def _positive_lists(interactions: DataFrame, month: date) -> DataFrame:
    """Users with a positive review in ``month``: that month's games and all their
    positively reviewed games (of any month, later ones included).

    Only the rows of these users are exchanged. They are counted per (user, game)
    first, combined before the exchange, so a very active user is many small groups
    and then one list bounded by the number of games, with a game repeated as often
    as it was reviewed.
    """
    here = F.col("current_month") == F.lit(month)
    active = interactions.where(here & F.col("user_id").isNotNull()).select("user_id").distinct()
    pairs = (
        interactions.join(active, "user_id", "left_semi")
        .groupBy("user_id", "game_id")
        .agg(F.sum("reviews").alias("_all"), F.sum(F.when(here, F.col("reviews")).otherwise(0)).alias("_month"))
    )
    return pairs.groupBy("user_id").agg(
        multiset_list(F.col("game_id"), F.col("_month")).alias("monthly_game_ids"),
        multiset_list(F.col("game_id"), F.col("_all")).alias("all_game_ids"),
    )


def user_features(
    facts: DataFrame,
    month: str | date,
    previous: DataFrame | None = None,
    mode: str = "literal",
    interactions: DataFrame | None = None,
) -> DataFrame:
    """Game lists of the users active in ``month``; a NULL user has none.

    ``previous`` is the stored table (any months), or None on the first run, when
    nothing counts as past. In ``literal`` mode the past of a user is what they
    reviewed in the month just before, and the list of all games is carried over
    from that month's row. ``accumulate`` adds each month to the past, refreshes the
    list of all games, and keeps users who were not active. ``interactions`` are the
    stored ``user_interactions`` of ``facts``, for callers that want many months.
    """
    if mode not in ("literal", "accumulate"):
        raise ValueError(f"unknown mode: {mode}")
    day = as_month(month)
    if interactions is None:
        interactions = facts.where("voted_up").select(
            "user_id", "game_id", month_of("timestamp_created").alias("current_month"), F.lit(1).alias("reviews")
        )
    active = _positive_lists(interactions, day)
    if previous is None:
        rows = active.select(
            "user_id",
            "monthly_game_ids",
            no_longs().alias("past_game_ids"),
            "all_game_ids",
            F.col("all_game_ids").alias("future_game_ids"),
        )
    else:
        before = previous.where(F.col("current_month") == F.lit(shift_month(day, -1))).select(
            "user_id",
            F.col("monthly_game_ids").alias("_monthly"),
            F.col("past_game_ids").alias("_past"),
            F.col("all_game_ids").alias("_all"),
        )
        if mode == "literal":
            joined = active.join(before, "user_id", "left").select(
                "user_id",
                "monthly_game_ids",
                F.coalesce("_monthly", no_longs()).alias("past_game_ids"),
                F.coalesce("_all", "all_game_ids").alias("all_game_ids"),
            )
        else:
            joined = active.join(before, "user_id", "full").select(
                "user_id",
                F.coalesce("monthly_game_ids", no_longs()).alias("monthly_game_ids"),
                F.array_sort(
                    F.array_union(F.coalesce("_past", no_longs()), F.coalesce("_monthly", no_longs()))
                ).alias("past_game_ids"),
                F.coalesce("all_game_ids", "_all").alias("all_game_ids"),
            )
        rows = joined.withColumn("future_game_ids", without("all_game_ids", "past_game_ids"))
    return rows.withColumn("current_month", F.lit(day))


def user_interactions(facts: DataFrame) -> DataFrame:
    """(user_id, game_id, current_month, reviews): positive reviews, counted.

    The long form of the user lists, with one row per game instead of one list per
    user, for accounts whose lists would not fit a row.
    """
    return (
        facts.where("voted_up")
        .groupBy("user_id", "game_id", month_of("timestamp_created").alias("current_month"))
        .agg(F.count(F.lit(1)).alias("reviews"))
    )


def future_rows(interactions: DataFrame, month: str | date) -> DataFrame:
    """(user_id, game_id, copies): what ``future_game_ids`` of the literal user
    features lists for the users active in ``month``, as rows."""
    day = as_month(month)
    in_this = F.when(F.col("current_month") == F.lit(day), F.col("reviews")).otherwise(0)
    in_last = F.when(F.col("current_month") == F.lit(shift_month(day, -1)), F.col("reviews")).otherwise(0)
    pairs = interactions.groupBy("user_id", "game_id").agg(
        F.sum("reviews").alias("copies"), F.sum(in_this).alias("_now"), F.sum(in_last).alias("_before")
    )
    active = interactions.where(F.col("current_month") == F.lit(day)).select("user_id").distinct()
    return pairs.where("_before = 0").join(active, "user_id", "left_semi").select("user_id", "game_id", "copies")


def training_features(
    facts: DataFrame,
    metrics: DataFrame,
    games: DataFrame,
    users: DataFrame,
    month: str | date,
    user_direction: str = "forward",
) -> DataFrame:
    """Reviews of one month with the features known before it.

    All rows of a run share the probe time (the month before), so each as-of join
    is an aggregate per key and a left join. The user features are looked up at or
    *after* that time by default; ``backward`` avoids seeing later months.
    """
    day = as_month(month)
    before = F.lit(shift_month(day, -1))
    rows = facts.where(in_month(F.col("timestamp_created"), day)).select(
        "*", F.lit(day).alias("current_month"), before.alias("prev_month")
    )
    known = asof_at(metrics.select("game_id", "game_review_month", *COUNTS, "game_weighted_score"),
                    ["game_id"], "game_review_month", before).drop("game_review_month")
    past = asof_at(
        users.select("user_id", "current_month", "past_game_ids"), ["user_id"], "current_month", before, user_direction
    ).drop("current_month")
    joined = rows.join(known, "game_id", "left").join(games, "game_id", "left").join(past, "user_id", "left")
    return joined.select(
        *rows.columns,
        *[c for c in games.columns if c != "game_id"],
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS],
        "game_weighted_score",
        "past_game_ids",
    )


def month_range(start: str | date, end: str | date) -> list[date]:
    months, day, last = [], as_month(start), as_month(end)
    while day <= last:
        months.append(day)
        day = shift_month(day, 1)
    return months


def backfill(
    spark: SparkSession,
    facts: DataFrame,
    games: DataFrame,
    start: str | date,
    end: str | date,
    paths: dict[str, str],
    mode: str = "literal",
    after_month: Callable[[date], None] | None = None,
) -> None:
    """Write the three feature tables for each month from ``start`` to ``end``.

    Months run strictly in order because a month's user features read the ones of
    the month before; running a month again never reads that month itself. Each
    month replaces its own partitions only. ``paths`` names the folders ``metrics``,
    ``game``, ``user`` and ``reviews``.

    The facts are read three times, however many months there are: for the metrics,
    for the counted interactions, and for the rows of the wanted months, which are
    dealt by month once.
    """
    metrics_frame = monthly_game_metrics(facts)
    metrics_frame.write.mode("overwrite").parquet(paths["metrics"])
    metrics = spark.read.schema(metrics_frame.schema).parquet(paths["metrics"])
    months = month_range(start, end)
    if not months:
        return
    interactions = staged(user_interactions(facts))
    wanted = facts.where(in_range(F.col("timestamp_created"), months[0], shift_month(months[-1], 1)))
    dealt = staged(wanted.withColumn("_of_month", month_of("timestamp_created")), "_of_month")
    for day in months:
        stored = read_if_present(spark, paths["user"], schemas.USER_FEATURES)
        write_month(user_features(facts, day, stored, mode, interactions), paths["user"], "current_month")
        write_month(game_features(metrics, games, day), paths["game"], "game_review_month")
        users = spark.read.schema(schemas.USER_FEATURES).parquet(paths["user"])
        of_month = dealt.where(F.col("_of_month") == F.lit(day)).select(*facts.columns)
        write_month(training_features(of_month, metrics, games, users, day), paths["reviews"], "current_month")
        if after_month:
            after_month(day)

