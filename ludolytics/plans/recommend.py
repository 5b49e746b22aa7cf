"""Popularity, random and factorisation recommenders, splits and ground truth."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ludolytics.functions.dates import between_days, in_range, month_of, on_or_before, previous_month
from ludolytics.operators.keyed import ordered_list, top_ids_by_group, top_rows
from ludolytics.operators.ordering import exact_sample, full_rank, number_rows, shuffle_key
from ludolytics.sources.readers import load_model
from ludolytics.sources.writers import save_model, staged

# ---------------------------------------------------------------- splits


def train_validation(facts: DataFrame, train_until: date, validate_until: date) -> tuple[DataFrame, DataFrame]:
    """Reviews up to ``train_until``, and those after it up to ``validate_until``."""
    ts = F.col("timestamp_created")
    return (
        facts.where(on_or_before(ts, train_until)),
        facts.where(between_days(ts, train_until, validate_until)),
    )


def new_entities(dim: DataFrame, ts: str, after: date, until: date) -> DataFrame:
    """Dimension rows that first appear within ``(after, until]``."""
    return dim.where(between_days(F.col(ts), after, until))


def exclude_cold_start(facts: DataFrame, new_games: DataFrame, new_users: DataFrame) -> DataFrame:
    """Reviews whose game and user were both known before the window."""
    return facts.join(new_games.select("game_id"), "game_id", "left_anti").join(
        new_users.select("user_id"), "user_id", "left_anti"
    )


def split_and_sample(
    users: DataFrame, boundary: date, train_size: int, test_size: int, seed: int = 42, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Exact-size samples of the user rows up to and after ``boundary``."""
    month, keys = F.col("current_month"), ["user_id", "current_month"]
    return (
        exact_sample(users.where(month <= F.lit(boundary)), train_size, keys, seed, strict),
        exact_sample(users.where(month > F.lit(boundary)), test_size, keys, seed, strict),
    )


def vocabulary_sizes(cumulative: DataFrame, day: date) -> DataFrame:
    """(num_users, num_games) on exactly that day."""
    return cumulative.where(F.col("review_day") == F.lit(day)).select(
        F.col("cumulative_user_count").alias("num_users"), F.col("cumulative_game_count").alias("num_games")
    )


def interactions(facts: DataFrame, positive_only: bool = True) -> DataFrame:
    """(user_id, game_id, label) with label 1.0 for a positive review."""
    kept = facts.where("voted_up") if positive_only else facts
    return kept.select("user_id", "game_id", F.col("voted_up").cast("double").alias("label"))


def _busy(df: DataFrame, key: str, more_than: int) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("reviews")).where(F.col("reviews") > more_than)


def active_keys(train: DataFrame, game_more_than: int = 100, user_more_than: int = 10) -> tuple[DataFrame, DataFrame]:
    """Games and users with more than that many reviews, counted on the whole set."""
    return _busy(train, "game_id", game_more_than), _busy(train, "user_id", user_more_than)


def min_activity(df: DataFrame, games: DataFrame, users: DataFrame) -> DataFrame:
    """Rows of active games and users (see ``active_keys``)."""
    return df.join(games.select("game_id"), "game_id", "left_semi").join(
        users.select("user_id"), "user_id", "left_semi"
    )


# ---------------------------------------------------------------- popularity


def _popular_first() -> list[Column]:
    return [F.col("game_num_positive_reviews").desc_nulls_last(), F.col("game_id").asc_nulls_last()]


def fit_popularity(game_features: DataFrame) -> DataFrame:
    """All games of each month with their ``rank`` by positive reviews (ties by id)."""
    return full_rank(game_features, "game_review_month", "game_num_positive_reviews", "game_id")


def topk_by_month(game_features: DataFrame, k: int = 10) -> DataFrame:
    """(game_review_month, top_game_ids): the best ``k`` games of each month in order."""
    return top_ids_by_group(game_features, "game_review_month", _popular_first(), "game_id", k, "top_game_ids")


def predict_popular(users: DataFrame, top: DataFrame, out: str = "predictions") -> DataFrame:
    """Each row with the top games of the month before its ``current_month``, or []."""
    looked_up = top.select(
        F.add_months("game_review_month", 1).alias("_month"), F.col("top_game_ids").alias(out)
    )
    joined = users.join(looked_up, F.trunc("current_month", "MM") == F.col("_month"), "left").drop("_month")
    return joined.withColumn(out, F.coalesce(out, F.array().cast("array<bigint>")))


def popularity_score(rows: DataFrame, game_features: DataFrame, ts: str, out: str = "score") -> DataFrame:
    """Positive reviews the row's game had in the month before ``ts``; NULL if none."""
    scores = game_features.select(
        F.col("game_id").alias("_g"), F.col("game_review_month").alias("_m"),
        F.col("game_num_positive_reviews").alias(out),
    )
    on = (F.col("game_id") == F.col("_g")) & (previous_month(ts) == F.col("_m"))
    return rows.join(scores, on, "left").drop("_g", "_m")


def top_of_month(ranking: DataFrame, month: date, k: int) -> DataFrame:
    """The first ``k`` games of one month of a fitted ranking."""
    return ranking.where((F.col("game_review_month") == F.lit(month)) & (F.col("rank") <= k)).orderBy("rank")


class PopularityModel:
    """Fit, save, load and batch prediction; everything stays a DataFrame."""

    def __init__(self, k: int = 10):
        self.k = k
        self.ranking: DataFrame | None = None

    def fit(self, game_features: DataFrame) -> PopularityModel:
        self.ranking = fit_popularity(game_features)
        return self

    def save(self, path: str) -> None:
        save_model(self.ranking, path)

    def load(self, spark: SparkSession, path: str) -> PopularityModel:
        self.ranking = load_model(spark, path)
        return self

    def transform(self, users: DataFrame) -> DataFrame:
        best = self.ranking.where(F.col("rank") <= self.k)
        top = best.groupBy("game_review_month").agg(ordered_list("rank", "game_id").alias("top_game_ids"))
        return predict_popular(users, top)


# ---------------------------------------------------------------- random


def distinct_games(game_features: DataFrame) -> DataFrame:
    """One row per game, the one of its newest month."""
    return top_rows(game_features, ["game_id"], [F.col("game_review_month").desc_nulls_last()])


def _draws(key: Column, n: Column, k: int) -> Column:
    """For each position ``j`` of the last ``k`` below ``n`` a number up to ``j``, NULL for a position below 0.

    One entry after the other, not as a function of an array, so that the digests are compiled and made once.
    """

    def drawn(j: Column) -> Column:
        digits = F.substring(F.md5(F.concat_ws("|", key, j.cast("string"))), 1, 12)
        return F.when(j >= 0, F.pmod(F.conv(digits, 16, 10).cast("long"), j + 1))

    return F.array(*(drawn(n - k + i) for i in range(k)))


def _distinct(draws: Column, n: Column, k: int) -> Column:
    """``k`` distinct positions below ``n``, uniform over all such sets; all of them if fewer.

    A draw already taken stands for its position itself (sampling without replacement
    in ``k`` steps).
    """

    def step(taken: Column, draw: Column) -> Column:
        own = F.when(F.array_contains(taken, draw["drawn"]), draw["j"]).otherwise(draw["drawn"])
        return F.concat(taken, F.array(own))

    numbered = F.transform(draws, lambda drawn, i: F.struct((n - k + i).alias("j"), drawn.alias("drawn")))
    return F.aggregate(F.filter(numbered, lambda draw: draw["j"] >= 0), F.array().cast("array<bigint>"), step)


def recommend_random(
    users: DataFrame, games: DataFrame, keys: Sequence[str], k: int = 10, seed: int = 42, out: str = "predictions"
) -> DataFrame:
    """``k`` distinct random games per row of ``users`` (all games if fewer).

    Games get dense numbers; each row draws numbers from a hash of its key and the
    seed, and the drawn numbers are joined back: k rows per user, never user x game.
    The numbered games are stored, so that their size is known: a small list goes to
    the draws, and the draws of a row stay where they were made.
    """
    numbered = staged(number_rows(games.select("game_id"), ["game_id"], seed))
    total = numbered.agg(F.count(F.lit(1)).alias("n")).scalar()
    sized = users.select(*keys, shuffle_key(keys, seed).alias("_h"), total.alias("_n"))
    draws = sized.withColumn("_draws", _draws(F.col("_h"), F.col("_n"), k))
    positions = _distinct(F.col("_draws"), F.col("_n"), k)
    drawn = draws.select(*keys, F.posexplode(positions).alias("_order", "position"))
    picked = drawn.join(numbered, "position").groupBy(*keys).agg(ordered_list("_order", "game_id").alias(out))
    return users.join(picked, list(keys), "left").withColumn(
        out, F.coalesce(out, F.array().cast("array<bigint>"))
    )


# ---------------------------------------------------------------- ground truth


def future_ground_truth(training: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """(user_id, current_month, future_game_ids) per anchor.

    An anchor is a month, within ``[start, end)`` if given, in which the user liked
    a game; its list holds every game the user liked in that month or later (also
    after ``end``), by first such month and then id.

    A game's month ``m`` is its first one for exactly the anchors between its
    previous month and ``m``, so each (anchor, game) is produced once and no pairs
    are formed and thrown away. The anchors of a user are months: a short list.
    """
    liked = training.where("voted_up").select("user_id", "game_id", "current_month").distinct()
    wanted = liked
    if start is not None:
        wanted = wanted.where(F.col("current_month") >= F.lit(start))
    if end is not None:
        wanted = wanted.where(F.col("current_month") < F.lit(end))
    anchors = wanted.groupBy("user_id").agg(F.collect_set("current_month").alias("_anchors"))
    earlier = Window.partitionBy("user_id", "game_id").orderBy("current_month")
    spans = liked.withColumn("_before", F.lag("current_month").over(earlier))
    covered = F.filter(
        "_anchors",
        lambda a: (a <= F.col("current_month")) & (F.col("_before").isNull() | (a > F.col("_before"))),
    )
    rows = spans.join(anchors, "user_id").select(
        "user_id", F.explode(covered).alias("_anchor"), F.col("current_month").alias("_first"), "game_id"
    )
    return rows.groupBy("user_id", F.col("_anchor").alias("current_month")).agg(
        ordered_list("_first", "game_id").alias("future_game_ids")
    )


def future_ground_truth_of_year(training: DataFrame, year: int) -> DataFrame:
    return future_ground_truth(training, date(year, 1, 1), date(year + 1, 1, 1))


def all_time_ground_truth(future: DataFrame) -> DataFrame:
    """Per user the lists of all anchors in month order, one after the other."""
    return future.groupBy("user_id").agg(
        F.flatten(ordered_list("current_month", "future_game_ids")).alias("future_game_ids")
    )


# ---------------------------------------------------------------- factorisation


def fit_factors(
    facts: DataFrame, rank: int = 64, seed: int = 42, iterations: int = 10
) -> tuple[object, DataFrame, DataFrame]:
    """User and game vectors from positive reviews (implicit feedback ALS).

    Returns the model and the maps (user_id, user_no) and (game_id, game_no): the
    learner wants 32-bit keys, so ids get dense numbers. What is needed several times,
    by the learner too, is stored: the pairs, the maps and the numbered ratings.
    """
    liked = staged(
        facts.where("voted_up").groupBy("user_id", "game_id").agg(F.count(F.lit(1)).cast("float").alias("rating"))
    )
    users = number_rows(liked.select("user_id").distinct(), ["user_id"], seed, "user_no")
    games = number_rows(liked.select("game_id").distinct(), ["game_id"], seed, "game_no")
    users = staged(users.withColumn("user_no", F.col("user_no").cast("int")))
    games = staged(games.withColumn("game_no", F.col("game_no").cast("int")))
    ratings = staged(liked.join(users, "user_id").join(games, "game_id").select("user_no", "game_no", "rating"))
    als = ALS(
        rank=rank,
        maxIter=iterations,
        implicitPrefs=True,
        userCol="user_no",
        itemCol="game_no",
        ratingCol="rating",
        seed=seed,
        coldStartStrategy="drop",
    )
    return als.fit(ratings), users, games


def recommend_by_factors(
    model: object, users: DataFrame, games: DataFrame, wanted: DataFrame, k: int = 10, out: str = "predictions"
) -> DataFrame:
    """(user_id, predictions): the ``k`` best games of the users in ``wanted``."""
    subset = wanted.select("user_id").distinct().join(users, "user_id")
    recs = model.recommendForUserSubset(subset.select("user_no"), k)
    ranked = recs.select("user_no", F.posexplode("recommendations").alias("_order", "_rec")).select(
        "user_no", "_order", F.col("_rec.game_no").alias("game_no")
    )
    named = ranked.join(games, "game_no").groupBy("user_no").agg(ordered_list("_order", "game_id").alias(out))
    return subset.join(named, "user_no").select("user_id", out)


def month_rows(facts: DataFrame, start: date, end: date) -> DataFrame:
    """Reviews of ``[start, end)`` with their month, as the ground truth wants them."""
    return facts.where(in_range(F.col("timestamp_created"), start, end)).withColumn(
        "current_month", month_of("timestamp_created")
    )
