"""Staging, canonical ids, deduplication, dimensions, facts and daily marts."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolytics.functions.dates import epoch_timestamp, release_timestamp
from ludolytics.operators.keyed import latest_per_key, total_order
from ludolytics.operators.ordering import running_totals

REVIEW_COLUMNS = [
    "review_id",
    "user_id",
    "game_id",
    "review",
    "timestamp_created",
    "scrape_date",
    "written_during_early_access",
    "voted_up",
    "weighted_vote_score",
    "votes_up",
    "comment_count",
]

FACT_COLUMNS = [
    "review_id",
    "user_id",
    "game_id",
    "review",
    "written_during_early_access",
    "voted_up",
    "weighted_vote_score",
    "votes_up",
    "comment_count",
    "timestamp_created",
    "scrape_date",
]


def stg_reviews(raw_reviews: DataFrame) -> DataFrame:
    return raw_reviews.select(
        F.col("rec_id").alias("review_id"),
        F.col("author_id").alias("user_id"),
        F.col("appid").alias("game_id"),
        "review",
        epoch_timestamp("timestamp_created").alias("timestamp_created"),
        "scrape_date",
        "written_during_early_access",
        "voted_up",
        "weighted_vote_score",
        "votes_up",
        "comment_count",
    )


def stg_games(raw_games: DataFrame) -> DataFrame:
    """Released games only; a NULL type or release flag is left out."""
    released = raw_games.where((F.col("type") == "game") & ~F.col("coming_soon"))
    return released.select(
        F.col("appid").alias("game_id"),
        F.col("name").alias("game_name"),
        F.col("is_free").alias("game_is_free"),
        F.col("developers").alias("game_developers"),
        F.col("publishers").alias("game_publishers"),
        F.col("categories").alias("game_categories"),
        F.col("genres").alias("game_genres"),
        release_timestamp("release_date").alias("game_release_date"),
        F.col("about_the_game").alias("game_about"),
        F.col("short_description").alias("game_short_description"),
        F.col("detailed_description").alias("game_detailed_description"),
        F.col("review_score").alias("game_review_score"),
        F.col("review_score_desc").alias("game_review_score_description"),
        F.col("scrape_date").alias("game_scrape_date"),
    )


def non_game_ids(raw_games: DataFrame) -> DataFrame:
    """Apps whose newest landed row is not a game. Ties of the date go by type."""
    order = [F.col("scrape_date").desc_nulls_last(), F.col("type").desc_nulls_last()]
    newest = latest_per_key(raw_games.select("appid", "type", "scrape_date"), ["appid"], order)
    return newest.where(F.col("type") != "game").select("appid")


def new_ids_to_scrape(app_ids: DataFrame, games: DataFrame, non_games: DataFrame) -> DataFrame:
    """Listed apps not yet known as a game or a non-game."""
    known = games.select(F.col("game_id").alias("appid"))
    return app_ids.select("appid").join(known, "appid", "left_anti").join(non_games, "appid", "left_anti")


def int_deduplicated_games(games: DataFrame) -> DataFrame:
    """Best-scored row per name, then lowest id, then newest landing."""
    order = [
        F.col("game_review_score").desc_nulls_last(),
        F.col("game_id").asc_nulls_last(),
        F.col("game_scrape_date").desc_nulls_last(),
    ]
    return latest_per_key(games, ["game_name"], order)


def int_canonical_game_ids(games: DataFrame, deduplicated: DataFrame) -> DataFrame:
    """Every game row's id with the id that stands for its name.

    A game landed n times appears n times; the right side has one row per name, so
    nothing multiplies.
    """
    canonical = deduplicated.select("game_name", F.col("game_id").alias("canonical_game_id"))
    return games.select("game_name", F.col("game_id").alias("original_game_id")).join(canonical, "game_name").select(
        "original_game_id", "canonical_game_id"
    )


def int_reviews_with_canonical_id(
    reviews: DataFrame, canonical_ids: DataFrame, deduplicated_games: DataFrame
) -> DataFrame:
    """Reviews moved to the canonical id, kept only if that is a known game."""
    mapped = reviews.join(canonical_ids, F.col("game_id") == F.col("original_game_id"), "left").withColumn(
        "game_id", F.coalesce("canonical_game_id", "game_id")
    )
    return mapped.select(*REVIEW_COLUMNS).join(deduplicated_games.select("game_id"), "game_id", "left_semi").select(
        *REVIEW_COLUMNS
    )


def int_deduplicated_reviews(reviews: DataFrame) -> DataFrame:
    """One row per ``review_id``, highest game first; ties go by the other columns.

    All but the text: leaving it out of the order lets plans that do not want the
    text skip reading and exchanging it.
    """
    order = [F.col("game_id").desc_nulls_last(), *total_order(reviews, skip=("review_id", "game_id", "review"))]
    return latest_per_key(reviews, ["review_id"], order)


def first_reviews(reviews: DataFrame, key: str, out: str) -> DataFrame:
    return reviews.groupBy(key).agg(F.min("timestamp_created").alias(out))


def dim_games(deduplicated_games: DataFrame, reviews: DataFrame) -> DataFrame:
    """Games with a release date, imputed from the first review where missing.

    The prerelease date is the first review when that came before the release.
    """
    first = first_reviews(reviews, "game_id", "first_review_date")
    release = F.coalesce("game_release_date", "first_review_date")
    joined = deduplicated_games.join(first, "game_id", "left")
    return joined.where(release.isNotNull()).select(
        "game_id",
        "game_name",
        "game_is_free",
        "game_developers",
        "game_publishers",
        "game_categories",
        "game_genres",
        F.col("game_release_date").alias("game_steam_release_date"),
        release.alias("game_release_date"),
        F.least(release, F.col("first_review_date")).alias("game_prerelease_date"),
        "game_short_description",
        "game_about",
        "game_detailed_description",
        "game_scrape_date",
        "game_review_score",
        "game_review_score_description",
    )


def dim_users(reviews: DataFrame) -> DataFrame:
    return first_reviews(reviews, "user_id", "first_review_timestamp")


def fact_reviews(reviews: DataFrame, games: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Reviews of games and users that have a dimension row (whose keys are unique).

    Leave ``users`` out when the user dimension was built from these same reviews:
    then only a NULL user has no row, and the reviews need no exchange by user.
    """
    kept = reviews.join(games.select("game_id"), "game_id", "left_semi")
    if users is None:
        kept = kept.where(F.col("user_id").isNotNull())
    else:
        kept = kept.join(users.select("user_id"), "user_id", "left_semi")
    return kept.select(*FACT_COLUMNS)


def _per_day(df: DataFrame, ts: str, out: str) -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("review_day")).agg(F.count(F.lit(1)).alias(out))


def mart_entity_daily_counts(facts: DataFrame, users: DataFrame, games: DataFrame) -> DataFrame:
    """Reviews, new users and new games of every day that has any of them."""
    reviews = _per_day(facts, "timestamp_created", "daily_reviews_count")
    new_users = _per_day(users, "first_review_timestamp", "new_users")
    new_games = _per_day(games, "game_prerelease_date", "daily_games_count")
    days = (
        reviews.select("review_day")
        .union(new_users.select("review_day"))
        .union(new_games.select("review_day"))
        .distinct()
    )
    counts = ["daily_reviews_count", "new_users", "daily_games_count"]
    return (
        days.join(reviews, "review_day", "left")
        .join(new_users, "review_day", "left")
        .join(new_games, "review_day", "left")
        .select("review_day", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts])
    )


def mart_entities_cumulative(daily: DataFrame) -> DataFrame:
    """Running totals over the calendar: one input row per day."""
    totals = {
        "cumulative_review_count": "daily_reviews_count",
        "cumulative_user_count": "new_users",
        "cumulative_game_count": "daily_games_count",
    }
    return running_totals(daily, "review_day", totals).select("review_day", *totals)


def entities_on(cumulative: DataFrame, day) -> DataFrame:
    """Totals of exactly that day; no row when nothing happened on it."""
    return cumulative.where(F.col("review_day") == F.lit(day))


class Models(Mapping):
    """The layer graph over raw games and reviews; a model is built when asked for.

    With ``root`` the models named by ``stored`` are written there on first use and
    read back. A stored dimension has a size the optimizer knows before the reviews
    are read: a small one is broadcast and spares the reviews an exchange by game,
    a large one is not. Storing the deduplicated reviews, which feed three models,
    saves the scan, joins and exchange of the raw reviews twice. The facts are these
    less the rows of unknown games and users: storing them would write all reviews again.
    """

    GAME_LEVEL = ("int_deduplicated_games", "canonical_map")
    ALL_SHARED = (*GAME_LEVEL, "int_deduplicated_reviews", "dim_games", "dim_users")

    def __init__(
        self,
        raw_games: DataFrame,
        raw_reviews: DataFrame,
        root: str | None = None,
        stored: Sequence[str] = ALL_SHARED,
    ):
        self._root, self._stored = root, stored
        self._built: dict[str, DataFrame] = {}
        self._recipes = {
            "stg_games": lambda m: stg_games(raw_games),
            "stg_reviews": lambda m: stg_reviews(raw_reviews),
            "int_deduplicated_games": lambda m: int_deduplicated_games(m["stg_games"]),
            "int_canonical_game_ids": lambda m: int_canonical_game_ids(m["stg_games"], m["int_deduplicated_games"]),
            # repeated pairs would only repeat reviews that the deduplication
            # removes again
            "canonical_map": lambda m: m["int_canonical_game_ids"].distinct(),
            "int_reviews_with_canonical_id": lambda m: int_reviews_with_canonical_id(
                m["stg_reviews"], m["canonical_map"], m["int_deduplicated_games"]
            ),
            "int_deduplicated_reviews": lambda m: int_deduplicated_reviews(m["int_reviews_with_canonical_id"]),
            "dim_games": lambda m: dim_games(m["int_deduplicated_games"], m["int_deduplicated_reviews"]),
            "dim_users": lambda m: dim_users(m["int_deduplicated_reviews"]),
            "fact_reviews": lambda m: fact_reviews(m["int_deduplicated_reviews"], m["dim_games"]),
            "mart_entity_daily_counts": lambda m: mart_entity_daily_counts(
                m["fact_reviews"], m["dim_users"], m["dim_games"]
            ),
            "mart_entities_cumulative": lambda m: mart_entities_cumulative(m["mart_entity_daily_counts"]),
        }

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            df = self._recipes[name](self)
            if self._root and name in self._stored:
                path = f"{self._root}/{name}"
                df.write.mode("overwrite").parquet(path)
                df = df.sparkSession.read.schema(df.schema).parquet(path)
            self._built[name] = df
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._recipes)

    def __len__(self) -> int:
        return len(self._recipes)
