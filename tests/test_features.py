from datetime import date, datetime

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from ludolytics import schemas
from ludolytics.plans import features as f
from ludolytics.sources.readers import load_data

FACTS = (
    "review_id long, user_id long, game_id long, review string, written_during_early_access boolean, "
    "voted_up boolean, weighted_vote_score double, votes_up long, comment_count long, "
    "timestamp_created timestamp, scrape_date date"
)
M = [date(2020, m, 1) for m in range(1, 13)]


def facts(spark, *records):
    """(user, game, month, voted_up, weight) on the 15th of the month."""
    data = [
        (i, u, g, "t", False, up, w, 0, 0, datetime(2020, m, 15, 23, 59), date(2020, m, 16))
        for i, (u, g, m, up, w) in enumerate(records)
    ]
    return spark.createDataFrame(data, FACTS)


def games(spark, *ids):
    df = spark.createDataFrame([(i, f"g{i}") for i in ids], "game_id long, game_name string")
    return df


def test_monthly_metrics(spark):
    df = facts(
        spark, (1, 1, 1, True, 0.0), (2, 1, 1, False, 0.0), (3, 1, 3, True, 0.5), (4, 1, 3, None, 0.5),
        (5, 2, 2, False, 1.0),
    )
    got = rows(f.monthly_game_metrics(df))
    assert got == [
        (1, M[0], 2, 1, 1, 2, 1, 1, None),  # all weights zero
        (1, M[2], 2, 1, 0, 4, 2, 1, 0.5),  # a NULL vote counts as neither
        (2, M[1], 1, 0, 1, 1, 0, 1, 0.0),
    ]


def test_game_features_of_one_month(spark):
    df = facts(spark, (1, 1, 1, True, 1.0), (1, 1, 2, True, 1.0), (1, 9, 2, True, 1.0))
    out = f.game_features(f.monthly_game_metrics(df), games(spark, 1, 2), "2020-02-01")
    assert rows(out, "game_id", "game_name", "game_review_month", "game_cum_num_reviews") == [(1, "g1", M[1], 2)]
    with pytest.raises(ValueError):
        f.game_features(f.monthly_game_metrics(df), games(spark, 1), "2020-02-03")


HISTORY = [
    (1, 10, 1, True, 1.0), (1, 10, 1, True, 1.0), (1, 11, 2, True, 1.0), (1, 12, 4, True, 1.0),
    (1, 13, 2, False, 1.0), (2, 10, 2, True, 1.0), (2, 12, 3, True, 1.0), (3, 10, 1, True, 1.0),
]


def user_rows(df):
    return rows(df, "user_id", "monthly_game_ids", "past_game_ids", "all_game_ids", "future_game_ids")


def test_first_month_has_no_past(spark):
    out = f.user_features(facts(spark, *HISTORY), M[0])
    assert user_rows(out) == [
        (1, [10, 10], [], [10, 10, 11, 12], [10, 10, 11, 12]),
        (3, [10], [], [10], [10]),
    ]
    assert out.columns == schemas.USER_FEATURES.names


def test_literal_past_is_the_month_before(spark):
    df = facts(spark, *HISTORY)
    first = f.user_features(df, M[0])
    second = f.user_features(df, M[1], first)
    assert user_rows(second) == [
        (1, [11], [10, 10], [10, 10, 11, 12], [11, 12]),
        (2, [10], [], [10, 12], [10, 12]),
    ]
    # user 1 is absent in March, so April starts without a past
    third = f.user_features(df, M[2], first.unionByName(second))
    fourth = f.user_features(df, M[3], first.unionByName(second).unionByName(third))
    assert user_rows(fourth) == [(1, [12], [], [10, 10, 11, 12], [10, 10, 11, 12])]


def test_future_rows_equal_the_future_lists(spark):
    df = facts(spark, *HISTORY)
    second = f.user_features(df, M[1], f.user_features(df, M[0]))
    listed = second.select("user_id", F.explode("future_game_ids").alias("game_id")).groupBy("user_id", "game_id")
    assert rows(f.future_rows(f.user_interactions(df), M[1])) == rows(listed.count())


def test_accumulated_past_survives_a_gap(spark):
    df = facts(spark, *HISTORY)
    stored = f.user_features(df, M[0])
    for m in M[1:4]:
        stored = stored.unionByName(f.user_features(df, m, stored, "accumulate"))
    april = stored.where(F.col("current_month") == F.lit(M[3]))
    assert user_rows(april) == [
        (1, [12], [10, 11], [10, 10, 11, 12], [12]),
        (2, [], [10, 12], [10, 12], []),
        (3, [], [10], [10], []),
    ]
    with pytest.raises(ValueError):
        f.user_features(df, M[0], mode="other")


def test_training_rows_are_point_in_time(spark):
    df = facts(
        spark, (1, 1, 1, True, 1.0), (1, 1, 4, True, 1.0), (2, 2, 4, True, 1.0), (3, 1, 4, True, 1.0),
    )
    metrics = f.monthly_game_metrics(df)
    users = spark.createDataFrame(
        [
            (1, [], [5], [], [], M[2]),  # seen in the month before
            (1, [], [6], [], [], M[3]),
            (2, [], [7], [], [], M[3]),  # only in the month itself
            (3, [], [8], [], [], M[6]),  # only later: still matched forward
            (3, [], [9], [], [], M[0]),
        ],
        schemas.USER_FEATURES,
    )
    out = f.training_features(df, metrics, games(spark, 1), users, M[3])
    picked = rows(
        out, "user_id", "game_id", "current_month", "prev_month", "game_name", "game_num_reviews",
        "game_weighted_score", "past_game_ids",
    )
    assert picked == [
        (1, 1, M[3], M[2], "g1", 1, 1.0, [5]),  # newest metrics month is January
        (2, 2, M[3], M[2], None, 0, None, [7]),
        (3, 1, M[3], M[2], "g1", 1, 1.0, [8]),
    ]
    backward = f.training_features(df, metrics, games(spark, 1), users, M[3], "backward")
    assert rows(backward, "user_id", "past_game_ids") == [(1, [5]), (2, None), (3, [9])]


def test_backfill_equals_single_months_and_can_be_repeated(spark, tmp_path):
    df = facts(spark, *HISTORY)
    paths = {n: str(tmp_path / n) for n in ("metrics", "game", "user", "reviews")}
    dim = games(spark, 10, 11, 12, 13)
    f.backfill(spark, df, dim, M[0], M[3], paths)
    stored = spark.read.parquet(paths["user"])
    first = f.user_features(df, M[0])
    second = f.user_features(df, M[1], first)
    assert user_rows(stored.where(F.col("current_month") == F.lit(M[1]))) == user_rows(second)
    before = {n: rows(spark.read.parquet(paths[n])) for n in ("game", "user", "reviews")}
    f.backfill(spark, df, dim, M[2], M[3], paths)  # the last two months again
    assert {n: rows(spark.read.parquet(paths[n])) for n in before} == before
    loaded = load_data(spark, paths, "2020-02-01", "user")
    assert rows(loaded.select("current_month").distinct()) == [(M[0],), (M[1],)]
    assert "PartitionFilters: [isnotnull(current_month" in loaded._jdf.queryExecution().toString()
    for bad in (("2020-13-01", "user"), ("2020-01-01", "other"), ("01/02/2020", "game")):
        with pytest.raises(ValueError):
            load_data(spark, paths, *bad)


def test_hot_user_and_hot_game_keep_all_rows(spark):
    hot = spark.range(30_000).selectExpr(
        "id AS review_id", "IF(id % 3 = 0, 0, id) AS user_id", "IF(id % 3 = 1, 0, id % 50) AS game_id", "'t' AS review",
        "false AS written_during_early_access", "true AS voted_up", "0.5D AS weighted_vote_score", "0L AS votes_up",
        "0L AS comment_count", "timestamp'2020-01-15 00:00:00' AS timestamp_created", "date'2020-01-16' AS scrape_date",
    )
    users = f.user_features(hot, M[0])
    assert users.agg(F.sum(F.size("monthly_game_ids"))).collect()[0][0] == 30_000
    assert f.monthly_game_metrics(hot).agg(F.sum("game_num_reviews")).collect()[0][0] == 30_000


def test_backfill_deals_the_facts_once(spark, tmp_path, monkeypatch):
    df = facts(spark, *HISTORY)
    paths = {n: str(tmp_path / n) for n in ("metrics", "game", "user", "reviews")}
    seen = []
    lists, training = f._positive_lists, f.training_features
    monkeypatch.setattr(f, "_positive_lists", lambda x, m: seen.append(x) or lists(x, m))
    monkeypatch.setattr(f, "training_features", lambda x, *rest: seen.append(x) or training(x, *rest))
    f.backfill(spark, df, games(spark, 10, 11, 12, 13), M[0], M[3], paths)
    assert len(seen) == 8
    # each month reads the stored interactions, and its own partition of the stored rows
    assert all("Scan parquet" in plan(x) and "Scan ExistingRDD" not in plan(x) for x in seen)
    assert all("PartitionFilters: [isnotnull(_of_month" in plan(x) for x in seen[1::2])
    empty = {n: str(tmp_path / f"none-{n}") for n in paths}
    f.backfill(spark, df, games(spark, 10), M[3], M[0], empty)
    assert spark.read.parquet(empty["metrics"]).count() == spark.read.parquet(paths["metrics"]).count()


def test_a_null_user_has_no_lists(spark):
    df = facts(spark, *HISTORY)
    nobody = df.withColumn("user_id", F.lit(None).cast("long"))
    assert user_rows(f.user_features(df.union(nobody), M[0])) == user_rows(f.user_features(df, M[0]))
