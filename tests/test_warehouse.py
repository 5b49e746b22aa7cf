from datetime import date, datetime

from helpers import rows
from pyspark.sql import functions as F

from ludolytics import schemas
from ludolytics.functions.dates import release_timestamp
from ludolytics.plans import warehouse as w

D1, D2 = date(2024, 1, 1), date(2024, 2, 1)


def games(spark, *records):
    base = dict.fromkeys(schemas.GAMES.names)
    base.update(type="game", coming_soon=False, scrape_date=D1)
    return spark.createDataFrame([{**base, **r} for r in records], schemas.GAMES)


def reviews(spark, *records):
    base = dict.fromkeys(schemas.REVIEWS.names)
    base.update(voted_up=True, weighted_vote_score=0.5, scrape_date=D1, timestamp_created=1_700_000_000)
    return spark.createDataFrame([{**base, **r} for r in records], schemas.REVIEWS)


def test_staging_keeps_released_games_only(spark):
    raw = games(
        spark,
        dict(appid=1, name="a"),
        dict(appid=2, name="b", type="dlc"),
        dict(appid=3, name="c", coming_soon=True),
        dict(appid=4, name="d", coming_soon=None),
        dict(appid=5, name="e", type=None),
    )
    assert rows(w.stg_games(raw), "game_id") == [(1,)]


def test_release_date_formats(spark):
    texts = ["Jan 5, 2020", "05 JAN, 2020", " Jan  5, 2020 ", "Coming soon", "Q1 2021", "", None, "Feb 30, 2020"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[1] for r in rows(df.select("i", release_timestamp("t")))]
    day = datetime(2020, 1, 5)
    assert got == [day, day, day, None, None, None, None, None]


def test_best_row_per_name(spark):
    raw = games(
        spark,
        dict(appid=2, name="x", review_score=5),
        dict(appid=1, name="x", review_score=5),
        dict(appid=3, name="y", review_score=None),
        dict(appid=4, name="y", review_score=1),
        dict(appid=5, name=None, review_score=9),
        dict(appid=6, name=None, review_score=8),
        dict(appid=7, name="z", review_score=1, scrape_date=D1),
        dict(appid=7, name="z", review_score=1, scrape_date=D2),
    )
    best = w.int_deduplicated_games(w.stg_games(raw))
    assert rows(best, "game_id", "game_scrape_date") == [(1, D1), (4, D1), (5, D1), (7, D2)]
    # idempotent
    assert rows(w.int_deduplicated_games(best)) == rows(best)


def test_map_repeats_games_landed_twice_and_skips_null_names(spark):
    raw = games(
        spark,
        dict(appid=1, name="x", review_score=2),
        dict(appid=2, name="x", review_score=1),
        dict(appid=2, name="x", review_score=1, scrape_date=D2),
        dict(appid=3, name=None),
    )
    staged = w.stg_games(raw)
    assert rows(w.int_canonical_game_ids(staged, w.int_deduplicated_games(staged))) == [(1, 1), (2, 1), (2, 1)]


def test_reviews_move_to_the_canonical_game_and_lose_non_games(spark):
    raw_games = games(
        spark,
        dict(appid=1, name="x", review_score=2),
        dict(appid=2, name="x", review_score=1),
        dict(appid=2, name="x", review_score=1, scrape_date=D2),
    )
    raw = reviews(spark, dict(rec_id=10, appid=2, author_id=1), dict(rec_id=11, appid=99, author_id=1))
    staged, best = w.stg_games(raw_games), w.int_deduplicated_games(w.stg_games(raw_games))
    with_id = w.int_reviews_with_canonical_id(w.stg_reviews(raw), w.int_canonical_game_ids(staged, best), best)
    assert rows(with_id, "review_id", "game_id") == [(10, 1), (10, 1)]  # fans out
    assert rows(w.int_deduplicated_reviews(with_id), "review_id", "game_id") == [(10, 1)]  # repaired
    m = w.Models(raw_games, raw)
    assert rows(m["int_deduplicated_reviews"], "review_id", "game_id") == [(10, 1)]


def test_review_duplicates_keep_the_highest_game(spark):
    raw = reviews(
        spark,
        dict(rec_id=1, appid=3, author_id=1),
        dict(rec_id=1, appid=7, author_id=1, votes_up=1),
        dict(rec_id=1, appid=7, author_id=1, votes_up=2),
        dict(rec_id=1, appid=None, author_id=1),
    )
    assert rows(w.int_deduplicated_reviews(w.stg_reviews(raw)), "game_id", "votes_up") == [(7, 2)]


def test_non_games_look_at_the_newest_row_first(spark):
    raw = games(
        spark,
        dict(appid=1, type="game", scrape_date=D1),
        dict(appid=1, type="dlc", scrape_date=D2),
        dict(appid=2, type="dlc", scrape_date=D1),
        dict(appid=2, type="game", scrape_date=D2),
        dict(appid=3, type=None),
    )
    assert rows(w.non_game_ids(raw)) == [(1,)]


def test_unreleased_games_are_listed_again(spark):
    raw = games(spark, dict(appid=1), dict(appid=2, coming_soon=True), dict(appid=3, type="dlc"))
    ids = spark.createDataFrame([(i, "n") for i in (1, 2, 3, 4)], schemas.APP_IDS)
    assert rows(w.new_ids_to_scrape(ids, w.stg_games(raw), w.non_game_ids(raw))) == [(2,), (4,)]


def test_game_dimension_dates(spark):
    first = 1_500_000_000
    raw_games = games(
        spark,
        dict(appid=1, name="released, no reviews", release_date="Jan 5, 2020"),
        dict(appid=2, name="neither"),
        dict(appid=3, name="imputed"),
        dict(appid=4, name="early access", release_date="Jan 5, 2020"),
        dict(appid=5, name="reviewed later", release_date="Jan 5, 2010"),
    )
    raw = reviews(spark, *[dict(rec_id=i, appid=i, author_id=1, timestamp_created=first) for i in (3, 4, 5)])
    dim = w.Models(raw_games, raw)["dim_games"]
    seen = datetime(2017, 7, 14, 2, 40)
    day, old = datetime(2020, 1, 5), datetime(2010, 1, 5)
    assert rows(dim, "game_id", "game_steam_release_date", "game_release_date", "game_prerelease_date") == [
        (1, day, day, day),
        (3, None, seen, seen),
        (4, day, day, seen),
        (5, old, old, old),
    ]
    assert dim.columns == schemas.SERVING_GAME_COLUMNS


def test_facts_drop_null_users_either_way(spark):
    raw_games = games(spark, dict(appid=1, name="x", release_date="Jan 5, 2020"))
    raw = reviews(spark, dict(rec_id=1, appid=1, author_id=5), dict(rec_id=2, appid=1, author_id=None))
    m = w.Models(raw_games, raw)
    assert rows(m["dim_users"], "user_id") == [(5,), (None,)]
    joined = w.fact_reviews(m["int_deduplicated_reviews"], m["dim_games"], m["dim_users"])
    assert rows(m["fact_reviews"]) == rows(joined)
    assert rows(joined, "review_id") == [(1,)]


def test_daily_and_cumulative_marts(spark):
    raw_games = games(
        spark,
        dict(appid=1, name="x", release_date="Jan 5, 2020"),
        dict(appid=2, name="y", release_date="Jan 7, 2020"),
    )
    at = lambda d: int(datetime(2020, 1, d, 12).timestamp())
    raw = reviews(
        spark,
        dict(rec_id=1, appid=1, author_id=1, timestamp_created=at(6)),
        dict(rec_id=2, appid=1, author_id=1, timestamp_created=at(6)),
        dict(rec_id=3, appid=1, author_id=2, timestamp_created=at(8)),
    )
    m = w.Models(raw_games, raw)
    d = lambda n: date(2020, 1, n)
    assert rows(m["mart_entity_daily_counts"]) == [(d(5), 0, 0, 1), (d(6), 2, 1, 0), (d(7), 0, 0, 1), (d(8), 1, 1, 0)]
    assert rows(m["mart_entities_cumulative"]) == [(d(5), 0, 0, 1), (d(6), 2, 1, 1), (d(7), 2, 1, 2), (d(8), 3, 2, 2)]
    assert w.entities_on(m["mart_entities_cumulative"], date(2020, 1, 9)).isEmpty()


def test_stored_models_equal_lazy_ones(spark, tmp_path):
    raw_games = games(spark, dict(appid=1, name="x", release_date="Jan 5, 2020"), dict(appid=2, name="x"))
    raw = reviews(spark, *[dict(rec_id=i, appid=1 + i % 2, author_id=i % 3) for i in range(20)])
    lazy, stored = w.Models(raw_games, raw), w.Models(raw_games, raw, str(tmp_path))
    for name in lazy:
        assert rows(lazy[name]) == rows(stored[name]), name


def test_dedup_trims_a_hot_key_before_the_exchange(spark):
    raw = reviews(spark, dict(rec_id=1, appid=1, author_id=1)).crossJoin(spark.range(1000).select("id"))
    plan = w.int_deduplicated_reviews(w.stg_reviews(raw.drop("id")))._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.index("WindowGroupLimit") < plan.index("Exchange")
    text_free = w.int_deduplicated_reviews(w.stg_reviews(raw)).select("game_id").agg(F.count("game_id"))
    exchange = text_free._jdf.queryExecution().optimizedPlan().toString()
    assert "review#" not in exchange.split("Window")[-1].split("Project")[1]
