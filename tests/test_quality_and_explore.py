from datetime import date, datetime

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from ludolytics.functions.arrays import any_contains_text, without
from ludolytics.functions.dates import previous_month, whole_days_between
from ludolytics.plans import explore as x
from ludolytics.plans import quality as q


def test_checks_return_failing_rows(spark):
    child = spark.createDataFrame([(1, 5), (1, None), (2, 6), (None, 6), (None, 7)], "id long, p long")
    parent = spark.createDataFrame([(5,), (None,)], "pid long")
    assert rows(q.not_null(child, ["id", "p"])) == [("id", 2), ("p", 1)]
    assert rows(q.unique(child, "id")) == [(1, 2)]
    assert rows(q.relationships(child, "p", parent, "pid")) == [(6, 2), (7, 1)]


def test_accepted_values(spark):
    df = spark.createDataFrame([(["a", "z"], "a"), (["z"], "y"), (None, None)], "xs array<string>, v string")
    assert rows(q.accepted_values(df, "xs", ["a"])) == [("z", 2)]
    assert rows(q.accepted_values(df, "v", spark.createDataFrame([("a",)], "w string"))) == [("y", 1)]


def test_run_checks_counts_failures(spark):
    facts = spark.createDataFrame(
        [(1, 1, 1, True, datetime(2024, 1, 1), date(2024, 1, 1)), (1, 2, 9, None, None, date(2024, 1, 1))],
        "review_id long, user_id long, game_id long, voted_up boolean, timestamp_created timestamp, scrape_date date",
    )
    users = spark.createDataFrame([(1, datetime(2024, 1, 1))], "user_id long, first_review_timestamp timestamp")
    games = spark.createDataFrame(
        [(1, datetime(2024, 1, 1), None)], "game_id long, game_release_date timestamp, game_prerelease_date timestamp"
    )
    out = {(r.model, r.check_name): r.failures for r in
           q.run_checks({"fact_reviews": facts, "dim_users": users, "dim_games": games}).collect()}
    failing = {k: v for k, v in out.items() if v}
    assert failing == {
        ("fact_reviews", "not_null:voted_up"): 1,
        ("fact_reviews", "not_null:timestamp_created"): 1,
        ("fact_reviews", "unique:review_id"): 1,
        ("fact_reviews", "relationships:user_id"): 1,
        ("fact_reviews", "relationships:game_id"): 1,
        ("dim_games", "not_null:game_prerelease_date"): 1,
    }
    assert ("dim_users", "not_null:first_review_timestamp") in out


@pytest.fixture(scope="module")
def games(spark):
    return spark.createDataFrame(
        [
            (1, "a", ["x", "y"], 10, 0.5), (2, "b", ["x"], 2, 1.0), (3, "c", [], 0, None), (4, "d", None, 3, 0.2),
            (5, "e", ["y"], 100, 0.9),
        ],
        "game_id long, game_name string, tags array<string>, game_num_positive_reviews long, score double",
    )


def test_category_profile(games):
    assert [tuple(r) for r in x.category_profile(games, "tags").collect()] == [("y", 2, 55.0), ("x", 2, 6.0), (None, 2, 1.5)]
    assert rows(x.category_members(games, "tags"))[:2] == [("x", "a"), ("x", "b")]
    assert x.category_members(games, "tags").count() == 6


def test_summary(games):
    got = {r.statistic: r.value for r in x.summary_statistics(games, "score").collect()}
    assert got["count"] == 4 and got["null_count"] == 1 and got["min"] == 0.2 and got["max"] == 1.0
    assert got["mean"] == pytest.approx(0.65) and got["q50"] == 0.9 and got["q25"] == 0.5


def test_location_and_five_numbers(games):
    one = x.location_statistics(games, "game_num_positive_reviews", {"q95": 0.95}).collect()[0]
    assert (one.mean, one.median, one.q95) == (23.0, 3.0, 100.0)
    tagged = games.withColumn("g", F.size("tags") > 0)
    by = {r.g: (r.minimum, r.median, r.maximum) for r in x.five_numbers(tagged, "game_num_positive_reviews", ["g"]).collect()}
    assert by[True] == (2.0, 10.0, 100.0) and by[False] == (0.0, 0.0, 0.0)
    grouped = x.location_statistics(tagged, "game_num_positive_reviews", {"hi": 1.0}, ["g"])
    assert grouped.count() == 3  # true, false and NULL


def test_histogram_equals_numpy(spark):
    values = np.random.default_rng(0).gamma(2, 10, 800)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    counts, edges = np.histogram(values, 20)
    got = {r.bin: (r["count"], r.bin_start) for r in x.histogram(df, "v").collect()}
    assert [got.get(i, (0,))[0] for i in range(20)] == list(counts)
    assert all(got[i][1] == pytest.approx(edges[i]) for i in got)
    logs, edges = np.histogram(np.log10(values), 10)
    with_bad = df.union(spark.createDataFrame([(0.0,), (-3.0,)], "v double"))
    got = {r.bin: (r["count"], r.bin_end) for r in x.histogram(with_bad, "v", 10, log=True).collect()}
    assert [got.get(i, (0,))[0] for i in range(10)] == list(logs)
    assert all(got[i][1] == pytest.approx(10 ** edges[i + 1]) for i in got)
    same = spark.createDataFrame([(5.0,)] * 7, "v double")
    assert rows(x.histogram(same, "v"), "bin", "count") == [(0, 7)]


def test_kernel_density_is_close_to_the_exact_one(spark):
    values = np.random.default_rng(1).normal(50, 9, 500)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    out = sorted((r.x, r.density) for r in x.kernel_density(df, "v", grid=60).collect())
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.array([g for g, _ in out])
    exact = np.exp(-(((grid[:, None] - values) / h) ** 2) / 2).sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi))
    assert np.allclose([d for _, d in out], exact, rtol=1e-2)
    constant = spark.createDataFrame([(1.0,)] * 5, "v double")
    assert all(r.density is None for r in x.kernel_density(constant, "v", grid=3).collect())


def test_bands_and_thresholds(spark):
    df = spark.createDataFrame([(i,) for i in range(0, 101)], "n long")
    bands = {r.n: r.band for r in x.popularity_band(df, "n", "band").collect()}
    assert (bands[0], bands[1], bands[50], bands[51]) == ("no_reviews", "low_reviews", "low_reviews", "moderate_reviews")
    assert (bands[75], bands[76], bands[95], bands[96]) == ("moderate_reviews", "high_reviews", "high_reviews", "very_high_reviews")
    assert x.above_quantile(df, "n", 0.95).count() == 5 and x.up_to_quantile(df, "n", 0.95).count() == 96


def test_latest_entries(spark):
    df = spark.createDataFrame(
        [(1, date(2020, 1, 1), date(2020, 5, 1), 1), (1, date(2020, 2, 1), date(2020, 4, 1), 2),
         (1, date(2020, 2, 1), date(2020, 5, 1), 3)],
        "game_id long, game_review_month date, game_scrape_date date, n int",
    )
    assert rows(x.latest_game_entries(df), "n") == [(3,)]


def test_text_filters(spark):
    df = spark.createDataFrame([(1, "abcd"), (2, "é" * 9), (3, None), (4, "abcdef")], "id int, t string")
    assert [r.id for r in x.longer_than(df, "t", 4).collect()] == [4, 2]
    assert rows(x.members(df, "id", [1, 4]), "id") == [(1,), (4,)]


def test_array_and_date_expressions(spark):
    df = spark.createDataFrame([([1, 1, 2, 3], [2])], "a array<long>, b array<long>")
    assert rows(df.select(without("a", "b"))) == [([1, 1, 3],)]
    names = spark.createDataFrame([(["Big Co", "x"],), ([],), (None,)], "n array<string>")
    assert [r[0] for r in names.select(any_contains_text("n", ["big", "zz"])).collect()] == [True, False, None]
    days = spark.createDataFrame([(datetime(2020, 3, 1), datetime(2020, 2, 28, 12))], "a timestamp, b timestamp")
    assert rows(days.select(whole_days_between(F.col("a"), F.col("b")), previous_month("a"))) == [(1, date(2020, 2, 1))]
