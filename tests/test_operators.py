import numpy as np
import pandas as pd
import pytest
from helpers import rows
from pyspark.sql import functions as F

from ludolytics.operators import asof, keyed, ordering


@pytest.fixture(scope="module")
def sides(spark):
    rng = np.random.default_rng(3)
    # one key holds a third of the rows; times collide
    keys = np.where(rng.random(600) < 0.34, 0, rng.integers(0, 8, 600))
    left = pd.DataFrame({"i": range(600), "k": keys, "t": rng.integers(0, 400, 600)})
    right = pd.DataFrame({"k": rng.integers(0, 6, 120), "u": rng.integers(0, 400, 120)}).drop_duplicates()
    right["v"] = right["k"] * 1000 + right["u"]
    to_ts = lambda c: F.timestamp_seconds(F.col(c)).alias(c)
    return (
        left,
        right,
        spark.createDataFrame(left).select("i", "k", to_ts("t")),
        spark.createDataFrame(right).select("k", to_ts("u"), "v"),
    )


def expected(left, right, direction):
    merged = pd.merge_asof(
        left.sort_values("t"), right.sort_values("u"), left_on="t", right_on="u", by="k", direction=direction
    )
    return sorted((int(i), None if np.isnan(v) else int(v)) for i, v in zip(merged["i"], merged["v"]))


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("slice_seconds", [None, 7, 1000])
def test_asof_join_equals_brute_force(sides, direction, slice_seconds):
    left, right, l, r = sides
    got = asof.asof_join(l, r, ["k"], "t", "u", direction, slice_seconds)
    assert sorted((x.i, x.v) for x in got.collect()) == expected(left, right, direction)


def test_asof_forms_agree(sides):
    left, right, l, r = sides
    got = asof.asof_by_interval(l, r, ["k"], "t", "u")
    assert sorted((x.i, x.v) for x in got.collect()) == expected(left, right, "backward")
    for direction in ("backward", "forward"):
        fixed = l.withColumn("t", F.timestamp_seconds(F.lit(200)))
        by_join = asof.asof_join(fixed, r, ["k"], "t", "u", direction)
        at = asof.asof_at(r, ["k"], "u", F.timestamp_seconds(F.lit(200)), direction)
        assert rows(by_join, "i", "v") == rows(fixed.join(at, "k", "left"), "i", "v")


def test_asof_handles_null_keys_and_refuses_unknown_directions(spark):
    l = spark.createDataFrame([(1, None, 5), (2, 1, None), (3, 1, 5)], "i int, k int, t int")
    r = spark.createDataFrame([(None, 1, 7), (1, 1, 8), (1, None, 9)], "k int, u int, v int")
    assert rows(asof.asof_join(l, r, ["k"], "t", "u"), "i", "v") == [(1, None), (2, None), (3, 8)]
    with pytest.raises(ValueError):
        asof.asof_join(l, r, ["k"], "t", "u", "nearest")


def test_top_rows_and_ordered_lists(spark):
    df = spark.createDataFrame([("a", i % 5, i) for i in range(50)] + [("b", 1, 99)], "g string, s int, x int")
    best = keyed.top_rows(df, ["g"], [F.col("s").desc(), F.col("x")], 3, rank="r")
    assert rows(best, "g", "x", "r") == [("a", 14, 3), ("a", 4, 1), ("a", 9, 2), ("b", 99, 1)]
    lists = keyed.top_ids_by_group(df, "g", [F.col("s").desc(), F.col("x")], "x", 3, "xs")
    assert rows(lists) == [("a", [4, 9, 14]), ("b", [99])]


def test_multiset_list_repeats_items(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 5, 1), ("a", 3, 0), ("b", 2, 0)], "g string, x long, n long")
    got = df.groupBy("g").agg(keyed.multiset_list(F.col("x"), F.col("n")).alias("xs"))
    assert rows(got) == [("a", [1, 1, 5]), ("b", [])]


def test_upsert_replaces_by_key(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c", 9), (3, None, 9)], "k int, v string, extra int")
    assert rows(keyed.upsert_by_key(old, new, ["k"])) == [(1, "a", None), (2, "c", 9), (3, None, 9)]


@pytest.mark.parametrize("n", [0, 1, 37, 500, 600])
def test_exact_sample_size_and_repeatability(spark, n):
    df = spark.range(500).withColumn("m", F.lit("2020-01-01"))
    first = rows(ordering.exact_sample(df, n, ["id", "m"], 42), "id")
    assert len(first) == min(n, 500)
    again = rows(ordering.exact_sample(df.repartition(7), n, ["id", "m"], 42), "id")
    assert first == again
    if n == 37:
        assert rows(ordering.exact_sample(df, n, ["id", "m"], 43), "id") != first


def test_strict_sample_raises_when_short(spark):
    with pytest.raises(ValueError):
        ordering.exact_sample(spark.range(5), 6, ["id"], strict=True)


def test_sample_does_not_shuffle_the_table(spark, tmp_path):
    spark.range(1000).selectExpr("id", "repeat('x', 10) AS wide").write.parquet(str(tmp_path / "t"))
    df = ordering.exact_sample(spark.read.parquet(str(tmp_path / "t")), 10, ["id"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Filter")  # the sample is a filter over the scan


def test_positions_are_dense(spark):
    numbered = ordering.number_rows(spark.range(700), ["id"], 1)
    assert sorted(r.position for r in numbered.collect()) == list(range(700))


@pytest.mark.parametrize("width", [1, 16, 65_536])
def test_full_rank_equals_a_window(spark, width):
    rng = np.random.default_rng(5)
    # a third of the values are equal, a third of the rows share one group
    values = np.where(rng.random(900) < 0.34, 1, rng.integers(0, 300, 900))
    groups = np.where(rng.random(900) < 0.34, 0, rng.integers(0, 4, 900))
    pdf = pd.DataFrame({"g": groups, "v": values.astype(float), "id": rng.permutation(900)})
    df = spark.createDataFrame(pdf).withColumn("v", F.when(F.col("id") % 50 != 0, F.col("v").cast("long")))
    got = ordering.full_rank(df, "g", "v", "id", tie_width=width)
    want = keyed.top_rows(df, ["g"], [F.col("v").desc_nulls_last(), F.col("id")], 10_000, rank="rank")
    assert rows(got, "g", "id", "rank") == rows(want, "g", "id", "rank")


@pytest.mark.parametrize("method", ["nearest", "linear"])
def test_exact_quantiles_equal_numpy(spark, method):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", None], 500), "v": np.round(rng.gamma(1, 5, 500), 1)})
    probs = {"lo": 0.0, "q1": 0.25, "mid": 0.5, "q9": 0.93, "hi": 1.0}
    df = spark.createDataFrame(pdf)

    def want(values):
        ordered = np.sort(values)
        if method == "nearest":
            return [ordered[int(np.floor(p * (len(ordered) - 1) + 0.5))] for p in probs.values()]
        return [np.quantile(ordered, p) for p in probs.values()]

    total = ordering.exact_quantiles(df, "v", probs, (), method).collect()[0]
    assert np.allclose(list(total), want(pdf["v"].to_numpy()))
    by_group = {r[0]: list(r)[1:] for r in ordering.exact_quantiles(df, "v", probs, ["g"], method).collect()}
    assert len(by_group) == 3
    for g, values in pdf.groupby("g", dropna=False)["v"]:
        key = g if isinstance(g, str) else None
        assert np.allclose(by_group[key], want(values.to_numpy()))


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert ordering.exact_quantiles(empty, "v", {"q": 0.5}).collect()[0].q is None


def test_running_totals_end_at_the_sum(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 7), ("b", 1, 1)], "g string, m int, n int")
    out = ordering.running_totals(df, "m", {"total": "n"}, ["g"])
    assert rows(out, "g", "m", "total") == [("a", 1, 5), ("a", 2, 12), ("b", 1, 1)]
