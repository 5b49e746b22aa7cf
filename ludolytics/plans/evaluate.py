"""Evaluation of recommendations against ground truth, one aggregation per split."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolytics.functions import metrics as M
from ludolytics.operators.keyed import ordered_list
from ludolytics.plans.recommend import predict_popular, split_and_sample, topk_by_month


def row_metrics(df: DataFrame, truth: str, recs: str, ks: Sequence[int] = (5, 10)) -> DataFrame:
    """Add every metric for every k as a column of its row."""
    t, r = F.col(truth), F.col(recs)
    return df.select(
        "*",
        *[
            fn(t, r, k).alias(f"{name}_at_{k}")
            for k in ks
            for name, fn in {
                "hit": M.hit,
                "precision": M.precision,
                "recall": M.recall,
                "ap": M.average_precision,
                "ndcg": M.ndcg,
            }.items()
        ],
    )


SUMMARY = {"hit": "hitrate", "precision": "precision", "recall": "recall", "ap": "map", "ndcg": "ndcg"}


def summarize(scored: DataFrame, ks: Sequence[int] = (5, 10), by: Sequence[str] = ()) -> DataFrame:
    """Average the row metrics: hit rate, MAP, precision, recall, NDCG."""
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("evaluated"),
        *[F.avg(f"{name}_at_{k}").alias(f"{out}_at_{k}") for k in ks for name, out in SUMMARY.items()],
    )


def evaluate_lists(df: DataFrame, truth: str, recs: str, ks: Sequence[int] = (5, 10)) -> DataFrame:
    return summarize(row_metrics(df, truth, recs, ks), ks)


def evaluate_rows(
    truth: DataFrame, recs: DataFrame, keys: Sequence[str], item: str = "game_id", ks: Sequence[int] = (5, 10)
) -> DataFrame:
    """The same metrics from long tables, without building any relevant list.

    ``truth`` has one row per relevant item (repeats count towards the length that
    average precision divides by), ``recs`` rows (keys, item, rank). Only hits are
    joined, so an account with a huge history is spread by item, and what is
    gathered per key is at most k ranks.
    """
    keys = list(keys)
    k_max = max(ks)
    relevant = truth.where(F.col(item).isNotNull()).groupBy(*keys, item).agg(F.count(F.lit(1)).alias("_copies"))
    sizes = relevant.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_distinct"), F.sum("_copies").alias("_length")
    )
    first = recs.where(F.col("rank") <= k_max).groupBy(*keys, item).agg(F.min("rank").alias("rank"))
    hits = (
        relevant.join(first, [*keys, item])
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.col("rank").cast("int"))).alias("_ranks"))
    )
    per_key = sizes.join(hits, keys, "left").withColumn(
        "_ranks", F.coalesce("_ranks", F.array().cast("array<int>"))
    )

    def within(k: int) -> Column:
        return F.filter("_ranks", lambda r: r <= k)

    def gain(positions: Column) -> Column:
        return F.aggregate(positions, F.lit(0.0), lambda a, r: a + 1 / F.log2(r + 1.0))

    columns = []
    for k in ks:
        ranks = within(k)
        total = F.aggregate(F.transform(ranks, lambda r, i: (i + 1) / r), F.lit(0.0), lambda a, x: a + x)
        best = F.sequence(F.lit(1), F.least(F.col("_distinct"), F.lit(k)).cast("int"))
        columns += [
            (F.size(ranks) > 0).cast("int").alias(f"hit_at_{k}"),
            (F.size(ranks) / F.lit(k)).alias(f"precision_at_{k}"),
            (F.size(ranks) / F.col("_distinct")).alias(f"recall_at_{k}"),
            (total / F.least(F.lit(k), F.col("_length"))).alias(f"ap_at_{k}"),
            (gain(ranks) / gain(best)).alias(f"ndcg_at_{k}"),
        ]
    return summarize(per_key.select(*keys, *columns), ks)


def explode_truth(df: DataFrame, keys: Sequence[str], truth: str, item: str = "game_id") -> DataFrame:
    return df.select(*keys, F.explode(truth).alias(item))


def explode_recs(df: DataFrame, keys: Sequence[str], recs: str, item: str = "game_id") -> DataFrame:
    return df.select(*keys, F.posexplode(recs).alias("rank", item)).withColumn("rank", F.col("rank") + 1)


def truth_lists(truth: DataFrame, keys: Sequence[str], item: str = "game_id", out: str = "truth") -> DataFrame:
    return truth.groupBy(*keys).agg(ordered_list(item, item).alias(out))


def run_experiment(
    game_features: DataFrame,
    user_features: DataFrame,
    boundary: date,
    train_size: int = 100_000,
    test_size: int = 10_000,
    k: int = 10,
    seed: int = 42,
    ks: Sequence[int] = (5, 10),
    strict: bool = False,
) -> DataFrame:
    """Popularity baseline on a sampled train and eval split: one row per split.

    The ranking is fitted on all months: a row only ever looks at the month before. Rows are drawn first; a drawn row
    without any future game has no metric and is left out of the averages and the count.
    """
    top = topk_by_month(game_features, k)
    train, test = split_and_sample(user_features, boundary, train_size, test_size, seed, strict)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("eval")))
    both = both.where(F.size("future_game_ids") > 0)
    scored = row_metrics(predict_popular(both, top), "future_game_ids", "predictions", ks)
    return summarize(scored, ks, ["split"])
