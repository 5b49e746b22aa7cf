"""Exploration reports: category profiles, distributions, popularity bands."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolytics.functions.dates import years_between
from ludolytics.operators.keyed import latest_per_key
from ludolytics.operators.ordering import exact_quantiles


def latest_game_entries(game_features: DataFrame) -> DataFrame:
    """The newest feature row of each game."""
    order = [F.col("game_review_month").desc_nulls_last(), F.col("game_scrape_date").desc_nulls_last()]
    return latest_per_key(game_features, ["game_id"], order)


def games_with_latest_metrics(games: DataFrame, game_features: DataFrame) -> DataFrame:
    newest = latest_game_entries(game_features).select(
        "game_id",
        "game_review_month",
        "game_num_reviews",
        "game_weighted_score",
        "game_num_positive_reviews",
        "game_num_negative_reviews",
    )
    return games.join(newest, "game_id")


def category_profile(games: DataFrame, category: str) -> DataFrame:
    """(category, count, avg_pos_reviews), best first; an empty list counts as NULL.

    A game is counted once per category it lists.
    """
    return (
        games.select(F.explode_outer(category).alias("category"), "game_num_positive_reviews")
        .groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("count"),
            (F.sum("game_num_positive_reviews") / F.count(F.lit(1))).alias("avg_pos_reviews"),
        )
        .orderBy(F.col("avg_pos_reviews").desc_nulls_last(), "category")
    )


def category_members(games: DataFrame, category: str) -> DataFrame:
    """(category, game_name): the names behind a profile, one per row, so that a
    category most games share is never gathered into one list."""
    return games.select(F.explode_outer(category).alias("category"), "game_name")


def summary_statistics(df: DataFrame, column: str) -> DataFrame:
    """(statistic, value): count, null_count, mean, std, min, quartiles, max."""
    q = exact_quantiles(df, column, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    c = F.col(column)
    base = df.agg(
        F.count(c).cast("double").alias("count"),
        F.count_if(c.isNull()).cast("double").alias("null_count"),
        F.avg(c).alias("mean"),
        F.stddev(c).alias("std"),
        F.min(c).cast("double").alias("min"),
        F.max(c).cast("double").alias("max"),
    ).select("*", *[q.select(n).scalar().alias(n) for n in ("q25", "q50", "q75")])
    names = ["count", "null_count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    rows = F.array(*[F.struct(F.lit(n).alias("statistic"), F.col(n).alias("value")) for n in names])
    return base.select(F.inline(rows))


def location_statistics(df: DataFrame, column: str, probs: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Mean, median (interpolated) and nearest-rank quantiles, per group if asked."""
    nearest = exact_quantiles(df, column, probs, by)
    median = exact_quantiles(df, column, {"median": 0.5}, by, "linear")
    mean = df.where(F.col(column).isNotNull()).groupBy(*by).agg(F.avg(column).alias("mean"))
    if not by:
        one = mean.select(
            "*", median.scalar().alias("median"), *[nearest.select(n).scalar().alias(n) for n in probs]
        )
        return one
    out = mean
    for other in (median, nearest):
        keyed = other.select(*[F.col(c).alias(f"_{c}") for c in by], *[c for c in other.columns if c not in by])
        on = None
        for c in by:
            test = F.col(c).eqNullSafe(F.col(f"_{c}"))
            on = test if on is None else on & test
        out = out.join(keyed, on).drop(*[f"_{c}" for c in by])
    return out


def five_numbers(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Minimum, quartiles and maximum (interpolated) per group."""
    probs = {"minimum": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "maximum": 1.0}
    return exact_quantiles(df, value, probs, by, "linear")


def _range(df: DataFrame, x: Column) -> DataFrame:
    return df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi")).alias("r"))


def _bin(offset: Column, width: Column, bins: int) -> Column:
    """Bin number; everything is in bin 0 when all values are equal."""
    return F.least(F.coalesce(F.floor(F.try_divide(offset, width)), F.lit(0)), F.lit(bins - 1))


def histogram(df: DataFrame, column: str, bins: int = 20, log: bool = False) -> DataFrame:
    """(bin, bin_start, bin_end, count) of equal-width bins; empty bins are left out.

    With ``log`` the bins are equal on a log10 scale and values <= 0 are left out.
    The last bin includes its upper end.
    """
    kept = df.where(F.col(column).isNotNull())
    x = F.col(column).cast("double")
    if log:
        kept = kept.where(F.col(column) > 0)
        x = F.log10(x)
    kept = kept.select(x.alias("_x"))
    span = _range(kept, F.col("_x")).scalar()
    lo, width = span["lo"], (span["hi"] - span["lo"]) / bins
    number = _bin(F.col("_x") - lo, width, bins)
    counts = kept.groupBy(number.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    edge = lambda n: F.pow(F.lit(10.0), n) if log else n
    return counts.select(
        "bin",
        edge(lo + F.col("bin") * width).alias("bin_start"),
        edge(lo + (F.col("bin") + 1) * width).alias("bin_end"),
        "count",
    )


def kernel_density(
    df: DataFrame, column: str, grid: int = 200, bins: int = 1024, log: bool = False
) -> DataFrame:
    """(x, density): Gaussian kernel density on an even grid over the data range.

    With ``log`` grid and density are those of the decimal logarithms, values <= 0 are left out, and x is the value
    itself. Bandwidth by Scott's rule. Values are first counted in fine bins, whose centres
    stand for them; each bin then adds its share to every grid point. The work after
    the scan depends on ``bins`` and ``grid`` only.
    """
    x = F.col(column).cast("double")
    kept = df.where(F.col(column) > 0).select(F.log10(x).alias("_x")) if log else (
        df.where(F.col(column).isNotNull()).select(x.alias("_x"))
    )
    stats = kept.agg(
        F.struct(
            F.min("_x").alias("lo"),
            F.max("_x").alias("hi"),
            F.stddev("_x").alias("sd"),
            F.count("_x").alias("n"),
        )
    ).scalar()
    fine = (stats["hi"] - stats["lo"]) / bins
    number = _bin(F.col("_x") - stats["lo"], fine, bins)
    binned = kept.groupBy(number.alias("_b")).agg(F.count(F.lit(1)).alias("_w"))
    centre = stats["lo"] + (F.col("_b") + 0.5) * fine
    bandwidth = stats["sd"] * F.pow(stats["n"].cast("double"), F.lit(-0.2))
    points = binned.select(
        "_b", "_w", F.posexplode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("_pos", "_g")
    ).withColumn("x", stats["lo"] + F.col("_g") * (stats["hi"] - stats["lo"]) / (grid - 1))
    z = F.try_divide(F.col("x") - centre, bandwidth)
    scale = stats["n"] * bandwidth * math.sqrt(2 * math.pi)
    share = F.try_divide(F.col("_w") * F.exp(-z * z / 2), scale)
    density = points.groupBy("_g").agg(F.first("x").alias("x"), F.sum(share).alias("density"))
    return density.select((F.pow(F.lit(10.0), "x") if log else F.col("x")).alias("x"), "density")


# fixed values: the popularity bands and the quantile that closes each
BANDS = [("low_reviews", 0.5), ("moderate_reviews", 0.75), ("high_reviews", 0.95)]


def popularity_band(df: DataFrame, column: str, out: str) -> DataFrame:
    """Label rows by quantile thresholds of ``column`` over the whole table."""
    limits = exact_quantiles(df, column, {name: p for name, p in BANDS})
    value = F.col(column)
    label = F.when(value <= 0, F.lit("no_reviews"))
    for name, _ in BANDS:
        label = label.when(value <= limits.select(name).scalar(), F.lit(name))
    return df.withColumn(out, label.otherwise(F.lit("very_high_reviews")))


def above_quantile(df: DataFrame, column: str, p: float) -> DataFrame:
    return df.where(F.col(column) > exact_quantiles(df, column, {"q": p}).scalar())


def up_to_quantile(df: DataFrame, column: str, p: float) -> DataFrame:
    return df.where(F.col(column) <= exact_quantiles(df, column, {"q": p}).scalar())


def non_text_features(games: DataFrame) -> DataFrame:
    """Score, price flag, review count with its band, and age at the newest month."""
    banded = popularity_band(games, "game_num_reviews", "game_num_reviews_cat")
    age = years_between(F.col("game_review_month"), F.col("game_prerelease_date"))
    return banded.select(
        "game_id",
        "game_name",
        "game_weighted_score",
        "game_is_free",
        "game_num_reviews",
        "game_num_reviews_cat",
        age.alias("years_since_release"),
    )


def text_lengths(games: DataFrame) -> DataFrame:
    return games.select(
        "*",
        F.char_length("game_detailed_description").alias("game_detailed_description_len"),
        F.char_length("game_short_description").alias("game_short_description_len"),
    )


def longer_than(df: DataFrame, text: str, n: int) -> DataFrame:
    """Rows whose text has more than ``n`` characters, shortest first."""
    return df.withColumn("_len", F.char_length(text)).where(F.col("_len") > n).orderBy("_len").drop("_len")


def members(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Rows whose ``column`` is one of ``values``."""
    return df.where(F.col(column).isin(list(values)))
