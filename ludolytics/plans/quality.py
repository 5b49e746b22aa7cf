"""Data checks. Each returns the failing rows, so an empty result means passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, failures) of the columns holding NULLs, in one scan."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns])
    return counted.select(F.inline(pairs)).where(F.col("failures") > 0)


def unique(df: DataFrame, column: str) -> DataFrame:
    """(key, copies) of the keys that occur more than once."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """(key, rows) of non-NULL child keys without a parent.

    Keys are counted before the join, so a hot key joins as one row.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("failures"))
    return keys.join(parent.select(F.col(field).alias(column)), column, "left_anti")


def accepted_values(df: DataFrame, column: str, accepted: Sequence[str] | DataFrame) -> DataFrame:
    """(value, failures) of values, or array elements, outside a vocabulary."""
    is_array = df.schema[column].dataType.typeName() == "array"
    value = F.explode(column) if is_array else F.col(column)
    seen = df.select(value.alias("value")).where(F.col("value").isNotNull())
    counts = seen.groupBy("value").agg(F.count(F.lit(1)).alias("failures"))
    if isinstance(accepted, DataFrame):
        return counts.join(accepted.select(F.col(accepted.columns[0]).alias("value")), "value", "left_anti")
    return counts.where(~F.col("value").isin(list(accepted)))


# which checks each model has to pass
CHECKS = {
    "int_deduplicated_games": {"not_null": ["game_id", "game_name"], "unique": ["game_id"]},
    "int_reviews_with_canonical_id": {
        "relationships": [("game_id", "int_deduplicated_games", "game_id")],
    },
    "int_deduplicated_reviews": {
        "not_null": [
            "review_id",
            "user_id",
            "game_id",
            "timestamp_created",
            "written_during_early_access",
            "voted_up",
            "weighted_vote_score",
            "votes_up",
            "comment_count",
        ],
        "unique": ["review_id"],
    },
    "dim_games": {"not_null": ["game_release_date", "game_prerelease_date"]},
    "dim_users": {"not_null": ["first_review_timestamp"]},
    "fact_reviews": {
        "not_null": ["review_id", "user_id", "game_id", "voted_up", "timestamp_created", "scrape_date"],
        "unique": ["review_id"],
        "relationships": [("user_id", "dim_users", "user_id"), ("game_id", "dim_games", "game_id")],
    },
}


def run_checks(models: dict[str, DataFrame]) -> DataFrame:
    """All declared checks over the given models: (model, check_name, failures)."""
    parts = []

    def add(model: str, name: str, failing: DataFrame, total) -> None:
        parts.append(
            failing.agg(F.coalesce(total, F.lit(0)).cast("long").alias("failures")).select(
                F.lit(model).alias("model"), F.lit(name).alias("check_name"), "failures"
            )
        )

    for model, checks in CHECKS.items():
        if model not in models:
            continue
        df = models[model]
        if checks.get("not_null"):
            columns = checks["not_null"]
            counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
            rows = F.array(
                *[
                    F.struct(
                        F.lit(model).alias("model"),
                        F.lit(f"not_null:{c}").alias("check_name"),
                        F.col(c).alias("failures"),
                    )
                    for c in columns
                ]
            )
            parts.append(counted.select(F.inline(rows)))
        for column in checks.get("unique", []):
            add(model, f"unique:{column}", unique(df, column), F.count(F.lit(1)))
        for column, parent, field in checks.get("relationships", []):
            failing = relationships(df, column, models[parent], field)
            add(model, f"relationships:{column}", failing, F.sum("failures"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
