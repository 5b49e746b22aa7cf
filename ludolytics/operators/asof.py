"""As-of joins: match each left row with the nearest right row in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _check(direction: str) -> None:
    if direction not in ("backward", "forward"):
        raise ValueError(f"unknown as-of direction: {direction}")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
    direction: str = "backward",
    slice_seconds: int | None = None,
) -> DataFrame:
    """Left join to the latest right row at or before (``backward``), or the
    earliest at or after (``forward``), the left time. Right keys must be unique.

    All left rows with one key and one time have the same match, so the search
    runs on the distinct (key, time) pairs and an equality join hands the match
    to the rows; that join is one whose hot partitions adaptive execution splits.
    With ``slice_seconds`` the search itself is also cut by time: the nearest
    right row of other slices is carried into a slice as one extra row, and a key
    with very many distinct times is searched by many tasks.
    """
    _check(direction)
    by = list(by)
    payload = [c for c in right.columns if c not in by]
    backward = direction == "backward"
    usable = F.col("_at").isNotNull()
    for c in by:  # NULL keys match nothing and must not gather in one group
        usable = usable & F.col(c).isNotNull()
    probes = left.select(*by, F.col(left_ts).alias("_at")).where(usable).distinct()
    facts = right.select(*by, F.col(right_ts).alias("_at"), F.struct(*payload).alias("_row")).where(usable)
    group = list(by)
    if slice_seconds:
        group.append("_slice")
        number = F.floor(F.unix_micros(F.col("_at").cast("timestamp")) / (slice_seconds * 1_000_000))
        probes, facts = probes.withColumn("_slice", number), facts.withColumn("_slice", number)
        facts = facts.unionByName(_carried(probes, facts, by, backward))
    timeline = (
        facts.withColumn("_probe", F.lit(0))
        .unionByName(probes.withColumn("_probe", F.lit(1)), allowMissingColumns=True)
    )
    # walk towards the probe from the side the match comes from; at equal times
    # the right row comes first
    when = F.col("_at").asc() if backward else F.col("_at").desc()
    window = (
        Window.partitionBy(*group)
        .orderBy(when, "_probe")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = (
        timeline.withColumn("_row", F.last("_row", ignorenulls=True).over(window))
        .where(F.col("_probe") == 1)
        .select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], "_at", "_row")
    )
    on = F.col(left_ts) == F.col("_at")
    for i, c in enumerate(by):
        on = on & (F.col(c) == F.col(f"_k{i}"))
    joined = left.join(found, on, "left")
    return joined.select(*left.columns, *[F.col(f"_row.{c}").alias(c) for c in payload])


def _carried(probes: DataFrame, facts: DataFrame, by: list[str], backward: bool) -> DataFrame:
    """For each probed slice, the nearest right row lying in another slice."""
    pick = F.max_by if backward else F.min_by
    edges = facts.groupBy(*by, "_slice").agg(pick(F.struct("_at", "_row"), F.col("_at")).alias("_edge"))
    asked = probes.select(*by, "_slice").distinct().withColumn("_asked", F.lit(True))
    step = F.col("_slice").asc() if backward else F.col("_slice").desc()
    window = Window.partitionBy(*by).orderBy(step).rangeBetween(Window.unboundedPreceding, -1)
    return (
        edges.unionByName(asked, allowMissingColumns=True)
        .withColumn("_edge", F.last("_edge", ignorenulls=True).over(window))
        .where(F.col("_asked") & F.col("_edge").isNotNull())
        .select(*by, F.col("_edge._at").alias("_at"), F.col("_edge._row").alias("_row"), "_slice")
    )


def asof_by_interval(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_ts: str,
    right_ts: str,
) -> DataFrame:
    """Backward as-of join through validity intervals, for a right side with few
    rows per key: a right row is valid until the next one of its key."""
    by = list(by)
    payload = [c for c in right.columns if c not in by]
    following = F.lead(right_ts).over(Window.partitionBy(*by).orderBy(right_ts))
    spans = right.where(F.col(right_ts).isNotNull()).select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)],
        F.struct(*payload).alias("_row"),
        F.col(right_ts).alias("_from"),
        following.alias("_until"),
    )
    on = (F.col("_from") <= F.col(left_ts)) & (F.col("_until").isNull() | (F.col(left_ts) < F.col("_until")))
    for i, c in enumerate(by):
        on = on & (F.col(c) == F.col(f"_k{i}"))
    joined = left.join(spans, on, "left")
    return joined.select(*left.columns, *[F.col(f"_row.{c}").alias(c) for c in payload])


def asof_at(
    right: DataFrame, by: Sequence[str], right_ts: str, at: Column, direction: str = "backward"
) -> DataFrame:
    """The row of each key an as-of join would find for one fixed time.

    When every left row has the same time, an as-of join is this aggregate
    (combined before the exchange) and an ordinary left join on the key.
    """
    _check(direction)
    by = list(by)
    payload = [c for c in right.columns if c not in by]
    backward = direction == "backward"
    near = right.where(F.col(right_ts) <= at if backward else F.col(right_ts) >= at)
    pick = F.max_by if backward else F.min_by
    return near.groupBy(*by).agg(pick(F.struct(*payload), F.col(right_ts)).alias("_row")).select(*by, "_row.*")
