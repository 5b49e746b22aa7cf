"""Whole-table ordering work that never puts the table into one task.

Each function cuts the order into slices, counts the slices, adds up the counts
over the (small) list of slices, and finishes inside each slice in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_SLICES = 64


def running_totals(
    df: DataFrame, order: str, totals: dict[str, str], partition: Sequence[str] = ()
) -> DataFrame:
    """Add a running sum per entry of ``totals`` (output name -> input column).

    Meant for rows already aggregated to one per (partition, calendar unit), so a
    partition never holds more rows than the calendar has days or months.
    """
    window = (
        Window.partitionBy(*partition)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.select("*", *[F.sum(source).over(window).alias(name) for name, source in totals.items()])


def shuffle_key(keys: Sequence[str], seed: int | str) -> Column:
    """A reproducible pseudo-random sort key (32 hex digits) for each row key."""
    parts = [F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]]
    return F.md5(F.concat_ws("|", *parts))


def _slice_counts(tagged: DataFrame, slice_col: str) -> DataFrame:
    """Rows per slice and rows in all slices before it; one row per slice."""
    counts = tagged.groupBy(slice_col).agg(F.count(F.lit(1)).alias("_in_slice"))
    earlier = Window.orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_in_slice").over(earlier), F.lit(0)))


def exact_sample(
    df: DataFrame, n: int, keys: Sequence[str], seed: int = 42, strict: bool = False
) -> DataFrame:
    """Exactly ``n`` rows, chosen by a seeded hash of the unique row ``keys``.

    The sample is "the n smallest hashes". Counting rows per four-digit hash
    prefix (at most 65,536 groups) tells which prefix holds the n-th hash; only
    that prefix is ordered, and the sample itself is a plain filter: no row of
    the table is shuffled. ``strict`` raises when there are fewer rows than ``n``.
    """
    if strict:
        found = df.count()
        if found < n:
            raise ValueError(f"cannot sample {n} rows from {found}")
    if n <= 0:
        return df.limit(0)
    hashed = df.select(shuffle_key(keys, seed).alias("_h")).withColumn("_p", F.substring("_h", 1, 4))
    edge = _slice_counts(hashed, "_p").where((F.col("_before") < n) & (F.col("_before") + F.col("_in_slice") >= n))
    inside = hashed.join(edge, "_p").withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy("_h")))
    cut = inside.where(F.col("_r") + F.col("_before") == n).select("_h")
    # no edge: the table has fewer than n rows and 'g' sorts after every digest
    return df.where(shuffle_key(keys, seed) <= F.coalesce(cut.scalar(), F.lit("g")))


def number_rows(df: DataFrame, keys: Sequence[str], seed: int | str, out: str = "position") -> DataFrame:
    """Dense positions 0..N-1 in the order of the seeded hash of ``keys``."""
    tagged = df.withColumn("_h", shuffle_key(keys, seed)).withColumn("_p", F.substring("_h", 1, 3))
    inner = F.row_number().over(Window.partitionBy("_p").orderBy("_h", *keys))
    numbered = tagged.withColumn("_r", inner).join(_slice_counts(tagged, "_p"), "_p")
    return numbered.withColumn(out, F.col("_before") + F.col("_r") - 1).drop("_h", "_p", "_r", "_before", "_in_slice")


def _with_slice(df: DataFrame, value: str, bounds: DataFrame, out: str) -> DataFrame:
    """Add an order-preserving slice number; a value equal to a bound gets its own.

    Any value that makes up more than 1/64 of the rows is one of the bounds, so a
    slice of several values is always a small part of the table. The bound is found
    by halving, in steps that stay within generated code.
    """
    located = df.withColumn("_bounds", bounds.scalar()).withColumn("_at", F.lit(0))
    step = _SLICES // 2
    while step:
        passed = F.get("_bounds", F.col("_at") + (step - 1)) < F.col(value)
        located = located.withColumn("_at", F.col("_at") + F.when(passed, step).otherwise(0))
        step //= 2
    exact = F.when(F.get("_bounds", F.col("_at")) == F.col(value), 1).otherwise(0)
    return located.withColumn(out, F.col("_at") * 2 + exact).drop("_bounds", "_at")


def _bounds(df: DataFrame, value: str) -> DataFrame:
    steps = [i / _SLICES for i in range(1, _SLICES)]
    found = F.array_distinct(F.percentile_approx(value, F.array(*map(F.lit, steps)), 10_000))
    return df.agg(found.alias("bounds"))


def full_rank(
    df: DataFrame, group: str, value: str, tie: str, out: str = "rank", tie_width: int = 65_536
) -> DataFrame:
    """Rank of every row in its group by ``value`` descending, then ``tie`` ascending.

    Unlike a plain window, a group is ranked by many tasks: slices of the value
    order, split again by ranges of the integer ``tie`` column, are ranked one by
    one and shifted by the size of the slices before them.
    """
    # NULL values rank last, as the last slice
    part = F.when(F.col(value).isNotNull(), -F.col("_s")).otherwise(F.lit(1))
    chunk = F.when(F.col("_s") % 2 != 0, F.floor(F.col(tie) / tie_width)).otherwise(F.lit(0))
    tagged = _with_slice(df, value, _bounds(df, value), "_s").withColumn("_s", part).withColumn("_t", chunk)
    slice_keys = [group, "_s", "_t"]
    sizes = tagged.groupBy(*slice_keys).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_s", "_t").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *slice_keys,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    inner = Window.partitionBy(*slice_keys).orderBy(F.col(value).desc_nulls_last(), F.col(tie).asc_nulls_last())
    ranked = tagged.withColumn("_r", F.row_number().over(inner))
    matched = ranked.alias("r").join(
        offsets.alias("o"),
        F.col(f"r.{group}").eqNullSafe(F.col(f"o.{group}"))
        & (F.col("r._s") == F.col("o._s"))
        & (F.col("r._t").eqNullSafe(F.col("o._t"))),
        "inner",
    )
    return matched.select(*[F.col(f"r.{c}") for c in df.columns], (F.col("o._before") + F.col("r._r")).alias(out))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    by: Sequence[str] = (),
    method: str = "nearest",
) -> DataFrame:
    """Exact quantiles (output name -> probability), one row per group of ``by``.

    ``nearest`` takes the value at index ``round(p * (n - 1))``, ``linear``
    interpolates. Equal values are counted before anything is ordered, and the
    ordering is done slice by slice, so neither a hot group nor a hot value
    collects in one task.
    """
    if method not in ("nearest", "linear"):
        raise ValueError(f"unknown quantile method: {method}")
    by = list(by)
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    tagged = _with_slice(counts, "_v", _bounds(df, value), "_s")
    sizes = tagged.groupBy(*by, "_s").agg(F.sum("_n").alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)],
        F.col("_s").alias("_so"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("_total"),
    )
    inner = (
        Window.partitionBy(*by, "_s").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    on = F.col("_s") == F.col("_so")
    for i, c in enumerate(by):
        on = on & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    placed = tagged.withColumn("_upto", F.sum("_n").over(inner)).join(offsets, on)
    # a value with its copies covers the sorted indexes first..last
    last = F.col("_before") + F.col("_upto") - 1
    first = last - F.col("_n") + 1

    def at(index: Column) -> Column:
        return F.max(F.when((first <= index) & (index <= last), F.col("_v")))

    out = []
    for name, p in probs.items():
        spot = (F.col("_total") - 1) * F.lit(p)
        if method == "nearest":
            out.append(at(F.round(spot)).cast("double").alias(name))
        else:
            low, high = at(F.floor(spot)).cast("double"), at(F.ceil(spot)).cast("double")
            share = F.max(spot - F.floor(spot))
            out.append((low + (high - low) * share).alias(name))
    return placed.groupBy(*by).agg(*out)
