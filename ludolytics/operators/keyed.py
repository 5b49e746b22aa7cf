"""Per-key selection: latest row, top rows, ordered lists, upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int = 1,
    rank: str | None = None,
) -> DataFrame:
    """The first ``n`` rows of every key.

    The bound on ``row_number`` lets the optimizer trim each key to ``n`` rows
    before the exchange, so one hot key sends ``n`` rows per input partition.
    """
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col(name) <= n)
    return kept if rank else kept.drop(name)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_rows(df, keys, order)


def total_order(df: DataFrame, skip: Sequence[str] = ()) -> list[Column]:
    """Every orderable column, so that equal leading keys still sort one way."""
    return [F.col(c).desc_nulls_last() for c, kind in df.dtypes if c not in skip and "map<" not in kind]


def top_ids_by_group(
    df: DataFrame, group: str, order: Sequence[Column], item: str, k: int, out: str
) -> DataFrame:
    """One row per group with its best ``k`` items as a list in rank order."""
    best = top_rows(df, [group], order, k, rank="_rank")
    return best.groupBy(group).agg(ordered_list("_rank", item).alias(out))


def ordered_list(sort_key: str | Sequence[str], item: str) -> Column:
    """Aggregate: ``item`` values as a list sorted by ``sort_key``, then by item."""
    keys = [sort_key] if isinstance(sort_key, str) else list(sort_key)
    packed = F.sort_array(F.collect_list(F.struct(*keys, F.col(item).alias("_item"))))
    return F.transform(packed, lambda entry: entry["_item"])


def multiset_list(item: Column, copies: Column) -> Column:
    """Aggregate: sorted list holding ``item`` as often as ``copies`` says.

    Feed it rows already reduced to one per (group, item): what is collected is
    then bounded by the number of distinct items, however many rows the group has.
    """
    packed = F.sort_array(F.collect_list(F.when(copies > 0, F.struct(item.alias("i"), copies.alias("n")))))
    return F.flatten(F.transform(packed, lambda e: F.array_repeat(e["i"], e["n"].cast("int"))))


def upsert_by_key(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``updates`` replace rows of ``target`` with the same key."""
    keys = list(keys)
    changed = updates.select(*keys)
    return target.join(changed, keys, "left_anti").unionByName(updates, allowMissingColumns=True)
