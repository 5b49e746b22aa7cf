"""Ranking metrics of one row: a recommended list against a relevant list.

Recommendations are in rank order. Metrics that divide by the number of relevant
items are NULL when there are none.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _top(recs: Column, k: int) -> Column:
    return F.slice(recs, 1, k)


def hit(truth: Column, recs: Column, k: int) -> Column:
    return F.arrays_overlap(truth, _top(recs, k)).cast("int")


def precision(truth: Column, recs: Column, k: int) -> Column:
    return F.size(F.array_intersect(_top(recs, k), truth)) / F.lit(k)


def recall(truth: Column, recs: Column, k: int) -> Column:
    relevant = F.size(F.array_distinct(truth))
    return F.when(relevant > 0, F.size(F.array_intersect(_top(recs, k), truth)) / relevant)


def _gains(truth: Column, recs: Column, k: int) -> Column:
    """Ranks (from 1) of the first occurrences of relevant items within the top k."""
    top = _top(recs, k)
    return F.filter(
        F.transform(F.array_distinct(top), lambda x: F.when(F.array_contains(truth, x), F.array_position(top, x))),
        lambda rank: rank.isNotNull(),
    )


def average_precision(truth: Column, recs: Column, k: int) -> Column:
    """Sum of hits-so-far/rank over the hits, divided by min(k, length of truth)."""
    ranks = _gains(truth, recs, k)
    total = F.aggregate(
        F.transform(ranks, lambda rank, i: (i + 1) / rank), F.lit(0.0), lambda acc, x: acc + x
    )
    return F.when(F.size(truth) > 0, total / F.least(F.lit(k), F.size(truth)))


def ndcg(truth: Column, recs: Column, k: int) -> Column:
    """Binary gain with a log2(rank + 1) discount over the best possible order."""

    def discounted(ranks: Column) -> Column:
        return F.aggregate(ranks, F.lit(0.0), lambda acc, rank: acc + 1 / F.log2(rank + 1.0))

    relevant = F.least(F.size(F.array_distinct(truth)), F.lit(k))
    ideal = F.when(relevant > 0, F.sequence(F.lit(1), relevant))
    return F.when(relevant > 0, discounted(_gains(truth, recs, k)) / discounted(ideal))
