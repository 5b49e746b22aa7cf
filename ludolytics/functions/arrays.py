"""Array column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def no_longs() -> Column:
    return F.array().cast("array<bigint>")


def without(values: Column | str, excluded: Column | str) -> Column:
    """Drop the excluded values but keep order and duplicates of the rest."""
    excluded = F.col(excluded) if isinstance(excluded, str) else excluded
    return F.filter(values, lambda x: ~F.array_contains(excluded, x))


def any_contains_text(values: Column | str, needles: Sequence[str]) -> Column:
    """Whether any element contains any needle, ignoring case."""
    lowered = [n.lower() for n in needles]

    def hit(x: Column) -> Column:
        tests = [F.contains(F.lower(x), F.lit(n)) for n in lowered]
        out = tests[0]
        for t in tests[1:]:
            out = out | t
        return out

    return F.exists(values, hit)


def any_of(values: Column | str, wanted: Sequence[str]) -> Column:
    return F.arrays_overlap(values, F.array(*[F.lit(w) for w in wanted]))
