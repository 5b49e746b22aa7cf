"""Registered queries: a Spark function over a table folder, the inventory lines it
covers, and SQL over the same tables that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolytics.session import configure


@dataclass(frozen=True)
class Workload:
    name: str
    covers: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


WORKLOADS: dict[str, Workload] = {}


def portable(df: DataFrame, as_text: Sequence[str] = ()) -> DataFrame:
    """Dates, times and lists as text, so that any client compares them alike.

    ``as_text`` names whole-number columns that hold NULLs, which some clients turn
    into floats.
    """
    out = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind == "date":
            column = column.cast("string")
        elif kind.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif kind.startswith("array"):
            column = F.array_join(F.transform(column, lambda x: x.cast("string")), ",")
        elif name in as_text:
            column = column.cast("string")
        out.append(column.alias(name))
    return df.select(*out)


def workload(name: str, covers: str, sql: str | None = None, as_text: Sequence[str] = ()):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(configure(spark), sf_dir.rstrip("/")), as_text)

        WORKLOADS[name] = Workload(name, covers, run, sql)
        return fn

    return register
