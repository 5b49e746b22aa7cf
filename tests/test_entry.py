import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import TABLES, rows
from ludolytics.workloads import WORKLOADS

SMALL = "/root/testdata/sf0.001"

# a cross-section; check_queries.py runs all of them
COMPARED = [
    "monthly_game_metrics",
    "int_deduplicated_reviews",
    "mart_entities_cumulative",
    "training_features",
    "asof_forward_sliced",
    "evaluate_rows",
    "recommend_random",
    "exact_sample",
    "five_numbers",
    "semantic_search_batch",
    "metadata_search",
    "clean_html",
    "chunk_fixed",
    "incremental_append",
    "incremental_append_null_mark",
    "streaming_ingest",
    "vectors_by_group",
    "run_experiment",
    "fold_preferences",
    "kernel_density_log",
    "unaccepted_categories",
    "list_index_few_probes",
    "chunk_recursive",
    "versioned_merge",
    "streaming_merge",
    "search_ready_sessions",
    "stored_index_all_probes",
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS FROM '{SMALL}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", COMPARED)
def test_query_equals_its_sql(spark, duck, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    want = duck.sql(entry.oracle_sql()[name]).df()
    assert len(got) > 0
    assert rows(got) == rows(want)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(WORKLOADS) >= 100
    covered = {line for w in WORKLOADS.values() for line in w.covers.split()}
    for family, last in {"P": 17, "J": 16, "G": 18, "R": 4, "W": 6, "K": 9, "U": 3, "I": 16, "M": 23, "V": 5, "D": 3,
                         "X": 6, "T": 9, "F": 27, "Z": 2, "Y": 2}.items():
        missing = [f"{family}{n:02d}" for n in range(1, last + 1) if f"{family}{n:02d}" not in covered]
        assert not missing, missing
