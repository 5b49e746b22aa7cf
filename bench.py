"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the cores.
Every query runs once; its rows go to a sink that drops them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from ludolytics.session import build_session
from ludolytics.workloads import WORKLOADS

HEADLINE = [
    "monthly_game_metrics",
    "int_deduplicated_games",
    "int_reviews_with_canonical_id",
    "int_deduplicated_reviews",
    "dim_games",
    "fact_reviews",
    "mart_entities_cumulative",
    "user_features_next_month",
    "training_features",
    "asof_backward",
    "asof_backward_sliced",
    "fit_popularity",
    "topk_by_month",
    "future_ground_truth",
    "evaluate_lists",
    "evaluate_rows",
    "recommend_random",
    "exact_sample",
    "five_numbers",
    "kernel_density",
    "semantic_search_batch",
    "metadata_search",
    "chunk_set_similarity",
    "clean_html",
    "chunk_fixed",
    "chunk_embeddings",
    "flatten_review_payload",
    "incremental_append",
    "streaming_ingest",
    "run_checks",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM's code paths and the Python workers before the clock runs
    smallest = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    warm = smallest if os.path.isdir(smallest) else sf_dir
    WORKLOADS["clean_html"].run(spark, warm).limit(1).collect()
    WORKLOADS["monthly_game_metrics"].run(spark, warm).limit(1).collect()
    wanted = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        WORKLOADS[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": spark.version,
                "shuffle_partitions": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
