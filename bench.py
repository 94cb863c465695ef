"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` a
comma-separated choice of queries. Every query runs to the end over all its rows and columns
(into the no-op sink), after one untimed query that starts the session.
"""

from __future__ import annotations

import json
import os
import re
import time

from checks.queries import QUERIES
from qaspark.session import build_session

HEADLINE = [
    "yearly_counts", "survey_trend", "trends_merged", "trends_payload", "mean_of_yearly", "sample_per_year",
    "clean_questions", "html_to_text", "dedupe_first", "latest_within_ttl", "describe", "box_stats", "count_pivot",
    "tag_frequency", "tag_pairs", "cooccurrence_edges", "degree_centrality", "network_payload", "top_cotags",
    "tokenize", "top_words", "term_counts", "vocabulary", "tfidf", "cluster_labels",
    "top_patterns", "patterns_payload", "betweenness", "communities", "core_distance", "density_clusters", "svd_energy",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["rows_per_language"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
