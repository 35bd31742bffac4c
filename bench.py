"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one line of JSON."""

from __future__ import annotations

import json
import os
import re
import tempfile
import time

from kinspan.plans import QUERIES
from kinspan.session import session

HEADLINE = [
    "degree_distribution",
    "graph_counts",
    "key_degree_report",
    "validate_relations",
    "sort_edges",
    "unique_edges",
    "raw_edges",
    "summary_edges",
    "pair_events",
    "pair_event_spans",
    "bulk_load",
    "pair_lookup_raw",
    "pair_lookup_summary",
    "incident_edges_raw",
    "incident_edges_summary",
    "k_hop_average",
    "local_clustering",
    "average_clustering",
    "rows_with_columns",
    "latest_cells",
    "batch_get",
    "range_counts",
    "lookup_ids",
    "upsert",
    "line_counts",
    "sample_lines",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "kinspan-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="kinspan-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["event_type_counts"](spark, sf_dir).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
