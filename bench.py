"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is written whole to the no-op sink: every row and column is computed, nothing is
collected. The time of a query includes planning.
"""

from __future__ import annotations

import json
import os
import sys
import time

from lexmill.plans.registry import load_all
from lexmill.session import local_session

HEADLINE = (
    "consolidate_texts", "consolidate_cases", "best_text", "dedup_edges", "dedup_law_refs", "canonical_variant",
    "refresh_counts", "degree_summary", "target_catalog", "shared_bodies", "integrity_report",
    "resolve_ecli_targets", "resolve_by_priority", "match_by_date_and_token", "provision_labels", "compare_edge_builds",
    "classify_texts", "flush_link_records", "link_dutch_texts", "resolve_citation_strings", "late_binding",
    "case_identifiers", "swap_dataset", "merge_people_links", "pagerank", "clusters", "inverted_index", "nearest_segments",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    queries = load_all()
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    times = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }), flush=True)


if __name__ == "__main__":
    main()
