"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the cores, BENCH_QUERIES (optional) a comma-separated choice or ``all``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from casemill.plans.registry import all_queries
from casemill.session import clear_scratch, local_session

HEADLINE = [
    "bulk_ingest", "incremental_refresh", "kpi_summary", "volume_by_month_group", "top_categories", "yoy_growth", "detect_spikes",
    "emerging_scores", "default_analytics", "company_benchmark", "column_profile", "facts_scale", "lag_correlation", "mapping_coverage",
    "entity_review", "opportunities", "value_scenarios", "value_sensitivity", "sample_summary", "class_report", "stratified_split",
    "clean_text", "tfidf_weights", "lexical_topk", "dense_topk", "hybrid_topk", "retrieval_eval", "index_search", "topic_registry",
    "router_report", "answers", "final_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    queries = all_queries()
    names = list(queries) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus)
    queries["kpi_summary"](spark, sf_dir).collect()  # start the session and warm the file system cache
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        clear_scratch(spark)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
