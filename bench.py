"""Headline queries at one scale; prints one JSON line.

BENCH_SF_DIR: data folder (default /root/testdata/sf0.1). BENCH_CPUS: local cores (default 8).
Every query starts from the given tables: layers it needs are built inside its own time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scriptloom.plans.bind import Corpus  # noqa: E402
from scriptloom.plans.catalog import QUERIES  # noqa: E402
from scriptloom.session import get_session  # noqa: E402

HEADLINE = [
    "q_clean_script", "q_repair_tags", "q_mention_count", "q_participants", "q_summary_edges", "q_edges_union",
    "q_entities", "q_cooccurrence", "q_cooccur_top", "q_cooccur_for", "q_collate_relations", "q_relation_rows",
    "q_grep_literal", "q_grep_regex", "q_resolve_links", "q_content_hash", "q_unit_plan", "q_requests",
    "q_corpus_stats", "q_related_containers", "q_similar_names", "q_whats_new", "q_build_report", "q_container_entities",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](Corpus(spark, folder)).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
