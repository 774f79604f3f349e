"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.  Each query is
planned and run from nothing after one small warm-up; its result is consumed
without being collected.
"""

from __future__ import annotations

import json
import os
import time

from broadsheet.plans.queries import QUERIES
from broadsheet.plans.similarity_export import run_similarity_export
from broadsheet.session import local_session, new_folder

HEADLINE = [
    "clean_revenue",
    "clean_dates",
    "validate_counts",
    "resolve_company",
    "resolve_company_large",
    "enrich_articles",
    "relevance_filter",
    "full_enrichment",
    "knn_by_id",
    "hybrid_search",
    "top3_neighbours",
    "top3_neighbours_blocked",
    "embed_documents",
    "document_neighbours",
    "similarity_job",
    "sql_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in ("enrich_articles", "top3_neighbours"):
            QUERIES[name](spark, small).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    # The similarity job alone, from a stored table to the written export.
    enriched = new_folder(spark, "bench-enriched")
    QUERIES["enrich_articles"](spark, sf_dir).write.parquet(enriched)
    start = time.perf_counter()
    run_similarity_export(spark, enriched, new_folder(spark, "bench-export"), input_format="parquet")
    seconds["similarity_job_alone"] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
