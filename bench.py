"""Headline queries, one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
Each query is built and run to the end once after a warm-up query; its time includes planning.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from paysift import build_session  # noqa: E402
from paysift.plans import load_all  # noqa: E402

HEADLINES = [
    "annualised_pay", "salary_filter_reasons", "page_texts", "document_keys", "salary_lineage", "tiers_by_thirds", "attached_item_lists", "item_pair_counts", "itemsets_held", "fact_table",
    "olap_top_items", "olap_by_experience", "olap_industry_state", "salary_by_item", "quantiles_by_priority", "rank_correlation", "document_overlap", "company_capped_snapshots", "imputed_salaries",
    "salary_z_scores", "documents_without_reposts", "vocabulary", "matched_words", "matched_terms", "frequent_itemsets", "association_rules", "high_tier_rules", "scored_rules", "validated_rules",
    "cooccurrence_graph", "jaccard_network", "related_titles", "grouped_design", "leakage_report", "connected_documents", "prediction_intervals", "rule_intervals", "feature_totals", "auc_per_class",
    "nearest_neighbours", "euclidean_silhouette", "density_clusters", "isolation_flags", "job_facts", "encoded_rows", "market_export", "csv_round_trip", "replaced_snapshots", "streamed_snapshots",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("paysift-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
                          spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"), spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    registry = load_all()
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINES
    registry["table_counts"](spark, folder).collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        registry[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": Path(folder).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
