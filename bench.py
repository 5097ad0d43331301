"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_QUERIES (comma separated) change what runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from supplyloom.plans import catalog  # noqa: E402
from supplyloom.session import local_session  # noqa: E402
from supplyloom.storage import clear_scratch  # noqa: E402

HEADLINES = (
    "silver_relations",
    "probability_profile",
    "degree_distribution",
    "edge_split",
    "edge_batches",
    "fanout_sample",
    "two_hop_blocks",
    "negatives_uniform",
    "negatives_strict",
    "sage_embeddings",
    "sage_embeddings_pool",
    "order_graph_embeddings",
    "score_relations",
    "gold_refined",
    "auc_ap_by_batch",
    "auc_ap_pooled",
    "topk_missing_links",
    "risk_enriched",
    "supplier_tiers",
    "entity_resolution",
    "stream_silver",
    "train_link_model",
    "evaluate_link_model",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), app="supplyloom-bench")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINES
    queries = catalog.queries()
    seconds: dict[str, float] = {}
    # One untimed query starts the JVM's and the Python workers' warm-up.
    queries["confidence_filter"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    clear_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
