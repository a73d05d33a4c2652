"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: one JSON line with seconds each."""

from __future__ import annotations

import json
import os
import time

from millrace.plans.catalogue import QUERIES
from millrace.session import build_session, owned

#: One or two of each family; `noop` writes run a query to its end without collecting it.
HEADLINE = (
    "d1_content_dedup j1_inner_star j3_full_outer_recon j7_priority_resolve j14_bag_match j15_sorted_pairing a3_two_level_rollup a8_rank_percentile a17_grouped_missing "
    "w1_best_of w3_topk_per_group w10_chunking g2_volume_band g3_adaptive_mode g5_verdict g12_evidence_patch u5_delta_plan v1_package_invariants e3_recursive_path t2_pii_redact t4_collateral x1_grid_radius_join x3_range_join"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")

    def run(q):
        with owned(spark):
            QUERIES[q](spark, sf_dir).write.format("noop").mode("overwrite").save()

    run(HEADLINE[0])  # start-up is not a query's time
    took = {}
    for q in HEADLINE:
        best = []
        for _ in range(2):
            t = time.perf_counter()
            run(q)
            best.append(time.perf_counter() - t)
        took[q] = round(min(best), 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
