"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import time

from riskloom.plans.catalog import QUERIES
from riskloom.session import local_session

HEADLINE = [
    "a11_feature_table",
    "a11_features_from_documents",
    "j2_labels_joined",
    "r1_band_distribution",
    "r2_band_profile",
    "r3_top_delinquent",
    "r4_default_rate_by_band",
    "r5_pd_quintiles",
    "w2_ntile",
    "w3_decile",
    "w4_cumulative_shares",
    "w5_chronology_breaks",
    "w6_balance_breaks",
    "m2_stratified_split",
    "m7_m9_discrimination",
    "m12_decile_table",
    "p1_trades",
    "p2_transactions",
    "s4_quarantine",
    "d2_missing_keys",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("riskloom-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # The first query pays for the JVM's warm-up; it is not part of any figure.
    QUERIES["r1_band_distribution"](spark, sf_dir).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
