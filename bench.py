"""Time the headline queries and print one JSON line.

Each query is computed in full into Spark's no-op sink. A first, untimed round over all of them warms the
JVM, so the order of the list does not matter.
"""

from __future__ import annotations

import json
import os
import time

from ledgerloom.registry import QUERIES
from ledgerloom.session import local_session

HEADLINE = (
    "mart_customer_360",
    "mart_customer_lifetime_value",
    "mart_credit_risk_servicing",
    "mart_fraud_analytics",
    "mart_transaction_analytics",
    "stg_transactions",
    "stg_credit_scores",
    "customer_txn_summary",
    "ingest_dedup_latest_composite",
    "ingest_merge_upsert",
    "ingest_backfill",
    "scd2_snapshot",
    "scd2_from_changes",
    "sample_fraction",
    "dq_unique",
    "dq_relationships",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores=cores, memory=os.environ.get("BENCH_MEMORY", "8g"))
    spark.conf.set("spark.sql.shuffle.partitions", cores)
    timings = {}
    for _ in range(2):
        for name in HEADLINE:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
