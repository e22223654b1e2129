"""One customer holds a third of all orders and events, some of them at the same moment: same answers, no hot task."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from compare import compare, connect
from conftest import SMALL
from ledgerloom.registry import ORACLE, QUERIES

HOT = {"orders": ("o_orderkey", "o_custkey"), "events": ("event_id", "user_id")}
CHECKED = (
    "stg_credit_scores",
    "mart_customer_360",
    "mart_credit_risk_servicing",
    "mart_fraud_analytics",
    "mart_transaction_analytics",
    "customer_txn_summary",
    "ingest_dedup_latest",
    "ingest_merge_upsert",
    "ingest_merge_dedup_guard",
    "insert_ignore",
    "scd2_snapshot",
    "scd2_from_changes",
    "as_of_lookup",
    "as_of_join",
    "as_of_join_history",
    "rolling_horizons",
    "distinct_from_daily_state",
    "stream_upsert",
    "dq_relationships",
    "dq_unique",
    "dq_rate_thresholds",
)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("skewed")
    for f in os.listdir(SMALL):
        name = f.removesuffix(".parquet")
        if name not in HOT:
            os.symlink(f"{SMALL}/{f}", root / f)
            continue
        row, owner = HOT[name]
        df = spark.read.parquet(f"{SMALL}/{f}")
        df = df.withColumn(owner, F.when(F.col(row) % 3 == 0, F.lit(7)).otherwise(F.col(owner)).cast("bigint"))
        if name == "events":
            df = df.withColumn("ts", F.when(F.col(row) % 6 == 0, F.date_trunc("day", "ts").cast("timestamp_ntz")).otherwise(F.col("ts")))
        df.coalesce(1).write.parquet(str(root / "parts" / name))
        (part,) = (root / "parts" / name).glob("part-*.parquet")
        os.symlink(part, root / f)
    return str(root)


@pytest.fixture(scope="module")
def duck(skewed):
    return connect(skewed)


@pytest.mark.parametrize("name", CHECKED)
def test_same_answer(spark, duck, skewed, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLE[name], skewed) is None


def test_adaptive_execution_splits_the_hot_customer(spark, skewed):
    """The marts' joins are shaped so that a skewed side can be split, once it is too large to broadcast."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        df = QUERIES["mart_fraud_analytics"](spark, skewed)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    final = plan.split("Initial Plan")[0]
    hot = [line for line in final.splitlines() if "SortMergeJoin(skew=true)" in line]
    assert any("customer_id" in line for line in hot), final[:3000]
