"""Properties of the physical plans that matter at scale."""

from __future__ import annotations

import pytest

from conftest import SMALL
from ledgerloom.plans import marts
from ledgerloom.registry import QUERIES, bed

WRITES = {"ingest_tables", "sink_mart_table", "sink_cluster", "sink_raw_partitioned", "sink_cleanup", "store_failures"}
WRITES |= {"stream_upsert", "dq_report", "ingest_backfill_stored", "rolling_horizons", "distinct_from_daily_state", "store_failures_counts"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_quadratic_or_python_operators(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text


def test_one_scan_of_transactions(bed):
    assert plan(marts.customer_txn_summary(bed)).count("FileScan") == 1


def test_latest_rows_are_reduced_before_the_shuffle(spark):
    for name in ("ingest_dedup_latest", "top1_per_group", "stg_credit_scores", "scd2_from_changes"):
        text = plan(QUERIES[name](spark, SMALL))
        assert "row_number(), 1, Partial" in text, name


def test_window_reaches_the_scan(spark):
    text = plan(QUERIES["ingest_window_filter"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-08T00:00), LessThan(ts,2024-01-22T00:00)]" in text


def test_columns_are_pruned(spark):
    text = plan(QUERIES["distinct_rows"](spark, SMALL))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_no_window_spans_a_whole_key(spark):
    """Flags and successors are found without sorting all rows of a key in one task."""
    text = plan(QUERIES["scd2_from_changes"](spark, SMALL))
    assert "windowspecdefinition(customer_id" in text
    lead = [line for line in text.splitlines() if "lead(updated_at" in line]
    assert lead and all("_bucket" in line for line in lead)
    flag = plan(bed(spark, SMALL).ref("stg_credit_scores"))
    assert flag.count("WindowGroupLimit") == 2


def test_distinct_counts_do_not_carry_the_metrics(bed):
    """Two scans: additive metrics in one, narrow pairs for the distinct counts in the other."""
    text = plan(bed.ref("mart_transaction_analytics"))
    assert "Expand" not in text and text.count("FileScan") == 2


def test_merge_is_one_join(spark):
    from ledgerloom.operators.merge import merge_upsert

    target = spark.range(100_000).selectExpr("id AS k", "id AS v", "timestamp_ntz '2024-01-01' AS t")
    text = plan(merge_upsert(target, target.limit(5), "k", "t"))
    assert text.count("FullOuter") == 1 and "LeftAnti" not in text
