from __future__ import annotations

from collections import Counter
from datetime import date, datetime

from helpers import mini, rows
from ledgerloom.catalog import Catalog
from ledgerloom.config import Thresholds
from ledgerloom.operators import quality
from ledgerloom.operators.quality import ACCEPTED, NOT_NULL, RANGE, RELATIONSHIP, UNIQUE, Check
from ledgerloom.plans import checks


def counts(spark, cat, *suite):
    return {(r.column_name, r.test): r.failures for r in quality.failure_counts(spark, cat, suite).collect()}


def test_declared_suite():
    kinds = Counter(c.kind for c in checks.ALL_CHECKS)
    assert kinds == {NOT_NULL: 85, UNIQUE: 42, ACCEPTED: 38, RANGE: 11, RELATIONSHIP: 7}
    assert [len(x) for x in (checks.SOURCE_CHECKS, checks.STAGING_CHECKS, checks.MART_CHECKS)] == [77, 75, 31]
    assert len({c.name for c in checks.ALL_CHECKS}) == 183


def test_each_kind(spark):
    merchants = rows(
        spark,
        "merchants",
        {"merchant_id": 1, "merchant_name": None, "risk_level": "normal", "mcc_code": "5411"},
        {"merchant_id": 1, "merchant_name": "a", "risk_level": None, "mcc_code": "none"},
        {"merchant_id": 2, "merchant_name": "a", "risk_level": "odd", "mcc_code": None},
        {"merchant_id": None, "merchant_name": "b", "risk_level": "odd", "mcc_code": "none"},
        {"merchant_id": None, "merchant_name": "b", "risk_level": "high", "mcc_code": "none"},
    )
    cat = mini(spark, merchants=merchants)
    suite = (
        Check("sources", "merchants", "merchant_name", NOT_NULL),
        Check("sources", "merchants", "merchant_id", UNIQUE),
        Check("sources", "merchants", "merchant_name", UNIQUE),
        Check("sources", "merchants", "risk_level", ACCEPTED, ("normal", "elevated", "high")),
        Check("sources", "merchants", "mcc_code", RELATIONSHIP, parent=("merchant_categories", "mcc_code")),
        Check("sources", "merchants", "merchant_id", RANGE, low="1", high="1"),
    )
    got = counts(spark, cat, *suite)
    assert got == {
        ("merchant_name", NOT_NULL): 1,
        ("merchant_id", UNIQUE): 1,
        ("merchant_name", UNIQUE): 2,
        ("risk_level", ACCEPTED): 2,
        ("mcc_code", RELATIONSHIP): 3,
        ("merchant_id", RANGE): 1,
    }
    for check in suite:
        assert quality.violations(cat, check).count() == got[(check.column, check.kind)], check.name


def test_range_bounds(spark):
    amounts = rows(spark, "transactions", *[{"transaction_id": i, "amount": v} for i, v in enumerate((-1, 0, "0.01"))])
    cat = mini(spark, transactions=amounts)
    check = lambda inclusive: Check("s", "transactions", "amount", RANGE, low="0", inclusive=inclusive)
    assert quality.violations(cat, check(True)).count() == 1
    assert quality.violations(cat, check(False)).count() == 2


def test_empty_relation_reports_zero(spark):
    got = counts(spark, mini(spark), *[c for c in checks.SOURCE_CHECKS if c.model == "accounts"])
    assert len(got) == 9 and set(got.values()) == {0}


def test_assertions(spark):
    accounts = rows(
        spark,
        "accounts",
        {"account_id": 1, "account_status": "Active", "balance": -1},
        {"account_id": 2, "account_status": "dormant", "balance": -1},
        {"account_id": 3, "account_status": "active", "balance": 0},
    )
    flags = lambda confirmed, false: rows(
        spark,
        "fraud_flags",
        *[{"flag_id": i, "is_confirmed_fraud": i < confirmed, "reviewed_at": datetime(2024, 1, 1)} for i in range(confirmed + false)],
        {"flag_id": 999, "is_confirmed_fraud": True},
    )
    cat = mini(spark, accounts=accounts, fraud_flags=flags(21, 80))
    assert [r.account_id for r in quality.no_negative_balance(cat).collect()] == [1]
    assert quality.fraud_rate_out_of_bounds(cat).first().asDict() == {"confirmed_count": 21, "total_flagged": 101}
    assert quality.fraud_rate_out_of_bounds(mini(spark, fraud_flags=flags(20, 81))).count() == 0
    assert quality.fraud_rate_out_of_bounds(mini(spark, fraud_flags=flags(100, 0))).count() == 0
    assert quality.fraud_rate_out_of_bounds(mini(spark)).count() == 0
    assert quality.customer_360_complete(cat).count() == 0


def test_gate(spark):
    report = spark.createDataFrame(
        [("sources", "fail"), ("staging", "pass"), ("staging", "fail"), ("marts", "fail")], "stage string, status string"
    )
    got = {r.stage: (r.tests, r.failing, r.blocked) for r in quality.gate(report).collect()}
    assert got == {"sources": (1, 1, False), "staging": (2, 1, True), "marts": (1, 1, False)}


def test_rates(spark):
    df = rows(spark, "merchants", *[{"merchant_id": i // 2, "city": None if i < 3 else "x"} for i in range(10)])
    got = {
        (r.column_name, r.metric): (r.rate_pct, r.exceeded)
        for r in quality.rate_thresholds(df, "merchants", ["merchant_id", "city"], "merchant_id", Thresholds()).collect()
    }
    assert got == {
        ("merchant_id", "null_rate"): (0.0, False),
        ("city", "null_rate"): (30.0, True),
        ("merchant_id", "duplicate_rate"): (50.0, True),
    }


def test_checks_counted_while_writing_need_no_scan(spark, tmp_path):
    """Counts of a watched write equal those of a scan, and a report that knows them does not read the relation."""
    from ledgerloom.config import RunContext
    from ledgerloom.operators import sinks
    from ledgerloom.operators.quality import ACCEPTED, NOT_NULL, RANGE, UNIQUE, Check, Watch, failure_counts

    rows = [(i, None if i % 7 == 0 else i, "abc"[i % 3], float(i)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, v long, c string, x double").repartition(7)
    mine = [Check("marts", "m", "v", NOT_NULL), Check("marts", "m", "c", ACCEPTED, ("a", "b")), Check("marts", "m", "x", RANGE, low="10", high="400")]
    mine.append(Check("marts", "m", "id", UNIQUE))
    watch = Watch(mine)
    sinks.write_clustered(df, str(tmp_path / "m"), ["c"], ["id"], watch=watch)
    cat = Catalog({"m": lambda: spark.read.parquet(str(tmp_path / "m"))}, RunContext(as_of=date(2024, 1, 1)), {})
    scanned = {(r.column_name, r.test): r.failures for r in failure_counts(spark, cat, mine).collect()}
    assert {(c.column, c.kind): n for c, n in watch.counts().items()} == {k: n for k, n in scanned.items() if k[1] != UNIQUE}
    assert scanned["v", NOT_NULL] == 72 and scanned["x", RANGE] == 109
    by_row = [c for c in mine if c.row_level]
    known = failure_counts(spark, cat, by_row, watch.counts())
    assert "Scan parquet" not in known._jdf.queryExecution().executedPlan().toString()
    full = failure_counts(spark, cat, mine, watch.counts())
    assert full._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, failure_counts(spark, cat, mine).collect()))
    empty = Watch(mine)
    sinks.write_clustered(df.limit(0), str(tmp_path / "none"), (), ["id"], watch=empty)
    assert set(empty.counts().values()) == {0}
