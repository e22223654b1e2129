"""Edge rows of the staging models and marts, with hand-computed answers."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from helpers import AS_OF, CTX, by_key, mini, rows
from ledgerloom.plans import marts

NOON = datetime(2024, 6, 3, 12)  # a Monday


def txn(i, customer=1, days_ago=0, **more):
    day = AS_OF - timedelta(days=days_ago)
    base = {
        "transaction_id": i,
        "customer_id": customer,
        "account_id": customer,
        "type_id": 1,
        "amount": 100,
        "amount_idr": 100,
        "fee_amount": 0,
        "currency": "IDR",
        "channel": "mobile",
        "transaction_status": "completed",
        "transaction_date": day,
        "transaction_at": datetime(day.year, day.month, day.day, 10),
    }
    return base | more


def test_stg_customers(spark):
    cat = mini(
        spark,
        customers=rows(
            spark,
            "customers",
            {"customer_id": 1, "full_name": "Budi", "gender": " m", "date_of_birth": date(2000, 12, 31), "email": " A@B.C "},
            {"customer_id": 2, "deleted_at": NOON},
        ),
    )
    (r,) = cat.ref("stg_customers").collect()
    assert (r.customer_id, r.full_name, r.gender, r.age_years, r.email, r.is_deleted) == (1, "Bu***di", "M", 24, "a@b.c", False)
    prod = mini(spark, replace(CTX, env="prod"), customers=rows(spark, "customers", {"full_name": "Budi"}))
    assert prod.ref("stg_customers").first().full_name == "Budi"


def test_stg_accounts_filter_and_flags(spark):
    closed = lambda i, days: {"account_id": i, "account_status": "closed", "closed_date": days and AS_OF - timedelta(days=days)}
    accounts = rows(
        spark,
        "accounts",
        closed(1, 365),
        closed(2, 366),
        closed(3, None),
        {"account_id": 4, "account_status": None},
        {"account_id": 5, "account_status": "Active ", "product_type_id": 5, "balance": 100, "available_balance": 70, "dpd": 95, "outstanding_balance": 40},
        {"account_id": 6, "account_status": "active", "product_type_id": 99, "opened_date": AS_OF - timedelta(days=9)},
        {"account_id": 7, "account_status": None, "closed_date": AS_OF},
    )
    got = by_key(mini(spark, accounts=accounts).ref("stg_accounts"), "account_id")
    assert sorted(got) == [1, 5, 6, 7]
    five = got[5]
    assert (five.account_status, five.is_active, five.product_category) == ("active", False, "loan")
    assert (five.blocked_balance, five.outstanding_balance, five.dpd) == (Decimal("30.00"), Decimal("100.00"), 0)
    assert (got[6].product_code, got[6].outstanding_balance, got[6].account_age_days) == (None, Decimal("0.00"), 9)
    real = by_key(mini(spark, replace(CTX, servicing=True), accounts=accounts).ref("stg_accounts"), "account_id")
    assert (real[5].dpd, real[5].outstanding_balance) == (95, Decimal("40.00"))


def test_stg_loans(spark):
    apps = rows(
        spark,
        "loan_applications",
        {"application_id": 1, "requested_amount": 0, "approved_amount": 5, "collateral_type": None, "application_status": "approved"},
        {"application_id": 2, "requested_amount": 200, "approved_amount": 50, "collateral_type": "none", "application_status": "Disbursed", "submitted_at": NOON, "decided_at": NOON + timedelta(days=3)},
        {"application_id": 3, "deleted_at": NOON},
    )
    got = by_key(mini(spark, loan_applications=apps).ref("stg_loan_applications"), "application_id")
    assert sorted(got) == [1, 2]
    assert (got[1].approval_ratio, got[1].has_collateral, got[1].is_approved, got[1].days_to_decision) == (None, None, True, None)
    assert (got[2].approval_ratio, got[2].has_collateral, got[2].is_disbursed, got[2].days_to_decision) == (0.25, False, False, 3)
    assert got[2].application_status == "disbursed"


def test_stg_scores_ties(spark):
    scores = rows(
        spark,
        "credit_scores",
        {"score_id": 1, "customer_id": 1, "score_value": 600, "score_date": AS_OF},
        {"score_id": 2, "customer_id": 1, "score_value": 700, "score_date": AS_OF},
        {"score_id": 3, "customer_id": 2, "score_value": 500, "score_date": None},
    )
    got = by_key(mini(spark, credit_scores=scores).ref("stg_credit_scores"), "score_id")
    assert {k: r.is_latest_score for k, r in got.items()} == {1: False, 2: True, 3: True}
    assert got[2].score_band_derived == "good"


@pytest.mark.parametrize(
    "category, direction",
    [("credit", "credit"), ("reversal", "credit"), ("Debit", "debit"), ("FEE", "debit"), ("transfer", "unknown"), (None, "unknown")],
)
def test_direction(spark, category, direction):
    types = rows(spark, "transaction_types", {"type_id": 1, "type_category": category})
    cat = mini(spark, transactions=rows(spark, "transactions", txn(1)), transaction_types=types)
    assert cat.ref("stg_transactions").first().amount_direction == direction


def test_stg_transactions_times_and_values(spark):
    hours = [0, 5, 6, 23]
    facts = rows(
        spark,
        "transactions",
        *[txn(h, transaction_at=datetime(2024, 6, 1, h), transaction_date=date(2024, 6, 1)) for h in hours],
        txn(50, amount_idr=50_000_000, transaction_date=date(2024, 6, 2), transaction_at=datetime(2024, 6, 2, 9)),
        txn(51, amount_idr="50000000.01", fee_amount="1.50", transaction_date=date(2024, 6, 3), transaction_status=" FAILED", method_id=99),
    )
    got = by_key(mini(spark, transactions=facts).ref("stg_transactions"), "transaction_id")
    assert [got[h].is_off_hours for h in hours] == [True, True, False, False]
    assert [got[i].is_business_day for i in (0, 50, 51)] == [False, False, True]  # Saturday, Sunday, Monday
    assert (got[0].transaction_day_of_week, got[50].transaction_day_of_week) == (7, 1)
    assert (got[50].is_high_value, got[51].is_high_value) == (False, True)
    assert (got[51].total_amount_idr, got[51].is_failed, got[51].is_completed) == (Decimal("50000001.51"), True, False)
    assert (got[51].payment_method_code, got[51].transaction_month_key) == (None, "2024-06")


def test_stg_flags(spark):
    flags = rows(
        spark,
        "fraud_flags",
        {"flag_id": 1, "severity": " Critical", "confidence_score": "0.8000", "is_confirmed_fraud": True},
        {"flag_id": 2, "severity": "odd", "confidence_score": "0.7999", "is_confirmed_fraud": False, "reviewed_at": NOON},
        {"flag_id": 3, "reviewed_at": NOON},
        {"flag_id": 4},
    )
    got = by_key(mini(spark, fraud_flags=flags).ref("stg_fraud_flags"), "flag_id")
    assert [got[i].review_status for i in (1, 2, 3, 4)] == ["confirmed_fraud", "false_positive", "reviewed_inconclusive", "pending_review"]
    assert [(got[i].is_high_confidence, got[i].severity_score) for i in (1, 2)] == [(True, 4), (False, 0)]


def customer_world(spark, ctx=CTX):
    """1 busy, 2 without transactions or accounts, 3 dormant, 4 soft-deleted, 5 with channel ties."""
    return mini(
        spark,
        ctx,
        customers=rows(
            spark,
            "customers",
            *[{"customer_id": i, "onboarding_branch_id": 1} for i in (1, 2, 3, 5)],
            {"customer_id": 4, "deleted_at": NOON},
        ),
        branches=rows(spark, "branches", {"branch_id": 1, "branch_name": "HQ", "deleted_at": NOON}),
        accounts=rows(
            spark,
            "accounts",
            {"account_id": 1, "customer_id": 1, "account_status": "active", "product_type_id": 1, "balance": 10, "opened_date": date(2024, 5, 31)},
            {"account_id": 2, "customer_id": 1, "account_status": "dormant", "product_type_id": 5, "balance": 20, "dpd": 90},
            {"account_id": 3, "customer_id": 3, "account_status": "active", "product_type_id": 4, "balance": 30},
        ),
        transactions=rows(
            spark,
            "transactions",
            txn(1, 1, 30),
            txn(2, 1, 31, channel="atm"),
            txn(3, 1, 7, transaction_status="failed", amount_idr=999),
            txn(4, 3, 181, channel="web"),
            txn(5, 4, 1),
            txn(6, 5, 180, channel="atm"),
            txn(7, 5, 180, channel="branch"),
        ),
        loan_applications=rows(
            spark,
            "loan_applications",
            {"application_id": 1, "customer_id": 1, "application_status": "disbursed", "approved_amount": 7},
            {"application_id": 2, "customer_id": 1, "application_status": "rejected", "approved_amount": None},
        ),
        credit_scores=rows(
            spark,
            "credit_scores",
            {"score_id": 1, "customer_id": 1, "score_value": 600, "score_date": date(2024, 1, 1)},
            {"score_id": 2, "customer_id": 1, "score_value": 650, "score_date": date(2024, 2, 1)},
        ),
    )


def test_customer_360(spark):
    got = by_key(customer_world(spark).ref("mart_customer_360"), "customer_id")
    assert sorted(got) == [1, 2, 3, 5]
    one, two, three, five = (got[i] for i in (1, 2, 3, 5))
    assert (one.total_accounts, one.active_accounts, one.savings_accounts, one.loan_accounts, one.product_count) == (2, 1, 1, 1, 2)
    assert (one.total_balance_idr, one.total_outstanding_loan_idr, one.max_dpd) == (Decimal("10.00"), Decimal("20.00"), 0)
    assert (one.total_transactions, one.txn_count_30d, one.txn_count_90d, one.txn_volume_90d_idr) == (3, 1, 2, Decimal("200.00"))
    assert (one.preferred_channel, one.digital_adoption_score, one.days_since_last_txn, one.is_dormant) == ("mobile", 33.3, 7, False)
    assert (one.total_loan_applications, one.rejected_loans, one.total_disbursed_idr) == (2, 1, Decimal("7.00"))
    assert (one.latest_credit_score, one.onboarding_branch_name, one.is_npl_customer) == (650, None, False)
    assert (one.active_transaction_days, one.tenure_months) == (3, 5)
    assert (two.total_accounts, two.total_balance_idr, two.preferred_channel, two.product_count) == (0, Decimal("0.00"), "mobile", 0)
    assert (two.is_dormant, two.days_since_last_txn, two.digital_adoption_score, two.tenure_months) == (None, None, None, None)
    assert (three.is_dormant, three.product_count, three.preferred_channel) == (True, 0, "mobile")
    assert (five.is_dormant, five.preferred_channel) == (False, "atm")
    real = by_key(customer_world(spark, replace(CTX, servicing=True)).ref("mart_customer_360"), "customer_id")
    assert (real[1].max_dpd, real[1].is_npl_customer) == (90, True)


def test_every_score_has_its_weight(spark, monkeypatch):
    for name in ("r_score", "f_score", "m_score"):
        monkeypatch.setattr(marts, "RFM_WEIGHTS", {n: "1.00" if n == name else "0.00" for n in ("m_score", "f_score", "r_score")})
        for r in customer_world(spark).ref("mart_customer_lifetime_value").collect():
            assert r.rfm_score == r[name]


def test_lifetime_value(spark):
    got = by_key(customer_world(spark).ref("mart_customer_lifetime_value"), "customer_id")
    assert {i: r.r_score for i, r in got.items()} == {1: 5, 2: 1, 3: 1, 5: 2}
    assert (got[2].recency_days, got[2].rfm_score, got[2].clv_segment) == (9999, Decimal("1.00"), "lost")
    # 0.25 * 5 + 0.35 + 0.40
    assert (got[1].rfm_score, got[1].clv_segment, got[1].estimated_clv_idr) == (Decimal("2.00"), "at_risk", Decimal("240.00"))
    assert got[5].estimated_clv_idr == Decimal("140.00")
    assert (got[2].upsell_candidate, got[2].winback_candidate, got[3].upsell_candidate, got[3].winback_candidate) == (None, False, False, True)
    assert (got[3].cross_sell_eligible, got[1].cross_sell_eligible) == (True, False)
    assert got[1].snapshot_date == AS_OF


@pytest.mark.parametrize(
    "recency, score", [(0, 5), (7, 5), (8, 4), (30, 4), (31, 3), (90, 3), (91, 2), (180, 2), (181, 1)]
)
def test_recency_steps(spark, recency, score):
    cat = mini(
        spark,
        customers=rows(spark, "customers", {"customer_id": 1}),
        transactions=rows(spark, "transactions", txn(1, 1, recency)),
    )
    assert cat.ref("mart_customer_lifetime_value").first().r_score == score


def test_credit_risk(spark):
    dpds = [0, 30, 31, 60, 61, 89, 90, 91, None, -1]
    accounts = rows(
        spark,
        "accounts",
        *[{"account_id": i, "customer_id": 1, "account_status": "active", "product_type_id": 7, "outstanding_balance": 1000, "dpd": d} for i, d in enumerate(dpds)],
        {"account_id": 20, "customer_id": 2, "account_status": "active", "product_type_id": 5},
        {"account_id": 21, "customer_id": 1, "account_status": "active", "product_type_id": 1},
    )
    customers = rows(spark, "customers", {"customer_id": 1}, {"customer_id": 2, "deleted_at": NOON})
    cat = mini(spark, replace(CTX, servicing=True), accounts=accounts, customers=customers)
    got = by_key(cat.ref("mart_credit_risk"), "account_id")
    assert sorted(got) == list(range(10))  # orphaned and non-credit accounts are out
    assert [got[i].dpd_bucket for i in range(10)] == [
        "current",
        *("dpd_1_30", "dpd_31_60", "dpd_31_60", "dpd_61_90", "dpd_61_90", "dpd_61_90"),
        *("npl", "current", "unknown"),
    ]
    assert [got[i].is_npl for i in (5, 6, 7)] == [False, True, True]
    assert [str(got[i].estimated_provision_idr) for i in (0, 1, 4, 7)] == ["10.0000", "50.0000", "500.0000", "1000.0000"]
    assert (got[9].provision_rate, got[0].credit_score) == (None, None)
    total = [r for r in marts.npl_ratio(cat).collect() if r.rollup_level == 1]
    assert (total[0].accounts, total[0].npl_ratio) == (10, 0.2)


def test_fraud(spark):
    now = CTX.now
    flag = lambda i, **more: {"flag_id": i, "transaction_id": 1, "customer_id": 1, "severity": "critical", "confidence_score": "0.8000", "created_at": now - timedelta(hours=25)} | more
    flags = rows(
        spark,
        "fraud_flags",
        flag(1),
        flag(2, created_at=now - timedelta(hours=24, minutes=59)),
        flag(3, reviewed_at=now - timedelta(hours=23, minutes=1)),
        flag(4, confidence_score="0.7999", severity="high", customer_id=2),
        flag(5, transaction_id=77),
        flag(6, transaction_id=2, severity="odd", customer_id=9),
    )
    cat = mini(
        spark,
        fraud_flags=flags,
        transactions=rows(
            spark,
            "transactions",
            txn(1, 8, merchant_id=3, transaction_at=datetime(2024, 6, 30, 5)),
            txn(2, 8, merchant_id=None, transaction_at=datetime(2024, 6, 30, 4), amount_idr=50_000_001),
        ),
        merchants=rows(spark, "merchants", {"merchant_id": 3, "mcc_code": "7995", "risk_level": "Elevated"}),
        customers=rows(spark, "customers", {"customer_id": 1, "risk_rating": "High "}, {"customer_id": 2, "risk_rating": None}),
    )
    got = by_key(cat.ref("mart_fraud_analytics"), "flag_id")
    assert sorted(got) == [1, 2, 3, 4, 6]  # flag 5 has no transaction
    assert [str(got[i].combined_risk_score) for i in (1, 4, 6)] == ["0.9000", "0.7000", "0.4000"]
    assert [got[i].is_high_priority_alert for i in (1, 4, 6)] == [True, False, False]
    assert [got[i].is_sla_breached for i in (1, 2, 3)] == [True, False, False]
    assert (got[3].hours_to_review, got[1].hours_to_review) == (1, None)
    assert (got[1].merchant_category, got[1].is_high_risk_mcc, got[6].merchant_name) == ("Gambling & Betting", True, None)
    assert (got[1].is_off_hours, got[6].is_off_hours, got[6].is_high_value) == (False, True, True)
    assert (got[1].merchant_risk_level, got[6].customer_segment) == ("elevated", None)


def test_transaction_analytics(spark):
    facts = rows(
        spark,
        "transactions",
        *[txn(i, i % 2, transaction_at=datetime(2024, 6, 30, h), fee_amount=3) for i, h in enumerate((5, 6, 11, 12, 17, 18, 22, 23))],
        txn(20, transaction_status="pending", channel=None),
        txn(21, transaction_status="pending", channel=None),
    )
    got = {r.channel: r for r in mini(spark, transactions=facts).ref("mart_transaction_analytics").collect()}
    mobile, nothing = got["mobile"], got[None]
    assert (mobile.transaction_count, mobile.unique_customers, mobile.unique_accounts, mobile.completed_count) == (8, 2, 2, 8)
    assert (mobile.morning_count, mobile.afternoon_count, mobile.evening_count, mobile.offhours_count) == (2, 2, 2, 2)
    assert (mobile.total_volume_idr, mobile.total_fee_idr, mobile.total_gross_idr) == (Decimal("800.00"), Decimal("24.00"), Decimal("824.00"))
    assert (mobile.avg_amount_idr, mobile.success_rate, mobile.failure_rate, mobile.fee_per_txn_idr) == (100.0, 1.0, 0.0, 3.0)
    assert (nothing.transaction_count, nothing.completed_count, nothing.total_volume_idr) == (2, 0, Decimal("0.00"))
    assert (nothing.avg_amount_idr, nothing.min_amount_idr, nothing.fee_per_txn_idr) == (None, None, None)


def test_mart_invariants(bed):
    assert bed.ref("mart_customer_360").count() == bed.ref("stg_customers").count()
    counted = bed.ref("mart_transaction_analytics").groupBy().sum("transaction_count").first()[0]
    assert counted == bed.ref("stg_transactions").count()
    assert bed.ref("stg_credit_scores").where("is_latest_score").count() == bed.source("credit_scores").select("customer_id").distinct().count()


def test_distinct_counts_may_be_estimated(spark):
    from ledgerloom.registry import bed as make

    exact = make(spark, "/root/testdata/sf0.001")
    rough = type(exact)(exact._sources, replace(exact.ctx, approximate_distinct=True))
    grain = ("channel",)
    a = {r.channel: r for r in marts.transaction_metrics(exact.ref("stg_transactions"), grain).collect()}
    b = {r.channel: r for r in marts.transaction_metrics(rough.ref("stg_transactions"), grain, approximate=True).collect()}
    for channel, row in a.items():
        assert abs(b[channel].unique_customers / row.unique_customers - 1) < 0.2
        assert b[channel].transaction_count == row.transaction_count
    plan = rough.ref("mart_transaction_analytics")._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    assert "Generate" in exact.ref("mart_transaction_analytics")._jdf.queryExecution().executedPlan().toString()
