"""Marts. Facts are aggregated to the customer before they are joined, so no join fans out and a heavy
customer is reduced on the map side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.catalog import Catalog
from ledgerloom.functions import (
    audit_columns,
    calendar_months,
    date_lit,
    days_between,
    dpd_bucket,
    lower_trim,
    money_sum,
    provision_rate,
    safe_divide,
    step_score,
    ts_lit,
    whole_hours,
    zero_if_null,
)
from ledgerloom.functions.numeric import TOTAL
from ledgerloom.plans.staging import (
    derive_transactions,
    enrich_transactions,
    latest_scores,
    transaction_labels,
    typed_source,
)
from ledgerloom.sources.dims import join_dim

# The scoring tables of the customer value and fraud models.
HORIZONS = (30, 90, 365)
CHANNEL_PREFERENCE = ("mobile", "atm", "branch")
RECENCY_STEPS = (7, 30, 90, 180)
FREQUENCY_STEPS = (200, 100, 36, 12)
MONETARY_STEPS = (500_000_000, 100_000_000, 25_000_000, 5_000_000)
RFM_WEIGHTS = {"m_score": "0.40", "f_score": "0.35", "r_score": "0.25"}
CLV_SEGMENTS = (
    ("4.5", "champions"),
    ("3.5", "loyal_customers"),
    ("2.5", "potential_loyalists"),
    ("1.5", "at_risk"),
)
RETENTION = ((30, "1.2"), (90, "1.0"), (180, "0.7"))
RETENTION_FLOOR = "0.3"
NEVER_ACTIVE_DAYS = 9999
CONFIDENCE_WEIGHT = "0.50"
SEVERITY_WEIGHTS = {"critical": "0.40", "high": "0.30", "medium": "0.15", "low": "0.05"}
RATING_WEIGHTS = {"high": "0.10", "medium": "0.05"}
DAY_PARTS = {"morning": (6, 11), "afternoon": (12, 17), "evening": (18, 22)}
REVIEW_SLA_HOURS = 24


def _dec(text: str, scale: int = 2) -> Column:
    return F.lit(text).cast(f"decimal({scale + 1},{scale})")


def _lookup(label: Column, weights: dict[str, str]) -> Column:
    out = F.lit(None)
    for name, w in reversed(weights.items()):
        out = F.when(label == name, _dec(w)).otherwise(out)
    return F.coalesce(out, _dec("0"))


def customer_txn_summary(cat: Catalog, by_category: bool = True) -> DataFrame:
    """Lifetime and trailing-window activity per customer, in one scan of the transactions.

    Without ``by_category`` the debit and credit volumes are left out, and with them the join that brings
    the category to every transaction.
    """
    if by_category:
        staged = cat.ref("stg_transactions")
    else:
        status, channel = lower_trim("transaction_status"), lower_trim("channel")
        staged = typed_source(cat, "transactions").withColumns(
            {"is_completed": status == "completed", "channel": channel}
        )
    today = date_lit(cat.ctx.as_of)
    done, amount = F.col("is_completed"), F.col("amount_idr")
    recent = {n: (F.col("transaction_date") >= F.date_sub(today, n)) & done for n in HORIZONS}
    windows = [
        metric
        for n in HORIZONS
        for metric in (
            F.count_if(recent[n]).alias(f"txn_count_{n}d"),
            money_sum(recent[n], amount).alias(f"txn_volume_{n}d_idr"),
        )
    ]
    return (
        staged.groupBy("customer_id")
        .agg(
            F.count("*").alias("total_transactions"),
            money_sum(done, amount).alias("total_txn_volume_idr"),
            *[
                money_sum((F.col("transaction_category") == c) & done, amount).alias(f"total_{c}_idr")
                for c in (("debit", "credit") if by_category else ())
            ],
            F.max("transaction_at").alias("last_transaction_at"),
            F.min("transaction_at").alias("first_transaction_at"),
            F.count_distinct(F.to_date("transaction_at")).alias("active_transaction_days"),
            *windows,
            *[F.count_if((F.col("channel") == c) & done).alias(f"{c}_txn_count") for c in CHANNEL_PREFERENCE],
        )
    )


def customer_account_summary(cat: Catalog) -> DataFrame:
    """Account counts and balances per customer; the active balance covers all products."""
    product = F.col("product_category")
    return (
        cat.ref("stg_accounts")
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("total_accounts"),
            F.count_if(F.col("account_status") == "active").alias("active_accounts"),
            *[
                F.count_if(product == p).alias(f"{p}_count")
                for p in ("savings", "checking", "loan", "credit_card")
            ],
            money_sum(F.col("account_status") == "active", F.col("balance")).alias("total_balance_idr"),
            money_sum(product == "loan", F.col("outstanding_balance")).alias("total_outstanding_loan_idr"),
            F.max(F.when(product == "loan", F.col("dpd")).otherwise(0)).alias("max_dpd"),
            F.min("opened_date").alias("first_account_opened"),
        )
    )


def customer_loan_summary(cat: Catalog) -> DataFrame:
    status = F.col("application_status")
    return (
        cat.ref("stg_loan_applications")
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("total_loan_applications"),
            *[F.count_if(status == s).alias(f"{s}_loans") for s in ("approved", "rejected", "disbursed")],
            money_sum(status == "disbursed", F.col("approved_amount")).alias("total_disbursed_idr"),
            F.max("submitted_at").alias("last_loan_application_at"),
        )
    )


def _preferred_channel() -> Column:
    """The channel with most completed transactions; a tie goes to the earlier one in the list."""
    counts = [zero_if_null(F.col(f"{c}_txn_count")) for c in CHANNEL_PREFERENCE]
    most = F.greatest(*counts)
    return F.coalesce(*[F.when(n == most, F.lit(c)) for n, c in zip(counts, CHANNEL_PREFERENCE, strict=True)])


def mart_customer_360(cat: Catalog) -> DataFrame:
    """One row per live customer. Every joined relation has at most one row per customer."""
    ctx, today = cat.ctx, date_lit(cat.ctx.as_of)
    branches = cat.ref("stg_branches").select(
        F.col("branch_id").alias("onboarding_branch_id"),
        F.col("branch_name").alias("onboarding_branch_name"),
        F.col("city").alias("onboarding_branch_city"),
    )
    scores = latest_scores(cat).select(
        "customer_id",
        F.col("score_value").alias("latest_credit_score"),
        F.col("score_band").alias("credit_score_band"),
        F.col("score_date").alias("credit_score_date"),
    )
    joined = cat.ref("stg_customers").join(branches, "onboarding_branch_id", "left")
    activity = customer_txn_summary(cat, by_category=False)
    for part in (customer_account_summary(cat), activity, customer_loan_summary(cat), scores):
        joined = joined.join(part, "customer_id", "left")

    idle_days = days_between(today, F.to_date("last_transaction_at"))
    products = ("savings", "checking", "loan", "credit_card")
    breadth = sum((zero_if_null(F.col(f"{p}_count")) for p in products[1:]), zero_if_null(F.col("savings_count")))
    zeroed = lambda *names: [zero_if_null(F.col(n)).alias(n) for n in names]
    digital = safe_divide(100.0 * zero_if_null(F.col("mobile_txn_count")), zero_if_null(F.col("total_transactions")))
    return joined.select(
        *("customer_id", "customer_uuid", "full_name", "national_id_masked", "date_of_birth", "age_years"),
        *("gender", "marital_status", "occupation", "income_range"),
        *("email", "phone_primary", "address_city", "address_province"),
        *("customer_segment", "kyc_status", "kyc_verified_at", "acquisition_channel", "risk_rating"),
        *("is_politically_exposed", "onboarding_branch_name", "onboarding_branch_city"),
        *zeroed("total_accounts", "active_accounts"),
        *[zero_if_null(F.col(f"{p}_count")).alias(f"{p}_accounts") for p in products],
        *zeroed("total_balance_idr", "total_outstanding_loan_idr", "max_dpd"),
        "first_account_opened",
        *zeroed("total_transactions", "total_txn_volume_idr"),
        *[c for n in HORIZONS for c in zeroed(f"txn_count_{n}d", f"txn_volume_{n}d_idr")],
        *("last_transaction_at", "first_transaction_at"),
        *zeroed("active_transaction_days"),
        _preferred_channel().alias("preferred_channel"),
        *zeroed("total_loan_applications", "approved_loans", "rejected_loans", "total_disbursed_idr"),
        "last_loan_application_at",
        *("latest_credit_score", "credit_score_band", "credit_score_date"),
        idle_days.alias("days_since_last_txn"),
        (idle_days > ctx.limits.dormant_days).alias("is_dormant"),
        breadth.alias("product_count"),
        (zero_if_null(F.col("max_dpd")) >= ctx.limits.npl_dpd).alias("is_npl_customer"),
        F.round(digital, 1).alias("digital_adoption_score"),
        calendar_months(today, F.col("first_account_opened")).alias("tenure_months"),
        F.col("created_at").alias("customer_since"),
        *("updated_at", "updated_date"),
    ).withColumns(audit_columns(ctx, "mart_customer_360"))


def mart_customer_lifetime_value(cat: Catalog) -> DataFrame:
    """Recency-frequency-monetary scores and value estimate; a projection of the customer mart."""
    ctx = cat.ctx
    recency, spend = F.col("recency_days"), F.col("monetary_365d_idr")
    scored = (
        cat.ref("mart_customer_360")
        .withColumns(
            {
                "recency_days": F.coalesce("days_since_last_txn", F.lit(NEVER_ACTIVE_DAYS)),
                "frequency_365d": F.col("txn_count_365d"),
                "monetary_365d_idr": F.col("txn_volume_365d_idr"),
            }
        )
        .withColumns(
            {
                "r_score": step_score(recency, RECENCY_STEPS, ascending=False),
                "f_score": step_score(F.col("frequency_365d"), FREQUENCY_STEPS, ascending=True),
                "m_score": step_score(spend, MONETARY_STEPS, ascending=True),
            }
        )
    )
    blend = reduce(Column.__add__, (F.col(c) * _dec(w) for c, w in RFM_WEIGHTS.items()))
    segment, retention = F.lit("lost"), _dec(RETENTION_FLOOR, 1)
    for floor, name in reversed(CLV_SEGMENTS):
        segment = F.when(F.col("_blend") >= _dec(floor, 1), F.lit(name)).otherwise(segment)
    for days, factor in reversed(RETENTION):
        retention = F.when(recency <= days, _dec(factor, 1)).otherwise(retention)
    return (
        scored.withColumn("_blend", blend)
        .withColumns(
            {
                "rfm_score": F.round("_blend", 2),
                "clv_segment": segment,
                "estimated_clv_idr": F.round(spend * retention, 0).cast(TOTAL),
                "cross_sell_eligible": F.col("total_accounts") == 1,
                "upsell_candidate": ~F.col("is_dormant") & (F.col("product_count") < 3),
                "winback_candidate": F.col("is_dormant") & (recency <= 365),
                "snapshot_date": date_lit(ctx.as_of),
            }
        )
        .select(
            *("customer_id", "customer_uuid", "customer_segment", "kyc_status", "risk_rating"),
            *("income_range", "address_province", "acquisition_channel", "preferred_channel"),
            *("tenure_months", "product_count", "active_accounts", "is_dormant", "is_npl_customer"),
            *("digital_adoption_score", "total_balance_idr", "total_outstanding_loan_idr"),
            *("total_disbursed_idr", "latest_credit_score", "credit_score_band"),
            *("recency_days", "frequency_365d", "monetary_365d_idr"),
            *("txn_count_30d", "txn_volume_30d_idr", "txn_count_90d", "txn_volume_90d_idr"),
            *("r_score", "f_score", "m_score", "rfm_score", "clv_segment", "estimated_clv_idr"),
            *("cross_sell_eligible", "upsell_candidate", "winback_candidate"),
            *("last_transaction_at", "customer_since", "snapshot_date"),
        )
        .withColumns(audit_columns(ctx, "mart_customer_lifetime_value"))
    )


def mart_credit_risk(cat: Catalog) -> DataFrame:
    """One row per loan or card account of a live customer.

    Customers and their latest score are joined first: both have one row per customer. The accounts then
    meet them in a single join, which adaptive execution can split when one customer owns very many.
    """
    ctx = cat.ctx
    profile = (
        cat.ref("stg_customers")
        .select(
            *("customer_id", "customer_segment", "kyc_status", "risk_rating", "income_range"),
            *("address_province", "is_politically_exposed"),
        )
        .join(
            latest_scores(cat).select(
                "customer_id",
                F.col("score_value").alias("credit_score"),
                F.col("score_band").alias("credit_score_band"),
            ),
            "customer_id",
            "left",
        )
    )
    dpd = F.col("dpd")
    return (
        cat.ref("stg_accounts")
        .where(F.col("product_category").isin("loan", "credit_card"))
        .join(profile, "customer_id")
        .select(
            date_lit(ctx.as_of).alias("snapshot_date"),
            *("account_id", "account_number", "customer_id", "customer_segment", "risk_rating"),
            *("income_range", "address_province", "is_politically_exposed", "kyc_status"),
            *("credit_score", "credit_score_band", "product_code", "product_name", "product_category"),
            *("account_status", "opened_date", "interest_rate", "outstanding_balance", "dpd"),
            dpd_bucket(dpd).alias("dpd_bucket"),
            (dpd >= ctx.limits.npl_dpd).alias("is_npl"),
            provision_rate(dpd).alias("provision_rate"),
            (F.col("outstanding_balance") * provision_rate(dpd)).alias("estimated_provision_idr"),
        )
        .withColumns(audit_columns(ctx, "mart_credit_risk"))
    )


def mart_fraud_analytics(cat: Catalog) -> DataFrame:
    """One row per flag that has a transaction.

    The flags meet the bare transactions first; only the flagged ones are then enriched, so the fact
    shuffle carries no labels.
    """
    ctx = cat.ctx
    flags = cat.ref("stg_fraud_flags").select(
        *("flag_id", "transaction_id", "customer_id", "flag_type", "severity", "confidence_score"),
        *("model_version", "is_confirmed_fraud", "reviewed_by", "reviewed_at", "notes", "review_status"),
        F.col("created_at").alias("flagged_at"),
        "updated_at",
    )
    facts = typed_source(cat, "transactions").select(
        *("transaction_id", "transaction_date", "transaction_at", "type_id", "method_id", "channel"),
        *("amount_idr", "fee_amount", "currency", "transaction_status", "merchant_id", "reference_number"),
    )
    merchants = cat.ref("stg_merchants").select(
        "merchant_id",
        *("merchant_name", "mcc_code", F.col("category_name").alias("merchant_category")),
        F.col("is_online").alias("is_online_merchant"),
        F.col("risk_level").alias("merchant_risk_level"),
        "is_high_risk_mcc",
    )
    customers = cat.ref("stg_customers").select(
        *("customer_id", "customer_segment", "kyc_status"),
        F.col("risk_rating").alias("customer_risk_rating"),
        *("address_province", "is_politically_exposed"),
    )
    flagged = enrich_transactions(cat, flags.join(facts, "transaction_id"))
    severity, reviewed = F.col("severity"), F.col("reviewed_at")
    risk = (
        F.col("confidence_score") * _dec(CONFIDENCE_WEIGHT)
        + _lookup(severity, SEVERITY_WEIGHTS)
        + _lookup(F.col("customer_risk_rating"), RATING_WEIGHTS)
    )
    waiting = whole_hours(ts_lit(ctx.now), F.col("flagged_at"))
    return (
        flagged.join(merchants, "merchant_id", "left")
        .join(customers, "customer_id", "left")
        .select(
            *("flag_id", "transaction_id", "customer_id", "transaction_date", "transaction_at"),
            *("transaction_hour", "transaction_day_of_week", "transaction_type_code"),
            *("transaction_type_name", "transaction_category", "payment_method_code", "channel"),
            *("amount_idr", "currency", "transaction_status", "merchant_id", "reference_number"),
            *("merchant_name", "mcc_code", "merchant_category", "is_online_merchant"),
            *("merchant_risk_level", "is_high_risk_mcc", "flag_type", "severity", "confidence_score"),
            *("model_version", "is_confirmed_fraud", "reviewed_by", "reviewed_at", "notes", "flagged_at"),
            *("customer_segment", "kyc_status", "customer_risk_rating", "address_province"),
            "is_politically_exposed",
            F.round(risk, 4).alias("combined_risk_score"),
            (
                severity.isin("high", "critical")
                & (F.col("confidence_score") >= F.lit(ctx.limits.fraud_high_confidence))
            ).alias("is_high_priority_alert"),
            F.col("transaction_hour").between(0, 4).alias("is_off_hours"),
            "is_high_value",
            "review_status",
            whole_hours(reviewed, F.col("flagged_at")).alias("hours_to_review"),
            (reviewed.isNull() & (severity == "critical") & (waiting > REVIEW_SLA_HOURS)).alias("is_sla_breached"),
            "updated_at",
        )
        .withColumns(audit_columns(ctx, "mart_fraud_analytics"))
    )


TRANSACTION_GRAIN = (
    "transaction_date",
    "channel",
    "transaction_type_code",
    "transaction_type_name",
    "transaction_category",
    "payment_method_code",
    "transaction_status",
    "currency",
)


def transaction_metrics(
    staged: DataFrame, grain: tuple[str, ...], by_category: bool = True, approximate: bool = False
) -> DataFrame:
    """Volume, revenue and timing metrics at any grain; null grain values form groups."""
    done, amount, hour = F.col("is_completed"), F.col("amount_idr"), F.col("transaction_hour")
    paid = F.when(done, amount)
    categories = ("debit", "credit") if by_category else ()
    unique = {"unique_customers": "customer_id", "unique_accounts": "account_id"}
    estimates = [F.approx_count_distinct(c).alias(n) for n, c in unique.items()] if approximate else []
    counted = (
        staged.groupBy(*grain)
        .agg(
            F.count("*").alias("transaction_count"),
            *estimates,
            *[F.count_if(F.col(f"is_{s}")).alias(f"{s}_count") for s in ("completed", "failed", "reversed")],
            money_sum(done, amount).alias("total_volume_idr"),
            money_sum(done, F.col("fee_amount")).alias("total_fee_idr"),
            money_sum(done, F.col("total_amount_idr")).alias("total_gross_idr"),
            safe_divide(F.sum(paid), F.count(paid)).alias("avg_amount_idr"),
            F.min(paid).alias("min_amount_idr"),
            F.max(paid).alias("max_amount_idr"),
            *[
                money_sum((F.col("transaction_category") == c) & done, amount).alias(f"total_{c}_idr")
                for c in categories
            ],
            *[F.count_if(hour.between(*span)).alias(f"{part}_count") for part, span in DAY_PARTS.items()],
            F.count_if(~hour.between(6, 22)).alias("offhours_count"),
            safe_divide(F.count_if(done), F.count("*")).alias("success_rate"),
        )
        .withColumns(
            {
                "failure_rate": 1 - F.col("success_rate"),
                "fee_per_txn_idr": safe_divide(F.col("total_fee_idr"), F.col("completed_count")),
            }
        )
    )
    if approximate:
        return counted
    columns = counted.columns
    at = columns.index("transaction_count") + 1
    return null_safe_join(counted, distinct_counts(staged, grain, unique), grain).select(
        *columns[:at], *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in unique], *columns[at:]
    )


def distinct_counts(df: DataFrame, grain: Sequence[str], unique: Mapping[str, str]) -> DataFrame:
    """Exact distinct counts of several columns by group, apart from other aggregates.

    Beside them, Spark would send every row once more for each counted column, each time with the buffers of all
    aggregates. Here a row of the shuffle is the group, which column is meant, and its value.
    """
    pairs = [F.struct(F.lit(n).alias("which"), F.col(c).alias("value")) for n, c in unique.items()]
    seen = df.select(*grain, F.inline(F.array(*pairs))).where("value IS NOT NULL").distinct()
    return seen.groupBy(*grain).agg(*[F.count_if(F.col("which") == n).alias(n) for n in unique])


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on columns in which null equals null."""
    renamed = right.select(*[F.col(c).alias(f"_{c}") if c in on else c for c in right.columns])
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on))
    return left.join(renamed, same, "left").drop(*[f"_{c}" for c in on])


def mart_transaction_analytics(cat: Catalog) -> DataFrame:
    """Daily metrics by channel, type, method, status and currency.

    The labels follow from the type and method ids, so rows are grouped on the ids, an id without label
    counting as none, and labelled afterwards: the shuffle carries two numbers instead of four texts.
    """
    types, methods = transaction_labels(cat)
    known_types = types.select("type_id", F.col("type_id").alias("type_key"))
    known_methods = methods.select("method_id", F.col("method_id").alias("method_key"))
    derived = derive_transactions(cat, typed_source(cat, "transactions"))
    keyed = join_dim(join_dim(derived, known_types, "type_id"), known_methods, "method_id")
    slim = ("transaction_date", "channel", "type_key", "method_key", "transaction_status", "currency")
    counted = transaction_metrics(
        keyed, slim, by_category=False, approximate=cat.ctx.approximate_distinct
    )
    labelled = join_dim(
        join_dim(counted, types.withColumnRenamed("type_id", "type_key"), "type_key"),
        methods.withColumnRenamed("method_id", "method_key"),
        "method_key",
    )
    split = {
        f"total_{c}_idr": F.when(F.col("transaction_category") == c, F.col("total_volume_idr")).otherwise(
            F.lit(0).cast(TOTAL)
        )
        for c in ("debit", "credit")
    }
    metrics = [c for c in counted.columns if c not in slim]
    before = metrics.index("morning_count")
    return (
        labelled.withColumns(split)
        .select(*TRANSACTION_GRAIN, *metrics[:before], *split, *metrics[before:])
        .withColumns(audit_columns(cat.ctx, "mart_transaction_analytics"))
    )


def npl_ratio(cat: Catalog, by: tuple[str, ...] = ("customer_segment",)) -> DataFrame:
    """Non-performing share of the outstanding balance, with subtotals up to the whole portfolio."""
    owed = F.col("outstanding_balance")
    bad = money_sum(F.col("is_npl"), owed)
    return (
        cat.ref("mart_credit_risk")
        .rollup(*by)
        .agg(
            F.grouping_id().alias("rollup_level"),
            F.count("*").alias("accounts"),
            bad.alias("npl_outstanding_idr"),
            F.sum(owed).cast(TOTAL).alias("total_outstanding_idr"),
            safe_divide(bad, F.sum(owed)).alias("npl_ratio"),
        )
    )


MARTS = {
    f.__name__: f
    for f in (
        mart_customer_360,
        mart_customer_lifetime_value,
        mart_credit_risk,
        mart_fraud_analytics,
        mart_transaction_analytics,
    )
}
