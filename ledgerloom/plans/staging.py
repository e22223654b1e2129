"""Staging models: typed, cleaned rows of each source table. All are narrow plans over broadcast
dimensions, except the latest-score flag, which shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.catalog import Catalog
from ledgerloom.functions import (
    calendar_months,
    calendar_years,
    credit_band,
    date_lit,
    date_part,
    days_between,
    is_business_day,
    lower_trim,
    mask_pii,
    month_key,
    review_status,
    safe_divide,
    severity_rank,
    title_words,
    upper_trim,
)
from ledgerloom.functions.numeric import MONEY
from ledgerloom.operators.ranking import flag_latest, newest_first, top1_per_group
from ledgerloom.sources.contracts import SPECS
from ledgerloom.sources.dims import join_dim

# Category of a transaction type -> direction seen from the customer.
DIRECTIONS = {"credit": "credit", "reversal": "credit", "debit": "debit", "fee": "debit"}


def typed_source(cat: Catalog, name: str) -> DataFrame:
    """A source with exactly its declared columns and types.

    A nullable column that the source lacks is null; a required one must be there. ANSI casts make a value that does
    not fit its type an error rather than a silent null.
    """
    df = cat.source(name)
    given = {f.name: f.dataType for f in df.schema}
    missing = [c for c in SPECS[name].required if c not in given]
    if missing:
        raise ValueError(f"[{name}] source lacks required columns: {', '.join(missing)}")

    def typed(column: str, kind: T.DataType) -> str:
        if given.get(column) == kind:
            return f"`{column}`"
        return f"CAST({f'`{column}`' if column in given else 'NULL'} AS {kind.simpleString()}) AS `{column}`"

    return df.selectExpr(*[typed(f.name, f.dataType) for f in SPECS[name].schema])


def _live(df: DataFrame) -> DataFrame:
    return df.where(F.col("deleted_at").isNull())


def stg_customers(cat: Catalog) -> DataFrame:
    env, today = cat.ctx.env, date_lit(cat.ctx.as_of)
    tidy = ("marital_status", "email", "customer_segment", "kyc_status", "acquisition_channel", "risk_rating")
    return (
        _live(typed_source(cat, "customers"))
        .withColumns(
            {
                "full_name": mask_pii("full_name", env),
                "national_id_masked": mask_pii("national_id", env),
                "age_years": calendar_years(today, F.col("date_of_birth")),
                "gender": upper_trim("gender"),
                "address_city": title_words("address_city"),
                "address_province": title_words("address_province"),
                "is_deleted": F.col("deleted_at").isNotNull(),
                "updated_date": F.to_date("updated_at"),
            }
            | {c: lower_trim(c) for c in tidy}
        )
        .select(
            *("customer_id", "customer_uuid", "full_name", "national_id_masked", "national_id"),
            *("date_of_birth", "age_years", "gender", "marital_status", "occupation", "income_range"),
            *("email", "phone_primary", "phone_secondary", "address_street", "address_city"),
            *("address_province", "address_postal_code", "customer_segment", "kyc_status"),
            *("kyc_verified_at", "onboarding_branch_id", "acquisition_channel", "risk_rating"),
            *("is_politically_exposed", "is_deleted", "deleted_at", "created_at", "updated_at"),
            "updated_date",
        )
    )


def stg_accounts(cat: Catalog) -> DataFrame:
    """Accounts with their product. Status flags compare the status as stored, before tidying."""
    today = date_lit(cat.ctx.as_of)
    status = F.col("account_status")
    source = typed_source(cat, "accounts").where(
        (status != "closed") | (F.col("closed_date") >= F.date_sub(today, 365))
    )
    products = typed_source(cat, "product_types").select(
        "product_type_id",
        "product_code",
        "product_name",
        lower_trim("product_category").alias("product_category"),
        F.col("interest_rate").alias("product_rate"),
        F.lower("product_category").isin("loan", "credit_card").alias("is_credit"),
    )
    no_debt = F.lit(0).cast(MONEY)
    if cat.ctx.servicing:
        owed = F.coalesce("outstanding_balance", "balance")
        dpd = F.coalesce("dpd", F.lit(0)).cast("bigint")
    else:
        owed, dpd = F.col("balance"), F.lit(0).cast("bigint")
    return join_dim(source, products, "product_type_id").select(
        *("account_id", "account_number", "customer_id", "branch_id", "product_type_id"),
        *("product_code", "product_name", "product_category"),
        F.col("product_rate").alias("interest_rate"),
        *("currency", "balance", "available_balance"),
        (F.col("balance") - F.col("available_balance")).cast(MONEY).alias("blocked_balance"),
        lower_trim(status).alias("account_status"),
        *[(status == s).alias(f"is_{s}") for s in ("active", "dormant", "closed")],
        *("opened_date", "closed_date"),
        days_between(F.coalesce("closed_date", today), F.col("opened_date")).alias("account_age_days"),
        F.when(F.col("is_credit"), owed).otherwise(no_debt).alias("outstanding_balance"),
        dpd.alias("dpd"),
        *("created_at", "updated_at"),
        F.to_date("updated_at").alias("updated_date"),
    )


def stg_branches(cat: Catalog) -> DataFrame:
    age = calendar_years(date_lit(cat.ctx.as_of), F.col("opened_date"))
    return _live(typed_source(cat, "branches")).select(
        *("branch_id", "branch_code", "branch_name"),
        lower_trim("branch_type").alias("branch_type"),
        title_words("city").alias("city"),
        title_words("province").alias("province"),
        *("address", "phone", "is_active", "opened_date"),
        age.alias("branch_age_years"),
        *("created_at", "updated_at"),
    )


def stg_employees(cat: Catalog) -> DataFrame:
    tenure = calendar_months(date_lit(cat.ctx.as_of), F.col("hire_date"))
    return _live(typed_source(cat, "employees")).select(
        *("employee_id", "employee_code", "full_name"),
        lower_trim("email").alias("email"),
        lower_trim("role").alias("role"),
        *("branch_id", "hire_date"),
        tenure.alias("tenure_months"),
        *("is_active", "created_at", "updated_at"),
    )


def stg_loan_applications(cat: Catalog) -> DataFrame:
    """Loan applications with their product; null-safe ratio, and null collateral stays unknown."""
    products = typed_source(cat, "product_types").select("product_type_id", "product_code", "product_name")
    status = F.col("application_status")
    submitted = F.to_date("submitted_at")
    return join_dim(_live(typed_source(cat, "loan_applications")), products, "product_type_id").select(
        *("application_id", "application_number", "customer_id", "branch_id"),
        F.col("handled_by").alias("handled_by_employee_id"),
        *("product_type_id", "product_code", "product_name", "requested_amount", "approved_amount"),
        safe_divide(F.col("approved_amount"), F.col("requested_amount")).alias("approval_ratio"),
        *("tenor_months", "interest_rate", "purpose"),
        lower_trim("collateral_type").alias("collateral_type"),
        "collateral_value",
        (F.col("collateral_type") != "none").alias("has_collateral"),
        lower_trim(status).alias("application_status"),
        status.isin("approved", "disbursed").alias("is_approved"),
        (status == "disbursed").alias("is_disbursed"),
        (status == "rejected").alias("is_rejected"),
        *("rejection_reason", "submitted_at", "reviewed_at", "decided_at", "disbursed_at"),
        submitted.alias("submitted_date"),
        days_between(F.to_date("decided_at"), submitted).alias("days_to_decision"),
        *("created_at", "updated_at"),
    )


_SCORE_ORDER = ("score_date", "score_id")


def stg_credit_scores(cat: Catalog) -> DataFrame:
    """Every score, with the customer's most recent one flagged; ties on the date go to the higher id."""
    scored = typed_source(cat, "credit_scores").select(
        *("score_id", "customer_id", "score_value"),
        lower_trim("score_band").alias("score_band"),
        *("score_date", "model_version", "data_source"),
        credit_band(F.col("score_value")).alias("score_band_derived"),
        *("created_at", "updated_at"),
    )
    return flag_latest(scored, "customer_id", "score_id", newest_first(*_SCORE_ORDER), "is_latest_score")


def latest_scores(cat: Catalog) -> DataFrame:
    """The rows ``stg_credit_scores`` flags as latest, without building the flag for the others."""
    scores = typed_source(cat, "credit_scores").select("customer_id", "score_value", "score_band", *_SCORE_ORDER)
    best = top1_per_group(scores, ["customer_id"], newest_first(*_SCORE_ORDER))
    return best.select("customer_id", "score_value", lower_trim("score_band").alias("score_band"), "score_date")


def stg_merchants(cat: Catalog) -> DataFrame:
    categories = typed_source(cat, "merchant_categories").select("mcc_code", "category_name", "is_high_risk")
    return join_dim(_live(typed_source(cat, "merchants")), categories, "mcc_code").select(
        *("merchant_id", "merchant_uuid", "merchant_name", "merchant_legal_name", "mcc_code"),
        "category_name",
        F.col("is_high_risk").alias("is_high_risk_mcc"),
        title_words("city").alias("city"),
        title_words("province").alias("province"),
        *("country", "is_online"),
        lower_trim("risk_level").alias("risk_level"),
        F.col("risk_level").isin("elevated", "high").alias("is_elevated_risk"),
        *("is_active", "created_at", "updated_at", "deleted_at"),
    )


def transaction_labels(cat: Catalog) -> tuple[DataFrame, DataFrame]:
    """The labels of transaction types and of payment methods, by id."""
    types = typed_source(cat, "transaction_types").select(
        "type_id",
        F.col("type_code").alias("transaction_type_code"),
        F.col("type_name").alias("transaction_type_name"),
        lower_trim("type_category").alias("transaction_category"),
        F.lower("type_category").alias("_category"),
    )
    methods = typed_source(cat, "payment_methods").select(
        "method_id",
        F.col("method_code").alias("payment_method_code"),
        F.col("method_name").alias("payment_method_name"),
    )
    return types, methods


def derive_transactions(cat: Catalog, rows: DataFrame) -> DataFrame:
    """Add the columns that follow from a typed transaction row alone; other columns pass through."""
    day, at = F.col("transaction_date"), F.col("transaction_at")
    status = lower_trim("transaction_status")
    hour = date_part("HOUR", at)
    return rows.withColumns(
        {
            "total_amount_idr": (F.col("amount_idr") + F.col("fee_amount")).cast("decimal(21,2)"),
            "channel": lower_trim("channel"),
            "transaction_status": status,
            **{f"is_{s}": status == s for s in ("completed", "failed", "reversed", "pending")},
            "transaction_hour": hour,
            "transaction_day_of_week": date_part("DAYOFWEEK", at),
            "transaction_month": date_part("MONTH", day),
            "transaction_year": date_part("YEAR", day),
            "transaction_month_key": month_key(day),
            "is_business_day": is_business_day(day),
            "is_off_hours": hour.between(0, 5),
            "is_high_value": F.col("amount_idr") > cat.ctx.limits.high_value_idr,
        }
    )


def enrich_transactions(cat: Catalog, rows: DataFrame) -> DataFrame:
    """Derived columns, labels and direction of typed transaction rows.

    Separate from the staging model so that a mart which needs few transactions can join first and
    enrich only what is left.
    """
    types, methods = transaction_labels(cat)
    directions = F.create_map(*[F.lit(x) for pair in DIRECTIONS.items() for x in pair])
    direction = F.try_element_at(directions, F.coalesce("_category", F.lit("")))
    labelled = join_dim(join_dim(derive_transactions(cat, rows), types, "type_id"), methods, "method_id")
    return labelled.withColumn("amount_direction", F.coalesce(direction, F.lit("unknown"))).drop("_category")


def stg_transactions(cat: Catalog) -> DataFrame:
    return enrich_transactions(cat, typed_source(cat, "transactions")).select(
        *("transaction_id", "transaction_uuid", "account_id", "customer_id", "merchant_id"),
        *("type_id", "transaction_type_code", "transaction_type_name", "transaction_category"),
        *("method_id", "payment_method_code", "payment_method_name"),
        *("amount", "currency", "exchange_rate", "amount_idr", "fee_amount", "total_amount_idr"),
        *("balance_before", "balance_after", "description", "reference_number", "channel"),
        *("transaction_status", "status_reason", "is_completed", "is_failed", "is_reversed", "is_pending"),
        *("amount_direction", "transaction_date", "transaction_at", "processed_at"),
        *("transaction_hour", "transaction_day_of_week", "transaction_month", "transaction_year"),
        *("transaction_month_key", "is_business_day", "is_off_hours", "is_high_value"),
        *("created_at", "updated_at"),
    )


def stg_fraud_flags(cat: Catalog) -> DataFrame:
    severity = lower_trim("severity")
    confident = F.col("confidence_score") >= F.lit(cat.ctx.limits.fraud_high_confidence)
    return typed_source(cat, "fraud_flags").select(
        *("flag_id", "transaction_id", "customer_id"),
        lower_trim("flag_type").alias("flag_type"),
        severity.alias("severity"),
        *("confidence_score", "model_version"),
        severity_rank(severity).alias("severity_score"),
        confident.alias("is_high_confidence"),
        *("is_confirmed_fraud", "reviewed_by", "reviewed_at"),
        F.col("reviewed_at").isNotNull().alias("is_reviewed"),
        "notes",
        review_status(F.col("is_confirmed_fraud"), F.col("reviewed_at")).alias("review_status"),
        *("created_at", "updated_at"),
    )


STAGING = {
    f.__name__: f
    for f in (
        stg_customers,
        stg_accounts,
        stg_branches,
        stg_employees,
        stg_loan_applications,
        stg_credit_scores,
        stg_transactions,
        stg_merchants,
        stg_fraud_flags,
    )
}
