"""The declared quality suite: tests on sources, staging models and marts, and the source constraints."""

from __future__ import annotations

from ledgerloom.operators.quality import ACCEPTED, NOT_NULL, RANGE, RELATIONSHIP, UNIQUE, Check

# The permitted labels of each coded column.
SEGMENTS = "retail priority premier private sme corporate"
KYC = "pending verified rejected expired"
RISK = "low medium high blacklist"
PRODUCTS = "savings checking loan credit_card deposit investment"
ACCOUNT_STATES = "active dormant blocked closed pending"
CURRENCIES = "IDR USD SGD EUR"
BRANCH_TYPES = "main regional sub atm_center"
ROLES = "teller cs relationship_manager back_office analyst branch_manager it"
LOAN_STATES = "submitted under_review approved rejected disbursed cancelled withdrawn"
SCORE_BANDS = "poor fair good very_good exceptional"
TXN_STATES = "pending completed failed reversed"
CHANNELS = "mobile atm web pos branch qris"
MERCHANT_RISK = "normal elevated high"
SEVERITIES = "low medium high critical"
REVIEWS = "confirmed_fraud false_positive reviewed_inconclusive pending_review"
INCOMES = "0-3jt 3-5jt 5-10jt 10-25jt 25-50jt >50jt"


def _suite(
    stage: str,
    model: str,
    *,
    keys: str = "",
    unique: str = "",
    required: str = "",
    accepted: dict[str, str] | None = None,
    parents: dict[str, tuple[str, str]] | None = None,
    ranges: dict[str, tuple] | None = None,
) -> list[Check]:
    """``keys`` are both required and unique. A range is (low, high) or (low, high, inclusive)."""
    out = [Check(stage, model, c, NOT_NULL) for c in (keys + " " + required).split()]
    out += [Check(stage, model, c, UNIQUE) for c in (keys + " " + unique).split()]
    out += [Check(stage, model, c, ACCEPTED, tuple(v.split())) for c, v in (accepted or {}).items()]
    out += [Check(stage, model, c, RELATIONSHIP, parent=p) for c, p in (parents or {}).items()]
    for c, (low, high, *rest) in (ranges or {}).items():
        out.append(Check(stage, model, c, RANGE, low=low, high=high, inclusive=rest[0] if rest else True))
    return out


_SRC, _STG, _MART = "sources", "staging", "marts"

SOURCE_CHECKS = [
    *_suite(
        _SRC,
        "customers",
        keys="customer_id customer_uuid national_id",
        required="full_name created_at updated_at",
        accepted={"gender": "M F", "customer_segment": SEGMENTS, "kyc_status": KYC},
    ),
    *_suite(
        _SRC,
        "accounts",
        keys="account_id account_number",
        required="customer_id balance",
        accepted={"account_status": ACCOUNT_STATES, "currency": CURRENCIES},
        parents={"customer_id": ("customers", "customer_id")},
    ),
    *_suite(_SRC, "branches", keys="branch_id branch_code", accepted={"branch_type": BRANCH_TYPES}),
    *_suite(_SRC, "employees", keys="employee_id employee_code"),
    *_suite(
        _SRC,
        "loan_applications",
        keys="application_id application_number",
        required="customer_id",
        accepted={"application_status": LOAN_STATES},
        parents={"customer_id": ("customers", "customer_id")},
    ),
    *_suite(
        _SRC,
        "credit_scores",
        keys="score_id",
        required="score_value",
        accepted={"score_band": SCORE_BANDS},
        ranges={"score_value": ("300", "850")},
    ),
    *_suite(_SRC, "product_types", keys="product_type_id product_code", accepted={"product_category": PRODUCTS}),
    *_suite(
        _SRC,
        "transactions",
        keys="transaction_id transaction_uuid",
        required="account_id customer_id amount transaction_date transaction_at",
        accepted={"currency": CURRENCIES, "transaction_status": TXN_STATES},
        ranges={"amount": ("0", None, False)},
    ),
    *_suite(_SRC, "merchants", keys="merchant_id", accepted={"risk_level": MERCHANT_RISK}),
    *_suite(
        _SRC,
        "fraud_flags",
        keys="flag_id",
        required="transaction_id confidence_score",
        accepted={"severity": SEVERITIES},
        parents={"transaction_id": ("transactions", "transaction_id")},
        ranges={"confidence_score": ("0.0", "1.0")},
    ),
    *_suite(_SRC, "transaction_types", keys="type_id type_code"),
    *_suite(_SRC, "payment_methods", keys="method_id"),
    *_suite(_SRC, "merchant_categories", keys="mcc_code"),
]

STAGING_CHECKS = [
    *_suite(
        _STG,
        "stg_customers",
        keys="customer_id customer_uuid national_id",
        required="created_at updated_at is_deleted",
        accepted={"gender": "M F", "customer_segment": SEGMENTS, "kyc_status": KYC, "risk_rating": RISK},
    ),
    *_suite(
        _STG,
        "stg_accounts",
        keys="account_id account_number",
        required="customer_id balance",
        accepted={"product_category": PRODUCTS, "account_status": ACCOUNT_STATES, "currency": CURRENCIES},
        parents={"customer_id": ("stg_customers", "customer_id")},
        ranges={"balance": ("0", None)},
    ),
    *_suite(_STG, "stg_branches", keys="branch_id branch_code", accepted={"branch_type": BRANCH_TYPES}),
    *_suite(
        _STG,
        "stg_employees",
        keys="employee_id employee_code",
        required="branch_id",
        accepted={"role": ROLES},
        parents={"branch_id": ("stg_branches", "branch_id")},
    ),
    *_suite(
        _STG,
        "stg_loan_applications",
        keys="application_id application_number",
        required="customer_id requested_amount",
        accepted={"application_status": LOAN_STATES},
        parents={"customer_id": ("stg_customers", "customer_id")},
        ranges={"requested_amount": ("0", None, False)},
    ),
    *_suite(
        _STG,
        "stg_credit_scores",
        keys="score_id",
        required="customer_id score_value is_latest_score",
        accepted={"score_band": SCORE_BANDS},
        ranges={"score_value": ("300", "850")},
    ),
    *_suite(
        _STG,
        "stg_transactions",
        keys="transaction_id transaction_uuid",
        required="account_id customer_id amount_idr transaction_date",
        accepted={
            "transaction_status": TXN_STATES,
            "channel": CHANNELS,
            "amount_direction": "credit debit unknown",
        },
        ranges={"amount_idr": ("0", None, False)},
    ),
    *_suite(_STG, "stg_merchants", keys="merchant_id", accepted={"risk_level": MERCHANT_RISK}),
    *_suite(
        _STG,
        "stg_fraud_flags",
        keys="flag_id",
        required="transaction_id confidence_score",
        accepted={"severity": SEVERITIES, "review_status": REVIEWS},
        parents={"transaction_id": ("stg_transactions", "transaction_id")},
        ranges={"confidence_score": ("0.0", "1.0")},
    ),
]

MART_CHECKS = [
    *_suite(
        _MART,
        "mart_customer_360",
        keys="customer_id customer_uuid",
        required="total_balance_idr is_dormant is_npl_customer updated_date",
        accepted={"customer_segment": SEGMENTS, "kyc_status": KYC},
        ranges={"total_balance_idr": ("0", None)},
    ),
    *_suite(
        _MART,
        "mart_customer_lifetime_value",
        keys="customer_id",
        required="rfm_score snapshot_date",
        accepted={"clv_segment": "champions loyal_customers potential_loyalists at_risk lost"},
        ranges={"rfm_score": ("1", "5")},
    ),
    *_suite(
        _MART,
        "mart_transaction_analytics",
        required="transaction_date",
        accepted={"channel": CHANNELS, "transaction_status": TXN_STATES},
        ranges={"success_rate": ("0", "1")},
    ),
    *_suite(
        _MART,
        "mart_fraud_analytics",
        keys="flag_id",
        required="transaction_id transaction_date",
        accepted={"severity": SEVERITIES, "review_status": REVIEWS},
    ),
    *_suite(
        _MART,
        "mart_credit_risk",
        required="account_id snapshot_date is_npl",
        accepted={"dpd_bucket": "current dpd_1_30 dpd_31_60 dpd_61_90 npl unknown"},
    ),
]

ALL_CHECKS = [*SOURCE_CHECKS, *STAGING_CHECKS, *MART_CHECKS]

# The CHECK, UNIQUE and foreign-key constraints the source databases enforce themselves.
_DDL = "constraints"
DDL_CHECKS = [
    *_suite(_DDL, "branches", unique="branch_code", accepted={"branch_type": BRANCH_TYPES}),
    *_suite(_DDL, "product_types", unique="product_code", accepted={"product_category": PRODUCTS}),
    *_suite(
        _DDL,
        "customers",
        unique="customer_uuid national_id",
        accepted={
            "gender": "M F",
            "marital_status": "single married divorced widowed",
            "income_range": INCOMES,
            "customer_segment": SEGMENTS,
            "kyc_status": KYC,
            "acquisition_channel": "branch mobile_app web agent referral telemarketing",
            "risk_rating": RISK,
        },
        parents={"onboarding_branch_id": ("branches", "branch_id")},
    ),
    *_suite(
        _DDL,
        "employees",
        unique="employee_code email",
        accepted={"role": ROLES},
        parents={"branch_id": ("branches", "branch_id")},
    ),
    *_suite(
        _DDL,
        "accounts",
        unique="account_number",
        accepted={"account_status": ACCOUNT_STATES},
        parents={
            "customer_id": ("customers", "customer_id"),
            "product_type_id": ("product_types", "product_type_id"),
            "branch_id": ("branches", "branch_id"),
        },
    ),
    *_suite(
        _DDL,
        "credit_scores",
        accepted={"score_band": SCORE_BANDS},
        parents={"customer_id": ("customers", "customer_id")},
        ranges={"score_value": ("300", "850")},
    ),
    *_suite(
        _DDL,
        "loan_applications",
        unique="application_number",
        accepted={
            "collateral_type": "none property vehicle deposit guarantee other",
            "application_status": LOAN_STATES,
        },
        parents={
            "customer_id": ("customers", "customer_id"),
            "branch_id": ("branches", "branch_id"),
            "handled_by": ("employees", "employee_id"),
            "product_type_id": ("product_types", "product_type_id"),
        },
    ),
    *_suite(
        _DDL,
        "transactions",
        unique="transaction_uuid reference_number",
        parents={
            "type_id": ("transaction_types", "type_id"),
            "method_id": ("payment_methods", "method_id"),
            "merchant_id": ("merchants", "merchant_id"),
        },
    ),
    *_suite(
        _DDL,
        "merchants",
        unique="merchant_uuid",
        parents={"mcc_code": ("merchant_categories", "mcc_code")},
    ),
    *_suite(_DDL, "fraud_flags", parents={"transaction_id": ("transactions", "transaction_id")}),
]
