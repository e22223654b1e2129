"""The sources, staging models and marts as DuckDB SQL, and the assembly of a query from them."""

from __future__ import annotations

import re

from ledgerloom.sources.dims import DIMS
from ledgerloom.sources.testbed import MAPPINGS, duckdb_relation

TODAY = "DATE '2001-08-02'"
NOW = "TIMESTAMP '2001-08-02 00:00:00'"

_WORD = r"""\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""


def titled(c: str) -> str:
    runs = f"regexp_extract_all(lower({c}), '[^{_WORD}]+|[{_WORD}]+')"
    raised = f"list_transform({runs}, lambda w: upper(substr(w, 1, 1)) || substr(w, 2))"
    return f"CASE WHEN {c} IS NOT NULL THEN coalesce(array_to_string({raised}, ''), '') END"


def masked(c: str) -> str:
    return f"left({c}, 2) || '***' || right({c}, 2)"


def tidy(c: str) -> str:
    return f"lower(trim({c}))"


def tidied(*columns: str) -> str:
    return ", ".join(f"{tidy(c)} AS {c}" for c in columns)


def dbl(relation: str, *columns: str, tail: str = "") -> str:
    """All of a relation, with the given decimal columns as double."""
    if not columns:
        return f"SELECT * FROM {relation} {tail}"
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({casts}) FROM {relation} {tail}"


def audit(model: str) -> str:
    return (
        f"{NOW} AS dbt_updated_at, 'testbed' AS dbt_invocation_id, '{model}' AS dbt_model_name, 'dev' AS dbt_target"
    )


def band(score: str) -> str:
    return (
        f"CASE WHEN {score} >= 800 THEN 'exceptional' WHEN {score} >= 740 THEN 'very_good'"
        f" WHEN {score} >= 670 THEN 'good' WHEN {score} >= 580 THEN 'fair' ELSE 'poor' END"
    )


_OUTCOME = (
    "CASE WHEN is_confirmed_fraud THEN 'confirmed_fraud' WHEN NOT is_confirmed_fraud THEN 'false_positive'"
    " WHEN reviewed_at IS NOT NULL THEN 'reviewed_inconclusive' ELSE 'pending_review' END"
)

RELATIONS: dict[str, str] = {f"raw_{n}": duckdb_relation(n) for n in [*MAPPINGS, *DIMS]}

RELATIONS["stg_customers"] = f"""
SELECT customer_id, customer_uuid, {masked("full_name")} AS full_name,
  {masked("national_id")} AS national_id_masked, national_id, date_of_birth,
  date_diff('year', date_of_birth, {TODAY}) AS age_years, upper(trim(gender)) AS gender,
  {tidied("marital_status")}, occupation, income_range, {tidied("email")}, phone_primary, phone_secondary,
  address_street, {titled("address_city")} AS address_city, {titled("address_province")} AS address_province,
  address_postal_code, {tidied("customer_segment", "kyc_status")}, kyc_verified_at, onboarding_branch_id,
  {tidied("acquisition_channel", "risk_rating")}, is_politically_exposed, false AS is_deleted, deleted_at,
  created_at, updated_at, CAST(updated_at AS DATE) AS updated_date
FROM raw_customers WHERE deleted_at IS NULL"""


def _accounts(owed: str, dpd: str) -> str:
    return f"""
SELECT a.account_id, a.account_number, a.customer_id, a.branch_id, a.product_type_id, p.product_code,
  p.product_name, {tidy("p.product_category")} AS product_category, p.interest_rate, a.currency, a.balance,
  a.available_balance, a.balance - a.available_balance AS blocked_balance,
  {tidy("a.account_status")} AS account_status, a.account_status = 'active' AS is_active,
  a.account_status = 'dormant' AS is_dormant, a.account_status = 'closed' AS is_closed, a.opened_date,
  a.closed_date, date_diff('day', a.opened_date, ifnull(a.closed_date, {TODAY})) AS account_age_days,
  CASE WHEN lower(p.product_category) IN ('loan', 'credit_card') THEN {owed} ELSE 0 END AS outstanding_balance,
  CAST({dpd} AS BIGINT) AS dpd, a.created_at, a.updated_at, CAST(a.updated_at AS DATE) AS updated_date
FROM raw_accounts a LEFT JOIN raw_product_types p USING (product_type_id)
WHERE NOT a.account_status = 'closed' OR date_diff('day', a.closed_date, {TODAY}) <= 365"""


RELATIONS["stg_accounts"] = _accounts("a.balance", "0")
RELATIONS["stg_accounts_servicing"] = _accounts("ifnull(a.outstanding_balance, a.balance)", "ifnull(a.dpd, 0)")

RELATIONS["stg_branches"] = f"""
SELECT branch_id, branch_code, branch_name, {tidied("branch_type")}, {titled("city")} AS city,
  {titled("province")} AS province, address, phone, is_active, opened_date,
  date_diff('year', opened_date, {TODAY}) AS branch_age_years, created_at, updated_at
FROM raw_branches WHERE deleted_at IS NULL"""

RELATIONS["stg_employees"] = f"""
SELECT employee_id, employee_code, full_name, {tidied("email", "role")}, branch_id, hire_date,
  date_diff('month', hire_date, {TODAY}) AS tenure_months, is_active, created_at, updated_at
FROM raw_employees WHERE deleted_at IS NULL"""

RELATIONS["stg_loan_applications"] = f"""
SELECT l.application_id, l.application_number, l.customer_id, l.branch_id,
  l.handled_by AS handled_by_employee_id, l.product_type_id, p.product_code, p.product_name,
  l.requested_amount, l.approved_amount,
  CAST(l.approved_amount AS DOUBLE) / nullif(CAST(l.requested_amount AS DOUBLE), 0) AS approval_ratio,
  l.tenor_months, l.interest_rate, l.purpose, {tidy("l.collateral_type")} AS collateral_type,
  l.collateral_value, l.collateral_type <> 'none' AS has_collateral,
  {tidy("l.application_status")} AS application_status,
  l.application_status IN ('approved', 'disbursed') AS is_approved,
  l.application_status = 'disbursed' AS is_disbursed, l.application_status = 'rejected' AS is_rejected,
  l.rejection_reason, l.submitted_at, l.reviewed_at, l.decided_at, l.disbursed_at,
  CAST(l.submitted_at AS DATE) AS submitted_date,
  date_diff('day', CAST(l.submitted_at AS DATE), CAST(l.decided_at AS DATE)) AS days_to_decision,
  l.created_at, l.updated_at
FROM raw_loan_applications l LEFT JOIN raw_product_types p USING (product_type_id)
WHERE l.deleted_at IS NULL"""

RELATIONS["stg_credit_scores"] = f"""
SELECT score_id, customer_id, score_value, {tidied("score_band")}, score_date, model_version, data_source,
  {band("score_value")} AS score_band_derived,
  row_number() OVER (PARTITION BY customer_id ORDER BY score_date DESC, score_id DESC) = 1 AS is_latest_score,
  created_at, updated_at
FROM raw_credit_scores"""

RELATIONS["stg_merchants"] = f"""
SELECT m.merchant_id, m.merchant_uuid, m.merchant_name, m.merchant_legal_name, m.mcc_code, c.category_name,
  c.is_high_risk AS is_high_risk_mcc, {titled("m.city")} AS city, {titled("m.province")} AS province, m.country,
  m.is_online, {tidy("m.risk_level")} AS risk_level, m.risk_level IN ('elevated', 'high') AS is_elevated_risk,
  m.is_active, m.created_at, m.updated_at, m.deleted_at
FROM raw_merchants m LEFT JOIN raw_merchant_categories c USING (mcc_code)
WHERE m.deleted_at IS NULL"""

RELATIONS["stg_transactions"] = f"""
SELECT t.transaction_id, t.transaction_uuid, t.account_id, t.customer_id, t.merchant_id, t.type_id,
  y.type_code AS transaction_type_code, y.type_name AS transaction_type_name,
  {tidy("y.type_category")} AS transaction_category, t.method_id, m.method_code AS payment_method_code,
  m.method_name AS payment_method_name, t.amount, t.currency, t.exchange_rate, t.amount_idr, t.fee_amount,
  t.amount_idr + t.fee_amount AS total_amount_idr, t.balance_before, t.balance_after, t.description,
  t.reference_number, {tidy("t.channel")} AS channel, {tidy("t.transaction_status")} AS transaction_status,
  t.status_reason, {tidy("t.transaction_status")} = 'completed' AS is_completed,
  {tidy("t.transaction_status")} = 'failed' AS is_failed,
  {tidy("t.transaction_status")} = 'reversed' AS is_reversed,
  {tidy("t.transaction_status")} = 'pending' AS is_pending,
  CASE WHEN lower(y.type_category) IN ('credit', 'reversal') THEN 'credit'
       WHEN lower(y.type_category) IN ('debit', 'fee') THEN 'debit' ELSE 'unknown' END AS amount_direction,
  t.transaction_date, t.transaction_at, t.processed_at, hour(t.transaction_at) AS transaction_hour,
  dayofweek(t.transaction_at) + 1 AS transaction_day_of_week, month(t.transaction_date) AS transaction_month,
  year(t.transaction_date) AS transaction_year, strftime(t.transaction_date, '%Y-%m') AS transaction_month_key,
  isodow(t.transaction_date) <= 5 AS is_business_day, hour(t.transaction_at) <= 5 AS is_off_hours,
  t.amount_idr > 50000000 AS is_high_value, t.created_at, t.updated_at
FROM raw_transactions t LEFT JOIN raw_transaction_types y USING (type_id)
LEFT JOIN raw_payment_methods m USING (method_id)"""

RELATIONS["stg_fraud_flags"] = f"""
SELECT flag_id, transaction_id, customer_id, {tidied("flag_type", "severity")}, confidence_score, model_version,
  ifnull(list_position(['low', 'medium', 'high', 'critical'], {tidy("severity")}), 0) AS severity_score,
  confidence_score >= 0.80 AS is_high_confidence, is_confirmed_fraud, reviewed_by, reviewed_at,
  reviewed_at IS NOT NULL AS is_reviewed, notes, {_OUTCOME} AS review_status, created_at, updated_at
FROM raw_fraud_flags"""


def _total(amount: str, cond: str) -> str:
    return f"CAST(ifnull(sum({amount}) FILTER (WHERE {cond}), 0) AS DECIMAL(38,2))"


def _n(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def _horizon(n: int) -> str:
    recent = f"is_completed AND transaction_date >= {TODAY} - {n}"
    return f"{_n(recent)} AS txn_count_{n}d, {_total('amount_idr', recent)} AS txn_volume_{n}d_idr"


RELATIONS["customer_txn_summary"] = f"""
SELECT customer_id, count(*) AS total_transactions, {_total("amount_idr", "is_completed")} AS total_txn_volume_idr,
  {_total("amount_idr", "is_completed AND transaction_category = 'debit'")} AS total_debit_idr,
  {_total("amount_idr", "is_completed AND transaction_category = 'credit'")} AS total_credit_idr,
  max(transaction_at) AS last_transaction_at, min(transaction_at) AS first_transaction_at,
  count(DISTINCT CAST(transaction_at AS DATE)) AS active_transaction_days,
  {_horizon(30)}, {_horizon(90)}, {_horizon(365)},
  {_n("is_completed AND channel = 'mobile'")} AS mobile_txn_count,
  {_n("is_completed AND channel = 'atm'")} AS atm_txn_count,
  {_n("is_completed AND channel = 'branch'")} AS branch_txn_count
FROM stg_transactions GROUP BY customer_id"""


def _account_summary(source: str) -> str:
    return f"""
SELECT customer_id, count(*) AS total_accounts, {_n("account_status = 'active'")} AS active_accounts,
  {_n("product_category = 'savings'")} AS savings_count, {_n("product_category = 'checking'")} AS checking_count,
  {_n("product_category = 'loan'")} AS loan_count, {_n("product_category = 'credit_card'")} AS credit_card_count,
  {_total("balance", "account_status = 'active'")} AS total_balance_idr,
  {_total("outstanding_balance", "product_category = 'loan'")} AS total_outstanding_loan_idr,
  greatest(ifnull(max(dpd) FILTER (WHERE product_category = 'loan'), 0), 0) AS max_dpd,
  min(opened_date) AS first_account_opened
FROM {source} GROUP BY customer_id"""


RELATIONS["customer_account_summary"] = _account_summary("stg_accounts")
RELATIONS["customer_account_summary_servicing"] = _account_summary("stg_accounts_servicing")

RELATIONS["customer_loan_summary"] = f"""
SELECT customer_id, count(*) AS total_loan_applications,
  {_n("application_status = 'approved'")} AS approved_loans,
  {_n("application_status = 'rejected'")} AS rejected_loans,
  {_n("application_status = 'disbursed'")} AS disbursed_loans,
  {_total("approved_amount", "application_status = 'disbursed'")} AS total_disbursed_idr,
  max(submitted_at) AS last_loan_application_at
FROM stg_loan_applications GROUP BY customer_id"""


def _customer_360(accounts: str) -> str:
    z = lambda expr, name: f"ifnull({expr}, 0) AS {name}"
    return f"""
SELECT c.customer_id, c.customer_uuid, c.full_name, c.national_id_masked, c.date_of_birth, c.age_years, c.gender,
  c.marital_status, c.occupation, c.income_range, c.email, c.phone_primary, c.address_city, c.address_province,
  c.customer_segment, c.kyc_status, c.kyc_verified_at, c.acquisition_channel, c.risk_rating,
  c.is_politically_exposed, b.branch_name AS onboarding_branch_name, b.city AS onboarding_branch_city,
  {z("a.total_accounts", "total_accounts")}, {z("a.active_accounts", "active_accounts")},
  {z("a.savings_count", "savings_accounts")}, {z("a.checking_count", "checking_accounts")},
  {z("a.loan_count", "loan_accounts")}, {z("a.credit_card_count", "credit_card_accounts")},
  {z("a.total_balance_idr", "total_balance_idr")},
  {z("a.total_outstanding_loan_idr", "total_outstanding_loan_idr")}, {z("a.max_dpd", "max_dpd")},
  a.first_account_opened, {z("t.total_transactions", "total_transactions")},
  {z("t.total_txn_volume_idr", "total_txn_volume_idr")},
  {z("t.txn_count_30d", "txn_count_30d")}, {z("t.txn_volume_30d_idr", "txn_volume_30d_idr")},
  {z("t.txn_count_90d", "txn_count_90d")}, {z("t.txn_volume_90d_idr", "txn_volume_90d_idr")},
  {z("t.txn_count_365d", "txn_count_365d")}, {z("t.txn_volume_365d_idr", "txn_volume_365d_idr")},
  t.last_transaction_at, t.first_transaction_at, {z("t.active_transaction_days", "active_transaction_days")},
  CASE greatest(ifnull(t.mobile_txn_count, 0), ifnull(t.atm_txn_count, 0), ifnull(t.branch_txn_count, 0))
    WHEN ifnull(t.mobile_txn_count, 0) THEN 'mobile' WHEN ifnull(t.atm_txn_count, 0) THEN 'atm'
    ELSE 'branch' END AS preferred_channel,
  {z("l.total_loan_applications", "total_loan_applications")}, {z("l.approved_loans", "approved_loans")},
  {z("l.rejected_loans", "rejected_loans")}, {z("l.total_disbursed_idr", "total_disbursed_idr")},
  l.last_loan_application_at, s.score_value AS latest_credit_score, s.score_band AS credit_score_band,
  s.score_date AS credit_score_date,
  date_diff('day', CAST(t.last_transaction_at AS DATE), {TODAY}) AS days_since_last_txn,
  date_diff('day', CAST(t.last_transaction_at AS DATE), {TODAY}) > 180 AS is_dormant,
  ifnull(a.savings_count + a.checking_count + a.loan_count + a.credit_card_count, 0) AS product_count,
  ifnull(a.max_dpd, 0) >= 90 AS is_npl_customer,
  round(100.0::DOUBLE * t.mobile_txn_count / nullif(t.total_transactions, 0), 1) AS digital_adoption_score,
  date_diff('month', a.first_account_opened, {TODAY}) AS tenure_months, c.created_at AS customer_since,
  c.updated_at, c.updated_date, {audit("mart_customer_360")}
FROM stg_customers c LEFT JOIN stg_branches b ON b.branch_id = c.onboarding_branch_id
LEFT JOIN {accounts} a USING (customer_id)
LEFT JOIN customer_txn_summary t USING (customer_id) LEFT JOIN customer_loan_summary l USING (customer_id)
LEFT JOIN stg_credit_scores s ON s.customer_id = c.customer_id AND s.is_latest_score"""


RELATIONS["mart_customer_360"] = _customer_360("customer_account_summary")
RELATIONS["mart_customer_360_servicing"] = _customer_360("customer_account_summary_servicing")

RELATIONS["rfm_inputs"] = """
SELECT *, ifnull(days_since_last_txn, 9999) AS recency_days, txn_count_365d AS frequency_365d,
  txn_volume_365d_idr AS monetary_365d_idr,
  CASE WHEN days_since_last_txn <= 7 THEN 5 WHEN days_since_last_txn <= 30 THEN 4
       WHEN days_since_last_txn <= 90 THEN 3 WHEN days_since_last_txn <= 180 THEN 2 ELSE 1 END AS r_score,
  1 + (txn_count_365d >= 12)::INT + (txn_count_365d >= 36)::INT + (txn_count_365d >= 100)::INT
    + (txn_count_365d >= 200)::INT AS f_score,
  1 + (txn_volume_365d_idr >= 5000000)::INT + (txn_volume_365d_idr >= 25000000)::INT
    + (txn_volume_365d_idr >= 100000000)::INT + (txn_volume_365d_idr >= 500000000)::INT AS m_score
FROM mart_customer_360"""

RELATIONS["mart_customer_lifetime_value"] = f"""
SELECT customer_id, customer_uuid, customer_segment, kyc_status, risk_rating, income_range, address_province,
  acquisition_channel, preferred_channel, tenure_months, product_count, active_accounts, is_dormant,
  is_npl_customer, digital_adoption_score, total_balance_idr, total_outstanding_loan_idr, total_disbursed_idr,
  latest_credit_score, credit_score_band, recency_days, frequency_365d, monetary_365d_idr, txn_count_30d,
  txn_volume_30d_idr, txn_count_90d, txn_volume_90d_idr, r_score, f_score, m_score,
  (40 * m_score + 35 * f_score + 25 * r_score) / 100.0 AS rfm_score,
  CASE WHEN 40 * m_score + 35 * f_score + 25 * r_score >= 450 THEN 'champions'
       WHEN 40 * m_score + 35 * f_score + 25 * r_score >= 350 THEN 'loyal_customers'
       WHEN 40 * m_score + 35 * f_score + 25 * r_score >= 250 THEN 'potential_loyalists'
       WHEN 40 * m_score + 35 * f_score + 25 * r_score >= 150 THEN 'at_risk' ELSE 'lost' END AS clv_segment,
  round(CAST(monetary_365d_idr AS DECIMAL(20,2)) * CASE WHEN recency_days <= 30 THEN 1.2
    WHEN recency_days <= 90 THEN 1.0 WHEN recency_days <= 180 THEN 0.7 ELSE 0.3 END, 0) AS estimated_clv_idr,
  total_accounts = 1 AS cross_sell_eligible, NOT is_dormant AND product_count < 3 AS upsell_candidate,
  is_dormant AND recency_days <= 365 AS winback_candidate, last_transaction_at, customer_since,
  {TODAY} AS snapshot_date, {audit("mart_customer_lifetime_value")}
FROM rfm_inputs"""


def _credit_risk(accounts: str) -> str:
    rate = (
        "CASE WHEN a.dpd > 90 THEN 1.00 WHEN a.dpd > 60 THEN 0.50 WHEN a.dpd > 30 THEN 0.15"
        " WHEN a.dpd > 0 THEN 0.05 WHEN a.dpd = 0 THEN 0.01 END"
    )
    return f"""
SELECT {TODAY} AS snapshot_date, a.account_id, a.account_number, a.customer_id, c.customer_segment, c.risk_rating,
  c.income_range, c.address_province, c.is_politically_exposed, c.kyc_status, s.score_value AS credit_score,
  s.score_band AS credit_score_band, a.product_code, a.product_name, a.product_category, a.account_status,
  a.opened_date, a.interest_rate, a.outstanding_balance, a.dpd,
  CASE WHEN a.dpd > 90 THEN 'npl' WHEN a.dpd > 60 THEN 'dpd_61_90' WHEN a.dpd > 30 THEN 'dpd_31_60'
       WHEN a.dpd > 0 THEN 'dpd_1_30' WHEN a.dpd = 0 THEN 'current' ELSE 'unknown' END AS dpd_bucket,
  a.dpd >= 90 AS is_npl, {rate} AS provision_rate, a.outstanding_balance * {rate} AS estimated_provision_idr,
  {audit("mart_credit_risk")}
FROM {accounts} a JOIN stg_customers c USING (customer_id)
LEFT JOIN (SELECT * FROM stg_credit_scores WHERE is_latest_score) s USING (customer_id)
WHERE a.product_category IN ('loan', 'credit_card')"""


RELATIONS["mart_credit_risk"] = _credit_risk("stg_accounts")
RELATIONS["mart_credit_risk_servicing"] = _credit_risk("stg_accounts_servicing")

RELATIONS["mart_fraud_analytics"] = f"""
SELECT f.flag_id, f.transaction_id, f.customer_id, t.transaction_date, t.transaction_at, t.transaction_hour,
  t.transaction_day_of_week, t.transaction_type_code, t.transaction_type_name, t.transaction_category,
  t.payment_method_code, t.channel, t.amount_idr, t.currency, t.transaction_status, t.merchant_id,
  t.reference_number, m.merchant_name, m.mcc_code, m.category_name AS merchant_category,
  m.is_online AS is_online_merchant, m.risk_level AS merchant_risk_level, m.is_high_risk_mcc, f.flag_type,
  f.severity, f.confidence_score, f.model_version, f.is_confirmed_fraud, f.reviewed_by, f.reviewed_at, f.notes,
  f.created_at AS flagged_at, c.customer_segment, c.kyc_status, c.risk_rating AS customer_risk_rating,
  c.address_province, c.is_politically_exposed,
  round(f.confidence_score * 0.50
    + CAST(CASE f.severity WHEN 'critical' THEN 0.40 WHEN 'high' THEN 0.30 WHEN 'medium' THEN 0.15
           WHEN 'low' THEN 0.05 ELSE 0 END AS DECIMAL(6,4))
    + CAST(CASE c.risk_rating WHEN 'high' THEN 0.10 WHEN 'medium' THEN 0.05 ELSE 0 END AS DECIMAL(6,4)), 4)
    AS combined_risk_score,
  f.severity_score >= 3 AND f.confidence_score >= 0.80 AS is_high_priority_alert,
  t.transaction_hour <= 4 AS is_off_hours, t.is_high_value, f.review_status,
  date_sub('hour', f.created_at, f.reviewed_at) AS hours_to_review,
  f.reviewed_at IS NULL AND f.severity = 'critical' AND date_sub('hour', f.created_at, {NOW}) > 24
    AS is_sla_breached,
  f.updated_at, {audit("mart_fraud_analytics")}
FROM stg_fraud_flags f JOIN stg_transactions t USING (transaction_id)
LEFT JOIN stg_merchants m ON m.merchant_id = t.merchant_id
LEFT JOIN stg_customers c ON c.customer_id = f.customer_id"""


def transaction_metrics(grain: str) -> str:
    done = "is_completed"
    return f"""
SELECT {grain}, count(*) AS transaction_count, count(DISTINCT customer_id) AS unique_customers,
  count(DISTINCT account_id) AS unique_accounts, {_n(done)} AS completed_count, {_n("is_failed")} AS failed_count,
  {_n("is_reversed")} AS reversed_count, {_total("amount_idr", done)} AS total_volume_idr,
  {_total("fee_amount", done)} AS total_fee_idr, {_total("total_amount_idr", done)} AS total_gross_idr,
  CAST(sum(amount_idr) FILTER (WHERE {done}) AS DOUBLE) / nullif({_n(done)}, 0) AS avg_amount_idr,
  min(amount_idr) FILTER (WHERE {done}) AS min_amount_idr, max(amount_idr) FILTER (WHERE {done}) AS max_amount_idr,
  {_total("amount_idr", done + " AND transaction_category = 'debit'")} AS total_debit_idr,
  {_total("amount_idr", done + " AND transaction_category = 'credit'")} AS total_credit_idr,
  {_n("transaction_hour BETWEEN 6 AND 11")} AS morning_count,
  {_n("transaction_hour BETWEEN 12 AND 17")} AS afternoon_count,
  {_n("transaction_hour BETWEEN 18 AND 22")} AS evening_count,
  {_n("transaction_hour = 23 OR transaction_hour <= 5")} AS offhours_count,
  CAST({_n(done)} AS DOUBLE) / count(*) AS success_rate,
  1 - CAST({_n(done)} AS DOUBLE) / count(*) AS failure_rate,
  CAST({_total("fee_amount", done)} AS DOUBLE) / nullif({_n(done)}, 0) AS fee_per_txn_idr
FROM stg_transactions GROUP BY {grain}"""


GRAIN = (
    "transaction_date, channel, transaction_type_code, transaction_type_name, transaction_category,"
    " payment_method_code, transaction_status, currency"
)
RELATIONS["txn_metrics"] = transaction_metrics(GRAIN)
RELATIONS["mart_transaction_analytics"] = f"SELECT *, {audit('mart_transaction_analytics')} FROM txn_metrics"

# The decimal columns of each relation; registered queries return them as double.
DECIMALS: dict[str, tuple[str, ...]] = {
    "stg_accounts": ("interest_rate", "balance", "available_balance", "blocked_balance", "outstanding_balance"),
    "stg_loan_applications": ("requested_amount", "approved_amount", "interest_rate", "collateral_value"),
    "stg_transactions": (
        *("amount", "exchange_rate", "amount_idr", "fee_amount", "total_amount_idr"),
        *("balance_before", "balance_after"),
    ),
    "stg_fraud_flags": ("confidence_score",),
    "customer_txn_summary": (
        *("total_txn_volume_idr", "total_debit_idr", "total_credit_idr"),
        *("txn_volume_30d_idr", "txn_volume_90d_idr", "txn_volume_365d_idr"),
    ),
    "customer_account_summary": ("total_balance_idr", "total_outstanding_loan_idr"),
    "customer_loan_summary": ("total_disbursed_idr",),
    "mart_customer_360": (
        *("total_balance_idr", "total_outstanding_loan_idr", "total_txn_volume_idr", "txn_volume_30d_idr"),
        *("txn_volume_90d_idr", "txn_volume_365d_idr", "total_disbursed_idr"),
    ),
    "mart_customer_lifetime_value": (
        *("total_balance_idr", "total_outstanding_loan_idr", "total_disbursed_idr", "monetary_365d_idr"),
        *("txn_volume_30d_idr", "txn_volume_90d_idr", "rfm_score", "estimated_clv_idr"),
    ),
    "mart_credit_risk": ("interest_rate", "outstanding_balance", "provision_rate", "estimated_provision_idr"),
    "mart_fraud_analytics": ("amount_idr", "confidence_score", "combined_risk_score"),
    "mart_transaction_analytics": (
        *("total_volume_idr", "total_fee_idr", "total_gross_idr", "min_amount_idr", "max_amount_idr"),
        *("total_debit_idr", "total_credit_idr"),
    ),
}


def whole(relation: str) -> str:
    return dbl(relation, *DECIMALS.get(relation.removesuffix("_servicing"), ()))


def as_text(relation: str) -> str:
    """All of a relation, its amounts as text with two decimals."""
    casts = ", ".join(f"CAST(CAST({c} AS DECIMAL(38,2)) AS VARCHAR) AS {c}" for c in DECIMALS[relation])
    return f"SELECT * REPLACE ({casts}) FROM {relation}"


def assemble(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix the relations a query needs, directly or through others, as common table expressions."""
    known = RELATIONS | (extra or {})
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", text)) & known.keys() - needed:
            needed.add(name)
            visit(known[name])

    visit(sql)
    ctes = [f"{name} AS ({known[name]})" for name in known if name in needed]
    return (f"WITH {', '.join(ctes)} " if ctes else "") + sql
