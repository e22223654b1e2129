"""DuckDB SQL of the registered queries, by name."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from ledgerloom.operators.quality import ACCEPTED, NOT_NULL, RANGE, RELATIONSHIP, UNIQUE, Check
from ledgerloom.oracle.relations import (
    GRAIN,
    NOW,
    TODAY,
    assemble,
    audit,
    band,
    dbl,
    masked,
    tidy,
    titled,
    transaction_metrics,
)
from ledgerloom.plans.checks import ALL_CHECKS
from ledgerloom.sources.contracts import INGESTED, SPECS
from ledgerloom.sources.dims import DIMS
from ledgerloom.sources.testbed import MAPPINGS

CONTRACT_TABLES = tuple(SPECS)
CHANNEL_WEIGHTS = {"mobile": 40, "atm": 20, "web": 15, "pos": 15, "branch": 5, "qris": 5}
SNAPSHOT_RUNS = (datetime(2024, 1, 3), datetime(2024, 1, 9), datetime(2024, 1, 20), datetime(2024, 2, 1))


def _held(name: str) -> list[str]:
    """The columns a source table has here."""
    return list(SPECS[name].columns) if name in DIMS else list(MAPPINGS[name].cols)


#: Every source table: its key, and the key and all columns that may be null.
RATED_TABLES = {
    n: (s.key, [s.key, *(c for c in s.columns if c not in s.required and c in _held(n))]) for n, s in SPECS.items()
}
RATED_TABLES["change_feed"] = ("customer_id", ["customer_id", "balance"])

EPOCH = "TIMESTAMP '1995-01-01 00:00:00'"
STAGED = (
    *("stg_customers", "stg_accounts", "stg_branches", "stg_employees", "stg_loan_applications"),
    *("stg_credit_scores", "stg_merchants", "stg_transactions", "stg_fraud_flags"),
)

EXTRA: dict[str, str] = {}
SQL: dict[str, str] = {}


def source_rows(name: str) -> str:
    """A source table with all its columns; literal dimensions are active and loaded at the epoch."""
    if name not in DIMS:
        return f"raw_{name}"
    have = [part.split()[0] for part in DIMS[name][0].split(",")]
    rest = [c for c in SPECS[name].columns if c not in have]
    values = ", ".join(f"{'true' if c == 'is_active' else EPOCH} AS {c}" for c in rest)
    return f"(SELECT *, {values} FROM raw_{name}) AS dated" if rest else f"raw_{name}"


def assembled(text: str) -> str:
    return assemble(text, EXTRA)


def _newest(source: str, key: str, order: str = "updated_at DESC NULLS LAST, seq DESC") -> str:
    return (
        f"SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS n"
        f" FROM {source}) AS ranked WHERE n = 1"
    )


# ---- the change feed and its increments ---------------------------------------------------------------

EXTRA["feed_span"] = """
SELECT date_trunc('day', min(updated_at)) + to_days(CAST((date_diff('day', min(updated_at), max(updated_at)) + 1) // 2 AS INTEGER)) AS split
FROM raw_change_feed"""
_SPLIT = "(SELECT split FROM feed_span)"
EXTRA["feed_first"] = f"SELECT * FROM raw_change_feed WHERE updated_at < {_SPLIT}"
EXTRA["feed_target"] = _newest("feed_first", "customer_id")
EXTRA["feed_bent"] = f"""
SELECT CASE WHEN customer_id % 10 = 3 THEN customer_id + 1000000000 ELSE customer_id END AS customer_id,
  customer_segment, balance,
  CASE WHEN customer_id % 10 = 7 THEN NULL WHEN customer_id % 4 = 1 THEN updated_at - INTERVAL 20 DAY
       ELSE updated_at END AS updated_at, seq
FROM raw_change_feed WHERE updated_at >= {_SPLIT}"""
EXTRA["feed_increment"] = _newest("feed_bent", "customer_id")
EXTRA["feed_merged"] = """
SELECT CASE WHEN i.updated_at > t.updated_at THEN i ELSE t END AS r, i.customer_id IS NOT NULL AS offered
FROM feed_target t LEFT JOIN feed_increment i ON i.customer_id = t.customer_id
UNION ALL
SELECT i, true FROM feed_increment i WHERE i.customer_id NOT IN (SELECT customer_id FROM feed_target)"""

_MERGED = "SELECT r.customer_id, r.customer_segment, r.balance, r.updated_at, r.seq FROM feed_merged"
SQL["ingest_merge_upsert"] = _MERGED
SQL["ingest_merge_dedup_guard"] = _MERGED
SQL["ingest_merge_delete"] = f"{_MERGED} WHERE offered"
SQL["join_merge"] = """
SELECT coalesce(t.customer_id, i.customer_id) AS customer_id, t.updated_at AS stored_at, i.updated_at AS offered_at,
  CASE WHEN t.customer_id IS NULL THEN 'insert' WHEN i.customer_id IS NULL THEN 'not offered'
       WHEN i.updated_at > t.updated_at THEN 'update' ELSE 'keep' END AS branch
FROM feed_target t FULL JOIN feed_increment i ON i.customer_id = t.customer_id"""

# ---- sources and ingestion ----------------------------------------------------------------------------

SQL["scan_table"] = dbl("raw_merchants")


def _use(dim: str, key: str, label: str, user: str) -> str:
    return (
        f"SELECT '{dim}' AS dim, CAST(d.{key} AS VARCHAR) AS dim_key, d.{label} AS label,"
        f" (SELECT count(*) FROM raw_{user} u WHERE u.{key} = d.{key}) AS uses FROM raw_{dim} d"
    )


SQL["dim_literals"] = " UNION ALL ".join(
    [
        _use("transaction_types", "type_id", "type_code", "transactions"),
        _use("payment_methods", "method_id", "method_code", "transactions"),
        _use("merchant_categories", "mcc_code", "category_name", "merchants"),
        _use("product_types", "product_type_id", "product_code", "accounts"),
    ]
)
SQL["source_contract"] = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, '{c}' AS column_name,"
    f" '{SPECS[n].schema[c].dataType.simpleString()}' AS declared_type, count(*) AS rows,"
    f" count(*) - count({c}) AS nulls FROM {source_rows(n)}"
    for n in CONTRACT_TABLES
    for c in SPECS[n].required
)
SQL["ingest_project_cast"] = dbl(
    "raw_loan_applications", "requested_amount", "approved_amount", "interest_rate", "collateral_value"
)
_FEED = "SELECT customer_id, customer_segment, balance, updated_at, seq FROM raw_change_feed"
SQL["ingest_window_filter"] = f"""{_FEED}
WHERE updated_at >= TIMESTAMP '2024-01-08 00:00:00' AND updated_at < TIMESTAMP '2024-01-22 00:00:00'"""
SQL["ingest_window_tz"] = """
SELECT *, updated_at + INTERVAL 7 HOUR AS updated_at_wib FROM raw_change_feed
WHERE updated_at - INTERVAL 7 HOUR >= TIMESTAMP '2024-01-08 02:00:00'
  AND updated_at - INTERVAL 7 HOUR < TIMESTAMP '2024-01-22 02:00:00'"""
SQL["ingest_window_override"] = f"""{_FEED}
WHERE updated_at >= TIMESTAMP '2024-01-10 09:00:00' AND updated_at < TIMESTAMP '2024-01-22 09:00:00'"""
SQL["ingest_dedup_latest"] = _newest("raw_change_feed", "customer_id")
SQL["ingest_dedup_latest_composite"] = _newest(
    "lineitem",
    "l_orderkey, l_linenumber",
    "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC",
)
SQL["ingest_schema_evolution"] = f"""
SELECT customer_id, customer_segment, updated_at, NULL::DOUBLE AS balance, NULL::BIGINT AS seq,
  'added:balance,seq' AS outcome FROM feed_target
UNION ALL
SELECT customer_id, customer_segment, updated_at, balance, seq, 'added:balance,seq' FROM raw_change_feed
WHERE updated_at >= {_SPLIT}"""
EXTRA["feed_rest"] = f"SELECT * FROM raw_change_feed WHERE updated_at >= {_SPLIT}"
EXTRA["feed_rest_newest"] = _newest("feed_rest", "customer_id")
SQL["ingest_table"] = """
SELECT customer_id, coalesce(w.customer_segment, t.customer_segment) AS customer_segment, w.balance,
  coalesce(w.updated_at, t.updated_at) AS updated_at, coalesce(w.seq, t.seq) AS seq
FROM feed_target t FULL JOIN feed_rest_newest w USING (customer_id)"""
SQL["ingest_tables"] = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS rows, count(DISTINCT {SPECS[n].key}) AS keys,"
    f" min(updated_at) AS first_loaded, max(updated_at) AS last_loaded FROM "
    + (
        f"raw_{n}"
        if n in MAPPINGS
        else f"(SELECT *, TIMESTAMP '1995-01-01 00:00:00' AS updated_at FROM raw_{n}) AS dated"
    )
    for n in INGESTED
)
EXTRA["feed_keyed"] = "SELECT * FROM raw_change_feed WHERE seq % 7 <> 0"
SQL["ingest_required_kept"] = _newest("feed_keyed", "customer_id")
SQL["ingest_required_aside"] = """
SELECT NULL::BIGINT AS customer_id, customer_segment, balance, updated_at, seq, 'customer_id' AS null_columns
FROM raw_change_feed WHERE seq % 7 = 0"""
SQL["ingest_backfill_stored"] = _newest("raw_change_feed", "customer_id")
SQL["ingest_backfill"] = _newest("raw_change_feed", "customer_id")
SQL["ingest_backfill_resumed"] = _newest("raw_change_feed", "customer_id")
SQL["dq_unique_incremental"] = """
SELECT customer_id, count(*) AS n_records FROM raw_change_feed
WHERE customer_id IS NOT NULL AND updated_at IS NOT NULL GROUP BY customer_id HAVING count(*) > 1"""
SQL["ingest_freshness"] = " UNION ALL ".join(
    f"SELECT '{SPECS[n].system}' AS source, '{n}' AS table_name, max({SPECS[n].loaded_at}) AS max_loaded_at,"
    f" date_sub('second', max({SPECS[n].loaded_at}), {NOW}) / 3600.0::DOUBLE AS age_hours,"
    f" CASE WHEN date_sub('second', max({SPECS[n].loaded_at}), {NOW}) > 49 * 3600 THEN 'error'"
    f" WHEN date_sub('second', max({SPECS[n].loaded_at}), {NOW}) > 25 * 3600 THEN 'warn' ELSE 'pass' END AS status"
    f" FROM {source_rows(n)}"
    for n in CONTRACT_TABLES
)
SQL["insert_ignore"] = """
SELECT arg_min(application_id, (submitted_at, application_id)) AS application_id, application_number,
  min(submitted_at) AS submitted_at
FROM (SELECT application_id, customer_id || '-' || month(submitted_at) AS application_number, submitted_at
      FROM raw_loan_applications) AS apps
GROUP BY application_number"""
SQL["upsert_dim"] = """
SELECT merchant_id, CASE WHEN risk_level = 'high' THEN merchant_name ELSE upper(merchant_name) END AS merchant_name,
  risk_level FROM raw_merchants
UNION ALL
SELECT merchant_id + 1000000000, upper(merchant_name), 'unknown' FROM raw_merchants WHERE risk_level = 'high'"""
SQL["lookback_filter"] = f"""
SELECT transaction_id, customer_id, updated_at FROM raw_transactions WHERE updated_at >= {TODAY} - 3"""
SQL["execution_date"] = f"""
SELECT transaction_date = {TODAY} - 1 AS is_default, transaction_date AS execution_date,
  count(*) AS transactions, CAST(sum(amount_idr) AS DOUBLE) AS volume_idr
FROM raw_transactions WHERE transaction_date IN (DATE '2001-07-15', {TODAY} - 1) GROUP BY ALL"""

# ---- sinks --------------------------------------------------------------------------------------------

SQL["sink_raw_partitioned"] = """
SELECT CAST(year(updated_at) * 100 + month(updated_at) AS INT) AS part_key, count(*) AS rows, min(updated_at) AS first_update,
  max(updated_at) AS last_update, CAST(sum(amount_idr) AS DOUBLE) AS amount_idr
FROM raw_transactions GROUP BY 1"""
SQL["sink_cleanup"] = """
SELECT account_status, count(*) AS accounts, true AS stage_removed FROM raw_accounts GROUP BY account_status"""
SQL["sink_orphans"] = """
SELECT account_status, count(*) AS accounts, true AS orphan_removed FROM raw_accounts GROUP BY account_status"""
SQL["view_layer"] = """
SELECT c.customer_segment, t.channel, count(*) AS transactions, CAST(sum(t.amount_idr) AS DOUBLE) AS volume_idr
FROM stg_transactions t JOIN stg_customers c USING (customer_id) GROUP BY ALL"""
SQL["view_counts"] = " UNION ALL ".join(f"SELECT '{m}' AS view_name, count(*) AS rows FROM {m}" for m in STAGED)
SQL["target_namespace"] = " UNION ALL ".join(
    f"SELECT '{m}' AS model, count(*) AS rows, '{env}' AS env, '{name}' AS schema_name FROM {m}"
    for m in STAGED
    for env, name in (("prod", "staging"), ("ci", "ci_staging"), ("dev", "dev_staging"), ("laptop", "dev_staging"))
)
SQL["store_failures"] = """
SELECT account_id, customer_id, account_status, CAST(balance AS DOUBLE) AS balance FROM stg_accounts WHERE balance < 0"""
SQL["source_month_partition"] = """
SELECT CAST(strftime(transaction_date, '%Y%m') AS INT) AS partition_key, count(*) AS transactions,
  min(transaction_date) AS first_date, max(transaction_date) AS last_date
FROM raw_transactions GROUP BY 1"""

# ---- joins, aggregation, windows, sets ----------------------------------------------------------------

SQL["join_left_dim"] = """
SELECT type_id, transaction_id, CAST(amount_idr AS DOUBLE) AS amount_idr, type_code, type_category
FROM raw_transactions LEFT JOIN raw_transaction_types USING (type_id)"""
SQL["join_left_fact"] = """
SELECT c.customer_id, c.customer_segment, t.n AS transactions, a.n AS accounts FROM raw_customers c
LEFT JOIN (SELECT customer_id, count(*) AS n FROM raw_transactions GROUP BY 1) t USING (customer_id)
LEFT JOIN (SELECT customer_id, count(*) AS n FROM raw_accounts GROUP BY 1) a USING (customer_id)"""
SQL["join_inner"] = """
SELECT f.transaction_id, f.flag_id, f.severity, CAST(t.amount_idr AS DOUBLE) AS amount_idr, t.channel
FROM raw_fraud_flags f JOIN raw_transactions t USING (transaction_id)"""
SQL["join_anti"] = """
SELECT f.transaction_id, f.flag_id FROM raw_fraud_flags f
LEFT JOIN raw_transactions t USING (transaction_id) WHERE t.account_id IS NULL"""
SQL["agg_group_by"] = f"SELECT {GRAIN}, count(*) AS transactions FROM stg_transactions GROUP BY {GRAIN}"
SQL["agg_countif"] = """
SELECT severity, flag_type, count(*) FILTER (WHERE is_confirmed_fraud) AS confirmed,
  count(*) FILTER (WHERE NOT is_confirmed_fraud) AS false_positives, count(*) AS flags
FROM stg_fraud_flags GROUP BY ALL"""
SQL["agg_conditional_sum"] = """
SELECT customer_id, CAST(ifnull(sum(amount_idr) FILTER (WHERE is_failed), 0) AS DOUBLE) AS failed_idr,
  CAST(sum(amount_idr) FILTER (WHERE is_failed) AS DOUBLE) / nullif(count(*) FILTER (WHERE is_failed), 0)
    AS avg_failed_idr,
  CAST(min(amount_idr) FILTER (WHERE is_failed) AS DOUBLE) AS min_failed_idr,
  CAST(max(amount_idr) FILTER (WHERE is_failed) AS DOUBLE) AS max_failed_idr
FROM stg_transactions GROUP BY customer_id"""
SQL["agg_count_distinct"] = """
SELECT channel, count(DISTINCT customer_id) AS customers, count(DISTINCT account_id) AS accounts,
  count(DISTINCT merchant_id) AS merchants FROM raw_transactions GROUP BY channel"""
SQL["agg_minmax"] = """
SELECT customer_id, min(transaction_at) AS first_at, max(transaction_at) AS last_at,
  CAST(min(amount_idr) AS DOUBLE) AS least_idr,
  CAST(ifnull(max(amount_idr) FILTER (WHERE channel = 'mobile'), 0) AS DOUBLE) AS most_mobile_idr
FROM raw_transactions GROUP BY customer_id"""
SQL["agg_global"] = """
SELECT count(*) AS transactions, count(merchant_id) AS with_merchant FROM raw_transactions
HAVING count(merchant_id) > 0.1 * count(*)"""
SQL["win_row_number"] = "SELECT score_id, customer_id, score_date, is_latest_score FROM stg_credit_scores"
SQL["top1_per_group"] = _newest("raw_credit_scores", "customer_id", "score_date DESC, score_id DESC")
SQL["distinct_rows"] = "SELECT account_id, customer_id FROM raw_transactions GROUP BY ALL"
SQL["topk"] = """
SELECT transaction_id, transaction_date, CAST(amount_idr AS DOUBLE) AS amount_idr
FROM raw_transactions ORDER BY transaction_id DESC LIMIT 100"""
SQL["sample_n"] = """
SELECT account_id, customer_id FROM raw_accounts ORDER BY md5('42|' || account_id), account_id LIMIT 200"""
SQL["sample_fraction"] = """
SELECT transaction_id, account_id, CAST(amount_idr AS DOUBLE) AS amount_idr
FROM (SELECT *, row_number() OVER (ORDER BY md5('42|' || transaction_id), transaction_id) AS n,
        count(*) OVER () AS total FROM raw_transactions) AS ranked
WHERE n <= greatest(1, floor(total * 0.008))"""


def _weighted(draw: str) -> str:
    cum, whens = 0, []
    for label, weight in CHANNEL_WEIGHTS.items():
        cum += weight
        whens.append(f"WHEN {draw} < {cum} THEN '{label}'")
    return f"CASE {' '.join(whens)} END"


SQL["weighted_choice"] = f"""
SELECT transaction_id, {_weighted("draw")} AS assigned_channel
FROM (SELECT transaction_id, CAST('0x' || left(md5('7|' || transaction_id), 8) AS BIGINT) % 100 AS draw
      FROM raw_transactions) AS drawn"""

# ---- models at other grains ---------------------------------------------------------------------------

SQL["npl_ratio"] = """
SELECT customer_segment, dpd_bucket, grouping(customer_segment, dpd_bucket) AS rollup_level, count(*) AS accounts,
  CAST(ifnull(sum(outstanding_balance) FILTER (WHERE is_npl), 0) AS DOUBLE) AS npl_outstanding_idr,
  CAST(sum(outstanding_balance) AS DOUBLE) AS total_outstanding_idr,
  CAST(ifnull(sum(outstanding_balance) FILTER (WHERE is_npl), 0) AS DOUBLE)
    / nullif(CAST(sum(outstanding_balance) AS DOUBLE), 0) AS npl_ratio
FROM mart_credit_risk_servicing GROUP BY ROLLUP (customer_segment, dpd_bucket)"""
EXTRA["monthly_metrics"] = transaction_metrics("transaction_month_key, channel")
SQL["transaction_metrics_monthly"] = dbl(
    "monthly_metrics",
    *("total_volume_idr", "total_fee_idr", "total_gross_idr", "min_amount_idr", "max_amount_idr"),
    *("total_debit_idr", "total_credit_idr"),
)

# ---- functions ----------------------------------------------------------------------------------------


def _project(source: str, **columns: str) -> str:
    cols = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    return f"SELECT {SPECS[source].key}, {cols} FROM raw_{source}"


SQL |= {
    "fn_mask_pii": _project(
        "customers",
        masked_name=masked("full_name"),
        masked_short="left(full_name, 1) || '***' || left(full_name, 1)",
        masked_null="CAST(NULL AS VARCHAR)",
        prod_name="full_name",
    ),
    "fn_credit_band": _project(
        "credit_scores",
        band=band("score_value"),
        band_of_null=band("nullif(greatest(score_value, 500), 500)"),
    ),
    "fn_dpd_bucket": _project(
        "accounts",
        **{
            n: f"CASE WHEN {d} > 90 THEN 'npl' WHEN {d} > 60 THEN 'dpd_61_90' WHEN {d} > 30 THEN 'dpd_31_60'"
            f" WHEN {d} > 0 THEN 'dpd_1_30' WHEN {d} = 0 THEN 'current' ELSE 'unknown' END"
            for n, d in (("bucket", "dpd"), ("shifted", "(dpd - 5)"))
        },
    ),
    "fn_income_band_sort": _project(
        "customers",
        band_rank="ifnull(list_position(['0-3jt', '3-5jt', '5-10jt', '10-25jt', '25-50jt', '>50jt'], income_range), 0)",
    ),
    "fn_is_business_day": _project("transactions", business="isodow(transaction_date) NOT IN (6, 7)"),
    "fn_audit_columns": f"SELECT account_id, {audit('accounts')} FROM raw_accounts",
    "fn_safe_divide": _project(
        "loan_applications",
        ratio="CAST(approved_amount AS DOUBLE) / nullif(CAST(requested_amount AS DOUBLE), 0)",
        by_zero="CAST(NULL AS DOUBLE)",
    ),
    "fn_nullif_coalesce": _project(
        "transactions",
        fee_or_null="CASE WHEN fee_amount <> 0 THEN CAST(fee_amount AS DOUBLE) END",
        merchant_or_zero="CASE WHEN merchant_id IS NULL THEN 0 ELSE merchant_id END",
    ),
    "fn_string_norm": _project(
        "customers",
        gender="upper(trim(gender))",
        marital_status=tidy("marital_status"),
        email=tidy("email"),
        segment="lower(customer_segment)",
    ),
    "fn_initcap": _project(
        "customers",
        city=titled("address_city"),
        province=titled("address_province"),
        whole_name=titled("full_name"),
        nothing="''",
    ),
    "fn_concat_substr": _project(
        "customers", tail="right(full_name, 4)", joined="left(full_name, 2) || marital_status"
    ),
    "fn_date_diff_day": _project(
        "loan_applications",
        age_days=f"{TODAY} - CAST(submitted_at AS DATE)",
        decision_days="CAST(decided_at AS DATE) - CAST(submitted_at AS DATE)",
    ),
    "fn_date_diff_boundary": _project(
        "customers",
        years=f"date_diff('year', date_of_birth, {TODAY})",
        months=f"date_diff('month', date_of_birth, {TODAY})",
    ),
    "fn_timestamp_diff_hour": _project(
        "fraud_flags",
        review_hours="date_sub('hour', created_at, reviewed_at)",
        waiting_hours=f"date_sub('hour', created_at, {NOW})",
    ),
    "fn_date_sub": _project(
        "transactions", earlier="transaction_date - 30", recent=f"transaction_date >= {TODAY} - 365"
    ),
    "fn_extract": _project(
        "transactions",
        hour_of_day="hour(transaction_at)",
        weekday="dayofweek(transaction_at) + 1",
        month_of_year="month(transaction_date)",
        year_no="year(transaction_date)",
    ),
    "fn_format_date": _project("transactions", month_key="strftime(transaction_date, '%Y-%m')"),
    "fn_date_of_ts": _project("transactions", day="CAST(transaction_at AS DATE)"),
    "fn_now": _project("customers", as_of=TODAY, as_of_ts=NOW, is_current=f"updated_at < {TODAY} + 1"),
    "fn_round": _project(
        "transactions",
        r0="CAST(round(amount_idr * 0.333, 0) AS DOUBLE)",
        r1="CAST(round(amount_idr * 0.001, 1) AS DOUBLE)",
        r2="CAST(round(amount_idr * 0.005, 2) AS DOUBLE)",
        r4="CAST(round(exchange_rate * 0.12345, 4) AS DOUBLE)",
    ),
    "fn_cast": _project(
        "customers",
        national_no="CAST(national_id AS BIGINT)",
        id_text="CAST(customer_id AS VARCHAR)",
        born_text="CAST(date_of_birth AS VARCHAR)",
        exposed_no="CAST(is_politically_exposed AS INT)",
    ),
    "fn_case_searched": _project(
        "transactions",
        size="CASE WHEN amount_idr > 50000000 THEN 'high' WHEN amount_idr >= 10000000 THEN 'medium' ELSE 'low' END",
        online="CASE WHEN channel = 'mobile' OR channel = 'web' THEN 'digital' WHEN channel <> 'qris' THEN 'physical' END",
        merchant_known="ifnull(merchant_id, 5) > 4",
    ),
    "fn_bool_flags": _project(
        "fraud_flags",
        confirmed_and_high="is_confirmed_fraud AND severity = 'high'",
        open_or_low="NOT is_confirmed_fraud OR severity = 'low'",
        is_velocity="flag_type = 'velocity'",
    ),
    "fn_arith": _project(
        "accounts",
        blocked="CAST(balance - available_balance AS DOUBLE)",
        doubled="CAST(balance + balance AS DOUBLE)",
        rate_left="1 - CAST(available_balance AS DOUBLE) / nullif(CAST(balance AS DOUBLE), 0)",
    ),
}

# ---- history ------------------------------------------------------------------------------------------

_VERSION = "customer_id, customer_segment, balance, updated_at"


def _scd_id() -> str:
    return "md5(customer_id || '|' || strftime(updated_at, '%Y-%m-%d %H:%M:%S.%f')) AS scd_id"


for _i, _run in enumerate(SNAPSHOT_RUNS):
    EXTRA[f"seen_{_i}"] = f"SELECT * FROM raw_change_feed WHERE updated_at < TIMESTAMP '{_run}'"
    EXTRA[f"newest_{_i}"] = _newest(f"seen_{_i}", "customer_id")
    EXTRA[f"current_{_i}"] = f"SELECT {_VERSION} FROM newest_{_i} WHERE customer_segment <> 'sme'"
    _opened = f"SELECT {_VERSION}, updated_at AS valid_from, NULL::TIMESTAMP AS valid_to FROM "
    if _i == 0:
        EXTRA["history_0"] = _opened + "current_0"
    else:
        EXTRA[f"history_{_i}"] = f"""
SELECT h.customer_id, h.customer_segment, h.balance, h.updated_at, h.valid_from,
  CASE WHEN h.valid_to IS NOT NULL THEN h.valid_to WHEN c.customer_id IS NULL THEN TIMESTAMP '{_run}'
       WHEN c.updated_at > h.updated_at THEN c.updated_at END AS valid_to
FROM history_{_i - 1} h LEFT JOIN current_{_i} c USING (customer_id)
UNION ALL
{_opened} current_{_i} c WHERE NOT EXISTS (SELECT 1 FROM history_{_i - 1} h
  WHERE h.customer_id = c.customer_id AND h.valid_to IS NULL AND h.updated_at >= c.updated_at)"""
SQL["scd2_snapshot"] = f"SELECT *, {_scd_id()} FROM history_{len(SNAPSHOT_RUNS) - 1}"

SQL["scd2_hard_delete"] = f"""
SELECT customer_id, customer_uuid, full_name, national_id, date_of_birth, gender, customer_segment, kyc_status,
  risk_rating, income_range, address_province, acquisition_channel, is_politically_exposed, created_at, updated_at,
  updated_at AS valid_from, CASE WHEN deleted_at IS NOT NULL THEN {NOW} END AS valid_to, {_scd_id()}
FROM raw_customers"""
EXTRA["feed_versions"] = _newest("raw_change_feed", "customer_id, updated_at", "seq DESC")
EXTRA["feed_history"] = f"""
SELECT *, updated_at AS valid_from, lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) AS valid_to,
  {_scd_id()} FROM feed_versions"""
SQL["scd2_from_changes"] = dbl("feed_history")
SQL["as_of_lookup"] = """
SELECT customer_id, customer_segment, valid_from, valid_to FROM feed_history
WHERE TIMESTAMP '2024-01-15 12:00:00' >= valid_from
  AND TIMESTAMP '2024-01-15 12:00:00' < ifnull(valid_to, TIMESTAMP '9999-12-31')"""
EXTRA["score_versions"] = _newest("raw_credit_scores", "customer_id, created_at", "score_id DESC")
SQL["as_of_join"] = """
SELECT t.transaction_id, t.customer_id, t.transaction_at, s.score_id, s.score_value, s.created_at AS scored_at
FROM raw_transactions t ASOF LEFT JOIN score_versions s ON t.customer_id = s.customer_id AND t.transaction_at >= s.created_at"""
EXTRA["feed_asked"] = "SELECT seq, customer_id, updated_at - INTERVAL 1 DAY AS asked_at FROM raw_change_feed"
SQL["as_of_join_history"] = """
SELECT f.seq, f.customer_id, f.asked_at, h.customer_segment, h.balance, h.valid_from
FROM feed_asked f ASOF LEFT JOIN feed_history h ON f.customer_id = h.customer_id AND f.asked_at >= h.valid_from"""
SQL["rolling_horizons"] = (
    "SELECT customer_id, "
    + ", ".join(
        f"count(*) FILTER (WHERE {(recent := f'transaction_date >= {TODAY} - {h}')}) AS n_{h}d,"
        f" CAST(coalesce(sum(amount_idr) FILTER (WHERE {recent}), 0) AS DOUBLE) AS volume_{h}d"
        for h in (30, 90, 365)
    )
    + f" FROM raw_transactions WHERE trim(lower(transaction_status)) = 'completed' AND transaction_date <= {TODAY}"
    f" AND transaction_date >= {TODAY} - 365 GROUP BY customer_id"
)
SQL["distinct_from_daily_state"] = """
SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS month, channel, count(DISTINCT customer_id) AS distinct_customer_id,
  count(DISTINCT account_id) AS distinct_account_id
FROM raw_transactions GROUP BY ALL"""
SQL["stream_upsert"] = _newest("raw_change_feed", "customer_id")

# ---- quality ------------------------------------------------------------------------------------------


def _relation(name: str) -> str:
    return f"raw_{name}" if name in SPECS else name


def _broken(c: Check) -> str:
    rel, col = _relation(c.model), c.column
    if c.kind == NOT_NULL:
        return f"FROM {rel} WHERE {col} IS NULL"
    if c.kind == UNIQUE:
        return f"FROM (SELECT {col} FROM {rel} GROUP BY {col} HAVING count({col}) > 1) AS repeated"
    if c.kind == ACCEPTED:
        return f"FROM {rel} WHERE {col} NOT IN ({', '.join(repr(v) for v in c.values)})"
    if c.kind == RELATIONSHIP:
        parent, field = c.parent
        return f"FROM {rel} AS child ANTI JOIN {_relation(parent)} AS parent ON child.{col} = parent.{field} WHERE child.{col} IS NOT NULL"
    assert c.kind == RANGE
    equal = "=" if not c.inclusive else ""
    sides = [f"{col} <{equal} {c.low}"] if c.low is not None else []
    sides += [f"{col} >{equal} {c.high}"] if c.high is not None else []
    return f"FROM {rel} WHERE {' OR '.join(sides)}"


def check_counts(suite: Iterable[Check]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c.stage}' AS stage, '{c.model}' AS model, '{c.column}' AS column_name, '{c.kind}' AS test,"
        f" count(*) AS failures {_broken(c)}"
        for c in suite
    )


SQL["dq_no_negative_balance"] = """
SELECT account_id, account_number, CAST(balance AS DOUBLE) AS balance, account_status FROM stg_accounts
WHERE account_status = 'active' AND balance < 0"""
SQL["dq_customer_360_complete"] = """
SELECT customer_id, 'raw' AS found_in FROM raw_customers WHERE deleted_at IS NOT NULL
UNION ALL
SELECT customer_id, 'mart' FROM mart_customer_360 WHERE customer_id NOT IN (SELECT customer_id FROM stg_customers)"""
EXTRA["reviewed"] = """
SELECT count(*) FILTER (WHERE is_confirmed_fraud) AS confirmed_count, count(*) AS total_flagged
FROM stg_fraud_flags WHERE is_reviewed"""
SQL["dq_fraud_rate"] = "SELECT * FROM reviewed WHERE confirmed_count > 0.20 * total_flagged AND total_flagged > 100"


def _rates(model: str, key: str, columns: list[str]) -> str:
    parts = [
        (c, "null_rate", f"(count(*) - count({c})) * 100.0::DOUBLE / nullif(count(*), 0)", 5.0) for c in columns
    ]
    parts.append((key, "duplicate_rate", f"(count({key}) - count(DISTINCT {key})) * 100.0::DOUBLE / nullif(count(*), 0)", 0.1))
    return " UNION ALL ".join(
        f"SELECT '{model}' AS model, '{c}' AS column_name, '{metric}' AS metric, {rate} AS rate_pct,"
        f" {rate} > {limit} AS exceeded FROM {source_rows(model) if model in SPECS else f'raw_{model}'}"
        for c, metric, rate, limit in parts
    )


SQL["dq_rate_thresholds"] = " UNION ALL ".join(_rates(m, k, cols) for m, (k, cols) in RATED_TABLES.items())


def _singular(stage: str, model: str, name: str) -> str:
    return f"SELECT '{stage}' AS stage, '{model}' AS model, '*' AS column_name, '{name}' AS test, count(*) AS failures"


_STAGING_ASSERTIONS = " UNION ALL ".join(
    [
        _singular("staging", "stg_accounts", "assert_no_negative_balance")
        + " FROM stg_accounts WHERE account_status = 'active' AND balance < 0",
        _singular("staging", "stg_fraud_flags", "assert_fraud_rate_within_bounds")
        + " FROM reviewed WHERE confirmed_count > 0.20 * total_flagged AND total_flagged > 100",
    ]
)
_MART_ASSERTION = (
    _singular("marts", "mart_customer_360", "assert_customer_360_completeness")
    + " FROM mart_customer_360 WHERE customer_id NOT IN (SELECT customer_id FROM stg_customers)"
)
_SOURCE_AND_STAGING = [c for c in ALL_CHECKS if c.stage != "marts"]
_STATUS = "CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END"
SQL["dq_report"] = (
    f"SELECT *, {_STATUS} AS status FROM ({check_counts(ALL_CHECKS)} UNION ALL {_STAGING_ASSERTIONS}"
    f" UNION ALL {_MART_ASSERTION}) AS counted"
)
SQL["store_failures_counts"] = (
    f"SELECT * FROM ({check_counts([c for c in ALL_CHECKS if c.stage == 'staging'])}) AS counted WHERE failures > 0"
)
SQL["dq_gate"] = (
    "SELECT stage, count(*) AS tests, count(*) FILTER (WHERE failures > 0) AS failing,"
    " stage = 'staging' AND max(failures) > 0 AS blocked"
    f" FROM ({check_counts(_SOURCE_AND_STAGING)} UNION ALL {_STAGING_ASSERTIONS}) AS counted GROUP BY stage"
)
