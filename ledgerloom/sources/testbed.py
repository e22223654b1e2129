"""The bank's source relations derived from the given star-schema tables.

Every relation is a projection of a whole table (with joins for branches and a fan-out for accounts): no
rows are left out, so the work grows with the given data. The same expression text runs in Spark and in
DuckDB; the few differing spellings are filled in from ``SPARK`` or ``DUCKDB``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import RunContext
from ledgerloom.sources.contracts import SPECS
from ledgerloom.sources.dims import DIMS, reference_dim

AS_OF = date(2001, 8, 2)
AS_OF_TS = datetime(2001, 8, 2)
CTX = RunContext(as_of=AS_OF, as_of_ts=AS_OF_TS, invocation_id="testbed")

SPARK = {"ts": "TIMESTAMP_NTZ", "tstype": "timestamp_ntz", "fan": "explode(sequence(0L, c_custkey % 3))"}
DUCKDB = {"ts": "TIMESTAMP", "tstype": "timestamp", "fan": "unnest(range(0, c_custkey % 3 + 1))"}


@dataclass(frozen=True)
class Mapping:
    base: str
    cols: dict[str, str]
    joins: tuple[tuple[str, str], ...] = ()
    fan: bool = False
    derived: dict[str, str] = field(default_factory=dict)


def _case(expr: str, *labels: str, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(labels) if v != default)
    return f"CASE {expr} {whens}" + (f" ELSE '{default}'" if default else "") + " END"


def _cuts(expr: str, cuts: list[tuple[int, str]], default: str) -> str:
    whens = " ".join(f"WHEN {expr} < {hi} THEN '{v}'" for hi, v in cuts)
    return f"CASE {whens} ELSE '{default}' END"


_EPOCH = "{ts} '1995-01-01 00:00:00'"
_TODAY = "DATE '2001-08-02'"
_CUST = "(CASE WHEN o_custkey % 40 = 17 THEN o_custkey - 1 ELSE o_custkey END)"
_HOME_BRANCH = "cast(floor(c_custkey / 15) as bigint)"  # customers are 15 times as many as branches
_T = "o_orderkey"
_CHANNEL_CUTS = [(41, "mobile"), (62, "ATM"), (77, "web"), (92, "pos"), (97, " branch")]
_DAY = "interval '1' day"
_HOUR = "interval '1' hour"

MAPPINGS: dict[str, Mapping] = {
    "branches": Mapping(
        "supplier",
        {
            "branch_id": "s_suppkey",
            "branch_code": "concat('BRN', cast(1000 + s_suppkey as string))",
            "branch_name": "s_name",
            "branch_type": _case("s_suppkey % 4", "main", "Regional", "sub ", "atm_center"),
            "city": "lower(n_name)",
            "province": "lower(r_name)",
            "address": "cast(null as string)",
            "phone": "concat('+62', cast(s_suppkey as string))",
            "is_active": "s_suppkey % 20 <> 7",
            "opened_date": "DATE '1970-01-01' + cast((s_suppkey * 97) % 10000 as int)",
            "created_at": _EPOCH,
            "updated_at": f"{_EPOCH} + {_DAY} * (s_suppkey % 2000)",
            "deleted_at": "CASE WHEN s_suppkey % 25 = 4 THEN {ts} '2000-01-01 00:00:00' END",
        },
        joins=(("nation", "s_nationkey = n_nationkey"), ("region", "n_regionkey = r_regionkey")),
    ),
    "customers": Mapping(
        "customer",
        {
            "customer_id": "c_custkey",
            "customer_uuid": "concat('U', cast(c_custkey as string))",
            "full_name": "c_name",
            "national_id": "cast(1000000000000000 + c_custkey * 7919 as string)",
            "date_of_birth": "DATE '1950-01-01' + cast((c_custkey * 7919) % 18000 as int)",
            "gender": "CASE WHEN c_custkey % 2 = 0 THEN ' m' ELSE 'F ' END",
            "marital_status": _case("(c_custkey * 17) % 5", "Single", "married ", "divorced", "WIDOWED"),
            "occupation": "c_mktsegment",
            "income_range": _case(
                "(c_custkey * 19) % 7", "0-3jt", "3-5jt", "5-10jt", "10-25jt", "25-50jt", ">50jt"
            ),
            "email": "concat(' User', cast(c_custkey as string), '@Example.COM')",
            "phone_primary": "concat('+628', cast(10000000 + c_custkey as string))",
            "phone_secondary": "cast(null as string)",
            "address_street": "concat('Jalan ', cast(c_custkey as string))",
            "address_city": _case("c_nationkey % 4", "kota bogor-barat", "JAKARTA", "o''hare st.", "depok (utara)"),
            "address_province": _case("c_nationkey % 3", "jawa barat", "DKI JAKARTA", "banten/selatan"),
            "address_postal_code": "cast(10000 + c_custkey % 90000 as string)",
            "customer_segment": _cuts(
                "(c_custkey * 31) % 103",
                [(72, "Retail"), (87, "PRIORITY"), (95, "premier"), (97, "private"), (101, "sme")],
                "corporate",
            ),
            "kyc_status": _cuts(
                "(c_custkey * 37) % 107", [(91, "verified"), (99, "pending"), (103, "rejected")], "expired"
            ),
            "kyc_verified_at": f"CASE WHEN (c_custkey * 37) % 107 < 91 THEN {_EPOCH}"
            f" + {_DAY} * (c_custkey % 2000) + {_HOUR} * 5 END",
            "onboarding_branch_id": _HOME_BRANCH,
            "acquisition_channel": _case(
                "(c_custkey * 23) % 7", "branch", "Mobile_App", "web", "agent", "referral", "telemarketing"
            ),
            "risk_rating": _cuts("(c_custkey * 41) % 101", [(80, "low"), (95, "medium"), (99, "high")], "blacklist"),
            "is_politically_exposed": "c_custkey % 97 = 5",
            "created_at": f"{_EPOCH} + {_DAY} * (c_custkey % 2000)",
            "updated_at": f"{_EPOCH} + {_DAY} * (c_custkey % 2000)",
            "deleted_at": "CASE WHEN c_custkey % 50 = 49 THEN {ts} '2001-01-01 00:00:00' END",
        },
    ),
    "accounts": Mapping(
        "customer",
        {
            "account_id": "a",
            "account_number": "concat('8', cast(100000000000 + a as string))",
            "customer_id": "c_custkey",
            "product_type_id": "p",
            "branch_id": _HOME_BRANCH,
            "currency": "'IDR'",
            "balance": "bal",
            "available_balance": "cast(bal * 0.9 as decimal(20,2))",
            "account_status": "st",
            "opened_date": f"{_TODAY} - cast(a % 2000 as int)",
            "closed_date": f"CASE WHEN st = 'closed' THEN {_TODAY} - cast(a % 700 as int) END",
            "last_transaction_at": "cast(null as {tstype})",
            "credit_limit": "CASE WHEN p = 7 THEN cast(25000000 as decimal(20,2)) END",
            "outstanding_balance": "CASE WHEN p >= 5 THEN cast(bal * 0.8 as decimal(20,2)) END",
            "interest_rate": "cast(null as decimal(5,4))",
            "tenor_months": "CASE WHEN p IN (5, 6) THEN 12 + a % 48 END",
            "due_date": "cast(null as date)",
            "dpd": "CASE WHEN p >= 5 THEN (a * 13) % 140 END",
            "created_at": f"{_EPOCH} + {_DAY} * (a % 2000)",
            "updated_at": f"{_EPOCH} + {_DAY} * (a % 2400)",
            "deleted_at": "cast(null as {tstype})",
        },
        fan=True,
        derived={
            "a": "c_custkey * 3 + k",
            "p": "(c_custkey + k) % 7 + 1",
            "bal": "cast(c_acctbal * 1000 as decimal(20,2))",
            "st": _cuts(
                "((c_custkey * 3 + k) * 7919) % 101",
                [(89, "active"), (95, "dormant"), (98, "blocked"), (100, "closed")],
                "pending",
            ),
        },
    ),
    "transactions": Mapping(
        "orders",
        {
            "transaction_id": _T,
            "transaction_uuid": f"concat('T', cast({_T} as string))",
            "account_id": f"{_CUST} * 3 + {_T} % ({_CUST} % 3 + 1)",
            "customer_id": _CUST,
            "merchant_id": f"CASE WHEN {_T} % 15 + 1 IN (1, 2, 10) THEN {_T} % 10 END",
            "type_id": f"{_T} % 15 + 1",
            "method_id": f"cast(CASE WHEN ({_T} * 31) % 103 < 41 THEN 7 WHEN ({_T} * 31) % 103 < 62 THEN 1"
            f" WHEN ({_T} * 31) % 103 < 77 THEN 8 WHEN ({_T} * 31) % 103 < 92 THEN 1"
            f" WHEN ({_T} * 31) % 103 < 97 THEN 6 END as bigint)",
            "amount": "cast(o_totalprice * 120 as decimal(20,2))",
            "currency": "'IDR'",
            "exchange_rate": "cast(1 as decimal(15,6))",
            "amount_idr": "cast(o_totalprice * 120 as decimal(20,2))",
            "fee_amount": f"cast(CASE {_T} % 15 + 1 WHEN 4 THEN 6500 WHEN 5 THEN 6500 WHEN 3 THEN 7500 ELSE 0 END"
            " as decimal(20,2))",
            "balance_before": "cast(null as decimal(20,2))",
            "balance_after": "cast(null as decimal(20,2))",
            "description": "o_orderpriority",
            "reference_number": f"concat('REF', cast({_T} as string))",
            "channel": _cuts(f"({_T} * 31) % 103", _CHANNEL_CUTS, "qris"),
            "transaction_status": _cuts(
                f"({_T} * 7919) % 101", [(96, "completed"), (99, "Failed "), (100, "pending")], "reversed"
            ),
            "status_reason": "cast(null as string)",
            "transaction_date": "cast(o_orderdate as date)",
            "transaction_at": f"o_orderdate + {_HOUR} * (({_T} * 7) % 24)",
            "processed_at": "cast(null as {tstype})",
            "created_at": f"o_orderdate + {_HOUR} * (({_T} * 7) % 24)",
            "updated_at": f"o_orderdate + {_HOUR} * (({_T} * 7) % 24)",
        },
    ),
    # Flags sit on even transaction ids; those beyond the last transaction have none (inner joins drop them).
    "fraud_flags": Mapping(
        "events",
        {
            "flag_id": "event_id",
            "transaction_id": "event_id * 2",
            "customer_id": "user_id",
            "flag_type": _case(
                "(event_id * 3) % 5",
                "velocity",
                "geo_anomaly",
                "amount_anomaly",
                "device_fingerprint",
                "blacklist_merchant",
            ),
            "severity": _cuts("(event_id * 41) % 101", [(41, "low"), (76, "Medium"), (94, "high")], "critical"),
            "confidence_score": "cast((5000 + (event_id * 37) % 4901) / 10000.0 as decimal(5,4))",
            "model_version": "'v1.0'",
            "is_confirmed_fraud": "CASE WHEN (event_id * 43) % 107 < 75 THEN cast(null as boolean)"
            " WHEN (event_id * 43) % 107 < 96 THEN true ELSE false END",
            "reviewed_by": "CASE WHEN (event_id * 43) % 107 >= 70 THEN concat('analyst', cast(event_id % 9 as string)) END",
            "reviewed_at": f"CASE WHEN (event_id * 43) % 107 >= 70 THEN ts - {_DAY} * 8217"
            f" + {_HOUR} * (1 + (event_id * 11) % 72) END",
            "notes": "cast(null as string)",
            "created_at": f"ts - {_DAY} * 8217",
            "updated_at": f"ts - {_DAY} * 8217",
        },
    ),
    "credit_scores": Mapping(
        "orders",
        {
            "score_id": _T,
            "customer_id": "o_custkey",
            "score_value": f"300 + ({_T} * 37) % 551",
            "score_band": _cuts(
                f"(300 + ({_T} * 37) % 551)", [(580, "Poor"), (670, "fair"), (740, "good"), (800, "very_good")], "exceptional"
            ),
            "score_date": "cast(o_orderdate as date)",
            "model_version": "'v2.0'",
            "data_source": "'internal'",
            "created_at": "o_orderdate",
            "updated_at": "o_orderdate",
        },
    ),
    "loan_applications": Mapping(
        "orders",
        {
            "application_id": _T,
            "application_number": f"concat('LA', cast({_T} as string))",
            "customer_id": "o_custkey",
            "branch_id": "cast(floor(o_custkey / 15) as bigint)",
            "handled_by": f"CASE WHEN {_T} % 4 <> 0 THEN {_T} % 200 END",
            "product_type_id": f"{_T} % 2 + 5",
            "requested_amount": f"CASE WHEN {_T} % 50 = 7 THEN cast(0 as decimal(20,2))"
            " ELSE cast(o_totalprice * 1000 as decimal(20,2)) END",
            "approved_amount": f"CASE WHEN ({_T} * 29) % 103 >= 18 AND ({_T} * 29) % 103 < 75"
            " THEN cast(cast(o_totalprice * 1000 as decimal(20,2)) * 0.85 as decimal(20,2)) END",
            "tenor_months": f"12 + {_T} % 48",
            "interest_rate": "cast(0.0975 as decimal(5,4))",
            "purpose": "o_orderpriority",
            "collateral_type": _case(f"({_T} * 17) % 6", "none", "Property", "vehicle", "deposit", "guarantee"),
            "collateral_value": "cast(null as decimal(20,2))",
            "application_status": _cuts(
                f"({_T} * 29) % 103",
                [
                    (8, "submitted"),
                    (18, "under_review"),
                    (54, "approved"),
                    (75, "disbursed"),
                    (96, "rejected"),
                    (100, "Cancelled"),
                ],
                "withdrawn",
            ),
            "submitted_at": "o_orderdate",
            "reviewed_at": "cast(null as {tstype})",
            "decided_at": f"CASE WHEN ({_T} * 29) % 103 >= 18 AND ({_T} * 29) % 103 < 96"
            f" THEN o_orderdate + {_DAY} * (2 + {_T} % 11) END",
            "disbursed_at": "cast(null as {tstype})",
            "rejection_reason": "cast(null as string)",
            "created_at": "o_orderdate",
            "updated_at": "o_orderdate",
            "deleted_at": f"CASE WHEN {_T} % 60 = 59 THEN {{ts}} '2001-01-01 00:00:00' END",
        },
    ),
    "merchants": Mapping(
        "supplier",
        {
            "merchant_id": "s_suppkey",
            "merchant_uuid": "concat('M', cast(s_suppkey as string))",
            "merchant_name": "s_name",
            "merchant_legal_name": "concat('PT ', s_name)",
            "mcc_code": _case("s_suppkey % 4", "5411", "7995", "6051", "9999"),
            "city": _case("s_nationkey % 3", "kota tua", "SURABAYA", "nusa dua-bali"),
            "province": _case("s_nationkey % 2", "jawa timur", "BALI"),
            "country": "'ID'",
            "is_online": "s_suppkey % 4 = 1",
            "risk_level": "CASE WHEN s_suppkey % 10 < 8 THEN 'normal' WHEN s_suppkey % 10 = 8 THEN 'Elevated' ELSE 'high' END",
            "is_active": "s_suppkey % 11 <> 3",
            "created_at": _EPOCH,
            "updated_at": f"{_EPOCH} + {_DAY} * (s_suppkey % 2000)",
            "deleted_at": "CASE WHEN s_suppkey % 10 = 6 THEN {ts} '2001-01-01 00:00:00' END",
        },
    ),
    "employees": Mapping(
        "part",
        {
            "employee_id": "p_partkey",
            "employee_code": "concat('EMP', cast(10000 + p_partkey as string))",
            "full_name": "p_name",
            "email": "concat(upper(p_brand), '.', cast(p_partkey as string), ' ')",
            "role": _case(
                "p_size % 7",
                "Teller",
                "cs",
                "relationship_manager",
                "branch_manager",
                "back_office",
                "analyst",
                "it",
            ),
            "branch_id": "cast(floor(p_partkey / 20) as bigint)",
            "hire_date": f"{_TODAY} - cast(p_size * 100 as int)",
            "is_active": "p_partkey % 12 <> 5",
            "created_at": _EPOCH,
            "updated_at": f"{_EPOCH} + {_DAY} * (p_partkey % 2000)",
            "deleted_at": "CASE WHEN p_partkey % 30 = 29 THEN {ts} '2001-01-01 00:00:00' END",
        },
    ),
    # A stream of customer versions: many per key, one third of a scale test may sit on one key.
    "change_feed": Mapping(
        "events",
        {
            "customer_id": "user_id",
            "customer_segment": "CASE event_type WHEN 'signup' THEN 'retail' WHEN 'click' THEN 'priority'"
            " WHEN 'view' THEN 'premier' WHEN 'purchase' THEN 'private' ELSE 'sme' END",
            "balance": "value",
            "updated_at": "ts",
            "seq": "event_id",
        },
    ),
}


def spark_relation(table: Callable[[str], DataFrame], name: str) -> DataFrame:
    m = MAPPINGS[name]
    df = table(m.base)
    for other, on in m.joins:
        df = df.join(table(other), F.expr(on))
    if m.fan:
        df = df.selectExpr("*", f"{SPARK['fan']} AS k")
    if m.derived:
        df = df.selectExpr("*", *[f"{e} AS {c}" for c, e in m.derived.items()])
    return df.selectExpr(*[f"{e.format(**SPARK)} AS {c}" for c, e in m.cols.items()])


def duckdb_relation(name: str) -> str:
    """The same relation as a DuckDB SELECT."""
    if name in DIMS:
        ddl, rows = DIMS[name]
        names = [p.split()[0] for p in ddl.split(",")]
        types = [p.split()[1] for p in ddl.split(",")]
        values = ", ".join("(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in r) + ")" for r in rows)
        types = ["DECIMAL(5,4)" if n == "interest_rate" else t for n, t in zip(names, types)]
        casts = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in zip(names, types))
        return f"SELECT {casts} FROM (VALUES {values}) AS v({', '.join(names)})"
    m = MAPPINGS[name]
    source = " ".join([m.base, *[f"JOIN {other} ON {on}" for other, on in m.joins]])
    if m.fan:
        source = f"(SELECT *, {DUCKDB['fan']} AS k FROM {source})"
    if m.derived:
        source = f"(SELECT *, {', '.join(f'{e} AS {c}' for c, e in m.derived.items())} FROM {source})"
    cols = ", ".join(f"{e.format(**DUCKDB)} AS {c}" for c, e in m.cols.items())
    return f"SELECT {cols} FROM {source}"


def dim_source(spark: SparkSession, name: str) -> DataFrame:
    """A literal dimension with the rest of its declared columns: active, loaded at the epoch."""
    extra = {"is_active": F.lit(True), "created_at": None, "updated_at": None}
    dim = reference_dim(spark, name)
    epoch = F.lit("1995-01-01 00:00:00").cast("timestamp_ntz")
    for c in SPECS[name].columns:
        if c not in dim.columns:
            dim = dim.withColumn(c, extra[c] if extra[c] is not None else epoch)
    return dim.select(*SPECS[name].columns)


def sources(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    @lru_cache(maxsize=None)
    def table(base: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{base}.parquet")

    derived = {n: (lambda n=n: spark_relation(table, n)) for n in MAPPINGS}
    literal = {n: (lambda n=n: dim_source(spark, n)) for n in DIMS}
    return derived | literal
