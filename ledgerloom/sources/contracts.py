"""Declared contracts of the thirteen source tables: schema, merge key, clustering, freshness."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableSpec:
    """What a source table must look like and how it is kept up to date."""

    system: str
    name: str
    key: str
    ddl: str
    cluster_by: tuple[str, ...] = ()
    granularity: str = "MONTH"
    loaded_at: str = "updated_at"
    # Comma or newline separated column list; all declared columns when empty.
    columns_text: str = ""
    owner: str = "data-engineering"
    warn_after: timedelta = timedelta(hours=25)
    error_after: timedelta = timedelta(hours=49)

    @property
    def schema(self) -> StructType:
        """The declared columns. Read without a Spark session, unlike ``StructType.fromDDL``."""
        out = StructType()
        for part in re.split(r",(?![^(]*\))", self.ddl):
            name, kind, *rest = part.split()
            kind = kind.lower()
            out = out.add(name, "long" if kind == "bigint" else kind, nullable=not rest)
        return out

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]

    @property
    def columns(self) -> list[str]:
        """The columns to load, in list order. A name outside the schema fails here, before any data work."""
        known = self.schema.fieldNames()
        if not self.columns_text.strip():
            return known
        wanted = [c.strip() for c in self.columns_text.replace("\n", ",").split(",") if c.strip()]
        unknown = [c for c in wanted if c not in known]
        if unknown:
            raise ValueError(f"[{self.name}] columns not in the declared schema: {', '.join(unknown)}")
        return wanted


CORE = "core_banking"
TRANSACTIONS = "transactions"

_AUDIT = "created_at TIMESTAMP_NTZ NOT NULL, updated_at TIMESTAMP_NTZ NOT NULL"
_AUDIT_DEL = f"{_AUDIT}, deleted_at TIMESTAMP_NTZ"

# The source schemas. Source timestamps hold the bank's wall time.
_ALL = (
    TableSpec(
        CORE,
        "branches",
        "branch_id",
        f"""branch_id BIGINT NOT NULL, branch_code STRING NOT NULL, branch_name STRING NOT NULL,
        branch_type STRING NOT NULL, city STRING NOT NULL, province STRING NOT NULL, address STRING,
        phone STRING, is_active BOOLEAN NOT NULL, opened_date DATE, {_AUDIT_DEL}""",
        ("province", "branch_type", "is_active"),
        granularity="DAY",
    ),
    TableSpec(
        CORE,
        "product_types",
        "product_type_id",
        f"""product_type_id BIGINT NOT NULL, product_code STRING NOT NULL, product_name STRING NOT NULL,
        product_category STRING NOT NULL, interest_rate DECIMAL(5,4), is_active BOOLEAN NOT NULL, {_AUDIT}""",
        ("product_category", "is_active"),
    ),
    TableSpec(
        CORE,
        "customers",
        "customer_id",
        f"""customer_id BIGINT NOT NULL, customer_uuid STRING NOT NULL, full_name STRING NOT NULL,
        national_id STRING NOT NULL, date_of_birth DATE NOT NULL, gender STRING NOT NULL,
        marital_status STRING, occupation STRING, income_range STRING, email STRING, phone_primary STRING,
        phone_secondary STRING, address_street STRING, address_city STRING, address_province STRING,
        address_postal_code STRING, customer_segment STRING NOT NULL, kyc_status STRING NOT NULL,
        kyc_verified_at TIMESTAMP_NTZ, onboarding_branch_id BIGINT, acquisition_channel STRING,
        risk_rating STRING, is_politically_exposed BOOLEAN NOT NULL, {_AUDIT_DEL}""",
        ("address_city", "customer_segment", "kyc_status"),
    ),
    TableSpec(
        CORE,
        "employees",
        "employee_id",
        f"""employee_id BIGINT NOT NULL, employee_code STRING NOT NULL, full_name STRING NOT NULL,
        email STRING NOT NULL, role STRING NOT NULL, branch_id BIGINT, hire_date DATE NOT NULL,
        is_active BOOLEAN NOT NULL, {_AUDIT_DEL}""",
        ("role", "is_active", "branch_id"),
    ),
    TableSpec(
        CORE,
        "accounts",
        "account_id",
        f"""account_id BIGINT NOT NULL, account_number STRING NOT NULL, customer_id BIGINT NOT NULL,
        product_type_id BIGINT NOT NULL, branch_id BIGINT NOT NULL, currency STRING NOT NULL,
        balance DECIMAL(20,2) NOT NULL, available_balance DECIMAL(20,2) NOT NULL,
        account_status STRING NOT NULL, opened_date DATE NOT NULL, closed_date DATE,
        last_transaction_at TIMESTAMP_NTZ, credit_limit DECIMAL(20,2), outstanding_balance DECIMAL(20,2),
        interest_rate DECIMAL(5,4), tenor_months BIGINT, due_date DATE, dpd BIGINT, {_AUDIT_DEL}""",
        ("account_status", "product_type_id", "currency", "branch_id"),
    ),
    TableSpec(
        CORE,
        "credit_scores",
        "score_id",
        f"""score_id BIGINT NOT NULL, customer_id BIGINT NOT NULL, score_value BIGINT NOT NULL,
        score_band STRING NOT NULL, score_date DATE NOT NULL, model_version STRING NOT NULL,
        data_source STRING NOT NULL, {_AUDIT}""",
        ("score_band", "model_version", "data_source"),
    ),
    TableSpec(
        CORE,
        "loan_applications",
        "application_id",
        f"""application_id BIGINT NOT NULL, application_number STRING NOT NULL, customer_id BIGINT NOT NULL,
        branch_id BIGINT NOT NULL, handled_by BIGINT, product_type_id BIGINT NOT NULL,
        requested_amount DECIMAL(20,2) NOT NULL, approved_amount DECIMAL(20,2), tenor_months BIGINT NOT NULL,
        interest_rate DECIMAL(5,4), purpose STRING, collateral_type STRING, collateral_value DECIMAL(20,2),
        application_status STRING NOT NULL, submitted_at TIMESTAMP_NTZ NOT NULL, reviewed_at TIMESTAMP_NTZ,
        decided_at TIMESTAMP_NTZ, disbursed_at TIMESTAMP_NTZ, rejection_reason STRING, {_AUDIT_DEL}""",
        ("application_status", "product_type_id", "branch_id"),
    ),
    TableSpec(
        TRANSACTIONS,
        "transaction_types",
        "type_id",
        f"""type_id BIGINT NOT NULL, type_code STRING NOT NULL, type_name STRING NOT NULL,
        type_category STRING NOT NULL, is_active BOOLEAN NOT NULL, {_AUDIT}""",
    ),
    TableSpec(
        TRANSACTIONS,
        "payment_methods",
        "method_id",
        f"""method_id BIGINT NOT NULL, method_code STRING NOT NULL, method_name STRING NOT NULL,
        is_active BOOLEAN NOT NULL, {_AUDIT}""",
    ),
    TableSpec(
        TRANSACTIONS,
        "merchant_categories",
        "mcc_code",
        """mcc_code STRING NOT NULL, category_name STRING NOT NULL, is_high_risk BOOLEAN NOT NULL,
        created_at TIMESTAMP_NTZ NOT NULL""",
        loaded_at="created_at",
    ),
    TableSpec(
        TRANSACTIONS,
        "merchants",
        "merchant_id",
        f"""merchant_id BIGINT NOT NULL, merchant_uuid STRING NOT NULL, merchant_name STRING NOT NULL,
        merchant_legal_name STRING, mcc_code STRING, city STRING, province STRING, country STRING NOT NULL,
        is_online BOOLEAN NOT NULL, risk_level STRING NOT NULL, is_active BOOLEAN NOT NULL, {_AUDIT_DEL}""",
        ("risk_level", "mcc_code"),
    ),
    TableSpec(
        TRANSACTIONS,
        "transactions",
        "transaction_id",
        f"""transaction_id BIGINT NOT NULL, transaction_uuid STRING NOT NULL, account_id BIGINT NOT NULL,
        customer_id BIGINT NOT NULL, merchant_id BIGINT, type_id BIGINT NOT NULL, method_id BIGINT,
        amount DECIMAL(20,2) NOT NULL, currency STRING NOT NULL, exchange_rate DECIMAL(15,6) NOT NULL,
        amount_idr DECIMAL(20,2) NOT NULL, fee_amount DECIMAL(20,2) NOT NULL, balance_before DECIMAL(20,2),
        balance_after DECIMAL(20,2), description STRING, reference_number STRING, channel STRING,
        transaction_status STRING NOT NULL, status_reason STRING, transaction_date DATE NOT NULL,
        transaction_at TIMESTAMP_NTZ NOT NULL, processed_at TIMESTAMP_NTZ, {_AUDIT}""",
        ("channel", "transaction_status"),
    ),
    TableSpec(
        TRANSACTIONS,
        "fraud_flags",
        "flag_id",
        f"""flag_id BIGINT NOT NULL, transaction_id BIGINT NOT NULL, customer_id BIGINT NOT NULL,
        flag_type STRING NOT NULL, severity STRING NOT NULL, confidence_score DECIMAL(5,4) NOT NULL,
        model_version STRING NOT NULL, is_confirmed_fraud BOOLEAN, reviewed_by STRING,
        reviewed_at TIMESTAMP_NTZ, notes STRING, {_AUDIT}""",
        ("severity", "flag_type"),
    ),
)

SPECS: dict[str, TableSpec] = {s.name: s for s in _ALL}

# The tables the multi-table ingestion run loads by default.
INGESTED = (
    "customers",
    "branches",
    "product_types",
    "employees",
    "accounts",
    "credit_scores",
    "loan_applications",
)
