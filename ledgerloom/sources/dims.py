"""The bank's literal reference rows, and the join that brings a dimension to a fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Reference rows as seeded in the source systems; ids count from 1 in this order.
TRANSACTION_TYPES = (
    ("DEBIT_PURCHASE", "Debit Purchase", "debit"),
    ("CREDIT_PURCHASE", "Credit Card Purchase", "debit"),
    ("ATM_WITHDRAWAL", "ATM Cash Withdrawal", "debit"),
    ("TRANSFER_OUT", "Transfer Out", "debit"),
    ("TRANSFER_IN", "Transfer Incoming", "credit"),
    ("SALARY_CREDIT", "Salary Credit", "credit"),
    ("LOAN_DISBURSEMENT", "Loan Disbursement", "credit"),
    ("LOAN_PAYMENT", "Loan Monthly Payment", "debit"),
    ("BILL_PAYMENT", "Bill Payment", "debit"),
    ("QRIS_PAYMENT", "QRIS Digital Payment", "debit"),
    ("FEE_ADMIN", "Administration Fee", "fee"),
    ("FEE_TRANSFER", "Transfer Fee", "fee"),
    ("REVERSAL", "Transaction Reversal", "reversal"),
    ("INTEREST_INCOME", "Interest Income", "credit"),
    ("INTEREST_EXPENSE", "Interest Expense", "debit"),
)
PAYMENT_METHODS = (
    ("DEBIT_CARD", "Debit Card"),
    ("CREDIT_CARD", "Credit Card"),
    ("BANK_TRANSFER", "Bank Transfer"),
    ("QRIS", "QRIS"),
    ("VIRTUAL_ACC", "Virtual Account"),
    ("CASH", "Cash"),
    ("MOBILE_BANKING", "Mobile Banking"),
    ("INTERNET_BANKING", "Internet Banking"),
)
MERCHANT_CATEGORIES = (
    ("5411", "Grocery Stores & Supermarkets", False),
    ("5812", "Eating Places & Restaurants", False),
    ("5541", "Service Stations & Fuel", False),
    ("5912", "Drug Stores & Pharmacies", False),
    ("5732", "Electronics Stores", False),
    ("5311", "Department Stores", False),
    ("7011", "Hotels & Lodging", False),
    ("4511", "Airlines & Air Carriers", False),
    ("7995", "Gambling & Betting", True),
    ("6051", "Crypto & Currency Exchange", True),
    ("5999", "Misc Retail Stores", False),
    ("7372", "Computer Services & Software", False),
    ("8099", "Health Services", False),
    ("5661", "Shoe Stores", False),
    ("5691", "Clothing & Apparel", False),
)
PRODUCT_TYPES = (
    ("SAV001", "Tabungan Regular", "savings", "0.0250"),
    ("SAV002", "Tabungan Premium", "savings", "0.0350"),
    ("CHK001", "Giro Bisnis", "checking", "0.0000"),
    ("DEP001", "Deposito 3 Bulan", "deposit", "0.0550"),
    ("LON001", "KPR Properti", "loan", "0.0975"),
    ("LON002", "KTA Multiguna", "loan", "0.1200"),
    ("CC001", "Kartu Kredit Silver", "credit_card", "0.0200"),
)

# name -> (column list, rows)
DIMS = {
    "transaction_types": (
        "type_id BIGINT, type_code STRING, type_name STRING, type_category STRING",
        [(i, *row) for i, row in enumerate(TRANSACTION_TYPES, 1)],
    ),
    "payment_methods": (
        "method_id BIGINT, method_code STRING, method_name STRING",
        [(i, *row) for i, row in enumerate(PAYMENT_METHODS, 1)],
    ),
    "merchant_categories": (
        "mcc_code STRING, category_name STRING, is_high_risk BOOLEAN",
        list(MERCHANT_CATEGORIES),
    ),
    "product_types": (
        "product_type_id BIGINT, product_code STRING, product_name STRING, product_category STRING,"
        " interest_rate STRING",
        [(i, *row) for i, row in enumerate(PRODUCT_TYPES, 1)],
    ),
}


def reference_dim(spark: SparkSession, name: str) -> DataFrame:
    """The literal rows of one dimension. A local relation of at most 15 rows: Catalyst knows its size."""
    ddl, rows = DIMS[name]
    columns = [part.split()[0] for part in ddl.split(",")]
    literals = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    dim = spark.sql(f"SELECT * FROM VALUES {literals} AS dim({', '.join(columns)})")
    if name == "product_types":
        dim = dim.withColumn("interest_rate", F.col("interest_rate").cast("decimal(5,4)"))
    first = dim.columns[0]
    return dim if name == "merchant_categories" else dim.withColumn(first, F.col(first).cast("bigint"))


def join_dim(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join that keeps every fact row.

    No broadcast hint: the optimizer broadcasts a dimension whose size it knows to be under
    ``spark.sql.autoBroadcastJoinThreshold`` (always so for the literal rows above) and otherwise
    shuffles, where adaptive execution splits a skewed key.
    """
    return fact.join(dim, key, "left")


def _sql_literal(v) -> str:
    if isinstance(v, bool):
        return str(v).lower()
    return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
