"""Data-quality checks: each is a relation of violating rows, and a whole suite is a few aggregates.

All row-level checks of a relation share one aggregate, and all uniqueness checks share one shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.catalog import Catalog
from ledgerloom.config import Thresholds

NOT_NULL, UNIQUE, ACCEPTED, RELATIONSHIP, RANGE = (
    "not_null",
    "unique",
    "accepted_values",
    "relationships",
    "accepted_range",
)
REPORT_DDL = "stage STRING, model STRING, column_name STRING, test STRING"


@dataclass(frozen=True)
class Check:
    stage: str
    model: str
    column: str
    kind: str
    values: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None
    low: str | None = None
    high: str | None = None
    inclusive: bool = True

    @property
    def row_level(self) -> bool:
        return self.kind in (NOT_NULL, ACCEPTED, RANGE)

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model}_{self.column}"

    def broken(self) -> Column:
        """True for a violating row. Nulls pass everything but not_null."""
        c = F.col(self.column)
        if self.kind == NOT_NULL:
            return c.isNull()
        if self.kind == ACCEPTED:
            return ~c.isin(*self.values)
        if self.kind == RANGE:
            sides = []
            if self.low is not None:
                low = F.lit(self.low).cast("decimal(20,4)")
                sides.append(c < low if self.inclusive else c <= low)
            if self.high is not None:
                high = F.lit(self.high).cast("decimal(20,4)")
                sides.append(c > high if self.inclusive else c >= high)
            return reduce(lambda a, b: a | b, sides)
        raise ValueError(f"{self.kind} is not decided row by row")


def violations(cat: Catalog, check: Check) -> DataFrame:
    """The rows that break a check; for uniqueness the duplicated values with their counts."""
    df = cat.relation(check.model)
    if check.row_level:
        return df.where(check.broken())
    c = F.col(check.column)
    if check.kind == UNIQUE:
        counted = df.where(c.isNotNull()).groupBy(check.column).agg(F.count("*").alias("n_records"))
        return counted.where("n_records > 1")
    parent, parent_column = check.parent
    known = cat.relation(parent).select(F.col(parent_column).alias(check.column))
    return df.where(c.isNotNull()).join(known, check.column, "left_anti")


def broken_rows(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(row..., check_name): each violating row once for every row-level check that it breaks, in one scan."""
    names = F.array_compact(F.array(*[F.when(c.broken(), F.lit(c.name)) for c in checks]))
    return df.withColumn("check_name", F.explode(names))


def _labels(check: Check) -> list[Column]:
    return [F.lit(v) for v in (check.stage, check.model, check.column, check.kind)]


def _entry(check: Check, failures: Column) -> Column:
    names = ("stage", "model", "column_name", "test")
    tagged = [c.alias(n) for c, n in zip(_labels(check), names, strict=True)]
    return F.struct(*tagged, failures.cast("bigint").alias("failures"))


def _row_level(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    slots = {f"_c{i}": check for i, check in enumerate(checks)}
    counted = df.agg(*[F.count_if(check.broken()).alias(slot) for slot, check in slots.items()])
    entries = F.array(*[_entry(check, F.col(slot)) for slot, check in slots.items()])
    return counted.select(F.inline(entries))


class Watch:
    """Row-level checks of a relation, counted while it is written: they cost no scan of their own."""

    def __init__(self, checks: Iterable[Check]) -> None:
        self.checks = [c for c in checks if c.row_level]
        self._seen = Observation()

    def __call__(self, df: DataFrame) -> DataFrame:
        if not self.checks:
            return df
        return df.observe(self._seen, *[F.count_if(c.broken()).alias(f"_c{i}") for i, c in enumerate(self.checks)])

    def counts(self) -> dict[Check, int]:
        """Failures of each check, once the write is over."""
        seen = self._seen.get if self.checks else {}
        return {c: seen[f"_c{i}"] or 0 for i, c in enumerate(self.checks)}


def _unique(cat: Catalog, checks: Sequence[Check]) -> DataFrame:
    """Duplicated values of any number of columns and relations, in one shuffle.

    Every value travels with the number of its check, whole numbers as such and all else as text; equal
    pairs are counted on the map side first.
    """
    numbered = list(enumerate(checks))
    parts = []
    for model, group in groupby(numbered, key=lambda x: x[1].model):
        df = cat.relation(model)
        pairs = []
        for i, check in group:
            whole = isinstance(df.schema[check.column].dataType, T.IntegralType)
            number, text = (F.col(check.column), None) if whole else (None, F.col(check.column))
            pairs.append(
                F.struct(
                    F.lit(i).alias("i"),
                    (F.lit(None) if number is None else number).cast("bigint").alias("n_value"),
                    (F.lit(None) if text is None else text).cast("string").alias("t_value"),
                )
            )
        parts.append(df.select(F.inline(F.array(*pairs))))
    repeated = (
        reduce(DataFrame.unionByName, parts)
        .where(F.col("n_value").isNotNull() | F.col("t_value").isNotNull())
        .groupBy("i", "n_value", "t_value")
        .agg(F.count("*").alias("n"))
        .groupBy("i")
        .agg(F.count_if(F.col("n") > 1).alias("f"))
    )
    by_number = F.element_at(F.array(*[_entry(c, F.col("f")) for c in checks]), F.col("i") + 1)
    return repeated.select(by_number.alias("e")).select("e.*")


def _relationship(cat: Catalog, check: Check) -> DataFrame:
    """Child rows without a parent; children are counted per key first, so a hot key is one row."""
    parent, parent_column = check.parent
    children = (
        cat.relation(check.model)
        .where(F.col(check.column).isNotNull())
        .groupBy(F.col(check.column).alias("_key"))
        .agg(F.count("*").alias("_n"))
    )
    known = cat.relation(parent).select(F.col(parent_column).alias("_key"))
    lost = children.join(known, "_key", "left_anti").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_n"))
    return lost.select(F.inline(F.array(_entry(check, F.col("_n")))))


def failure_counts(
    spark: SparkSession, cat: Catalog, checks: Iterable[Check], known: Mapping[Check, int] | None = None
) -> DataFrame:
    """One row per check: stage, model, column_name, test, failures. ``known``: failures counted before."""
    checks, known = sorted(checks, key=lambda c: (c.stage, c.model)), known or {}
    parts = [_zeros(spark, checks, known)]
    checks = [c for c in checks if c not in known]
    for (_, model), group in groupby(checks, key=lambda c: (c.stage, c.model)):
        group = list(group)
        by_row = [c for c in group if c.row_level]
        if by_row:
            parts.append(_row_level(cat.relation(model), by_row))
        parts += [_relationship(cat, c) for c in group if c.kind == RELATIONSHIP]
    unique = [c for c in checks if c.kind == UNIQUE]
    if unique:
        parts.append(_unique(cat, unique))
    counted = reduce(DataFrame.unionByName, parts)
    return counted.groupBy("stage", "model", "column_name", "test").agg(F.sum("failures").alias("failures"))


def _zeros(spark: SparkSession, checks: Sequence[Check], known: Mapping[Check, int]) -> DataFrame:
    """Every check with what is known of it or zero failures, so that one over an empty relation still reports."""
    rows = ", ".join(f"('{c.stage}', '{c.model}', '{c.column}', '{c.kind}', {known.get(c, 0)}L)" for c in checks)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS z(stage, model, column_name, test, failures)")


def with_status(counts: DataFrame) -> DataFrame:
    return counts.withColumn("status", F.when(F.col("failures") > 0, "fail").otherwise("pass"))


def no_negative_balance(cat: Catalog) -> DataFrame:
    return (
        cat.ref("stg_accounts")
        .where((F.col("balance") < 0) & (F.col("account_status") == "active"))
        .select("account_id", "account_number", "balance", "account_status")
    )


def customer_360_complete(cat: Catalog) -> DataFrame:
    """Customers of the mart that staging does not know."""
    staged = cat.ref("stg_customers").select("customer_id")
    return cat.ref("mart_customer_360").select("customer_id").join(staged, "customer_id", "left_anti")


def fraud_rate_out_of_bounds(cat: Catalog, limit: float = 0.20, least: int = 100) -> DataFrame:
    """One row when too many reviewed flags are confirmed, none otherwise or when the sample is small."""
    confirmed, total = F.col("confirmed_count"), F.col("total_flagged")
    return (
        cat.ref("stg_fraud_flags")
        .where("is_reviewed")
        .agg(
            F.count_if(F.col("is_confirmed_fraud")).alias("confirmed_count"),
            F.count("*").alias("total_flagged"),
        )
        .where((F.try_divide(confirmed, total) > limit) & (total > least))
    )


SINGULAR = {
    "assert_no_negative_balance": ("staging", "stg_accounts", no_negative_balance),
    "assert_customer_360_completeness": ("marts", "mart_customer_360", customer_360_complete),
    "assert_fraud_rate_within_bounds": ("staging", "stg_fraud_flags", fraud_rate_out_of_bounds),
}


def singular_counts(cat: Catalog, stages: Sequence[str] = ("staging", "marts")) -> list[DataFrame]:
    return [
        check(cat)
        .agg(F.count("*").alias("failures"))
        .select(
            F.lit(stage).alias("stage"),
            F.lit(model).alias("model"),
            F.lit("*").alias("column_name"),
            F.lit(name).alias("test"),
            "failures",
        )
        for name, (stage, model, check) in SINGULAR.items()
        if stage in stages
    ]


def quality_report(
    spark: SparkSession, cat: Catalog, checks: Iterable[Check], known: Mapping[Check, int] | None = None
) -> DataFrame:
    """Every declared check and every assertion of their stages, with failures and status."""
    checks = list(checks)
    stages = sorted({c.stage for c in checks})
    parts = [failure_counts(spark, cat, checks, known), *singular_counts(cat, stages)]
    return with_status(reduce(DataFrame.unionByName, parts))


def gate(report: DataFrame, blocking: Sequence[str] = ("staging",)) -> DataFrame:
    """One row per stage: how many checks fail, and whether later steps must wait."""
    failing = F.count_if(F.col("status") == "fail")
    return report.groupBy("stage").agg(
        F.count("*").alias("tests"),
        failing.alias("failing"),
        (F.col("stage").isin(*blocking) & (failing > 0)).alias("blocked"),
    )


def rate_thresholds(df: DataFrame, model: str, columns: Sequence[str], key: str, limits: Thresholds) -> DataFrame:
    """Null rate of each column and duplicate rate of the key, in percent, against the declared limits."""
    counted = df.groupBy(key).agg(
        F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in columns if c != key]
    )
    key_nulls = F.sum(F.when(F.col(key).isNull(), F.col("_n")).otherwise(0))
    dups = F.sum(F.when(F.col(key).isNotNull(), F.col("_n") - 1).otherwise(0))
    totals = counted.agg(
        F.sum("_n").alias("_rows"),
        dups.alias("_dups"),
        *[(key_nulls if c == key else F.sum(f"_{c}")).alias(f"n_{c}") for c in columns],
    )

    def entry(column: str, metric: str, n: Column, limit: float) -> Column:
        rate = F.try_divide(n * 100.0, F.col("_rows"))
        return F.struct(
            F.lit(model).alias("model"),
            F.lit(column).alias("column_name"),
            F.lit(metric).alias("metric"),
            rate.alias("rate_pct"),
            (rate > limit).alias("exceeded"),
        )

    entries = [entry(c, "null_rate", F.col(f"n_{c}"), limits.max_null_rate_pct) for c in columns]
    entries.append(entry(key, "duplicate_rate", F.col("_dups"), limits.max_duplicate_rate_pct))
    return totals.select(F.inline(F.array(*entries)))
