"""Extract-side operators: projection with casts, time windows, freshness, schema evolution."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from ledgerloom.config import BUSINESS_ZONE
from ledgerloom.functions import ts_lit
from ledgerloom.sources.contracts import TableSpec


class SchemaConflict(ValueError):
    """A column arrives with a type the target cannot take."""


@dataclass(frozen=True)
class Window:
    """Half-open interval of business time, ``start <= updated_at < end``."""

    start: datetime
    end: datetime

    @classmethod
    def of_schedule(
        cls,
        interval_start: datetime,
        interval_end: datetime,
        window_start: datetime | str | None = None,
        window_end: datetime | str | None = None,
    ) -> Window:
        """A scheduled interval in business time; naive times are UTC. An explicit bound is already business
        time and wins."""

        def bound(override, scheduled: datetime) -> datetime:
            if override:
                return datetime.fromisoformat(override) if isinstance(override, str) else override
            aware = scheduled if scheduled.tzinfo else scheduled.replace(tzinfo=ZoneInfo("UTC"))
            return aware.astimezone(ZoneInfo(BUSINESS_ZONE)).replace(tzinfo=None)

        return cls(bound(window_start, interval_start), bound(window_end, interval_end))

    def split(self, every: str) -> list[Window]:
        """Consecutive windows of a day or a month that together cover this one."""
        out, lo = [], self.start
        while lo < self.end:
            hi = lo + timedelta(days=1) if every == "day" else _next_month(lo)
            out.append(Window(lo, min(hi, self.end)))
            lo = hi
        return out


def _next_month(t: datetime) -> datetime:
    first = t.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
    return first.replace(year=t.year + 1, month=1) if t.month == 12 else first.replace(month=t.month + 1)


def project_cast(df: DataFrame, spec: TableSpec, evolve: bool = False) -> DataFrame:
    """The spec's columns, in its order, in its types.

    A listed column the source does not have fails here, while the plan is built. With ``evolve`` the
    source's extra columns follow, unchanged.
    """
    types = {f.name: f.dataType.simpleString() for f in spec.schema}
    missing = [c for c in spec.columns if c not in df.columns]
    if missing:
        raise ValueError(f"[{spec.name}] source lacks columns: {', '.join(missing)}")
    extra = [c for c in df.columns if c not in types] if evolve else []
    return df.selectExpr(*[f"CAST(`{c}` AS {types[c]}) AS `{c}`" for c in spec.columns], *[f"`{c}`" for c in extra])


def broken_rows(df: DataFrame, spec: TableSpec) -> Column:
    """Names of the required columns that are null in a row; empty for a row the warehouse takes."""
    named = [F.when(F.col(c).isNull(), F.lit(c)) for c in spec.required if c in df.columns]
    return F.array_compact(F.array(*named)) if named else F.expr("CAST(array() AS array<string>)")


def required_only(df: DataFrame, spec: TableSpec, on_null: str = "refuse") -> DataFrame:
    """Rows with all required columns. Others end the run ("refuse") or stay out ("aside": see ``set_aside``).

    Decided row by row where the rows are; nothing is counted first.
    """
    names = broken_rows(df, spec)
    if on_null == "aside":
        return df.where(F.size(names) == 0)
    if on_null != "refuse":
        raise ValueError(f"on_null is 'refuse' or 'aside', not {on_null!r}")
    said = F.concat(F.lit(f"[{spec.name}] null in required columns: "), F.array_join(names, ", "))
    return df.where(F.when(F.size(names) == 0, True).otherwise(F.raise_error(said).cast("boolean")))


def set_aside(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows that ``required_only`` keeps out, with the names of their null columns."""
    return df.withColumn("null_columns", F.array_join(broken_rows(df, spec), ",")).where("null_columns != ''")


def window_filter(df: DataFrame, column: str, window: Window) -> DataFrame:
    """Keep the rows of the window. The bare column is compared, so the filter is pushed to the scan."""
    return df.where((F.col(column) >= ts_lit(window.start)) & (F.col(column) < ts_lit(window.end)))


def lookback(df: DataFrame, column: str, as_of: date, days: int = 3) -> DataFrame:
    """Rows touched in the last days before the execution date; takes in late arrivals."""
    since = datetime(as_of.year, as_of.month, as_of.day) - timedelta(days=days)
    return df.where(F.col(column) >= ts_lit(since))


def added_columns(target: DataFrame, incoming: DataFrame) -> list[StructField]:
    """Incoming columns the target lacks. A shared column of another type is refused."""
    have = {f.name: f.dataType for f in target.schema}
    clashes = [
        f"{f.name} is {have[f.name].simpleString()} in the target, {f.dataType.simpleString()} incoming"
        for f in incoming.schema
        if f.name in have and have[f.name] != f.dataType
    ]
    if clashes:
        raise SchemaConflict("type changes need a migration: " + "; ".join(clashes))
    return [f for f in incoming.schema if f.name not in have]


def evolve_schema(target: DataFrame, incoming: DataFrame) -> tuple[DataFrame, str]:
    """Give the target the incoming side's new columns, as nulls. Nothing is dropped or retyped."""
    new = added_columns(target, incoming)
    if not new:
        return target, "no_changes"
    wide = target.withColumns({f.name: F.lit(None).cast(f.dataType) for f in new})
    return wide, "added:" + ",".join(f.name for f in new)


def freshness(df: DataFrame, spec: TableSpec, as_of: datetime, loaded_at: str | None = None) -> DataFrame:
    """One row: newest load time, its age in hours, and pass, warn or error. No rows at all is an error."""
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), ts_lit(as_of))
    return df.agg(F.max(loaded_at or spec.loaded_at).alias("max_loaded_at")).select(
        F.lit(spec.system).alias("source"),
        F.lit(spec.name).alias("table_name"),
        "max_loaded_at",
        (age / 3600.0).alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull() | (age > spec.error_after.total_seconds()), "error")
        .when(age > spec.warn_after.total_seconds(), "warn")
        .otherwise("pass")
        .alias("status"),
    )


def contract_gaps(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Per required column: rows in all and rows that break the contract by being null."""
    required = [c for c in spec.required if c in df.columns]
    counted = df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.lit(_type(spec, c)).alias("declared_type"), F.col(c).alias("nulls"))
        for c in required
    ]
    return counted.select(
        F.lit(spec.name).alias("table_name"), "rows", F.explode(F.array(*entries)).alias("e")
    ).select("table_name", "e.column_name", "e.declared_type", "rows", "e.nulls")


def _type(spec: TableSpec, column: str) -> str:
    return spec.schema[column].dataType.simpleString()
