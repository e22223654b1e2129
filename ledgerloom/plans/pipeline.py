"""Runs: ingestion of one or many tables, backfill, and the transformation run with its gates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.catalog import Catalog
from ledgerloom.config import target_schema
from ledgerloom.operators.history import TRACKED_CUSTOMER_COLUMNS
from ledgerloom.operators.ingest import Window, freshness, project_cast, required_only, window_filter
from ledgerloom.operators.merge import merge_upsert
from ledgerloom.operators.quality import SINGULAR, Check, Watch, broken_rows, gate, quality_report, violations
from ledgerloom.operators.ranking import dedup_latest
from ledgerloom.operators.runs import RunLedger
from ledgerloom.operators.sinks import (
    collect_orphans,
    ensure_schema,
    merge_into_table,
    path_exists,
    rebuild_table,
    store_snapshot,
    write_clustered,
)
from ledgerloom.plans.checks import ALL_CHECKS
from ledgerloom.plans.marts import MARTS
from ledgerloom.plans.staging import STAGING, typed_source
from ledgerloom.sources.contracts import SPECS, TableSpec


@dataclass(frozen=True)
class MartLayout:
    schema: str
    partition_by: tuple[str, ...]
    cluster_by: tuple[str, ...]
    daily_snapshot: bool = False


# Where each mart lives and how it is laid out. The model's own clustering is used.
LAYOUTS = {
    "mart_customer_360": MartLayout(
        "marts_customer", ("updated_date",), ("customer_segment", "kyc_status", "risk_rating")
    ),
    "mart_customer_lifetime_value": MartLayout(
        "marts_customer", ("snapshot_date",), ("clv_segment", "customer_segment"), daily_snapshot=True
    ),
    "mart_credit_risk": MartLayout(
        "marts_risk",
        ("snapshot_date",),
        ("dpd_bucket", "product_category", "customer_segment"),
        daily_snapshot=True,
    ),
    "mart_fraud_analytics": MartLayout(
        "marts_risk", ("transaction_date",), ("severity", "flag_type", "is_confirmed_fraud")
    ),
    "mart_transaction_analytics": MartLayout(
        "marts_finance", ("transaction_date",), ("channel", "transaction_status", "transaction_type_code")
    ),
}


def extract(source: DataFrame, spec: TableSpec, window: Window, tie_break: Sequence[str] = ()) -> DataFrame:
    """The increment of one window: filter at the scan, cast, newest row per key."""
    rows = project_cast(window_filter(source, spec.loaded_at, window), spec, evolve=True)
    return dedup_latest(rows, [spec.key], spec.loaded_at, tie_break)


def ingest_relation(
    target: DataFrame, source: DataFrame, spec: TableSpec, window: Window, tie_break: Sequence[str] = ()
) -> DataFrame:
    """Extract, evolve and merge as one lazy plan."""
    return merge_upsert(target, extract(source, spec, window, tie_break), spec.key, spec.loaded_at, dedup=False)


def ingest_table(
    spark: SparkSession,
    spec: TableSpec,
    source: DataFrame,
    window: Window,
    schema: str,
    warehouse: str,
    tie_break: Sequence[str] = (),
    on_null: str = "refuse",
) -> str:
    """One ingestion run of one table, merged into its stored raw table.

    A null in a required column ends the run before the table changes; with ``on_null="aside"`` such rows stay out.
    """
    increment = project_cast(window_filter(source, spec.loaded_at, window), spec, evolve=True)
    increment = required_only(increment, spec, on_null)
    location = f"{warehouse}/{schema}/{spec.name}"
    return merge_into_table(spark, increment, f"{schema}.{spec.name}", spec, location, tie_break)


def ingest_tables(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    source: Callable[[str], DataFrame],
    window: Window,
    schema: str,
    warehouse: str,
    parallel: int = 4,
) -> dict[str, str]:
    """Independent tables in parallel: the threads only submit jobs, the executors do the work."""
    ensure_schema(spark, schema, warehouse)

    @inheritable_thread_target(spark)
    def run(spec: TableSpec) -> tuple[str, str]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.name)  # fair shares between tables
        return spec.name, ingest_table(spark, spec, source(spec.name), window, schema, warehouse)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return dict(pool.map(run, specs))


def backfill(
    spark: SparkSession,
    spec: TableSpec,
    source: DataFrame,
    windows: Sequence[Window],
    schema: str,
    warehouse: str,
    tie_break: Sequence[str] = (),
    resume: bool = False,
) -> list[str]:
    """Stored runs over successive windows, oldest first, one at a time; returns what each did.

    Each finished window is marked beside the table. With ``resume``, what earlier calls finished is skipped, also parts
    of a window, so a killed backfill goes on where it was; without it, all windows are loaded again. Marks of a table
    that is no longer there do not count.
    """
    ensure_schema(spark, schema, warehouse)
    location = f"{warehouse}/{schema}/{spec.name}"
    ledger = RunLedger(spark, location)
    if not path_exists(spark, f"{location}/_SUCCESS"):
        ledger.clear()
    outcomes = []
    for window in windows:
        said = "skipped"
        for part in ledger.left(window) if resume else [window]:
            said = ingest_table(spark, spec, source, part, schema, warehouse, tie_break)
            ledger.mark(part)
        outcomes.append(said)
    return outcomes


def backfill_relation(
    target: DataFrame, source: DataFrame, spec: TableSpec, windows: Sequence[Window], tie_break: Sequence[str] = ()
) -> DataFrame:
    """A backfill as one plan. Adjoining windows are merged into one before any work is done.

    Newest-wins over adjoining windows equals newest-wins over their union, so a month of daily runs
    costs one shuffle instead of thirty.
    """
    spans: list[Window] = []
    for w in windows:
        if spans and spans[-1].end == w.start:
            spans[-1] = Window(spans[-1].start, w.end)
        else:
            spans.append(w)
    for span in spans:
        target = ingest_relation(target, source, spec, span, tie_break)
    return target


def register_views(cat: Catalog, names: Sequence[str] = tuple(STAGING)) -> list[str]:
    """Expose the staging models as session views."""
    for name in names:
        cat.ref(name).createOrReplaceTempView(name)
    return list(names)


def build_mart(spark: SparkSession, cat: Catalog, name: str, warehouse: str, watch: Watch | None = None) -> str:
    """Write one mart to its table and let later models and tests read that table."""
    layout = LAYOUTS[name]
    schema = target_schema(cat.ctx.env, "marts", layout.schema)
    ensure_schema(spark, schema, warehouse)
    table, path = f"{schema}.{name}", f"{warehouse}/{schema}/{name}"
    if layout.daily_snapshot:
        write_clustered(
            cat.ref(name), path, layout.partition_by, layout.cluster_by, daily_snapshot=True, table=table, watch=watch
        )
    else:
        rebuild_table(cat.ref(name), table, path, layout.partition_by, layout.cluster_by, watch)
    stored = spark.table(table)
    if layout.daily_snapshot:
        stored = stored.where(stored.snapshot_date == cat.ctx.as_of)
    cat.replace(name, stored)
    return table


def build_marts(
    spark: SparkSession, cat: Catalog, warehouse: str, watches: Mapping[str, Watch] | None = None
) -> list[str]:
    """Write all marts: the customer, risk and finance domains in parallel, each domain in model order.

    ``watches`` count the row-level checks of their mart while it is written.
    """
    watches = watches or {}
    domains: dict[str, list[str]] = {}
    for name in MARTS:
        domains.setdefault(LAYOUTS[name].schema, []).append(name)

    @inheritable_thread_target(spark)
    def build(names: list[str]) -> list[str]:
        return [build_mart(spark, cat, n, warehouse, watches.get(n)) for n in names]

    with ThreadPoolExecutor(max_workers=len(domains)) as pool:
        return [table for tables in pool.map(build, domains.values()) for table in tables]


def store_failures(
    spark: SparkSession, cat: Catalog, checks: Sequence[Check], report: DataFrame, root: str
) -> dict[str, str]:
    """Keep the violating rows of each failing check; returns the path of each.

    One scan of a model for all its row-level checks: a row is written once for every check it breaks, by check.
    """
    failing = {(r.model, r.column_name, r.test) for r in report.where("status = 'fail'").collect()}  # one row per check
    wanted = [c for c in checks if (c.model, c.column, c.kind) in failing]
    paths = {}
    by_row: dict[str, list[Check]] = {}
    for check in wanted:
        if check.row_level:
            by_row.setdefault(check.model, []).append(check)
            paths[check.name] = f"{root}/rows/{check.model}/check_name={check.name}"
        else:
            paths[check.name] = f"{root}/{check.name}"
            violations(cat, check).write.mode("overwrite").parquet(paths[check.name])
    for model, own in by_row.items():
        rows = broken_rows(cat.relation(model), own)
        rows.write.mode("overwrite").partitionBy("check_name").parquet(f"{root}/rows/{model}")
    for name, (_, model, find) in SINGULAR.items():
        if (model, "*", name) in failing:
            paths[name] = f"{root}/{name}"
            find(cat).write.mode("overwrite").parquet(paths[name])
    return paths


def materialize(
    spark: SparkSession, cat: Catalog, names: Sequence[str], checks: Sequence[Check], root: str, parallel: int = 4
) -> dict[Check, int]:
    """Write models to tables that everything later reads, and count their row-level checks on the way.

    Staging models read sources alone and are written side by side; then the marts are, each domain in model order.
    The threads only submit jobs, so a model with few tasks does not keep the other cores waiting.
    """

    @inheritable_thread_target(spark)
    def build(group: Sequence[str]) -> dict[Check, int]:
        known: dict[Check, int] = {}
        for name in group:
            watch = Watch(c for c in checks if c.model == name)
            layout = LAYOUTS.get(name)
            write_clustered(cat.ref(name), f"{root}/{name}", (), layout.cluster_by if layout else (), watch=watch)
            known |= watch.counts()
            cat.replace(name, spark.read.parquet(f"{root}/{name}"))
        return known

    domains: dict[str, list[str]] = {}
    for name in names:
        if name in LAYOUTS:
            domains.setdefault(LAYOUTS[name].schema, []).append(name)
    known: dict[Check, int] = {}
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        for groups in ([[n] for n in names if n not in LAYOUTS], list(domains.values())):
            for counted in pool.map(build, groups):
                known |= counted
    return known


def freshness_report(cat: Catalog, names: Sequence[str]) -> DataFrame:
    parts = [freshness(typed_source(cat, n), SPECS[n], cat.ctx.now) for n in names]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def snapshot_customers(spark: SparkSession, cat: Catalog, warehouse: str) -> str:
    """Fold today's live customers into their history; the source table is read, not the staging model."""
    schema = target_schema(cat.ctx.env, "snapshots", "snapshots")
    ensure_schema(spark, schema, warehouse)
    current = typed_source(cat, "customers").where("deleted_at IS NULL").select(*TRACKED_CUSTOMER_COLUMNS)
    view = f"{schema}.snap_customers"
    store_snapshot(spark, current, view, "customer_id", cat.ctx.now, f"{warehouse}/{schema}/snap_customers")
    return view


class PipelineBlocked(RuntimeError):
    """A blocking gate failed; nothing after it ran."""


def run_pipeline(
    spark: SparkSession,
    cat: Catalog,
    warehouse: str,
    *,
    gates: Sequence[str] = ("freshness", "staging"),
    sources: Sequence[str] = tuple(SPECS),
    checks: Sequence[Check] = tuple(ALL_CHECKS),
) -> Mapping[str, object]:
    """Freshness, staging views and tests, marts and tests, history; in that order.

    A stale source or, unless the gate is left out, a failing staging test stops the run before the
    marts. Failing mart tests are reported and do not stop the history.
    """
    collect_orphans(spark)
    fresh = {r.table_name: r.status for r in freshness_report(cat, sources).collect()}  # one row per table
    if "freshness" in gates and "error" in fresh.values():
        raise PipelineBlocked(f"stale sources: {sorted(t for t, s in fresh.items() if s == 'error')}")
    views = register_views(cat)
    result: dict[str, object] = {"freshness": fresh, "views": views, "failures": {}}
    for stage in ("staging", "marts"):
        known: dict[Check, int] = {}
        if stage == "marts":
            watches = {m: Watch(c for c in checks if c.model == m) for m in MARTS}
            result["tables"] = build_marts(spark, cat, warehouse, watches)
            for watch in watches.values():
                known |= watch.counts()
        mine = [c for c in checks if c.stage == stage]
        path = f"{warehouse}/test_results/{stage}"
        quality_report(spark, cat, mine, known).write.mode("overwrite").parquet(path)
        report = spark.read.parquet(path)
        result[stage] = report
        result["failures"] |= store_failures(spark, cat, mine, report, f"{warehouse}/test_failures")
        if stage in gates and any(r.blocked for r in gate(report, gates).collect()):
            raise PipelineBlocked(f"{stage} tests failed; see {path}")
    result["snapshot"] = snapshot_customers(spark, cat, warehouse)
    return result
