"""Every registered query: a name, the Spark job, and where possible the DuckDB SQL that must agree.

Queries run over whole tables. Decimals leave as double, so both engines return the same plain types.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import functions as fn
from ledgerloom.catalog import Catalog
from ledgerloom.config import resolve_execution_date, target_schema
from ledgerloom.operators import asof, history, ingest, merge, quality, rolling, sampling, sinks
from ledgerloom.operators.ranking import dedup_latest, newest_first, top1_per_group
from ledgerloom.operators.uniqueness import KeyCounts
from ledgerloom.oracle import queries as sql
from ledgerloom.oracle.relations import as_text, whole
from ledgerloom.plans import checks, marts, pipeline
from ledgerloom.plans.staging import STAGING, typed_source
from ledgerloom.sources import feeds, testbed
from ledgerloom.sources.contracts import INGESTED, SPECS
from ledgerloom.sources.dims import join_dim
from ledgerloom.streaming import stream_upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
AS_OF, AS_OF_TS = testbed.AS_OF, testbed.AS_OF_TS


def bed(spark: SparkSession, sf_dir: str, servicing: bool = False) -> Catalog:
    return Catalog(testbed.sources(spark, sf_dir), replace(testbed.CTX, servicing=servicing))


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double."""
    return df.select(
        [F.col(f.name).cast("double") if isinstance(f.dataType, T.DecimalType) else f.name for f in df.schema]
    )


def query(name: str, oracle: str | None = None, servicing: bool = False):
    """Register a function of a catalog; its SQL is given or found under the same name."""

    def register(make: Callable[[SparkSession, Catalog, str], DataFrame]):
        QUERIES[name] = lambda spark, sf: plain(make(spark, bed(spark, sf, servicing), sf))
        text = oracle or sql.SQL.get(name)
        if text:
            ORACLE[name] = sql.assembled(text)
        return make

    return register


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


scratch = sinks.scratch


# ---- models -------------------------------------------------------------------------------------------

for _name in STAGING:
    query(_name, whole(_name))(lambda spark, cat, sf, n=_name: cat.ref(n))
for _name in pipeline.LAYOUTS:
    query(_name, whole(_name))(lambda spark, cat, sf, n=_name: cat.ref(n))
for _name in ("stg_accounts", "mart_customer_360", "mart_credit_risk"):
    query(f"{_name}_servicing", whole(f"{_name}_servicing"), servicing=True)(
        lambda spark, cat, sf, n=_name: cat.ref(n)
    )
for _make in (marts.customer_txn_summary, marts.customer_account_summary, marts.customer_loan_summary):
    query(_make.__name__, whole(_make.__name__))(lambda spark, cat, sf, make=_make: make(cat))


@query("npl_ratio", servicing=True)
def _(spark, cat, sf):
    return marts.npl_ratio(cat, ("customer_segment", "dpd_bucket"))


@query("transaction_metrics_monthly")
def _(spark, cat, sf):
    return marts.transaction_metrics(cat.ref("stg_transactions"), ("transaction_month_key", "channel"))


def exact(df: DataFrame) -> DataFrame:
    """Decimals as text of their scale, so that every digit is compared."""
    return df.select(
        [F.col(f.name).cast("string") if isinstance(f.dataType, T.DecimalType) else f.name for f in df.schema]
    )


for _name in ("mart_customer_360", "mart_transaction_analytics"):
    QUERIES[f"{_name}_exact"] = lambda spark, sf, n=_name: exact(bed(spark, sf).ref(n))
    ORACLE[f"{_name}_exact"] = sql.assembled(as_text(_name))


# ---- sources ------------------------------------------------------------------------------------------


@query("scan_table")
def _(spark, cat, sf):
    return cat.source("merchants")


@query("dim_literals")
def _(spark, cat, sf):
    """How often the data uses each literal reference row."""
    uses = (
        ("transaction_types", "type_id", "type_code", "transactions"),
        ("payment_methods", "method_id", "method_code", "transactions"),
        ("merchant_categories", "mcc_code", "category_name", "merchants"),
        ("product_types", "product_type_id", "product_code", "accounts"),
    )
    return union_all(
        [
            join_dim(
                cat.source(dim), cat.source(user).groupBy(key).agg(F.count("*").alias("n")), key
            ).select(
                F.lit(dim).alias("dim"),
                F.col(key).cast("string").alias("dim_key"),
                F.col(label).alias("label"),
                fn.zero_if_null(F.col("n")).alias("uses"),
            )
            for dim, key, label, user in uses
        ]
    )


@query("source_contract")
def _(spark, cat, sf):
    return union_all([ingest.contract_gaps(cat.source(n), SPECS[n]) for n in sql.CONTRACT_TABLES])


# ---- ingestion ----------------------------------------------------------------------------------------

SCHEDULED = (datetime(2024, 1, 8, 2), datetime(2024, 1, 22, 2))


@query("ingest_project_cast")
def _(spark, cat, sf):
    return ingest.project_cast(cat.source("loan_applications"), SPECS["loan_applications"])


@query("ingest_window_filter")
def _(spark, cat, sf):
    window = ingest.Window(datetime(2024, 1, 8), datetime(2024, 1, 22))
    return ingest.window_filter(cat.source("change_feed"), "updated_at", window)


@query("ingest_window_tz")
def _(spark, cat, sf):
    window = ingest.Window.of_schedule(*SCHEDULED)
    rows = ingest.window_filter(cat.source("change_feed"), "updated_at", window)
    return rows.withColumn("updated_at_wib", fn.to_business_time(F.col("updated_at")))


@query("ingest_window_override")
def _(spark, cat, sf):
    window = ingest.Window.of_schedule(*SCHEDULED, window_start="2024-01-10 09:00:00")
    return ingest.window_filter(cat.source("change_feed"), "updated_at", window)


@query("ingest_dedup_latest")
def _(spark, cat, sf):
    return dedup_latest(cat.source("change_feed"), ["customer_id"], "updated_at", ["seq"])


@query("ingest_dedup_latest_composite")
def _(spark, cat, sf):
    """Order lines repeat their key in the given data; the last shipped one stands."""
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    ties = ["l_partkey", "l_suppkey", "l_extendedprice"]
    return dedup_latest(lines, ["l_orderkey", "l_linenumber"], "l_shipdate", ties)


@query("ingest_schema_evolution")
def _(spark, cat, sf):
    feed = cat.source("change_feed")
    old = feeds.stored_target(feed).select("customer_id", "customer_segment", "updated_at")
    new = ingest.window_filter(feed, "updated_at", feeds.halves(feed)[1])
    wide, outcome = ingest.evolve_schema(old, new)
    return wide.unionByName(new).withColumn("outcome", F.lit(outcome))


def _merge(name: str, **options):
    @query(name)
    def run(spark, cat, sf):
        feed = cat.source("change_feed")
        increment = feeds.bent_increment(feed)
        if options.get("retried"):
            increment = increment.unionByName(increment)
        rest = {k: v for k, v in options.items() if k != "retried"}
        return merge.merge_upsert(
            feeds.stored_target(feed), increment, "customer_id", "updated_at", tie_break=["seq"], **rest
        )


_merge("ingest_merge_upsert")
_merge("ingest_merge_dedup_guard", retried=True)
_merge("ingest_merge_delete", delete_missing=True)


@query("ingest_table")
def _(spark, cat, sf):
    feed = cat.source("change_feed")
    narrow = feeds.stored_target(feed).drop("balance")
    return pipeline.ingest_relation(narrow, feed, feeds.FEED_SPEC, feeds.halves(feed)[1], ["seq"])


@query("ingest_tables")
def _(spark, cat, sf):
    """Loads the seven tables into stored raw tables, two windows each, and counts what arrived."""
    schema, root = f"raw_{uuid.uuid4().hex[:12]}", scratch(spark, "raw")
    specs = [SPECS[n] for n in INGESTED]
    ends = [w for s in specs if (w := feeds.span_of(cat.source(s.name), s.loaded_at))]
    whole = ingest.Window(min(w.start for w in ends), max(w.end for w in ends))
    middle = whole.start + (whole.end - whole.start) / 2
    for window in (ingest.Window(whole.start, middle), ingest.Window(middle, whole.end)):
        pipeline.ingest_tables(spark, specs, cat.source, window, schema, root)
    return union_all(
        [
            spark.table(f"{schema}.{s.name}").agg(
                F.lit(s.name).alias("table_name"),
                F.count("*").alias("rows"),
                F.count_distinct(s.key).alias("keys"),
                F.min(s.loaded_at).alias("first_loaded"),
                F.max(s.loaded_at).alias("last_loaded"),
            )
            for s in specs
        ]
    )


@query("ingest_backfill")
def _(spark, cat, sf):
    feed = cat.source("change_feed")
    nothing = feed.limit(0)
    whole = feeds.span_of(feed, "updated_at")
    return pipeline.backfill_relation(nothing, feed, feeds.FEED_SPEC, whole.split("day") if whole else [], ["seq"])


def _with_holes(feed: DataFrame) -> DataFrame:
    hole = F.when(F.col("seq") % 7 != 0, F.col("customer_id"))
    return feed.withColumn("customer_id", hole)


@query("ingest_required_kept")
def _(spark, cat, sf):
    """The feed with holes in its key, loaded without the rows that the contract refuses."""
    bent = ingest.project_cast(_with_holes(cat.source("change_feed")), feeds.FEED_SPEC)
    return dedup_latest(ingest.required_only(bent, feeds.FEED_SPEC, "aside"), ["customer_id"], "updated_at", ["seq"])


@query("ingest_required_aside")
def _(spark, cat, sf):
    bent = ingest.project_cast(_with_holes(cat.source("change_feed")), feeds.FEED_SPEC)
    return ingest.set_aside(bent, feeds.FEED_SPEC)


@query("ingest_backfill_stored")
def _(spark, cat, sf):
    """The feed week by week into a stored table: each run meets what the one before left."""
    feed = cat.source("change_feed")
    whole = feeds.span_of(feed, "updated_at")
    days = whole.split("day") if whole else []
    weeks = [ingest.Window(days[i].start, days[min(i + 7, len(days)) - 1].end) for i in range(0, len(days), 7)]
    schema, root = f"fill_{uuid.uuid4().hex[:12]}", scratch(spark, "fill")
    pipeline.backfill(spark, feeds.FEED_SPEC, feed, weeks, schema, root, ["seq"])
    return spark.table(f"{schema}.{feeds.FEED_SPEC.name}").drop(sinks.PART)


@query("ingest_backfill_resumed")
def _(spark, cat, sf):
    """A backfill that ended half way and is called again: what is done is skipped, the rest is loaded."""
    feed = cat.source("change_feed")
    whole = feeds.span_of(feed, "updated_at")
    halves = [w for w in feeds.halves(feed) if w.start < w.end]
    schema, root = f"fill_{uuid.uuid4().hex[:12]}", scratch(spark, "fill")
    pipeline.backfill(spark, feeds.FEED_SPEC, feed, halves[:1], schema, root, ["seq"])
    pipeline.backfill(spark, feeds.FEED_SPEC, feed, [whole] if whole else [], schema, root, ["seq"], resume=True)
    return spark.table(f"{schema}.{feeds.FEED_SPEC.name}").drop(sinks.PART)


@query("ingest_freshness")
def _(spark, cat, sf):
    return pipeline.freshness_report(cat, sql.CONTRACT_TABLES)


@query("insert_ignore")
def _(spark, cat, sf):
    """Numbers that repeat from month to month: only the first application of each is taken."""
    apps = cat.source("loan_applications").select(
        "application_id",
        F.concat_ws("-", "customer_id", F.month("submitted_at")).alias("application_number"),
        "submitted_at",
    )
    split = fn.ts_lit("1998-01-01 00:00:00")
    none = apps.limit(0)
    order = ["submitted_at", "application_id"]
    stored = merge.insert_ignore(none, apps.where(F.col("submitted_at") < split), ["application_number"], order)
    return merge.insert_ignore(stored, apps.where(F.col("submitted_at") >= split), ["application_number"], order)


@query("upsert_dim")
def _(spark, cat, sf):
    merchants = cat.source("merchants").select("merchant_id", "merchant_name", "risk_level")
    given = merchants.select(
        F.when(F.col("risk_level") == "high", F.col("merchant_id") + 1_000_000_000)
        .otherwise(F.col("merchant_id"))
        .alias("merchant_id"),
        F.upper("merchant_name").alias("merchant_name"),
        F.lit("unknown").alias("risk_level"),
    )
    return merge.upsert_columns(merchants, given, "merchant_id", ["merchant_name"])


@query("lookback_filter")
def _(spark, cat, sf):
    return ingest.lookback(cat.source("transactions"), "updated_at", AS_OF, 3).select(
        "transaction_id", "customer_id", "updated_at"
    )


@query("execution_date")
def _(spark, cat, sf):
    chosen = resolve_execution_date({"execution_date": "2001-07-15"}, AS_OF)
    default = resolve_execution_date({}, AS_OF)
    day = F.col("transaction_date")
    return (
        cat.source("transactions")
        .where(day.isin(chosen, default))
        .groupBy((day == fn.date_lit(default)).alias("is_default"), day.alias("execution_date"))
        .agg(F.count("*").alias("transactions"), fn.money_sum(F.lit(True), F.col("amount_idr")).alias("volume_idr"))
    )


# ---- sinks: what is read back must be what the model computes -----------------------------------------


@query("sink_mart_table", whole("mart_transaction_analytics"))
def _(spark, cat, sf):
    path, name = scratch(spark, "mart"), "mart_transaction_analytics"
    layout = pipeline.LAYOUTS[name]
    sinks.write_clustered(cat.ref(name), path, layout.partition_by, layout.cluster_by)
    return spark.read.parquet(path)


@query("sink_cluster", whole("mart_credit_risk_servicing"), servicing=True)
def _(spark, cat, sf):
    """A daily snapshot written twice: the second day replaces itself, not the day before."""
    path, layout = scratch(spark, "cluster"), pipeline.LAYOUTS["mart_credit_risk"]
    mart = cat.ref("mart_credit_risk")
    yesterday = mart.withColumn("snapshot_date", F.date_sub("snapshot_date", 1))
    for df in (yesterday, mart, mart):
        sinks.write_clustered(df, path, layout.partition_by, layout.cluster_by, daily_snapshot=True)
    return spark.read.parquet(path).where(F.col("snapshot_date") == fn.date_lit(AS_OF))


@query("sink_raw_partitioned")
def _(spark, cat, sf):
    path = scratch(spark, "raw")
    sinks.write_raw(cat.source("transactions"), SPECS["transactions"], path)
    return (
        spark.read.parquet(path)
        .groupBy(sinks.PART)
        .agg(
            F.count("*").alias("rows"),
            F.min("updated_at").alias("first_update"),
            F.max("updated_at").alias("last_update"),
            fn.money_sum(F.lit(True), F.col("amount_idr")).alias("amount_idr"),
        )
    )


@query("sink_cleanup")
def _(spark, cat, sf):
    """Stage, publish, and prove that the staging folder is gone although the work in it failed."""
    published, left_behind = scratch(spark, "published"), []
    try:
        with sinks.staged(spark) as stage:
            left_behind.append(stage)
            cat.source("accounts").write.parquet(stage)
            spark.read.parquet(stage).write.parquet(published)
            raise InterruptedError("a later step fails")
    except InterruptedError:
        pass
    gone = not any(sinks.path_exists(spark, p) for p in left_behind)
    return (
        spark.read.parquet(published)
        .groupBy("account_status")
        .agg(F.count("*").alias("accounts"), F.lit(gone).alias("stage_removed"))
    )


@query("sink_orphans")
def _(spark, cat, sf):
    """Of two staging folders, the one whose driver no longer renews its lease is removed."""
    root = scratch(spark, "leases")
    lost, live = sinks.Lease(spark, f"{root}/lost", 0), sinks.Lease(spark, f"{root}/live")
    lost.stop()
    for name in ("lost", "live"):
        cat.source("accounts").write.parquet(f"{root}/{name}")
    removed = sinks.collect_orphans(spark, root) == ["lost"] and not sinks.path_exists(spark, f"{root}/lost")
    live.end()
    kept = spark.read.parquet(f"{root}/live").groupBy("account_status")
    return kept.agg(F.count("*").alias("accounts"), F.lit(removed).alias("orphan_removed"))


@query("view_layer")
def _(spark, cat, sf):
    pipeline.register_views(cat)
    return spark.sql(
        """
        SELECT c.customer_segment, t.channel, count(*) AS transactions, sum(t.amount_idr) AS volume_idr
        FROM stg_transactions t JOIN stg_customers c USING (customer_id)
        GROUP BY c.customer_segment, t.channel
        """
    )


@query("view_counts")
def _(spark, cat, sf):
    """The rows of every staging model, read through its view."""
    names = pipeline.register_views(cat)
    return union_all([spark.table(n).agg(F.lit(n).alias("view_name"), F.count("*").alias("rows")) for n in names])


@query("target_namespace")
def _(spark, cat, sf):
    """Row counts per staging model under the name it has in each environment."""
    envs = ("prod", "ci", "dev", "laptop")
    names = F.array(
        *[
            F.struct(F.lit(e).alias("env"), F.lit(target_schema(e, "analytics", " staging ")).alias("schema_name"))
            for e in envs
        ]
    )
    counted = [cat.ref(m).agg(F.lit(m).alias("model"), F.count("*").alias("rows")) for m in STAGING]
    return union_all(counted).select("model", "rows", F.inline(names))


@query("store_failures")
def _(spark, cat, sf):
    wanted = [c for c in checks.STAGING_CHECKS if c.model == "stg_accounts"]
    report = quality.with_status(quality.failure_counts(spark, cat, wanted))
    paths = pipeline.store_failures(spark, cat, wanted, report, scratch(spark, "failures"))
    kept = spark.read.parquet(paths["accepted_range_stg_accounts_balance"])
    return kept.select("account_id", "customer_id", "account_status", "balance")


@query("store_failures_counts")
def _(spark, cat, sf):
    """What is kept of every failing check of the staging models, counted from the files."""
    report = quality.with_status(quality.failure_counts(spark, cat, checks.STAGING_CHECKS))
    root = scratch(spark, "failures")
    report.write.parquet(f"{root}/report")
    report = spark.read.parquet(f"{root}/report")
    paths = pipeline.store_failures(spark, cat, checks.STAGING_CHECKS, report, root)
    labels = ["stage", "model", "column", "kind"]
    kept = [
        spark.read.parquet(paths[c.name]).agg(
            *[F.lit(getattr(c, a)).alias(b) for a, b in zip(labels, ("stage", "model", "column_name", "test"))],
            F.count("*").alias("failures"),
        )
        for c in checks.STAGING_CHECKS
        if c.name in paths
    ]
    return union_all(kept)


@query("source_month_partition")
def _(spark, cat, sf):
    return (
        cat.source("transactions")
        .groupBy(fn.partition_key(F.col("transaction_date")).alias("partition_key"))
        .agg(
            F.count("*").alias("transactions"),
            F.min("transaction_date").alias("first_date"),
            F.max("transaction_date").alias("last_date"),
        )
    )


# ---- joins --------------------------------------------------------------------------------------------


@query("join_left_dim")
def _(spark, cat, sf):
    types = cat.source("transaction_types").select("type_id", "type_code", "type_category")
    rows = cat.source("transactions").select("transaction_id", "type_id", "amount_idr")
    return join_dim(rows, types, "type_id")


@query("join_left_fact")
def _(spark, cat, sf):
    spend = cat.source("transactions").groupBy("customer_id").agg(F.count("*").alias("transactions"))
    owned = cat.source("accounts").groupBy("customer_id").agg(F.count("*").alias("accounts"))
    customers = cat.source("customers").select("customer_id", "customer_segment")
    return customers.join(spend, "customer_id", "left").join(owned, "customer_id", "left")


@query("join_inner")
def _(spark, cat, sf):
    facts = cat.source("transactions").select("transaction_id", "amount_idr", "channel")
    return cat.source("fraud_flags").select("flag_id", "transaction_id", "severity").join(facts, "transaction_id")


@query("join_anti")
def _(spark, cat, sf):
    flags = cat.source("fraud_flags").select("flag_id", "transaction_id")
    return flags.join(cat.source("transactions").select("transaction_id"), "transaction_id", "left_anti")


@query("join_merge")
def _(spark, cat, sf):
    """Which branch of the merge each key takes."""
    feed = cat.source("change_feed")
    old = feeds.stored_target(feed).select("customer_id", F.col("updated_at").alias("stored_at"))
    increment = dedup_latest(feeds.bent_increment(feed), ["customer_id"], "updated_at", ["seq"])
    new = increment.select("customer_id", F.col("updated_at").alias("offered_at"), F.lit(True).alias("given"))
    branch = (
        F.when(F.col("stored_at").isNull(), "insert")
        .when(F.col("offered_at") > F.col("stored_at"), "update")
        .when(F.col("given"), "keep")
        .otherwise("not offered")
    )
    return old.join(new, "customer_id", "full").select("customer_id", "stored_at", "offered_at", branch.alias("branch"))


# ---- aggregation, windows, sets -----------------------------------------------------------------------


@query("agg_group_by")
def _(spark, cat, sf):
    rows = cat.ref("stg_transactions")
    return rows.groupBy(*marts.TRANSACTION_GRAIN).agg(F.count("*").alias("transactions"))


@query("agg_countif")
def _(spark, cat, sf):
    """A null condition counts as false: unreviewed flags are in neither count."""
    confirmed = F.col("is_confirmed_fraud")
    return (
        cat.ref("stg_fraud_flags")
        .groupBy("severity", "flag_type")
        .agg(
            F.count_if(confirmed).alias("confirmed"),
            F.count_if(~confirmed).alias("false_positives"),
            F.count("*").alias("flags"),
        )
    )


@query("agg_conditional_sum")
def _(spark, cat, sf):
    failed = F.when(F.col("is_failed"), F.col("amount_idr"))
    return (
        cat.ref("stg_transactions")
        .groupBy("customer_id")
        .agg(
            fn.money_sum(F.col("is_failed"), F.col("amount_idr")).alias("failed_idr"),
            fn.safe_divide(F.sum(failed), F.count(failed)).alias("avg_failed_idr"),
            F.min(failed).alias("min_failed_idr"),
            F.max(failed).alias("max_failed_idr"),
        )
    )


@query("agg_count_distinct")
def _(spark, cat, sf):
    return (
        cat.source("transactions")
        .groupBy("channel")
        .agg(
            F.count_distinct("customer_id").alias("customers"),
            F.count_distinct("account_id").alias("accounts"),
            F.count_distinct("merchant_id").alias("merchants"),
        )
    )


@query("agg_minmax")
def _(spark, cat, sf):
    return (
        cat.source("transactions")
        .groupBy("customer_id")
        .agg(
            F.min("transaction_at").alias("first_at"),
            F.max("transaction_at").alias("last_at"),
            F.min("amount_idr").alias("least_idr"),
            F.max(F.when(F.col("channel") == "mobile", F.col("amount_idr")).otherwise(0)).alias("most_mobile_idr"),
        )
    )


@query("agg_global")
def _(spark, cat, sf):
    counted = cat.source("transactions").agg(
        F.count("*").alias("transactions"), F.count("merchant_id").alias("with_merchant")
    )
    return counted.where(fn.safe_divide(F.col("with_merchant"), F.col("transactions")) > 0.1)


@query("win_row_number")
def _(spark, cat, sf):
    scores = cat.ref("stg_credit_scores")
    return scores.select("score_id", "customer_id", "score_date", "is_latest_score")


@query("top1_per_group")
def _(spark, cat, sf):
    order = newest_first("score_date", "score_id")
    return top1_per_group(cat.source("credit_scores"), ["customer_id"], order)


@query("distinct_rows")
def _(spark, cat, sf):
    return cat.source("transactions").select("account_id", "customer_id").distinct()


@query("topk")
def _(spark, cat, sf):
    newest = cat.source("transactions").orderBy(F.col("transaction_id").desc()).limit(100)
    return newest.select("transaction_id", "transaction_date", "amount_idr")


@query("sample_n")
def _(spark, cat, sf):
    return sampling.sample_n(cat.source("accounts").select("account_id", "customer_id"), "account_id", 200)


@query("sample_fraction")
def _(spark, cat, sf):
    rows = cat.source("transactions").select("transaction_id", "account_id", "amount_idr")
    return sampling.sample_fraction(rows, "transaction_id", 0.008)


@query("weighted_choice")
def _(spark, cat, sf):
    channel = sampling.weighted_choice("transaction_id", sql.CHANNEL_WEIGHTS, seed=7)
    return cat.source("transactions").select("transaction_id", channel.alias("assigned_channel"))


# ---- functions ----------------------------------------------------------------------------------------


def _project(name: str, source: str, columns: Callable[[], dict[str, Column]]):
    """A projection of one source; its columns are made when it runs, as they need a session."""

    @query(name)
    def run(spark, cat, sf):
        rows = cat.source(source)
        return rows.select(SPECS[source].key, *[c.alias(n) for n, c in columns().items()])


def _register_functions() -> None:
    c, today = F.col, lambda: fn.date_lit(AS_OF)
    _project(
        "fn_mask_pii",
        "customers",
        lambda: dict(
            masked_name=fn.mask_pii("full_name"),
            masked_short=fn.mask_pii(F.substring("full_name", 1, 1)),
            masked_null=fn.mask_pii("phone_secondary"),
            prod_name=fn.mask_pii("full_name", "prod"),
        ),
    )
    _project(
        "fn_credit_band",
        "credit_scores",
        lambda: dict(
            band=fn.credit_band(c("score_value")),
            band_of_null=fn.credit_band(F.when(c("score_value") > 500, c("score_value"))),
        ),
    )
    _project(
        "fn_dpd_bucket",
        "accounts",
        lambda: dict(
            bucket=fn.dpd_bucket(c("dpd")), shifted=fn.dpd_bucket(c("dpd") - 5),
        ),
    )
    _project(
        "fn_income_band_sort",
        "customers",
        lambda: dict(
            band_rank=fn.income_band_sort(c("income_range")),
        ),
    )
    _project(
        "fn_is_business_day",
        "transactions",
        lambda: dict(
            business=fn.is_business_day(c("transaction_date")),
        ),
    )
    _project(
        "fn_audit_columns",
        "accounts",
        lambda: fn.audit_columns(testbed.CTX, "accounts"),
    )
    _project(
        "fn_safe_divide",
        "loan_applications",
        lambda: dict(
            ratio=fn.safe_divide(c("approved_amount"), c("requested_amount")),
            by_zero=fn.safe_divide(c("requested_amount"), F.lit(0)),
        ),
    )
    _project(
        "fn_nullif_coalesce",
        "transactions",
        lambda: dict(
            fee_or_null=F.nullif(c("fee_amount"), F.lit(0)),
            merchant_or_zero=fn.zero_if_null(c("merchant_id")),
        ),
    )
    _project(
        "fn_string_norm",
        "customers",
        lambda: dict(
            gender=fn.upper_trim("gender"),
            marital_status=fn.lower_trim("marital_status"),
            email=fn.lower_trim("email"),
            segment=F.lower("customer_segment"),
        ),
    )
    _project(
        "fn_initcap",
        "customers",
        lambda: dict(
            city=fn.title_words("address_city"),
            province=fn.title_words("address_province"),
            whole_name=fn.title_words("full_name"),
            nothing=fn.title_words(F.substring("full_name", 1, 0)),
        ),
    )
    _project(
        "fn_concat_substr",
        "customers",
        lambda: dict(
            tail=F.substring("full_name", -4, 4),
            joined=F.concat(F.substring("full_name", 1, 2), c("marital_status")),
        ),
    )
    _project(
        "fn_date_diff_day",
        "loan_applications",
        lambda: dict(
            age_days=fn.days_between(today(), F.to_date("submitted_at")),
            decision_days=fn.days_between(F.to_date("decided_at"), F.to_date("submitted_at")),
        ),
    )
    _project(
        "fn_date_diff_boundary",
        "customers",
        lambda: dict(
            years=fn.calendar_years(today(), c("date_of_birth")),
            months=fn.calendar_months(today(), c("date_of_birth")),
        ),
    )
    _project(
        "fn_timestamp_diff_hour",
        "fraud_flags",
        lambda: dict(
            review_hours=fn.whole_hours(c("reviewed_at"), c("created_at")),
            waiting_hours=fn.whole_hours(fn.ts_lit(AS_OF_TS), c("created_at")),
        ),
    )
    _project(
        "fn_date_sub",
        "transactions",
        lambda: dict(
            earlier=F.date_sub("transaction_date", 30),
            recent=c("transaction_date") >= F.date_sub(today(), 365),
        ),
    )
    _project(
        "fn_extract",
        "transactions",
        lambda: dict(
            hour_of_day=fn.date_part("HOUR", c("transaction_at")),
            weekday=fn.date_part("DAYOFWEEK", c("transaction_at")),
            month_of_year=fn.date_part("MONTH", c("transaction_date")),
            year_no=fn.date_part("YEAR", c("transaction_date")),
        ),
    )
    _project(
        "fn_format_date",
        "transactions",
        lambda: dict(
            month_key=fn.month_key(c("transaction_date")),
        ),
    )
    _project(
        "fn_date_of_ts",
        "transactions",
        lambda: dict(
            day=F.to_date("transaction_at"),
        ),
    )
    _project(
        "fn_now",
        "customers",
        lambda: dict(
            as_of=today(),
            as_of_ts=fn.ts_lit(AS_OF_TS),
            is_current=F.to_date("updated_at") <= today(),
        ),
    )
    _project(
        "fn_round",
        "transactions",
        lambda: dict(
            r0=F.round(c("amount_idr") * F.lit("0.333").cast("decimal(4,3)"), 0),
            r1=F.round(c("amount_idr") / F.lit(1000).cast("decimal(4,0)"), 1),
            r2=F.round(c("amount_idr") * F.lit("0.005").cast("decimal(4,3)"), 2),
            r4=F.round(c("exchange_rate") * F.lit("0.12345").cast("decimal(6,5)"), 4),
        ),
    )
    _project(
        "fn_cast",
        "customers",
        lambda: dict(
            national_no=c("national_id").cast("bigint"),
            id_text=c("customer_id").cast("string"),
            born_text=c("date_of_birth").cast("string"),
            exposed_no=c("is_politically_exposed").cast("int"),
        ),
    )
    _project(
        "fn_case_searched",
        "transactions",
        lambda: dict(
            size=F.when(c("amount_idr") > 50_000_000, "high")
            .when(c("amount_idr").between(10_000_000, 50_000_000), "medium")
            .otherwise("low"),
            online=F.when(c("channel").isin("mobile", "web"), "digital").when(~c("channel").isin("qris"), "physical"),
            merchant_known=(c("merchant_id") > 4) | c("merchant_id").isNull(),
        ),
    )
    _project(
        "fn_bool_flags",
        "fraud_flags",
        lambda: dict(
            confirmed_and_high=c("is_confirmed_fraud") & (c("severity") == "high"),
            open_or_low=~c("is_confirmed_fraud") | (c("severity") == "low"),
            is_velocity=c("flag_type") == "velocity",
        ),
    )
    _project(
        "fn_arith",
        "accounts",
        lambda: dict(
            blocked=(c("balance") - c("available_balance")).cast("decimal(20,2)"),
            doubled=(c("balance") * 2).cast("decimal(22,2)"),
            rate_left=1 - fn.safe_divide(c("available_balance"), c("balance")),
        ),
    )


_register_functions()


# ---- history ------------------------------------------------------------------------------------------


def _feed_state(feed: DataFrame, until: datetime) -> DataFrame:
    """The customers as a snapshot run at that time finds them; segment sme counts as soft-deleted."""
    seen = feed.where(F.col("updated_at") < F.lit(until))
    latest = dedup_latest(seen, ["customer_id"], "updated_at", ["seq"])
    return latest.where("customer_segment <> 'sme'").select("customer_id", "customer_segment", "balance", "updated_at")


@query("scd2_snapshot")
def _(spark, cat, sf):
    """Three snapshot runs: keys appear, change, vanish and return."""
    feed = cat.source("change_feed")
    first, *later = sql.SNAPSHOT_RUNS
    state = history.first_versions(_feed_state(feed, first), "customer_id")
    for run in later:
        state = history.apply_snapshot(state, _feed_state(feed, run), "customer_id", run)
    return state


@query("scd2_hard_delete")
def _(spark, cat, sf):
    tracked = typed_source(cat, "customers")
    everyone = tracked.select(*history.TRACKED_CUSTOMER_COLUMNS)
    live = tracked.where("deleted_at IS NULL").select(*history.TRACKED_CUSTOMER_COLUMNS)
    return history.apply_snapshot(history.first_versions(everyone, "customer_id"), live, "customer_id", AS_OF_TS)


@query("scd2_from_changes")
def _(spark, cat, sf):
    return history.history_from_changes(cat.source("change_feed"), "customer_id", "seq")


@query("as_of_lookup")
def _(spark, cat, sf):
    versions = history.history_from_changes(cat.source("change_feed"), "customer_id", "seq")
    held = history.as_of_lookup(versions, datetime(2024, 1, 15, 12))
    return held.select("customer_id", "customer_segment", "valid_from", "valid_to")


@query("as_of_join")
def _(spark, cat, sf):
    """Every transaction with the credit score that its customer had when it was made."""
    scores = dedup_latest(cat.source("credit_scores"), ["customer_id", "created_at"], "created_at", ["score_id"])
    scores = scores.select("customer_id", "score_id", "score_value", F.col("created_at").alias("scored_at"))
    made = cat.source("transactions").select("transaction_id", "customer_id", "transaction_at")
    return asof.as_of_join(made, scores, "customer_id", "transaction_at", "scored_at", ["score_id", "score_value", "scored_at"])


@query("as_of_join_history")
def _(spark, cat, sf):
    """Every change of a customer with the version that held one day before it."""
    feed = cat.source("change_feed")
    versions = history.history_from_changes(feed, "customer_id", "seq")
    facts = feed.select("seq", "customer_id", F.expr("updated_at - interval '1' day").alias("asked_at"))
    columns = ["customer_segment", "balance", "valid_from"]
    return asof.as_of_join(facts, versions, "customer_id", "asked_at", "valid_from", columns, "valid_to")


# ---- trailing days ------------------------------------------------------------------------------------


@query("rolling_horizons")
def _(spark, cat, sf):
    """Stored daily partials, folded 45 days ago, corrected for late rows and moved on to today."""
    done = typed_source(cat, "transactions").where("trim(lower(transaction_status)) = 'completed'")
    is_late, root, key = F.col("transaction_id") % 7 == 3, scratch(spark, "rolling"), "customer_id"
    for name, rows in (("on_time", done.where(~is_late)), ("late", done.where(is_late))):
        parts = rolling.daily_partials(rows, key, "transaction_date", "amount_idr")
        parts.repartition("day").write.partitionBy("day").parquet(f"{root}/arrived={name}")
    stored = spark.read.parquet(root)
    was = AS_OF - timedelta(days=45)
    state = rolling.fold(stored.where("arrived = 'on_time'"), key, was, marts.HORIZONS)
    state = rolling.absorb(state, stored.where("arrived = 'late'"), key, was, marts.HORIZONS)
    return rolling.slide(state, stored, key, was, AS_OF, marts.HORIZONS)


@query("distinct_from_daily_state")
def _(spark, cat, sf):
    """Monthly distinct customers and accounts a channel, from daily states alone."""
    ids = ["customer_id", "account_id"]
    rows = typed_source(cat, "transactions").select("transaction_date", "channel", *ids)
    root = scratch(spark, "distinct")
    rolling.distinct_state(rows, ["transaction_date", "channel"], ids).write.parquet(root)
    daily = spark.read.parquet(root).withColumn("month", F.date_trunc("MONTH", "transaction_date").cast("date"))
    return rolling.merged_distincts(daily, ["month", "channel"], ids)


# ---- quality ------------------------------------------------------------------------------------------

for _kind in (quality.NOT_NULL, quality.UNIQUE, quality.ACCEPTED, quality.RELATIONSHIP, quality.RANGE):
    query(f"dq_{_kind}", sql.check_counts([c for c in checks.ALL_CHECKS if c.kind == _kind and c.stage != "marts"]))(
        lambda spark, cat, sf, kind=_kind: quality.failure_counts(
            spark, cat, [c for c in checks.ALL_CHECKS if c.kind == kind and c.stage != "marts"]
        )
    )


@query("dq_no_negative_balance")
def _(spark, cat, sf):
    return quality.no_negative_balance(cat)


@query("dq_customer_360_complete")
def _(spark, cat, sf):
    """Checked against the mart of an earlier load that still had the customers deleted since."""
    bad = cat.source("customers").select("customer_id")
    missing = bad.join(cat.ref("stg_customers").select("customer_id"), "customer_id", "left_anti")
    clean = quality.customer_360_complete(cat)
    return missing.select("customer_id", F.lit("raw").alias("found_in")).unionByName(
        clean.select("customer_id", F.lit("mart").alias("found_in"))
    )


@query("dq_fraud_rate")
def _(spark, cat, sf):
    return quality.fraud_rate_out_of_bounds(cat)


@query("dq_rate_thresholds")
def _(spark, cat, sf):
    limits = cat.ctx.limits
    return union_all(
        [
            quality.rate_thresholds(cat.source(n), n, columns, key, limits)
            for n, (key, columns) in sql.RATED_TABLES.items()
        ]
    )


def _full_report(spark: SparkSession, cat: Catalog) -> DataFrame:
    """Staging models and marts are tested as the tables they were written to, and while they are written."""
    names = [*STAGING, *pipeline.LAYOUTS]
    known = pipeline.materialize(spark, cat, names, checks.ALL_CHECKS, scratch(spark, "report"))
    return quality.quality_report(spark, cat, checks.ALL_CHECKS, known)


@query("dq_unique_incremental")
def _(spark, cat, sf):
    """Customers with more than one change in a stored feed, counted by half and half."""
    feed = sinks.with_partition(cat.source("change_feed"), feeds.FEED_SPEC)
    root = scratch(spark, "unique")
    counts = KeyCounts(spark, f"{root}/feed", feeds.FEED_SPEC)
    for half in feeds.halves(feed):
        rows = ingest.window_filter(feed, "updated_at", half)
        rows.write.mode("append").partitionBy(sinks.PART).parquet(f"{root}/feed")
        counts.refresh()
    return counts.duplicated()


@query("dq_report")
def _(spark, cat, sf):
    return _full_report(spark, cat)


@query("dq_gate")
def _(spark, cat, sf):
    return quality.gate(quality.quality_report(spark, cat, [c for c in checks.ALL_CHECKS if c.stage != "marts"]))


@query("ddl_constraints", sql.check_counts(checks.DDL_CHECKS))
def _(spark, cat, sf):
    return quality.failure_counts(spark, cat, checks.DDL_CHECKS)


# ---- streaming ----------------------------------------------------------------------------------------


@query("stream_upsert")
def _(spark, cat, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").schema
    # A glob, because a stream over a plain path insists on a folder and the table may be a single file.
    stream = spark.readStream.schema(events).parquet(f"{sf}/{{events.parquet}}")
    mapping = testbed.MAPPINGS["change_feed"]
    changes = stream.selectExpr(*[f"{e} AS {c}" for c, e in mapping.cols.items()])
    root, table = scratch(spark, "stream"), f"stream_{uuid.uuid4().hex[:12]}"
    run = stream_upsert(changes, table, feeds.FEED_SPEC, f"{root}/table", f"{root}/checkpoint", ["seq"])
    run.awaitTermination()
    return spark.table(table).drop(sinks.PART)
