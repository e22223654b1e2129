from __future__ import annotations

import threading
from dataclasses import replace
from datetime import date, datetime, timedelta
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from helpers import CTX, mini, rows
from ledgerloom.catalog import Catalog
from ledgerloom.operators import sinks
from ledgerloom.operators.ingest import Window
from ledgerloom.operators.merge import merge_upsert
from ledgerloom.operators.quality import NOT_NULL, Check
from ledgerloom.plans import pipeline
from ledgerloom.plans.checks import ALL_CHECKS
from ledgerloom.sources import sources_from_path, sources_from_tables
from ledgerloom.sources.contracts import SPECS, TableSpec
from ledgerloom.streaming import stream_upsert
from test_models import customer_world

T0 = datetime(2024, 1, 15)
SPEC = TableSpec(
    "core_banking", "things", "k", "k BIGINT NOT NULL, v STRING, t TIMESTAMP_NTZ", ("v",), loaded_at="t"
)


def frame(spark, *tuples):
    data = [(k, v, None if d is None else T0 + timedelta(days=d)) for k, v, d in tuples]
    return spark.createDataFrame(data, "k bigint, v string, t timestamp_ntz")


def content(df):
    return sorted(((r.k, r.v) for r in df.collect()), key=str)


@pytest.fixture
def place(spark, tmp_path, request):
    name = "t_" + tmp_path.name.replace("-", "_").replace("[", "_").replace("]", "_")
    return name, str(tmp_path / "table")


def stored_parts(path):
    import os

    return sorted(d for d in os.listdir(path) if d.startswith("part_key="))


def test_persistent_merge(spark, place):
    table, path = place
    first = frame(spark, (1, "a", 0), (2, "b", 0), (3, "c", 40), (4, "no time", None))
    assert sinks.merge_into_table(spark, first, table, SPEC, path) == "created"
    assert stored_parts(path) == ["part_key=0", "part_key=202401", "part_key=202402"]
    before = {p: sorted(f.name for f in Path(path, p).iterdir()) for p in stored_parts(path)}
    # Both January rows move on; February is rewritten; the undated partition is not touched.
    second = frame(spark, (1, "a2", 30), (2, "b2", 60), (5, "new", 61), (3, "older", 39))
    assert sinks.merge_into_table(spark, second, table, SPEC, path) == "no_changes"
    want = [(1, "a2"), (2, "b2"), (3, "c"), (4, "no time"), (5, "new")]
    assert content(spark.table(table)) == want
    assert content(merge_upsert(first, second, "k", "t")) == want
    assert stored_parts(path) == ["part_key=0", "part_key=202402", "part_key=202403"]
    untouched = sorted(f.name for f in Path(path, "part_key=0").iterdir())
    assert untouched == before["part_key=0"]
    # A retry, and an empty increment, change nothing; a new column is added and back-filled with null.
    sinks.merge_into_table(spark, second, table, SPEC, path)
    sinks.merge_into_table(spark, second.limit(0), table, SPEC, path)
    assert content(spark.table(table)) == want
    wider = frame(spark, (6, "x", 61)).withColumn("extra", F.lit(1))
    assert sinks.merge_into_table(spark, wider, table, SPEC, path) == "added:extra"
    assert {r.k: r.extra for r in spark.table(table).collect()} == {1: None, 2: None, 3: None, 4: None, 5: None, 6: 1}
    assert not sinks.path_exists(spark, f"{path}__stage")


def test_merged_partitions_are_laid_out_as_written_ones(spark, place, tmp_path):
    """The swap moves folders, so a merged partition has the files and the order of a clustered write."""
    table, path = place
    old = frame(spark, *[(i, f"v{i % 7}", i % 20) for i in range(200)])
    new = frame(spark, *[(i, f"w{i % 5}", 20 + i % 9) for i in range(100, 300)])
    sinks.merge_into_table(spark, old, table, SPEC, path)
    first = set(stored_parts(path))
    sinks.merge_into_table(spark, new, table, SPEC, path)
    alone = str(tmp_path / "alone")
    sinks.write_raw(merge_upsert(old, new, "k", "t"), SPEC, alone)
    assert stored_parts(path) == stored_parts(alone)
    for part in stored_parts(path):
        files = [sorted(Path(p, part).glob("*.parquet")) for p in (path, alone)]
        assert len(files[0]) == len(files[1])
        for a, b in zip(*files):
            rows = [[r.v for r in spark.read.parquet(str(f)).collect()] for f in (a, b)]
            assert rows[0] == sorted(rows[0]) and rows[0] == rows[1]
    # What was replaced stays aside until the next merge.
    assert set(stored_parts(f"{path}__old")) <= first and stored_parts(f"{path}__old")


def test_swap_goes_on_where_it_stopped(spark, place, monkeypatch):
    table, path = place
    sinks.merge_into_table(spark, frame(spark, (1, "a", 0), (2, "b", 40), (3, "c", 80)), table, SPEC, path)
    real, calls = sinks._move, []

    def dies_in_the_middle(*args):
        calls.append(args)
        if len(calls) == 4:
            raise ConnectionError("driver lost")
        real(*args)

    monkeypatch.setattr(sinks, "_move", dies_in_the_middle)
    with pytest.raises(ConnectionError):
        sinks.merge_into_table(spark, frame(spark, (1, "a2", 1), (2, "b2", 41), (3, "c2", 81)), table, SPEC, path)
    monkeypatch.setattr(sinks, "_move", real)
    sinks.merge_into_table(spark, frame(spark, (4, "d", 0)), table, SPEC, path)
    assert content(spark.table(table)) == [(1, "a2"), (2, "b2"), (3, "c2"), (4, "d")]


def test_merge_recovers_from_a_lost_driver(spark, place, monkeypatch):
    table, path = place
    sinks.merge_into_table(spark, frame(spark, (1, "a", 0), (2, "b", 40)), table, SPEC, path)
    increment = frame(spark, (1, "a2", 45))
    real = sinks._finish_swap
    calls = []

    def dies_before_the_swap(*args):
        calls.append(args)
        if len(calls) == 2:
            raise ConnectionError("driver lost")
        return real(*args)

    monkeypatch.setattr(sinks, "_finish_swap", dies_before_the_swap)
    with pytest.raises(ConnectionError):
        sinks.merge_into_table(spark, increment, table, SPEC, path)
    monkeypatch.setattr(sinks, "_finish_swap", real)
    assert content(spark.table(table)) == [(1, "a"), (2, "b")]
    assert sinks.path_exists(spark, f"{path}__stage/ready/_SUCCESS")
    # The next merge first completes the interrupted one.
    sinks.merge_into_table(spark, frame(spark, (3, "c", 50)), table, SPEC, path)
    assert content(spark.table(table)) == [(1, "a2"), (2, "b"), (3, "c")]
    assert stored_parts(path) == ["part_key=202402", "part_key=202403"]
    # A table whose catalog entry is lost is found again by its files.
    spark.sql(f"DROP TABLE {table}")
    sinks.merge_into_table(spark, frame(spark, (4, "d", 50)), table, SPEC, path)
    assert content(spark.table(table)) == [(1, "a2"), (2, "b"), (3, "c"), (4, "d")]


def test_empty_table_is_found_again(spark, place):
    table, path = place
    sinks.merge_into_table(spark, frame(spark, (1, "a", 0)).limit(0), table, SPEC, path)
    spark.sql(f"DROP TABLE {table}")
    assert sinks.merge_into_table(spark, frame(spark, (1, "a", 0)), table, SPEC, path) == "no_changes"
    assert content(spark.table(table)) == [(1, "a")]


def test_stream_equals_batch(spark, place, tmp_path):
    table, path = place
    changes = [frame(spark, *[(i % 4, f"v{n}.{i}", (i * 7 + n) % 90) for i in range(6)]) for n in range(3)]
    source = str(tmp_path / "in")
    for df in changes:
        df.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(changes[0].schema).option("maxFilesPerTrigger", 1).parquet(source)
    run = stream_upsert(stream, table, SPEC, path, str(tmp_path / "cp"), ["v"])
    run.awaitTermination()
    whole = changes[0].unionByName(changes[1]).unionByName(changes[2])
    batch = merge_upsert(whole.limit(0), whole, "k", "t", tie_break=["v"])
    assert content(spark.table(table)) == content(batch)
    # More changes arrive: the stream goes on from its checkpoint.
    frame(spark, (9, "late", 1)).coalesce(1).write.mode("append").parquet(source)
    stream_upsert(stream, table, SPEC, path, str(tmp_path / "cp"), ["v"]).awaitTermination()
    spark.catalog.refreshTable(table)  # the stream writes in a session of its own
    assert content(spark.table(table)) == sorted([*content(batch), (9, "late")], key=str)


def test_staged_folder_is_removed(spark, tmp_path):
    with pytest.raises(RuntimeError), sinks.staged(spark, str(tmp_path)) as stage:
        spark.range(3).write.parquet(stage)
        assert sinks.path_exists(spark, stage)
        raise RuntimeError
    assert not sinks.path_exists(spark, stage)


def test_scratch_root_follows_the_cluster():
    def session(master, shared=None):
        said = {"spark.checkpoint.dir": shared, "spark.sql.warehouse.dir": "file:/w/house/"}
        conf = SimpleNamespace(get=lambda key, default: said.get(key) or default)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert sinks.scratch_root(session("yarn", "hdfs://x/shared/")) == "hdfs://x/shared"
    assert sinks.scratch_root(session("local[4]", "/shared")) == "/shared"
    assert sinks.scratch_root(session("local[4]")) == "file:/w/house/_scratch"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        sinks.scratch_root(session("yarn"))


def test_daily_snapshots_accumulate(spark, tmp_path):
    df = spark.range(4).withColumn("d", F.lit(date(2024, 1, 1)))
    path = str(tmp_path / "m")
    for day in (date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 2)):
        sinks.write_clustered(df.withColumn("d", F.lit(day)), path, ["d"], ["id"], daily_snapshot=True)
    assert spark.read.parquet(path).count() == 8
    sinks.write_clustered(df, path, ["d"], ["id"])
    assert spark.read.parquet(path).count() == 4


def test_rebuild_keeps_the_table_until_the_new_one_is_whole(spark, tmp_path):
    sinks.ensure_schema(spark, "rebuilt", str(tmp_path))
    path, name = str(tmp_path / "m"), "rebuilt.m"
    for n in (3, 5):
        sinks.rebuild_table(spark.range(n).withColumn("d", F.lit(1)), name, path, ["d"], ["id"])
        assert spark.table(name).count() == n
    broken = spark.range(9).withColumn("d", F.raise_error(F.lit("bad row")))
    with pytest.raises(Exception, match="bad row"):
        sinks.rebuild_table(broken, name, path, (), ["id"])
    assert spark.table(name).count() == 5
    assert len(list(Path(path).glob("m__b*/_SUCCESS"))) == 2
    # A run may read the table it replaces.
    sinks.rebuild_table(spark.table(name).where("id < 2"), name, path)
    assert spark.table(name).count() == 2
    assert len(list(Path(path).glob("m__b*"))) == 2  # the one shown, and the one before for readers still on it


def test_partition_pruning(spark, tmp_path):
    path = str(tmp_path / "raw")
    sinks.write_raw(frame(spark, (1, "a", 0), (2, "b", 40)), SPEC, path)
    plan = spark.read.parquet(path).where("part_key = 202401")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_key" in plan


def test_ingest_tables_and_backfill(spark, bed, tmp_path):
    whole = Window(datetime(1994, 1, 1), datetime(2002, 1, 1))
    names = ("customers", "branches", "product_types")
    specs = [SPECS[n] for n in names]
    got = pipeline.ingest_tables(spark, specs, bed.source, whole, "raw_one", str(tmp_path), parallel=3)
    assert got == dict.fromkeys(names, "created")
    windows = Window(datetime(1994, 1, 1), datetime(2003, 1, 1)).split("month")[::30]
    starts = [w.start for w in windows] + [datetime(2002, 1, 1)]
    spans = [Window(a, b) for a, b in zip(starts, starts[1:])]
    pipeline.backfill(spark, SPECS["customers"], bed.source("customers"), spans, "raw_two", str(tmp_path))
    one, two = spark.table("raw_one.customers"), spark.table("raw_two.customers")
    assert one.exceptAll(two.select(one.columns)).count() == 0 and one.count() == two.count() == 150


def test_all_thirteen_tables_can_be_ingested(spark, bed, tmp_path):
    whole = Window(datetime(1994, 1, 1), datetime(2002, 1, 1))
    got = pipeline.ingest_tables(spark, list(SPECS.values()), bed.source, whole, "raw_all", str(tmp_path))
    assert len(got) == 13 and set(got.values()) == {"created"}
    systems = {"core_banking": "raw_all", "transactions": "raw_all"}
    stored = Catalog(sources_from_tables(spark, systems), bed.ctx)
    for mart in ("mart_customer_360", "mart_fraud_analytics", "mart_transaction_analytics"):
        mine, theirs = stored.ref(mart), bed.ref(mart)
        assert mine.exceptAll(theirs).count() == 0 and mine.count() == theirs.count(), mart


def test_pipeline_runs(spark, tmp_path):
    cat = customer_world(spark, CTX)
    with pytest.raises(pipeline.PipelineBlocked, match="stale sources"):
        pipeline.run_pipeline(spark, cat, str(tmp_path / "w1"))
    with pytest.raises(pipeline.PipelineBlocked, match="staging tests failed"):
        pipeline.run_pipeline(spark, cat, str(tmp_path / "w2"), gates=("staging",))
    done = pipeline.run_pipeline(spark, customer_world(spark, CTX), str(tmp_path / "w3"), gates=())
    assert len(done["views"]) == 9 and len(done["tables"]) == 5
    assert spark.sql("SELECT count(*) FROM stg_customers").first()[0] == 4
    assert spark.table("dev_marts_customer.mart_customer_360").count() == 4
    assert spark.table("dev_snapshots.snap_customers").where("valid_to IS NULL").count() == 4
    assert done["staging"].count() == len([c for c in ALL_CHECKS if c.stage == "staging"]) + 2
    assert done["marts"].where("test = 'not_null' AND column_name = 'is_dormant'").first().failures == 1
    kept = spark.read.parquet(done["failures"]["not_null_mart_customer_360_is_dormant"])
    assert [r.customer_id for r in kept.collect()] == [2]


def snapshot_world(spark, day, *customers):
    ctx = replace(CTX, as_of=day, as_of_ts=None, env="ci")
    return mini(spark, ctx, customers=rows(spark, "customers", *customers))


def customer(i, day, **more):
    return {"customer_id": i, "updated_at": datetime(2024, 1, day)} | more


def test_customer_snapshot_runs(spark, tmp_path, monkeypatch):
    w = str(tmp_path)
    run = lambda *args: pipeline.snapshot_customers(spark, snapshot_world(spark, *args), w)
    history = lambda: {
        (r.customer_id, r.valid_from.day, r.valid_to and (r.valid_to.month, r.valid_to.day))
        for r in spark.table("ci_snapshots.snap_customers").collect()
    }
    run(date(2024, 2, 1), customer(1, 1), customer(2, 1))
    assert history() == {(1, 1, None), (2, 1, None)}
    later = (date(2024, 2, 2), customer(1, 5, customer_segment="sme"), customer(2, 1, deleted_at=datetime(2024, 2, 1)))
    # The driver dies after the files are written and before the view moves.
    real = sinks._register_partitions
    monkeypatch.setattr(sinks, "_register_partitions", lambda *a: (_ for _ in ()).throw(ConnectionError()))
    with pytest.raises(ConnectionError):
        run(*later)
    monkeypatch.setattr(sinks, "_register_partitions", real)
    assert history() == {(1, 1, None), (2, 1, None)}
    want = {(1, 1, (1, 5)), (1, 5, None), (2, 1, (2, 2))}
    for _ in range(3):  # repeated runs change nothing
        run(*later)
        assert history() == want and spark.table("ci_snapshots.snap_customers").count() == 3
    run(date(2024, 2, 3), customer(1, 5), customer(2, 1))  # 2 is back, with its old time
    assert history() == want | {(2, 1, None)}
    spark.sql("DROP VIEW ci_snapshots.snap_customers")
    with pytest.raises(RuntimeError, match="restore it first"):
        run(*later)


def test_row_level_merge_needs_a_capable_format(spark, place):
    table, path = place
    frame(spark, (1, "a", 0)).write.option("path", path).saveAsTable(table)
    with pytest.raises(UnsupportedOperationException, match="MERGE INTO TABLE"):
        sinks.merge_into_row_level_table(spark, frame(spark, (1, "b", 1)), table, SPEC)


def test_catalog_from_stored_tables(spark, tmp_path, bed):
    schema, whole = "raw_cat", Window(datetime(1990, 1, 1), datetime(2010, 1, 1))
    core = [s for s in SPECS.values() if s.system == "core_banking"]
    pipeline.ingest_tables(spark, core, bed.source, whole, schema, str(tmp_path))
    cat = Catalog(sources_from_tables(spark, {"core_banking": schema}), bed.ctx)
    mine, theirs = cat.ref("stg_customers"), bed.ref("stg_customers")
    assert mine.exceptAll(theirs).count() == 0 and mine.count() == theirs.count()
    with pytest.raises(KeyError, match="no source named 'transactions'"):
        cat.ref("stg_transactions")
    bed.source("merchants").write.parquet(str(tmp_path / "merchants.parquet"))
    files = Catalog(sources_from_path(spark, str(tmp_path)), bed.ctx)
    assert files.source("merchants").count() == bed.source("merchants").count()


def test_independent_models_are_written_side_by_side(spark, tmp_path):
    """Two staging models wait for each other, then two domains of marts, which find staging written; checks are counted."""
    waits = {"staging": threading.Barrier(2, timeout=60), "marts": threading.Barrier(2, timeout=60)}

    def model(name, stage):
        def make(cat):
            waits[stage].wait()
            df = cat.ref("stg_a").unionByName(cat.ref("stg_b")) if stage == "marts" else spark.range(4).select(F.when(F.col("id") > 0, F.col("id")).alias("id"))
            return df.select("id", *(F.lit("x").alias(c) for c in layout(name)))

        return make

    def layout(name):
        return pipeline.LAYOUTS[name].cluster_by if name in pipeline.LAYOUTS else ()

    staging, marts = ["stg_a", "stg_b"], ["mart_fraud_analytics", "mart_transaction_analytics"]
    models = {n: model(n, "staging") for n in staging} | {n: model(n, "marts") for n in marts}
    suite = [Check("x", n, "id", NOT_NULL) for n in models]
    known = pipeline.materialize(spark, Catalog({}, CTX, models), [*staging, *marts], suite, str(tmp_path))
    assert [known[c] for c in suite] == [1, 1, 2, 2]
