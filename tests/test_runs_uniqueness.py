"""What is kept beside stored tables: finished windows, leases on staging folders, counts of values."""

from __future__ import annotations

import glob
import os
import random
import time
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import sinks
from ledgerloom.operators.ingest import Window
from ledgerloom.operators.runs import RunLedger, joined
from ledgerloom.operators.uniqueness import KeyCounts
from ledgerloom.plans import pipeline
from ledgerloom.sources.contracts import CORE, TableSpec

SPEC = TableSpec(CORE, "keys", "k", "k BIGINT NOT NULL, v STRING, t TIMESTAMP_NTZ", (), loaded_at="t", granularity="DAY")
SCHEMA = "k long, v string, t timestamp_ntz"
DAY = datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame([(k, v, DAY + timedelta(hours=h)) for k, v, h in rows], SCHEMA)


def days(*numbers):
    return [Window(DAY + timedelta(days=a), DAY + timedelta(days=b)) for a, b in numbers]


# ---- finished windows ---------------------------------------------------------------------------------


def test_left_is_what_no_finished_window_covers(spark, tmp_path):
    for seed in range(3):
        rng = random.Random(seed)
        ledger = RunLedger(spark, f"{tmp_path}/t{seed}")
        assert ledger.done() == [] and ledger.watermark() is None
        covered = set()
        for _ in range(4):
            a = rng.randrange(20)
            b = a + rng.randrange(1, 6)
            ledger.mark(*days((a, b)))
            covered |= set(range(a, b))
        (asked,) = days((3, 22))
        rest = {d for w in ledger.left(asked) for d in range((w.start - DAY).days, (w.end - DAY).days)}
        assert rest == set(range(3, 22)) - covered and joined(ledger.left(asked)) == ledger.left(asked)
        first = min(covered)
        assert ledger.watermark() == DAY + timedelta(days=next(d for d in range(first, 40) if d not in covered))


def test_killed_backfill_goes_on_where_it_was(spark, tmp_path, monkeypatch):
    rows = [(i % 17, f"v{i}", i) for i in range(120)]
    source, windows = frame(spark, rows), days((0, 1), (1, 2), (2, 3), (3, 5))
    schema, loaded = f"runs_{uuid.uuid4().hex[:8]}", []
    real = pipeline.ingest_table

    def killed(spark, spec, source, window, *rest):
        if len(loaded) == 2:
            raise InterruptedError("the driver is lost")
        loaded.append(window)
        return real(spark, spec, source, window, *rest)

    monkeypatch.setattr(pipeline, "ingest_table", killed)
    with pytest.raises(InterruptedError):
        pipeline.backfill(spark, SPEC, source, windows, schema, str(tmp_path), ["v"])
    ledger = RunLedger(spark, f"{tmp_path}/{schema}/keys")
    assert loaded == windows[:2] and ledger.watermark() == windows[1].end

    monkeypatch.setattr(pipeline, "ingest_table", lambda *a: loaded.append(a[3]) or real(*a))
    said = pipeline.backfill(spark, SPEC, source, windows, schema, str(tmp_path), ["v"], resume=True)
    assert said[:2] == ["skipped"] * 2 and loaded == windows
    newest = {k: v for k, v, _ in rows}
    assert {r.k: r.v for r in spark.table(f"{schema}.keys").collect()} == newest
    assert pipeline.backfill(spark, SPEC, source, windows, schema, str(tmp_path), ["v"], resume=True) == ["skipped"] * 4
    assert loaded == windows
    # Wider windows: only what is new is loaded. Without resume all is, and nothing changes.
    wide = days((0, 7))
    pipeline.backfill(spark, SPEC, source, wide, schema, str(tmp_path), ["v"], resume=True)
    assert loaded[4:] == days((5, 7))
    pipeline.backfill(spark, SPEC, source, wide, schema, str(tmp_path), ["v"])
    assert loaded[5:] == wide and {r.k: r.v for r in spark.table(f"{schema}.keys").collect()} == newest
    # The marks of a table that is gone do not count.
    spark.sql(f"DROP TABLE {schema}.keys")
    sinks.remove_path(spark, f"{tmp_path}/{schema}/keys")
    pipeline.backfill(spark, SPEC, source, wide, schema, str(tmp_path), ["v"], resume=True)
    assert loaded[6:] == wide and spark.table(f"{schema}.keys").count() == 17


# ---- leases -------------------------------------------------------------------------------------------


def test_only_abandoned_folders_are_collected(spark, tmp_path):
    root = str(tmp_path)
    assert sinks.collect_orphans(spark, f"{root}/missing") == []
    lost, live = sinks.Lease(spark, f"{root}/staged-lost", 1), sinks.Lease(spark, f"{root}/staged-live", 1)
    empty = sinks.Lease(spark, f"{root}/staged-empty", 0)  # its driver was lost before it wrote
    for name in ("staged-lost", "staged-live", "unleased"):
        spark.range(3).write.parquet(f"{root}/{name}")
    assert sinks.collect_orphans(spark, root) in ([], ["staged-empty"])
    for lease in (lost, empty):
        lease.stop()
    time.sleep(2)
    sinks.collect_orphans(spark, root)
    assert sorted(n for n in os.listdir(root) if not n.startswith(".")) == ["staged-live", "staged-live.lease-1", "unleased"]
    assert spark.read.parquet(f"{root}/staged-live").count() == 3
    live.end()
    assert sinks.collect_orphans(spark, root) == [] and not glob.glob(f"{root}/*.lease-*")


def test_staging_folder_and_its_lease_go_together(spark, tmp_path):
    with sinks.staged(spark, str(tmp_path)) as stage:
        assert len(glob.glob(f"{tmp_path}/*.lease-*")) == 1
        spark.range(3).write.parquet(stage)
        assert sinks.collect_orphans(spark, str(tmp_path)) == [] and sinks.path_exists(spark, stage)
    assert not [n for n in os.listdir(tmp_path) if not n.startswith(".")]


# ---- counts of values ---------------------------------------------------------------------------------


def store(spark, rows, path, mode="append"):
    out = sinks.with_partition(frame(spark, rows), SPEC).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    out.partitionBy(sinks.PART).parquet(path)


def check_counts(spark, counts, path, column="k"):
    table = spark.read.parquet(path).where(F.col(column).isNotNull())
    want = {r[0]: r["count"] for r in table.groupBy(column).count().collect()}
    assert {r[0]: r.n for r in counts.counts().collect()} == want
    assert {r[0]: r.n_records for r in counts.duplicated().collect()} == {k: n for k, n in want.items() if n > 1}


@pytest.mark.parametrize("column", ["k", "v"])
def test_counts_follow_any_change(spark, tmp_path, column):
    rng, path = random.Random(5), str(tmp_path / "t")
    counts = KeyCounts(spark, path, SPEC, column, buckets=4)
    assert counts.refresh() == ([], []) and counts.duplicated().count() == 0
    hot = [(1, None, h) for h in range(0, 96, 3)]  # one key with a third of all rows
    store(spark, hot + [(rng.randrange(40), f"w{rng.randrange(9)}", rng.randrange(96)) for _ in range(64)], path)
    assert len(counts.refresh()[0]) == 4
    check_counts(spark, counts, path, column)
    for step in range(3):
        mode = ("append", "overwrite")[step % 2]  # rows more, and partitions replaced
        store(spark, [(rng.randrange(40), f"w{rng.randrange(9)}", 24 * step + h) for h in range(5)], path, mode)
        read, _ = counts.refresh()
        assert len(read) == 1
        check_counts(spark, counts, path, column)
    assert counts.refresh() == ([], [])
    gone = sorted(glob.glob(f"{path}/{sinks.PART}=*"))[0]
    sinks.remove_path(spark, gone)
    assert counts.refresh()[0] == []
    check_counts(spark, counts, path, column)


def test_untouched_partitions_and_buckets_are_not_opened(spark, tmp_path):
    path = str(tmp_path / "t")
    counts = KeyCounts(spark, path, SPEC, buckets=16)
    store(spark, [(k, "x", 24 * (k % 5)) for k in range(200)], path)
    counts.refresh()
    for file in glob.glob(f"{path}/*/*.parquet"):  # unreadable, without a change of time, number or length
        with open(file, "r+b") as f:
            f.write(b"\0" * os.path.getsize(file))
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{counts.root}/buckets/*/*/*.parquet")}
    store(spark, [(7, "y", 24 * 30), (1000, "y", 24 * 30)], path)
    read, touched = counts.refresh()
    assert len(read) == 1 and 1 <= len(touched) <= 2
    assert [r.k for r in counts.duplicated().collect()] == [7]
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{counts.root}/buckets/*/*/*.parquet")}
    assert before.items() <= after.items() and 1 <= len(after) - len(before) <= 2


def test_lost_driver_leaves_the_counts_before(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    counts = KeyCounts(spark, path, SPEC, buckets=4)
    store(spark, [(k, "x", k) for k in range(40)], path)
    counts.refresh()
    store(spark, [(k, "z", 2) for k in range(5)], path)
    with monkeypatch.context() as m:
        m.setattr(spark, "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(InterruptedError()))
        with pytest.raises(InterruptedError):
            counts.refresh()
    assert counts.duplicated().count() == 0
    again = KeyCounts(spark, path, SPEC, buckets=4)
    assert len(again.refresh()[0]) == 1
    check_counts(spark, again, path)


def test_counts_of_a_merged_table(spark, tmp_path):
    table, path = f"merged_{uuid.uuid4().hex[:8]}", str(tmp_path / "t")
    counts = KeyCounts(spark, path, SPEC, buckets=4)
    for batch in ([(k, "a", k) for k in range(50)], [(k, "b", 60 + k) for k in range(0, 9)], [(3, "c", 400)]):
        sinks.merge_into_table(spark, frame(spark, batch), table, SPEC, path, ["v"])
        counts.refresh()
        check_counts(spark, counts, path)
        assert counts.duplicated().count() == 0
    spark.sql(f"DROP TABLE {table}")
