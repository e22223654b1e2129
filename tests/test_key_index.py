"""The index from key to partition: same tables as without it, and work that follows the batch, not the table."""

from __future__ import annotations

import glob
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import sinks
from ledgerloom.operators.merge import merge_upsert
from ledgerloom.sources.contracts import CORE, TableSpec

SPEC = TableSpec(CORE, "keys", "k", "k BIGINT NOT NULL, v STRING, t TIMESTAMP_NTZ", (), loaded_at="t", granularity="DAY")
SCHEMA = "k long, v string, t timestamp_ntz"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, datetime(2024, 1, 1) + timedelta(hours=h)) for k, v, h in rows], SCHEMA)


def content(df):
    return sorted(((r.k, r.v) for r in df.collect()), key=str)


@pytest.fixture
def place(spark, tmp_path):
    table = f"keyed_{os.path.basename(str(tmp_path)).replace('-', '_')}"
    yield table, str(tmp_path / "table")
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def indexed(path):
    return {os.path.relpath(f, f"{path}__index") for f in glob.glob(f"{path}__index/*/*/*.parquet")}


def check_index(spark, table, path):
    (root,) = glob.glob(f"{path}__index/of=*")
    index = spark.read.parquet(root).select("k", sinks.PART).collect()
    held = spark.table(table).select("k", sinks.PART).collect()
    assert sorted(map(tuple, index)) == sorted(map(tuple, held))


@pytest.mark.parametrize("seed", range(2))
def test_any_split_into_batches_gives_the_same_table(spark, place, seed):
    table, path = place
    rng = random.Random(seed)
    rows = [(rng.randrange(30), f"v{i}", rng.randrange(400)) for i in range(90)]
    at = sorted(rng.sample(range(90), 3))
    for batch in (rows[a:b] for a, b in zip([0, *at], [*at, 90])):
        sinks.merge_into_table(spark, frame(spark, batch), table, SPEC, path, ["v"], index_buckets=5)
        check_index(spark, table, path)
    whole = frame(spark, rows)
    assert content(spark.table(table)) == content(merge_upsert(whole.limit(0), whole, "k", "t", tie_break=["v"]))


def test_only_the_batch_s_buckets_and_partitions_are_opened(spark, place):
    """Every other file of the index and of the table is made unreadable: the merge does not notice."""
    table, path = place
    sinks.merge_into_table(spark, frame(spark, [(k, f"a{k}", 24 * (k % 20)) for k in range(400)]), table, SPEC, path, index_buckets=50)
    batch = frame(spark, [(41, "b", 24 * 30), (42, "old", 0)])  # a key that moves to a new day, and one that is older
    buckets = {r[0] for r in batch.select(F.pmod(F.xxhash64("k"), F.lit(50))).collect()}
    spared = {f"part_key=202401{d:02d}" for d in (2, 3, 1, 31)}
    for file in glob.glob(f"{path}__index/*/*/*.parquet") + glob.glob(f"{path}/*/*.parquet"):
        folder = os.path.basename(os.path.dirname(file))
        if folder not in spared and folder not in {f"{sinks.BUCKET}={b}" for b in buckets}:
            with open(file, "wb") as out:
                out.write(b"no parquet")
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}__index/*/*/*.parquet")}
    spark.catalog.refreshTable(table)
    sinks.merge_into_table(spark, batch, table, SPEC, path, index_buckets=50)
    found = spark.table(table).where(F.col(sinks.PART).isin(20240102, 20240103, 20240131))
    assert {41: "b", 42: "a42"}.items() <= dict(content(found)).items()
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}__index/*/*/*.parquet")}
    changed = {os.path.basename(os.path.dirname(f)) for f in before.keys() ^ after.keys()}
    assert changed == {f"{sinks.BUCKET}={b}" for b in buckets}


def test_interrupted_swap_moves_table_and_index_together(spark, place, monkeypatch):
    table, path = place
    sinks.merge_into_table(spark, frame(spark, [(k, "a", 24 * k) for k in range(6)]), table, SPEC, path, index_buckets=3)
    real, calls = sinks._move, []

    def dies_later(spark_, source, target):
        calls.append(source)
        if len(calls) == 4:
            raise ConnectionError
        real(spark_, source, target)

    monkeypatch.setattr(sinks, "_move", dies_later)
    with pytest.raises(ConnectionError):
        sinks.merge_into_table(spark, frame(spark, [(1, "b", 240), (7, "c", 2)]), table, SPEC, path, index_buckets=3)
    monkeypatch.setattr(sinks, "_move", real)
    sinks.merge_into_table(spark, frame(spark, [(8, "d", 3)]), table, SPEC, path, index_buckets=3)
    check_index(spark, table, path)
    assert content(spark.table(table)) == sorted([(0, "a"), (1, "b"), (2, "a"), (3, "a"), (4, "a"), (5, "a"), (7, "c"), (8, "d")])


def test_index_is_built_for_a_table_without_one_and_dropped_without_use(spark, place):
    table, path = place
    sinks.merge_into_table(spark, frame(spark, [(1, "a", 0), (2, "a", 30)]), table, SPEC, path)
    assert not indexed(path)
    sinks.merge_into_table(spark, frame(spark, [(1, "b", 50)]), table, SPEC, path, index_buckets=4)
    check_index(spark, table, path)
    sinks.merge_into_table(spark, frame(spark, [(2, "b", 60)]), table, SPEC, path, index_buckets=7)
    check_index(spark, table, path)
    assert all(f.startswith("of=7/") for f in indexed(path))
    sinks.merge_into_table(spark, frame(spark, [(3, "c", 60)]), table, SPEC, path)
    assert not indexed(path)
    assert content(spark.table(table)) == [(1, "b"), (2, "b"), (3, "c")]
