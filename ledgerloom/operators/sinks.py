"""Writing tables: layout, staging areas, and the persistent merge."""

from __future__ import annotations

import atexit
import re
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from ledgerloom.functions import partition_key
from ledgerloom.operators.history import apply_snapshot, first_versions
from ledgerloom.operators.ingest import added_columns
from ledgerloom.operators.merge import merge_upsert
from ledgerloom.operators.ranking import dedup_latest
from ledgerloom.sources.contracts import TableSpec

PART = "part_key"
BUCKET = "index_bucket"


def ensure_schema(spark: SparkSession, schema: str, warehouse: str) -> None:
    """Create a namespace that lives in the given warehouse folder."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{warehouse}/{schema}'")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``; in local mode else one in the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse").rstrip("/") + "/_scratch"


#: Seconds after its last renewal for which a lease holds; a live driver renews it four times in that span.
TERM = 86_400
_LEASE = re.compile(r"([^.].*)\.lease-(\d+)")
_SCRATCH: dict[str, str] = {}


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the application's own one, which goes when the driver's process ends.

    A query's rows are read after it has returned, so it cannot remove the folder itself. The folder is leased: if the
    driver is lost, a later application's first call removes it.
    """
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        collect_orphans(spark)
        _SCRATCH[app] = f"{scratch_root(spark)}/ledgerloom-{app}"
        lease = Lease(spark, _SCRATCH[app])
        fs, folder = _fs(spark, _SCRATCH[app])
        atexit.register(_remove_quietly, fs, folder, lease)
    return f"{_SCRATCH[app]}/{label}-{uuid.uuid4().hex[:12]}"


def _remove_quietly(fs, folder, lease: Lease) -> None:
    try:
        fs.delete(folder, True)
        lease.end()
    except Exception:  # noqa: BLE001  the JVM may be gone already; then the lease runs out
        lease.stop()


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, none if it is missing."""
    fs, p = _fs(spark, path)
    return [c.getPath().getName() for c in fs.listStatus(p)] if fs.exists(p) else []


def subfolders(spark: SparkSession, path: str, label: str) -> list[int]:
    """The numbers of the folders ``label=number`` in a folder."""
    found = [n.removeprefix(f"{label}=") for n in children(spark, path) if n.startswith(f"{label}=")]
    return sorted(int(n) for n in found)


def folder_print(spark: SparkSession, path: str) -> str:
    """Changes when files of a folder are replaced, added or removed: its time, and number and length of its files."""
    fs, p = _fs(spark, path)
    held = fs.getContentSummary(p)
    return f"{fs.getFileStatus(p).getModificationTime()}:{held.getFileCount()}:{held.getLength()}"


def touch(spark: SparkSession, path: str) -> int:
    """Write an empty file; returns its time by the file system's clock, in milliseconds."""
    fs, p = _fs(spark, path)
    fs.create(p, True).close()
    return fs.getFileStatus(p).getModificationTime()


class Lease:
    """A mark beside a folder that says it is in use: a file whose time a thread of the driver renews.

    It holds for ``term`` seconds after the last renewal. Times are the file system's, not a machine's.
    """

    def __init__(self, spark: SparkSession, folder: str, term: int = TERM) -> None:
        self.spark, self.file = spark, f"{folder}.lease-{term}"
        touch(spark, self.file)
        self._over = threading.Event()
        self._thread = threading.Thread(target=self._renew, args=(max(term, 1) / 4,), daemon=True)
        self._thread.start()

    def _renew(self, every: float) -> None:
        while not self._over.wait(every):
            try:
                touch(self.spark, self.file)
            except Exception:  # noqa: BLE001  a storage fault may pass before the term ends; the next turn tries again
                continue

    def stop(self) -> None:
        """Renew no more; the lease runs out."""
        self._over.set()
        self._thread.join()

    def end(self) -> None:
        self.stop()
        remove_path(self.spark, self.file)


def collect_orphans(spark: SparkSession, root: str | None = None) -> list[str]:
    """Remove the folders below ``root`` whose lease has run out: their driver was lost. Returns their names.

    Folders without a lease are not touched, nor those of drivers that still renew theirs.
    """
    root = root or scratch_root(spark)
    leases = [m for m in map(_LEASE.fullmatch, children(spark, root)) if m]
    if not leases:
        return []
    probe = f"{root}/.clock-{uuid.uuid4().hex}"
    now = touch(spark, probe)
    remove_path(spark, probe)
    gone = []
    for found in leases:
        fs, file = _fs(spark, f"{root}/{found[0]}")
        if fs.exists(file) and now - fs.getFileStatus(file).getModificationTime() > 1000 * int(found[2]):
            remove_path(spark, f"{root}/{found[1]}")  # before its lease, so that a lost collector is followed by another
            fs.delete(file, False)
            gone.append(found[1])
    return gone


@contextmanager
def staged(spark: SparkSession, root: str | None = None, term: int = TERM) -> Iterator[str]:
    """A private staging folder that is removed afterwards, also when the work in it failed.

    It is leased, so that ``collect_orphans`` removes what a lost driver leaves.
    """
    path = f"{root or scratch_root(spark)}/staged-{uuid.uuid4().hex}"
    lease = Lease(spark, path, term)
    try:
        yield path
    finally:
        remove_path(spark, path)
        lease.end()


def cluster_rows(
    df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str], one_partition: bool = False
) -> DataFrame:
    """Lay rows out for writing: few files per partition, each sorted by the cluster columns.

    Rows are gathered by partition value, so a partition is written by one task, not by all of them.
    REBALANCE lets adaptive execution split a value that is too large for one task and merge small ones.
    When all rows share one partition value they are gathered by the cluster columns instead.
    """
    balance = cluster_by if one_partition or not partition_by else partition_by
    if not balance:
        return df
    hint = f"REBALANCE({', '.join(balance)})"
    balanced = df.sparkSession.sql(f"SELECT /*+ {hint} */ * FROM {{df}}", df=df)
    return balanced.sortWithinPartitions(*dict.fromkeys([*partition_by, *cluster_by]))


def write_clustered(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    *,
    daily_snapshot: bool = False,
    table: str | None = None,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write parquet, partitioned and clustered, replacing what is there.

    A ``daily_snapshot`` holds one partition value and replaces only that partition, so that the earlier
    days stay. ``watch`` sees the rows in the stage that writes them, after the last shuffle: what it observes is
    counted once for each written task, also when an executor is lost and earlier stages run again.
    """
    spark = df.sparkSession
    mode = "dynamic" if daily_snapshot else "static"
    laid_out = cluster_rows(df, partition_by, cluster_by, daily_snapshot)
    writer = (
        (watch(laid_out) if watch else laid_out)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*partition_by)
    )
    if table is None:
        writer.parquet(path)
    elif not daily_snapshot or not spark.catalog.tableExists(table):
        writer.option("path", path).format("parquet").saveAsTable(table)
    else:
        writer.parquet(path)
        _register_partitions(spark, table)


def rebuild_table(
    df: DataFrame,
    name: str,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Replace a whole table without a moment in which it is missing or half written.

    The new build is a table of its own; a view takes the name over once the build is complete. The build before it
    stays for readers still on it; earlier ones, also abandoned ones, are removed.
    """
    spark = df.sparkSession
    shown = _shown_build(spark, name)
    build = f"{name.rpartition('.')[2]}__b{uuid.uuid4().hex[:12]}"
    schema = name.rpartition(".")[0]
    full = f"{schema}.{build}" if schema else build
    write_clustered(df, f"{path}/{build}", partition_by, cluster_by, table=full, watch=watch)
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('build' = '{build}') AS SELECT * FROM {full}")
    prefix = build.rpartition("__b")[0] + "__b"
    fs, folder = _fs(spark, path)
    for child in fs.listStatus(folder):
        old = child.getPath().getName()
        if old.startswith(prefix) and old not in (build, shown):
            spark.sql(f"DROP TABLE IF EXISTS {schema + '.' if schema else ''}{old}")
            fs.delete(child.getPath(), True)


def _shown_build(spark: SparkSession, view: str) -> str | None:
    """The build that the view shows now."""
    if not spark.catalog.tableExists(view):
        return None
    said = spark.sql(f"SHOW TBLPROPERTIES {view}").where("key = 'build'").first()
    return said["value"] if said else None


def with_partition(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the raw table's partition value, by month or day of its load time; 0 where that is null."""
    value = partition_key(F.to_date(spec.loaded_at), spec.granularity)
    return df.withColumn(PART, F.coalesce(value, F.lit(0)))


def write_raw(df: DataFrame, spec: TableSpec, path: str, table: str | None = None) -> None:
    write_clustered(with_partition(df, spec), path, [PART], spec.cluster_by, table=table)


def merge_into_table(
    spark: SparkSession,
    incoming: DataFrame,
    table: str,
    spec: TableSpec,
    location: str,
    tie_break: Sequence[str] = (),
    index_buckets: int | None = None,
) -> str:
    """Merge an increment into a partitioned parquet table; returns what happened to the schema.

    Only touched partitions are rewritten: those that hold a matched key and those the increment lands
    in. They are written once, laid out by ``write_clustered``, in a staging folder, and their folders are then moved
    into the table; the ones they replace are kept aside until the next merge. If the driver dies during the swap,
    the next call finds the finished staging folder and goes on with the swap; if it dies earlier, the table is as it
    was. Repeating a merge changes nothing, so a retry is always safe.

    The touched partitions are found by reading the target's keys once an increment, or with ``index_buckets`` by an
    index from key to partition (``KeyIndex``) kept in that many buckets beside the table: then only the buckets of the
    increment's keys are read and written, and the work follows the increment. A merge without it drops the index.
    """
    stage = f"{location}__stage"
    _finish_swap(spark, table, location, stage)
    index = KeyIndex(spark, location, spec.key, index_buckets) if index_buckets else None
    if index is None:
        remove_path(spark, f"{location}__index")
    incoming = dedup_latest(incoming, [spec.key], spec.loaded_at, tie_break)
    if not spark.catalog.tableExists(table):
        if not path_exists(spark, f"{location}/_SUCCESS"):
            remove_path(spark, f"{location}__index")
            write_raw(incoming, spec, location, table)
            if index:
                index.build(spark.table(table))
            return "created"
        # Written by an earlier session. Older partitions may lack later columns, so footers are merged.
        fs, folder = _fs(spark, location)
        has_rows = any(child.getPath().getName().startswith(f"{PART}=") for child in fs.listStatus(folder))
        reader = spark.read.option("mergeSchema", "true")
        schema = (reader.parquet(location) if has_rows else with_partition(incoming, spec)).schema
        spark.sql(
            f"CREATE TABLE {table} ({_ddl(schema)}) USING parquet PARTITIONED BY ({PART}) LOCATION '{location}'"
        )
        _register_partitions(spark, table)

    landed = with_partition(incoming, spec)
    landed.write.parquet(f"{stage}/increment")  # read several times below
    increment = spark.read.schema(landed.schema).parquet(f"{stage}/increment")
    new = added_columns(spark.table(table), increment)
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_ddl(new)})")
    outcome = "added:" + ",".join(f.name for f in new) if new else "no_changes"
    if increment.isEmpty():
        remove_path(spark, stage)
        return outcome

    target = spark.table(table)
    known = target.select(spec.key, PART)
    if index:
        if not index.complete():
            index.build(target)
        known = index.of(increment)
    holding = known.join(increment.select(spec.key), spec.key, "left_semi")
    # One value per month or day of the table's life, so this list is short whatever the row count.
    touched = [r[0] for r in holding.select(PART).union(increment.select(PART)).distinct().collect()]
    affected = target.where(F.col(PART).isin(touched)).drop(PART)
    merged = merge_upsert(
        affected,
        increment.drop(PART),
        spec.key,
        spec.loaded_at,
        dedup=False,
    )
    write_clustered(with_partition(merged, spec), f"{stage}/merged", [PART], spec.cluster_by)
    left = {r[0] for r in spark.read.parquet(f"{stage}/merged").select(PART).distinct().collect()}
    emptied = [(p,) for p in touched if p not in left]
    if index:
        index.stage(increment, spark.read.parquet(f"{stage}/merged"), f"{stage}/index")
    spark.createDataFrame(emptied, f"{PART} INT").coalesce(1).write.parquet(f"{stage}/ready")
    _finish_swap(spark, table, location, stage)
    return outcome


class KeyIndex:
    """Which partition of a stored table holds each key: rows (key, partition) in buckets by a hash of the key.

    It lives beside the table. A merge rewrites the buckets of its own keys, in its staging folder, and they are moved
    in with the table's partitions by the same swap, so that a lost driver leaves both old or both new. An index that
    is missing, half built or of another number of buckets is built anew from the table.
    """

    def __init__(self, spark: SparkSession, location: str, key: str, buckets: int) -> None:
        self.spark, self.key, self.buckets = spark, key, buckets
        self.root, self.path = f"{location}__index", f"{location}__index/of={buckets}"

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))

    def complete(self) -> bool:
        return path_exists(self.spark, f"{self.path}/_SUCCESS")

    def build(self, table: DataFrame) -> None:
        remove_path(self.spark, self.root)
        self._write(self._bucketed(table.select(self.key, PART)), self.path)

    def _write(self, rows: DataFrame, path: str) -> None:
        rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(path)

    def of(self, increment: DataFrame) -> DataFrame:
        """The index rows in the buckets of the increment's keys; other buckets are not opened."""
        # One number a bucket, so this list is short whatever the increment's size.
        wanted = [r[0] for r in self._bucketed(increment.select(self.key)).select(BUCKET).distinct().collect()]
        schema = f"`{self.key}` {increment.schema[self.key].dataType.simpleString()}, {PART} INT, {BUCKET} INT"
        return self.spark.read.schema(schema).parquet(self.path).where(F.col(BUCKET).isin(wanted))

    def stage(self, increment: DataFrame, merged: DataFrame, path: str) -> None:
        """Write the increment's buckets as they are after the merge."""
        keys = increment.select(self.key)
        kept = self.of(increment).join(keys, self.key, "left_anti")
        moved = self._bucketed(merged.select(self.key, PART).join(keys, self.key, "left_semi"))
        self._write(kept.unionByName(moved), path)


def merge_into_row_level_table(
    spark: SparkSession, incoming: DataFrame, table: str, spec: TableSpec, tie_break: Sequence[str] = ()
) -> None:
    """The same merge for a table format with row-level updates, which does it atomically by itself."""
    source = dedup_latest(incoming, [spec.key], spec.loaded_at, tie_break)
    spark.sql(
        f"""
        MERGE WITH SCHEMA EVOLUTION INTO {table} AS t USING {{source}} AS s ON t.{spec.key} = s.{spec.key}
        WHEN MATCHED AND s.{spec.loaded_at} > t.{spec.loaded_at} THEN UPDATE SET *
        WHEN NOT MATCHED THEN INSERT *
        """,
        source=source,
    )


def store_snapshot(
    spark: SparkSession, current: DataFrame, view: str, key: str, as_of: datetime, location: str
) -> None:
    """Fold the current state of a table into its stored history, shown by a view.

    Versions that were closed before are never read or written again: each run writes the open versions,
    and the versions it closed, under its own number, and then points the view at that number. A run that
    dies before that leaves the view as it was, and the next attempt has the same number and overwrites
    its leavings.
    """
    if spark.catalog.tableExists(view):
        last = int(spark.sql(f"SHOW TBLPROPERTIES {view} ('run')").first()["value"])
        history = spark.read.parquet(f"{location}/open/run={last}")
        state = apply_snapshot(history, current, key, as_of)
    elif path_exists(spark, f"{location}/open"):
        raise RuntimeError(f"{location} holds a history, but the view {view} is missing; restore it first")
    else:
        last, state = -1, first_versions(current, key)
    run = last + 1
    # Both writes come from one computed relation, so they cannot disagree.
    with staged(spark, location) as folded:
        state.write.parquet(folded)
        state = spark.read.schema(state.schema).parquet(folded)
        for part, ended in (("open", False), ("closed", True)):
            rows = state.where(F.col("valid_to").isNotNull() == ended)
            rows.write.mode("overwrite").parquet(f"{location}/{part}/run={run}")
    columns = ", ".join(f"`{c}`" for c in state.columns)
    ddl = _ddl(state.schema)
    for part in ("open", "closed"):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {view}_{part} ({ddl}, run INT) USING parquet PARTITIONED BY (run)"
            f" LOCATION '{location}/{part}'"
        )
        _register_partitions(spark, f"{view}_{part}")
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} TBLPROPERTIES ('run' = '{run}') AS"
        f" SELECT {columns} FROM {view}_closed WHERE run <= {run}"
        f" UNION ALL SELECT {columns} FROM {view}_open WHERE run = {run}"
    )
    if last > 0:  # keep the previous open set for readers still on it
        spark.sql(f"ALTER TABLE {view}_open DROP IF EXISTS PARTITION (run={last - 1})")
        remove_path(spark, f"{location}/open/run={last - 1}")


def _finish_swap(spark: SparkSession, table: str, location: str, stage: str) -> None:
    """Move the finished partitions of a staging folder into the table. Each step may already be done.

    What they replace goes to ``<location>__old``, emptied by the first step of each swap.
    """
    if path_exists(spark, f"{stage}/ready/_SUCCESS"):
        aside = f"{location}__old"
        if not path_exists(spark, f"{stage}/swapping"):
            remove_path(spark, aside)
            fs, mark = _fs(spark, f"{stage}/swapping")
            fs.mkdirs(mark)
        fs, merged = _fs(spark, f"{stage}/merged")
        moved = [c.getPath().getName() for c in fs.listStatus(merged)]
        for part in (p for p in moved if p.startswith(f"{PART}=")):
            _move(spark, f"{location}/{part}", f"{aside}/{part}")
            _move(spark, f"{stage}/merged/{part}", f"{location}/{part}")
        for (emptied,) in spark.read.parquet(f"{stage}/ready").collect():
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({PART}={emptied})")
            _move(spark, f"{location}/{PART}={emptied}", f"{aside}/{PART}={emptied}")
        if path_exists(spark, f"{stage}/index"):
            (index,) = [c.getPath() for c in fs.listStatus(_fs(spark, f"{location}__index")[1])]
            for bucket in [c.getPath().getName() for c in fs.listStatus(_fs(spark, f"{stage}/index")[1])]:
                if bucket.startswith(f"{BUCKET}="):
                    _move(spark, f"{index}/{bucket}", f"{aside}/{index.getName()}/{bucket}")
                    _move(spark, f"{stage}/index/{bucket}", f"{index}/{bucket}")
        _register_partitions(spark, table)
    if path_exists(spark, stage):
        remove_path(spark, stage)


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; a folder that is not there was moved before."""
    fs, old = _fs(spark, source)
    _, new = _fs(spark, target)
    if fs.exists(old):
        fs.mkdirs(new.getParent())
        if not fs.rename(old, new):
            raise OSError(f"cannot move {source} to {target}")


def _register_partitions(spark: SparkSession, table: str) -> None:
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def _ddl(fields: Iterable[StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
