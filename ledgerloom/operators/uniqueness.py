"""Uniqueness of a stored table, kept up to date from the partitions that changed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.sinks import BUCKET, PART, folder_print, path_exists, remove_path, subfolders
from ledgerloom.sources.contracts import TableSpec


class KeyCounts:
    """How often a stored raw table holds each value of a column.

    Beside the table lie, for each partition, its values with their counts, and for each bucket of a hash, its values
    with their counts in the whole table. ``refresh`` reads only partitions whose files changed, takes what they held
    before from what they hold now, and rewrites only the buckets of values whose count changed. A manifest names the
    folders of a state and is written last, so that a lost driver leaves the state before; the folders of the latest
    two states are kept. Null values are not counted.
    """

    def __init__(self, spark: SparkSession, location: str, spec: TableSpec, column: str | None = None, buckets: int = 64) -> None:
        self.spark, self.location, self.column, self.buckets = spark, location, column or spec.key, buckets
        self.root = f"{location}__counts/{self.column}-{buckets}"
        self.kind = spec.schema[self.column].dataType.simpleString()

    def _manifest(self, version: int) -> dict[tuple[str, int], tuple[int, str]]:
        """(kind, number) of each folder of a state, with the version that wrote it and the print of its files then."""
        rows = self.spark.read.parquet(f"{self.root}/manifest/v={version}").collect()  # a row a partition or bucket
        return {(r.kind, r.number): (r.written, r.seen) for r in rows}

    def _versions(self) -> list[int]:
        """States whose manifest is complete, oldest first."""
        found = subfolders(self.spark, f"{self.root}/manifest", "v")
        return sorted(v for v in found if path_exists(self.spark, f"{self.root}/manifest/v={v}/_SUCCESS"))

    def _rows(self, kind: str, folders: Iterable[tuple[int, int]]) -> DataFrame:
        """(value, n) of the (number, version) folders of a kind."""
        label = PART if kind == "parts" else BUCKET
        paths = [f"{self.root}/{kind}/v={v}/{label}={number}" for number, v in folders]
        schema = f"`{self.column}` {self.kind}, n BIGINT"
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def refresh(self) -> tuple[list[int], list[int]]:
        """Bring the counts up to date with the table's files; returns the partitions read and the buckets written."""
        versions = self._versions()
        state = self._manifest(versions[-1]) if versions else {}
        version = versions[-1] + 1 if versions else 0
        now = {p: folder_print(self.spark, f"{self.location}/{PART}={p}") for p in subfolders(self.spark, self.location, PART)}
        before = {number: seen for (kind, number), (_, seen) in state.items() if kind == "seen"}
        stale = sorted(p for p in now if before.get(p) != now[p])
        gone = sorted(p for p in before if p not in now)
        if not stale and not gone:
            return [], []

        column = F.col(f"`{self.column}`")
        remove_path(self.spark, f"{self.root}/parts/v={version}")
        if stale:
            paths = [f"{self.location}/{PART}={p}" for p in stale]
            rows = self.spark.read.option("basePath", self.location).parquet(*paths).where(column.isNotNull())
            counted = rows.groupBy(PART, self.column).agg(F.count("*").alias("n"))
            counted.write.partitionBy(PART).parquet(f"{self.root}/parts/v={version}")
        new = self._rows("parts", [(p, version) for p in subfolders(self.spark, f"{self.root}/parts/v={version}", PART)])
        changed = {("parts", p) for p in (*stale, *gone)}
        old = self._rows("parts", [(number, v) for (kind, number), (v, _) in state.items() if (kind, number) in changed])
        both = new.unionByName(old.withColumn("n", -F.col("n")))
        delta = both.groupBy(self.column).agg(F.sum("n").alias("n")).where("n != 0")
        delta = delta.withColumn(BUCKET, F.pmod(F.xxhash64(self.column), F.lit(self.buckets)).cast("int"))
        delta.write.mode("overwrite").parquet(f"{self.root}/delta")
        delta = self.spark.read.schema(delta.schema).parquet(f"{self.root}/delta")

        touched = sorted(r[0] for r in delta.select(BUCKET).distinct().collect())  # at most ``buckets`` numbers
        held = self._rows("buckets", [(b, state["buckets", b][0]) for b in touched if ("buckets", b) in state])
        held = held.withColumn(BUCKET, F.pmod(F.xxhash64(self.column), F.lit(self.buckets)).cast("int"))
        total = held.unionByName(delta).repartition(BUCKET).groupBy(BUCKET, self.column).agg(F.sum("n").alias("n"))
        total.where("n > 0").write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.root}/buckets/v={version}")

        kept = {k: v for k, v in state.items() if k not in changed and k[0] != "seen" and not (k[0] == "buckets" and k[1] in touched)}
        for kind, label in (("parts", PART), ("buckets", BUCKET)):
            kept |= {(kind, number): (version, "") for number in subfolders(self.spark, f"{self.root}/{kind}/v={version}", label)}
        kept |= {("seen", p): (version, seen) for p, seen in now.items()}
        rows = [(kind, number, written, seen) for (kind, number), (written, seen) in kept.items()]
        manifest = self.spark.createDataFrame(rows, "kind STRING, number INT, written BIGINT, seen STRING")
        manifest.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/v={version}")
        self._forget([kept, state], version)
        return stale, touched

    def _forget(self, states: list[dict], version: int) -> None:
        """Remove the folders that neither this state nor the one before names."""
        named = {(kind, number, written) for state in states for (kind, number), (written, _) in state.items()}
        for kind, label in (("parts", PART), ("buckets", BUCKET)):
            for v in subfolders(self.spark, f"{self.root}/{kind}", "v"):
                for number in subfolders(self.spark, f"{self.root}/{kind}/v={v}", label):
                    if (kind, number, v) not in named:
                        remove_path(self.spark, f"{self.root}/{kind}/v={v}/{label}={number}")
        for v in subfolders(self.spark, f"{self.root}/manifest", "v"):
            if v < version - 1:
                remove_path(self.spark, f"{self.root}/manifest/v={v}")

    def counts(self) -> DataFrame:
        """(value, n) of the whole table as of the last refresh."""
        versions = self._versions()
        state = self._manifest(versions[-1]) if versions else {}
        return self._rows("buckets", [(number, v) for (kind, number), (v, _) in state.items() if kind == "buckets"])

    def duplicated(self) -> DataFrame:
        """The values that stand in more than one row, as the uniqueness check has them; no shuffle, no table scan."""
        return self.counts().where("n > 1").withColumnRenamed("n", "n_records")
