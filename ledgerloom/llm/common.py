"""What the operators share: table access, clean inputs, checkpoints, links to components."""

from __future__ import annotations

import math
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


Body = Callable[[Column], Column]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where it is not installed, and name a checkpoint folder.

    The folder is the one in ``spark.checkpoint.dir``; where that is unset, as in tests, it is one below the
    warehouse, never a machine-local temporary folder.
    """
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    scratch(spark)
    return spark


def scratch(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch files."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        folder = shared.rstrip("/")
    else:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage: a reliable checkpoint in the shared folder, dropped by Spark's cleaner."""
    ready(df.sparkSession)
    return df.checkpoint(eager=True)


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns an operator reads, a null text as the empty one. Other columns stay behind."""
    ready(docs.sparkSession)
    return docs.select(F.col(f"`{key}`").alias(key), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(text))


def named(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, text): what an operator reads, with each row named by its key and a hash of its text."""
    rows = texts(docs, key, text)
    return rows.select(F.struct(F.col(f"`{key}`").alias("key"), F.xxhash64(text).alias("text_hash")).alias("row"), text)


def without(docs: DataFrame, gone: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose name is no ``row`` of ``gone``; another text under the same key stays.

    Rows without a key stay. What goes is joined away: that list is the shorter one, and where adaptive execution finds
    it small the texts are not shuffled.
    """
    bad = gone.select(F.col("row.key").alias("_gone_key"), F.col("row.text_hash").alias("_gone_hash")).distinct()
    own = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    return docs.join(bad, (F.col(f"`{key}`") == F.col("_gone_key")) & (own == F.col("_gone_hash")), "left_anti")


def bucket(key: str | Column, n: int) -> Column:
    """CRC-32 of the key's decimal text, modulo n; null keys fall into bucket 0 of the text ''."""
    col = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % n


def hashed_sample(rows: DataFrame, total: int, n: int, *by: str) -> DataFrame:
    """The n of ``total`` rows that come first in the order of a hash of some columns: the same in every run.

    A first cut on the hash leaves little more than n rows over all tasks, so what reaches the driver does not
    grow with the number of tasks.
    """
    hashed = rows.withColumn("_hash", F.pmod(F.xxhash64(*by), F.lit(1 << 32)))
    if total > n:
        share = min(1.0, (n + 8 * math.sqrt(n) + 16) / total)
        hashed = hashed.where(F.col("_hash") < int(share * (1 << 32)))
    return hashed.orderBy("_hash", *by).limit(n).drop("_hash")


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): every node of the links with the smallest node it can reach.

    Alternating large-star and small-star rounds (Kiveris et al., 2014). A round is a grouped minimum, pre-aggregated
    before its shuffle, and a join on the node, which adaptive execution may split; no neighbourhood is gathered.
    The number of rounds grows with the logarithm of the longest chain. Only round counters reach the driver.
    """
    edges = cut(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    )
    for _ in range(max_rounds):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select("u", F.col("m").alias("v")).unionAll(
            small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        new = cut(small.distinct())
        # Stars all around: every edge points to a node that itself has no smaller neighbour.
        deeper = new.select("u").intersect(new.select("v")).limit(1).count()
        twice = 0 if deeper else new.groupBy("u").count().where("count > 1").limit(1).count()
        edges = new
        if not deeper and not twice:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def let(value: Column, body: Body) -> Column:
    """``body`` of a value that is computed once however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)
