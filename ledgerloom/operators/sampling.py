"""Repeatable sampling and weighted assignment, from a hash of the row's key and a seed.

MD5 is used because every SQL engine computes the same value, so a sample can be checked elsewhere.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKETS_HEX = 4  # 16**4 = 65536 cuts of the hash range


def key_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` pseudo-random rows; each task offers at most ``n`` (a distributed top-n)."""
    return df.withColumn("_h", key_hash(key, seed)).orderBy("_h", key).limit(n).drop("_h")


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Exactly ``max(1, floor(fraction * rows))`` rows, the lowest by key hash.

    ``key`` is unique. The sample grows with the data, so it is never sorted in one place. Counts per hash bucket (65536
    rows at most, whatever the input) locate the bucket in which the quota ends: lower buckets are taken
    whole, and only that one, about 1/65536 of the rows, is ranked.
    """
    hashed = df.withColumn("_h", key_hash(key, seed)).withColumn("_b", F.substring("_h", 1, _BUCKETS_HEX))
    counts = hashed.groupBy("_b").agg(F.count("*").alias("_n"))
    upto = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    quota = F.greatest(F.lit(1), F.floor(F.sum("_n").over(whole) * F.lit(fraction)))
    cut = (
        counts.select("_b", "_n", F.sum("_n").over(upto).alias("_cum"), quota.alias("_quota"))
        .where((F.col("_cum") - F.col("_n")) < F.col("_quota"))
        .select(
            "_b",
            (F.col("_quota") - F.col("_cum") + F.col("_n")).alias("_left"),
            (F.col("_cum") > F.col("_quota")).alias("_split"),
        )
    )
    # cut holds at most one row per bucket, so it is broadcast safely.
    chosen = hashed.join(F.broadcast(cut), "_b")
    taken = chosen.where(~F.col("_split"))
    rank = Window.partitionBy("_b").orderBy("_h", key)
    edge = chosen.where("_split").withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= F.col("_left"))
    return taken.select(*df.columns).unionByName(edge.select(*df.columns))


def weighted_choice(key: str, weights: Mapping[str, int], seed: int = 42) -> Column:
    """A label per row with the given integer weights, decided by the key alone."""
    total = sum(weights.values())
    draw = F.conv(F.substring(key_hash(key, seed), 1, 8), 16, 10).cast("bigint") % total
    labels = list(weights)
    cum, out = 0, None
    for label in labels[:-1]:
        cum += weights[label]
        out = F.when(draw < cum, label) if out is None else out.when(draw < cum, label)
    return F.lit(labels[-1]) if out is None else out.otherwise(labels[-1])
