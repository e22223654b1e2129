"""Ranking operators that survive a key holding a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def top1_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group.

    The ``row_number() = 1`` filter makes Spark keep one row per key on the map side
    (WindowGroupLimit), so a hot key sends one row per map task through the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedup_latest(df: DataFrame, keys: Sequence[str], order: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per merge key: the newest by ``order``; equal times are settled by ``tie_break``."""
    return top1_per_group(df, keys, newest_first(order, *tie_break))


def flag_latest(
    df: DataFrame, key: str, row_id: str, order: Sequence[Column], flag: str = "is_latest"
) -> DataFrame:
    """Keep all rows and mark the first row of each group.

    A plain window would sort a whole group in one task. Here the winners are found with map-side
    reduction and matched back on ``row_id``, which is unique and so spreads every group evenly.
    """
    winners = top1_per_group(df, [key], order).select(F.col(row_id).alias("_id"), F.lit(True).alias(flag))
    joined = df.join(winners, F.col(row_id) == F.col("_id"), "left")
    return joined.withColumn(flag, F.coalesce(flag, F.lit(False))).drop("_id")


def next_value(
    df: DataFrame, key: str, order: str, result: str, bucket: str = "HOUR", times: DataFrame | None = None
) -> DataFrame:
    """``lead(order)`` within each key, for rows unique on (key, order), without one task per key.

    Rows are cut into time buckets. Inside a bucket a window finds the successor; the last row of a
    bucket takes the first time of the key's next non-empty bucket. That second step runs on one row per
    (key, bucket), so a single group is bounded by the number of buckets in the history, whatever the
    number of rows. Choose the bucket so that one key's rows in one bucket fit a task. ``times`` may name
    a cheaper relation with the same (key, order) pairs, duplicates allowed, to take the first times from.
    """
    cut = F.date_trunc(bucket, F.col(order)).cast("timestamp_ntz")
    within = Window.partitionBy(key, "_bucket").orderBy(order)
    ahead = Window.partitionBy("_k").orderBy("_b")
    firsts = (
        (df if times is None else times)
        .groupBy(F.col(key).alias("_k"), cut.alias("_b"))
        .agg(F.min(order).alias("_first"))
        .select("_k", "_b", F.lead("_first").over(ahead).alias("_next"))
    )
    inner = df.withColumn("_bucket", cut).withColumn("_inner", F.lead(order).over(within))
    return (
        inner.join(firsts, (F.col(key) == F.col("_k")) & (F.col("_bucket") == F.col("_b")), "left")
        .withColumn(result, F.coalesce("_inner", "_next"))
        .drop("_bucket", "_k", "_b", "_next", "_inner")
    )
