"""As-of join: every fact with the version of its key that was in force at the fact's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    valid_from: str,
    columns: Sequence[str],
    valid_to: str | None = None,
    bucket: str = "DAY",
) -> DataFrame:
    """``facts`` with ``columns`` of the newest version that began at or before each fact; null where none did.

    ``versions`` holds one row per (key, valid_from). With ``valid_to`` a version no longer counts from that time on.
    Facts without key or time keep their row, with nulls; such versions never match. All facts stay, once each.

    No range join: facts and versions become one relation, cut by key and time bucket, and a version is carried
    forward to the facts after it. What a bucket leaves open is carried on to the key's later buckets over one row per
    (key, bucket), so a key with very many facts is many groups, each of one bucket's rows. Choose the bucket so that
    one key's rows in one bucket fit a task.
    """
    known = F.col(key).isNotNull() & F.col(at).isNotNull()
    version = F.struct(*[F.col(c) for c in columns], *([F.col(valid_to).alias("_ends")] if valid_to else []))
    begun = versions.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(key).alias("_key"), F.col(valid_from).cast("timestamp_ntz").alias("_at"), version.alias("_version")
    )
    asked = facts.where(known).select(
        F.col(key).alias("_key"), F.col(at).cast("timestamp_ntz").alias("_at"), F.struct(*facts.columns).alias("_fact")
    )
    both = begun.withColumn("_fact", F.lit(None).cast(asked.schema["_fact"].dataType)).unionByName(
        asked.withColumn("_version", F.lit(None).cast(begun.schema["_version"].dataType))
    )
    both = both.withColumn("_bucket", F.date_trunc(bucket, "_at").cast("timestamp_ntz"))
    within = Window.partitionBy("_key", "_bucket").orderBy("_at", F.col("_fact").isNotNull())
    inside = both.withColumn("_inside", F.last("_version", True).over(within.rowsBetween(Window.unboundedPreceding, 0)))
    # One row per (key, bucket): what held before the bucket began.
    last = both.groupBy(F.col("_key").alias("_k"), F.col("_bucket").alias("_b")).agg(
        F.max_by("_version", F.when(F.col("_version").isNotNull(), F.col("_at"))).alias("_last")
    )
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("_k", "_b", F.last("_last", True).over(before).alias("_carried"))
    joined = inside.where("_fact IS NOT NULL").join(
        carried, (F.col("_key") == F.col("_k")) & (F.col("_bucket") == F.col("_b")), "left"
    )
    held = F.coalesce("_inside", "_carried")
    if valid_to:
        held = F.when(held["_ends"].isNull() | (held["_ends"] > F.col("_at")), held)
    found = joined.withColumn("_held", held).select("_fact.*", *[F.col("_held")[c].alias(c) for c in columns])
    rest = facts.where(~known)
    nulls = {c: F.lit(None).cast(found.schema[c].dataType) for c in columns}
    return found.unionByName(rest.withColumns(nulls))
