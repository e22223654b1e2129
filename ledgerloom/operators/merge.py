"""Merges of an increment into a target.

These are pure: they return the merged relation. The increment holds one row per key when it meets the
target, so no key can be hot in these joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ingest import evolve_schema
from ledgerloom.operators.ranking import dedup_latest, top1_per_group


def merge_upsert(
    target: DataFrame,
    incoming: DataFrame,
    key: str,
    order: str,
    *,
    dedup: bool = True,
    tie_break: Sequence[str] = (),
    delete_missing: bool = False,
) -> DataFrame:
    """Newer wins: a matched row is replaced when the incoming one is strictly newer, else kept.

    Also kept when either time is null. Unmatched incoming rows are inserted. ``dedup`` guards against a
    retried extract that left the same key twice; without it the caller vouches for unique keys.
    ``delete_missing`` drops target rows the increment does not have: right only for a full extract.

    One join for increments of any size: full outer, or right outer when missing rows are dropped. It shuffles each
    side once by the key; rows of the target cross no second join.
    """
    if dedup:
        incoming = dedup_latest(incoming, [key], order, tie_break)
    target, _ = evolve_schema(target, incoming)
    joined = (
        target.withColumn("_known", F.lit(True))
        .alias("t")
        .join(
            incoming.withColumn("_given", F.lit(True)).alias("s"),
            F.col(f"t.{key}") == F.col(f"s.{key}"),
            "right" if delete_missing else "full",
        )
    )
    newer = F.col(f"s.{order}") > F.col(f"t.{order}")
    take = F.col("s._given").isNotNull() & (F.col("t._known").isNull() | newer)
    # A column the increment does not carry keeps its old value, and is null in an inserted row.
    given = set(incoming.columns)
    return joined.select(
        [
            F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) if c in given else F.col(f"t.{c}")
            for c in target.columns
        ]
    )


def insert_ignore(
    target: DataFrame, rows: DataFrame, key: Sequence[str], first: Sequence[str]
) -> DataFrame:
    """Append the rows whose key is new; of several with one key, the lowest by ``first`` is inserted."""
    fresh = top1_per_group(rows, key, [F.col(c).asc_nulls_last() for c in first])
    new = fresh.join(target.select(*key), list(key), "left_anti")
    return target.unionByName(new.select(*target.columns))


def upsert_columns(
    target: DataFrame, rows: DataFrame, key: str, update: Sequence[str]
) -> DataFrame:
    """Insert new keys whole; for known keys overwrite only the listed columns."""
    joined = (
        target.withColumn("_known", F.lit(True))
        .alias("t")
        .join(rows.withColumn("_given", F.lit(True)).alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "full")
    )
    known, given = F.col("t._known").isNotNull(), F.col("s._given").isNotNull()

    def pick(c: str):
        use_new = given if c in update else ~known
        new = F.col(f"s.{c}") if c in rows.columns else F.lit(None)
        return F.when(use_new, new).otherwise(F.col(f"t.{c}")).alias(c)

    return joined.select(*[pick(c) for c in target.columns])
