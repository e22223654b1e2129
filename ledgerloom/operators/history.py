"""Type-2 history: one row per version of a key, with the time span in which it held."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import ts_lit
from ledgerloom.operators.ranking import dedup_latest, next_value

# The customer attributes the snapshot follows.
TRACKED_CUSTOMER_COLUMNS = (
    "customer_id",
    "customer_uuid",
    "full_name",
    "national_id",
    "date_of_birth",
    "gender",
    "customer_segment",
    "kyc_status",
    "risk_rating",
    "income_range",
    "address_province",
    "acquisition_channel",
    "is_politically_exposed",
    "created_at",
    "updated_at",
)


def scd_id(key: str, updated_at: str) -> Column:
    stamp = F.date_format(F.col(updated_at), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.md5(F.concat(F.col(key).cast("string"), F.lit("|"), stamp))


def first_versions(current: DataFrame, key: str, updated_at: str = "updated_at") -> DataFrame:
    """The history after the first snapshot: every row open since its own update time."""
    return current.withColumns(
        {
            "valid_from": F.col(updated_at),
            "valid_to": F.lit(None).cast("timestamp_ntz"),
            "scd_id": scd_id(key, updated_at),
        }
    )


def apply_snapshot(
    history: DataFrame,
    current: DataFrame,
    key: str,
    as_of: datetime,
    *,
    updated_at: str = "updated_at",
    hard_deletes: bool = True,
) -> DataFrame:
    """Fold the current state of a table into its history.

    A new or returning key opens a version. A row whose ``updated_at`` moved forward closes the open
    version at that time and opens its own. Equal or older rows change nothing. With ``hard_deletes`` a
    key missing from ``current`` is closed at the run time; a soft-deleted row that the caller filters out
    counts as missing.

    Only the open versions are joined, one row per key on each side; closed ones pass straight through.
    """
    columns = history.columns
    closed = history.where(F.col("valid_to").isNotNull())
    openings = first_versions(current, key, updated_at).select(*columns)
    both = (
        history.where(F.col("valid_to").isNull())
        .withColumn("_open", F.lit(True))
        .alias("h")
        .join(openings.withColumn("_seen", F.lit(True)).alias("c"), F.col(f"h.{key}") == F.col(f"c.{key}"), "full")
    )
    is_open, is_seen = F.col("h._open").isNotNull(), F.col("c._seen").isNotNull()
    moved = F.coalesce(F.col(f"c.{updated_at}") > F.col(f"h.{updated_at}"), F.lit(False))
    end = F.when(is_seen & moved, F.col(f"c.{updated_at}"))
    if hard_deletes:
        end = end.when(~is_seen, ts_lit(as_of))
    kept = F.struct(*[(end if c == "valid_to" else F.col(f"h.{c}")).alias(c) for c in columns])
    opened = F.struct(*[F.col(f"c.{c}").alias(c) for c in columns])
    rows = F.array(F.when(is_open, kept), F.when(is_seen & (~is_open | moved), opened))
    changed = both.select(F.explode(F.array_compact(rows)).alias("r")).select("r.*")
    return closed.unionByName(changed)


def history_from_changes(
    feed: DataFrame, key: str, tie_break: str, *, updated_at: str = "updated_at", bucket: str = "HOUR"
) -> DataFrame:
    """The whole history in one pass over a change feed; equal to snapshotting after every change."""
    versions = dedup_latest(feed, [key, updated_at], updated_at, [tie_break])
    spans = next_value(versions, key, updated_at, "valid_to", bucket, times=feed.select(key, updated_at))
    return spans.withColumns({"valid_from": F.col(updated_at), "scd_id": scd_id(key, updated_at)})


def as_of_lookup(history: DataFrame, at: datetime | date) -> DataFrame:
    """The versions that held at a moment: ``valid_from <= at < valid_to``, an open end being infinite."""
    moment = ts_lit(at if isinstance(at, datetime) else datetime(at.year, at.month, at.day))
    open_or_later = F.col("valid_to").isNull() | (F.col("valid_to") > moment)
    return history.where((F.col("valid_from") <= moment) & open_or_later)
