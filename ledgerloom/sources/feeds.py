"""The customer change feed as ingestion input: its contract and the increments used to exercise merges."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ingest import Window, window_filter
from ledgerloom.operators.ranking import dedup_latest
from ledgerloom.sources.contracts import CORE, TableSpec

FEED_SPEC = TableSpec(
    CORE,
    "customer_changes",
    "customer_id",
    "customer_id BIGINT NOT NULL, customer_segment STRING, balance DOUBLE, updated_at TIMESTAMP_NTZ, seq BIGINT",
    ("customer_segment",),
    granularity="DAY",
)
# The second half of the feed, bent so that a merge meets every case: new keys (ids moved up), rows older
# than the target's (moved back in time), and rows without a time.
BENT = {
    "customer_id": "CASE WHEN customer_id % 10 = 3 THEN customer_id + 1000000000 ELSE customer_id END",
    "customer_segment": "customer_segment",
    "balance": "balance",
    "updated_at": "CASE WHEN customer_id % 10 = 7 THEN NULL"
    " WHEN customer_id % 4 = 1 THEN updated_at - interval '1' day * 20 ELSE updated_at END",
    "seq": "seq",
}


def span_of(rows: DataFrame, loaded_at: str) -> Window | None:
    """The whole days that the rows' load times cover; None without any."""
    first, last = rows.agg(F.min(loaded_at), F.max(loaded_at)).first()
    if first is None:
        return None
    days = [datetime(t.year, t.month, t.day) for t in (first, last)]
    return Window(days[0], days[1] + timedelta(days=1))


def halves(feed: DataFrame) -> tuple[Window, Window]:
    """The span of the feed's load times, cut at the start of its middle day. Without rows both are empty."""
    whole = span_of(feed, "updated_at")
    if whole is None:
        never = datetime(1970, 1, 1)
        return Window(never, never), Window(never, never)
    split = whole.start + timedelta(days=(whole.end - whole.start).days // 2)
    return Window(whole.start, split), Window(split, whole.end)


def stored_target(feed: DataFrame) -> DataFrame:
    first_half = window_filter(feed, "updated_at", halves(feed)[0])
    return dedup_latest(first_half, ["customer_id"], "updated_at", ["seq"])


def bent_increment(feed: DataFrame) -> DataFrame:
    second_half = window_filter(feed, "updated_at", halves(feed)[1])
    return second_half.selectExpr(*[f"{e} AS {c}" for c, e in BENT.items()])
