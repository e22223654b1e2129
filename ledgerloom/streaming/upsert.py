"""The continuous form of ingestion: a change stream merged into its table, micro-batch by micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators.ingest import project_cast
from ledgerloom.operators.sinks import merge_into_table
from ledgerloom.sources.contracts import TableSpec


def stream_upsert(
    changes: DataFrame,
    table: str,
    spec: TableSpec,
    location: str,
    checkpoint: str,
    tie_break: Sequence[str] = (),
    index_buckets: int | None = 64,
    **trigger,
) -> StreamingQuery:
    """Start the stream. By default it drains what is there and stops.

    The merge is newer-wins and idempotent, so the table ends up the same however the changes are cut
    into batches, and a batch replayed after a failure does no harm. An index from key to partition, in
    ``index_buckets`` buckets, lets a micro-batch open only the buckets of its keys and the partitions that hold
    them or receive a row. Take as many buckets as give each a file's worth of keys; None goes without index.
    """

    def merge_batch(batch: DataFrame, _batch_id: int) -> None:
        rows = project_cast(batch, spec, evolve=True)
        merge_into_table(batch.sparkSession, rows, table, spec, location, tie_break, index_buckets)

    return (
        changes.writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
