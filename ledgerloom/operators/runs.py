"""Which windows of a table's load are done."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from ledgerloom.operators.ingest import Window
from ledgerloom.operators.sinks import children, remove_path, touch

_FORM = "%Y%m%dT%H%M%S%f"


def joined(windows: list[Window]) -> list[Window]:
    """The same time in the fewest windows, oldest first."""
    out: list[Window] = []
    for w in sorted(windows, key=lambda w: w.start):
        if out and w.start <= out[-1].end:
            out[-1] = Window(out[-1].start, max(out[-1].end, w.end))
        else:
            out.append(w)
    return out


class RunLedger:
    """A mark for each finished window, beside the table that it was loaded into.

    A mark is an empty file, made after the load's swap. A driver that is lost between the two loads that window again,
    which changes nothing.
    """

    def __init__(self, spark: SparkSession, location: str) -> None:
        self.spark, self.path = spark, f"{location}__runs"

    def mark(self, window: Window) -> None:
        touch(self.spark, f"{self.path}/{window.start:{_FORM}}_{window.end:{_FORM}}")

    def done(self) -> list[Window]:
        names = [n.split("_") for n in children(self.spark, self.path) if not n.startswith((".", "_"))]
        return joined([Window(*(datetime.strptime(t, _FORM) for t in n)) for n in names])

    def left(self, window: Window) -> list[Window]:
        """The parts of a window that no finished one covers, oldest first."""
        out, at = [], window.start
        for w in self.done():
            if w.end <= at or w.start >= window.end:
                continue
            if w.start > at:
                out.append(Window(at, w.start))
            at = w.end
        return [*out, Window(at, window.end)] if at < window.end else out

    def watermark(self) -> datetime | None:
        """The end of the first unbroken stretch of finished windows."""
        done = self.done()
        return done[0].end if done else None

    def clear(self) -> None:
        remove_path(self.spark, self.path)
