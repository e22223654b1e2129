"""Classification ladders. Each ladder is plain data, read in order; the first rung that fits wins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bank's classification tables.
CREDIT_BANDS = ((800, "exceptional"), (740, "very_good"), (670, "good"), (580, "fair"))
DPD_RANGES = ((0, 0), (1, 30), (31, 60), (61, 90), (91, None))
DPD_LABELS = ("current", "dpd_1_30", "dpd_31_60", "dpd_61_90", "npl")
PROVISION_RATES = ("0.01", "0.05", "0.15", "0.50", "1.00")
INCOME_ORDER = ("0-3jt", "3-5jt", "5-10jt", "10-25jt", "25-50jt", ">50jt")
SEVERITY_ORDER = ("low", "medium", "high", "critical")


def _ladder(rungs: Sequence[tuple[Column, Column]], default: Column | None = None) -> Column:
    first, *rest = rungs
    chain = reduce(lambda acc, rung: acc.when(*rung), rest, F.when(*first))
    return chain if default is None else chain.otherwise(default)


def credit_band(score: Column) -> Column:
    """A null score falls through to the lowest band."""
    return _ladder([(score >= low, F.lit(name)) for low, name in CREDIT_BANDS], F.lit("poor"))


def _dpd_rungs(dpd: Column, values: Sequence[Column]) -> list[tuple[Column, Column]]:
    tests = [dpd >= lo if hi is None else dpd.between(lo, hi) for lo, hi in DPD_RANGES]
    return list(zip(tests, values, strict=True))


def dpd_bucket(dpd: Column) -> Column:
    """Days past due to risk bucket; null and negative values are ``unknown``."""
    return _ladder(_dpd_rungs(dpd, [F.lit(x) for x in DPD_LABELS]), F.lit("unknown"))


def provision_rate(dpd: Column) -> Column:
    return _ladder(_dpd_rungs(dpd, [F.lit(x).cast("decimal(3,2)") for x in PROVISION_RATES]))


def income_band_sort(label: Column) -> Column:
    """Sortable rank of an income range label, 0 when unknown."""
    return _rank(label, INCOME_ORDER)


def severity_rank(severity: Column) -> Column:
    return _rank(severity, SEVERITY_ORDER)


def _rank(label: Column, order: Sequence[str]) -> Column:
    return _ladder([(label == name, F.lit(i)) for i, name in enumerate(order, start=1)], F.lit(0))


def step_score(value: Column, steps: Sequence, *, ascending: bool) -> Column:
    """Score 5 down to 2 for the first step reached, 1 when none is."""
    tests = [value >= s if ascending else value <= s for s in steps]
    return _ladder([(t, F.lit(score)) for t, score in zip(tests, (5, 4, 3, 2), strict=True)], F.lit(1))


def review_status(is_confirmed: Column, reviewed_at: Column) -> Column:
    """Three-valued review outcome; an undecided flag may still have been looked at."""
    return _ladder(
        [
            (is_confirmed, F.lit("confirmed_fraud")),
            (~is_confirmed, F.lit("false_positive")),
            (reviewed_at.isNotNull(), F.lit("reviewed_inconclusive")),
        ],
        F.lit("pending_review"),
    )
