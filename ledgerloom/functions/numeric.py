from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(20,2)"
TOTAL = "decimal(38,2)"


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(MONEY)


def safe_divide(num: Column, den: Column) -> Column:
    """Ratio as double; null when the divisor is zero or either side is null."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def amount_when(cond: Column, amount: Column) -> Column:
    """The amount where the condition is true, otherwise 0 (also where the condition is null)."""
    return F.when(cond, amount).otherwise(F.lit(0).cast(MONEY))


def money_sum(cond: Column, amount: Column) -> Column:
    return F.sum(amount_when(cond, amount)).cast(TOTAL)
