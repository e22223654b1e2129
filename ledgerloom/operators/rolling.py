"""Activity of trailing days from stored daily partials: a day enters a horizon and leaves it, nothing is recounted.

Also exact distinct counts from daily states that merge into longer spans.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import TOTAL

DAY, N, VOLUME = "day", "n", "volume"


def daily_partials(rows: DataFrame, key: str, day: str, amount: str) -> DataFrame:
    """(key, day, n, volume). Partials of rows that come late are further rows: all folds add them up."""
    rows = rows.where(F.col(day).isNotNull())
    return rows.groupBy(key, F.col(day).alias(DAY)).agg(F.count("*").alias(N), F.sum(amount).cast(TOTAL).alias(VOLUME))


def _names(horizons: Sequence[int]) -> list[str]:
    return [name for h in horizons for name in (f"n_{h}d", f"volume_{h}d")]


def _weighed(partials: DataFrame, key: str, signs: dict[int, Column]) -> DataFrame:
    """Counts and volumes per key, each day taken with the sign that it has in a horizon."""
    sums = []
    for h, sign in signs.items():
        sums.append(F.sum(sign * F.col(N)).alias(f"n_{h}d"))
        sums.append(F.sum(sign * F.coalesce(F.col(VOLUME), F.lit(0).cast(TOTAL))).cast(TOTAL).alias(f"volume_{h}d"))
    return partials.groupBy(key).agg(*sums)


def _between(low: date, high: date) -> Column:
    """Days after ``low``, up to ``high``."""
    return (F.col(DAY) > F.lit(low)) & (F.col(DAY) <= F.lit(high))


def _sign(*cases: tuple[Column, int]) -> Column:
    out = F.lit(0)
    for cond, value in reversed(cases):
        out = F.when(cond, value).otherwise(out)
    return out


def _any_activity(state: DataFrame, horizons: Sequence[int]) -> DataFrame:
    return state.where(F.greatest(*[F.col(f"n_{h}d") for h in horizons]) > 0 if len(horizons) > 1 else F.col(f"n_{horizons[0]}d") > 0)


def fold(partials: DataFrame, key: str, at: date, horizons: Sequence[int]) -> DataFrame:
    """(key, n_30d, volume_30d, ...): activity on the last h days up to ``at``, the h-th day before it included."""
    spans = {h: _between(at - timedelta(days=h + 1), at) for h in horizons}
    seen = partials.where(_between(at - timedelta(days=max(horizons) + 1), at))
    return _weighed(seen, key, {h: _sign((span, 1)) for h, span in spans.items()})


def _added(state: DataFrame, change: DataFrame, key: str, horizons: Sequence[int]) -> DataFrame:
    names = _names(horizons)
    both = state.select(key, *names).unionByName(change.select(key, *names))
    sums = [F.sum(c).cast(state.schema[c].dataType).alias(c) for c in names]
    return _any_activity(both.groupBy(key).agg(*sums), horizons)


def absorb(state: DataFrame, late: DataFrame, key: str, at: date, horizons: Sequence[int]) -> DataFrame:
    """The state after partials that came late, for days up to ``at``."""
    return _added(state, fold(late, key, at, horizons), key, horizons)


def slide(
    state: DataFrame, partials: DataFrame, key: str, was: date, now: date, horizons: Sequence[int]
) -> DataFrame:
    """The state of ``was`` moved on to ``now``: days that enter are added, days that leave are taken off.

    Of the partials only those days are read, 2 x (now - was) for each horizon: where they are stored by day, other
    days are not opened. A key without activity in any horizon has no row. ``partials`` must hold what the state
    holds, late partials included. A step longer than a horizon needs no other rule.
    """
    if now < was:
        raise ValueError(f"{now} is before {was}: fold the partials anew")
    signs, days = {}, []
    for h in horizons:
        low, new_low = was - timedelta(days=h + 1), now - timedelta(days=h + 1)
        enter, leave = _between(max(was, new_low), now), _between(low, min(was, new_low))
        signs[h] = _sign((enter, 1), (leave, -1))
        days += [enter, leave]
    moved = partials.where(reduce(Column.__or__, days))
    return _added(state, _weighed(moved, key, signs), key, horizons)


# ---- distinct counts ------------------------------------------------------------------------------------


def distinct_state(rows: DataFrame, by: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """(by, id_column, id_word, bits): which ids a group has, 64 consecutive ids a row as the bits of a long.

    Built with map-side combination, column by column; a null id counts as none. A row takes a few bytes whether one
    of its ids occurs or all do, so a state is at most as long as the rows it is made from.
    """
    parts = []
    for c in ids:
        named = rows.select(*by, F.lit(c).alias("id_column"), F.col(c).cast("long").alias("_id")).where("_id IS NOT NULL")
        words = named.groupBy(*by, "id_column", F.shiftright("_id", 6).alias("id_word"))
        parts.append(words.agg(F.bit_or(F.expr("shiftleft(1L, cast(_id & 63 as int))")).alias("bits")))
    return reduce(DataFrame.unionByName, parts)


def merged_distincts(state: DataFrame, by: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """(by, distinct_<id>...): exact distinct counts of a coarser group, from states alone."""
    whole = state.groupBy(*by, "id_column", "id_word").agg(F.bit_or("bits").alias("bits"))
    counted = whole.select(*by, "id_column", F.bit_count("bits").alias("_n"))
    sums = [F.coalesce(F.sum(F.when(F.col("id_column") == c, F.col("_n"))), F.lit(0).cast("long")).alias(f"distinct_{c}") for c in ids]
    return counted.groupBy(*by).agg(*sums)
