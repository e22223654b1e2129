"""As-of join, trailing days from daily partials, and distinct counts that merge, against plain recomputation."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.asof import as_of_join
from ledgerloom.operators.rolling import absorb, daily_partials, distinct_state, fold, merged_distincts, slide

T0 = datetime(2024, 1, 1)
D0 = date(2024, 1, 1)


def at(hours):
    return None if hours is None else T0 + timedelta(hours=hours)


def facts_of(spark, rows):
    return spark.createDataFrame([(i, k, at(h)) for i, k, h in rows], "id long, k long, t timestamp_ntz")


def versions_of(spark, rows):
    return spark.createDataFrame([(k, at(a), at(b), v) for k, a, b, v in rows], "k long, s timestamp_ntz, e timestamp_ntz, v string")


@pytest.mark.parametrize("bucket", ["HOUR", "DAY", "YEAR"])
def test_as_of_join_equals_a_search(spark, bucket):
    """One key has a third of all facts; gaps, ties and times before the first version."""
    rng = random.Random(4)
    keys = [7 if i % 3 == 0 else rng.randrange(20) for i in range(600)]
    facts = [(i, k, rng.randrange(-50, 900)) for i, k in enumerate(keys)] + [(900, None, 5), (901, 7, None), (902, 77, 1), (0, 7, 3)]
    versions = []
    for k in range(20):
        starts = sorted(rng.sample(range(800), rng.randrange(5)))
        for a, b in zip(starts, [*starts[1:], None]):
            end = a + 1 if rng.random() < 0.2 else b
            versions.append((k, a, end, f"{k}@{a}"))
    versions += [(None, 1, None, "no key"), (7, None, None, "no time")]
    got = as_of_join(facts_of(spark, facts), versions_of(spark, versions), "k", "t", "s", ["v"], "e", bucket)

    def held(k, h):
        best = max((x for x in versions if x[0] == k and x[1] is not None and h is not None and x[1] <= h), key=lambda x: x[1], default=None)
        return best[3] if best and k is not None and (best[2] is None or best[2] > h) else None

    want = sorted(((i, k, at(h), held(k, h)) for i, k, h in facts), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert got.columns == ["id", "k", "t", "v"] and sum(w[3] is not None for w in want) > 100


def test_as_of_join_of_empty_sides(spark):
    facts, versions = facts_of(spark, [(1, 1, 5)]), versions_of(spark, [(1, 2, None, "x")])
    assert as_of_join(facts.limit(0), versions, "k", "t", "s", ["v"]).count() == 0
    assert [r.v for r in as_of_join(facts, versions.limit(0), "k", "t", "s", ["v"]).collect()] == [None]


def test_no_window_of_the_as_of_join_spans_a_key(spark):
    join = as_of_join(facts_of(spark, [(1, 1, 5)]), versions_of(spark, [(1, 2, None, "x")]), "k", "t", "s", ["v"])
    text = join._jdf.queryExecution().executedPlan().toString()
    rows = [line for line in text.splitlines() if "last(_version" in line and "windowspecdefinition" in line]
    assert rows and all("_bucket" in line for line in rows) and "NestedLoop" not in text


HORIZONS = (2, 7, 30)


def payments(spark, rows):
    return spark.createDataFrame([(k, None if d is None else D0 + timedelta(days=d), Decimal(a)) for k, d, a in rows], "k long, d date, a decimal(20,2)")


def plain(rows, now):
    out = {}
    for k, d, a in rows:
        for h in HORIZONS:
            if d is not None and now - h <= d <= now:
                own = out.setdefault(k, {x: [0, Decimal(0)] for x in HORIZONS})[h]
                own[0] += 1
                own[1] += Decimal(a)
    return out


def state_rows(df):
    return {r.k: {h: [r[f"n_{h}d"], r[f"volume_{h}d"]] for h in HORIZONS} for r in df.collect()}


def test_days_enter_and_leave(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(12), rng.randrange(0, 90), f"{rng.randrange(1, 9999)}.25") for _ in range(400)] + [(1, None, "3")]
    late = [(rng.randrange(15), rng.randrange(0, 60), "1.50") for _ in range(60)]
    when = lambda n: D0 + timedelta(days=n)
    stored = daily_partials(payments(spark, rows), "k", "d", "a")
    more = daily_partials(payments(spark, late), "k", "d", "a")
    state = fold(stored, "k", when(40), HORIZONS)
    assert state_rows(state) == plain(rows, 40)
    state = absorb(state, more, "k", when(40), HORIZONS)
    assert state_rows(state) == plain(rows + late, 40)
    every = stored.unionByName(more)
    one = slide(state, every, "k", when(40), when(41), HORIZONS)
    assert state_rows(one) == plain(rows + late, 41)
    assert state_rows(slide(one, every, "k", when(41), when(95), HORIZONS)) == plain(rows + late, 95)
    assert state_rows(slide(state, every, "k", when(40), when(300), HORIZONS)) == {}
    assert state_rows(slide(state, every, "k", when(40), when(40), HORIZONS)) == plain(rows + late, 40)
    with pytest.raises(ValueError):
        slide(state, every, "k", when(41), when(40), HORIZONS)


def test_only_days_that_move_are_opened(spark, tmp_path):
    """The days between the ends of the horizons are made unreadable."""
    rows = [(d % 5, d, "2.00") for d in range(90)]
    daily_partials(payments(spark, rows), "k", "d", "a").repartition("day").write.partitionBy("day").parquet(str(tmp_path / "parts"))
    stored = spark.read.parquet(str(tmp_path / "parts"))
    state = spark.createDataFrame(fold(stored, "k", D0 + timedelta(days=60), HORIZONS).collect(), fold(stored, "k", D0, HORIZONS).schema)
    read = {f"day={D0 + timedelta(days=n)}" for n in (61, 62, 58, 59, 53, 54, 30, 31)}
    for file in tmp_path.glob("parts/day=*/*.parquet"):
        if file.parent.name not in read:
            file.write_bytes(b"no parquet")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    moved = slide(state, stored, "k", D0 + timedelta(days=60), D0 + timedelta(days=62), HORIZONS)
    assert state_rows(moved) == plain(rows, 62)


def test_distinct_states_merge(spark):
    rng = random.Random(2)
    rows = [(D0 + timedelta(days=rng.randrange(70)), "ab"[i % 2], rng.choice([None, 1, 40_000, -5, rng.randrange(200)]), rng.randrange(9)) for i in range(500)]
    df = spark.createDataFrame(rows, "d date, c string, x long, y int")
    daily = distinct_state(df, ["d", "c"], ["x", "y"]).withColumn("m", F.month("d"))
    got = {(r.m, r.c): (r.distinct_x, r.distinct_y) for r in merged_distincts(daily, ["m", "c"], ["x", "y"]).collect()}
    want = {}
    for d, c, x, y in rows:
        own = want.setdefault((d.month, c), (set(), set()))
        own[0].add(x)
        own[1].add(y)
    assert got == {k: (len(a - {None}), len(b)) for k, (a, b) in want.items()}


def test_a_distinct_state_is_no_larger_than_its_ids(spark):
    """Ids far apart, as a day's are in a large table: a row of a state takes bytes, not a bitmap of 4 KB."""
    df = spark.createDataFrame([(D0, i * 100_000 - 7, None if i % 2 else i) for i in range(50)], "d date, x long, y int")
    state = distinct_state(df, ["d"], ["x", "y"])
    assert state.count() <= 50 + 25
    cells = [c for row in state.collect() for c in row]
    assert sum(len(c) for c in cells if isinstance(c, (bytes, bytearray))) < 100 * 50
    got = merged_distincts(state, ["d"], ["x", "y"]).first()
    assert (got.distinct_x, got.distinct_y) == (50, 25)


def test_distinct_states_of_whole_words(spark):
    """All 64 bits of a word, ids at its edges and below zero, and the same id in two states."""
    edges = [-(2**63), -65, -64, -1, 0, 63, 64, 127, 2**63 - 1, *range(128, 192)]
    df = spark.createDataFrame([(D0 + timedelta(days=k), i) for k in (0, 1) for i in edges], "d date, x long")
    state = distinct_state(df, ["d"], ["x"]).withColumn("m", F.month("d"))
    assert merged_distincts(state, ["m"], ["x"]).first().distinct_x == len(edges)
