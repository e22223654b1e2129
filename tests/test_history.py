from __future__ import annotations

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerloom.operators.history import apply_snapshot, as_of_lookup, first_versions, history_from_changes

T0 = datetime(2024, 1, 1)
DDL = "k bigint, v string, updated_at timestamp_ntz"


def at(h):
    return T0 + timedelta(hours=h)


def state(spark, *tuples):
    return spark.createDataFrame([(k, v, at(h)) for k, v, h in tuples], DDL)


def spans(df):
    return sorted((r.k, r.v, r.valid_from, r.valid_to) for r in df.collect())


def fix(spark, df):
    return spark.createDataFrame(df.collect(), df.schema)


def key(row):
    return (row[0], row[2], row[1])


def test_snapshot_rules(spark):
    first = first_versions(state(spark, (1, "same", 1), (2, "a", 1), (3, "b", 5), (4, "gone", 1)), "k")
    second = state(spark, (1, "same", 1), (2, "a2", 3), (3, "older", 4), (5, "new", 2))
    h2 = fix(spark, apply_snapshot(first, second, "k", at(10)))
    assert sorted(map(tuple, [(r.k, r.v, r.valid_from, r.valid_to) for r in h2.collect()]), key=key) == [
        (1, "same", at(1), None),
        (2, "a", at(1), at(3)),
        (2, "a2", at(3), None),
        (3, "b", at(5), None),
        (4, "gone", at(1), at(10)),
        (5, "new", at(2), None),
    ]
    third = state(spark, (1, "same", 1), (2, "a2", 3), (3, "b", 5), (4, "back", 12), (5, "new", 2))
    h3 = apply_snapshot(h2, third, "k", at(20))
    fours = sorted((r.v, r.valid_from, r.valid_to) for r in h3.where("k = 4").collect())
    assert fours == [("back", at(12), None), ("gone", at(1), at(10))]
    assert h3.count() == 7
    kept = apply_snapshot(first, second, "k", at(10), hard_deletes=False)
    assert kept.where("k = 4").first().valid_to is None


def test_scd_id_is_stable(spark):
    h = first_versions(state(spark, (1, "a", 1)), "k").first()
    again = history_from_changes(state(spark, (1, "a", 1)).selectExpr("*", "1L AS seq"), "k", "seq").first()
    assert h.scd_id == again.scd_id and len(h.scd_id) == 32


CHANGE = st.tuples(st.integers(0, 3), st.sampled_from("abc"), st.integers(0, 60))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(CHANGE, min_size=1, max_size=10, unique_by=lambda c: (c[0], c[2])))
def test_one_pass_equals_snapshots(spark, changes):
    """Snapshotting after every change gives the history computed from the feed in one pass."""
    one_pass = history_from_changes(state(spark, *changes).selectExpr("*", "1L AS seq"), "k", "seq")
    history, current = None, {}
    for k, v, h in sorted(changes, key=lambda c: c[2]):
        current[k] = (k, v, h)
        now = state(spark, *current.values())
        history = first_versions(now, "k") if history is None else apply_snapshot(history, now, "k", at(h))
        history = fix(spark, history)
    got = sorted([(r.k, r.v, r.valid_from, r.valid_to) for r in one_pass.collect()], key=key)
    assert got == sorted([(r.k, r.v, r.valid_from, r.valid_to) for r in history.collect()], key=key)
    open_keys = [r.k for r in one_pass.where("valid_to IS NULL").collect()]
    assert sorted(open_keys) == sorted({c[0] for c in changes})
    per_key = {}
    for k, _, start, end in got:
        per_key.setdefault(k, []).append((start, end))
    for pieces in per_key.values():
        assert all(a[1] == b[0] for a, b in zip(pieces, pieces[1:]))


def test_as_of(spark):
    feed = state(spark, (1, "a", 0), (1, "b", 10), (2, "c", 20)).selectExpr("*", "1L AS seq")
    h = history_from_changes(feed, "k", "seq")
    seen = lambda hour: {r.k: r.v for r in as_of_lookup(h, at(hour)).collect()}
    assert [seen(-1), seen(0), seen(9), seen(10), seen(20)] == [{}, {1: "a"}, {1: "a"}, {1: "b"}, {1: "b", 2: "c"}]
