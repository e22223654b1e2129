from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import rows
from ledgerloom.operators import ingest, merge
from ledgerloom.operators.ingest import SchemaConflict, Window
from ledgerloom.operators.ranking import dedup_latest, flag_latest, newest_first, next_value, top1_per_group
from ledgerloom.plans import pipeline
from ledgerloom.sources.contracts import SPECS, TableSpec

T0 = datetime(2024, 1, 1)
DDL = "k bigint, v string, t timestamp_ntz, seq bigint"
SPEC = TableSpec("core_banking", "things", "k", "k BIGINT NOT NULL, v STRING, t TIMESTAMP_NTZ, seq BIGINT", loaded_at="t")


def at(h):
    return None if h is None else T0 + timedelta(hours=h)


def frame(spark, *tuples):
    return spark.createDataFrame([(k, v, at(h), s) for k, v, h, s in tuples], DDL)


def values(df):
    return {r.k: r.v for r in df.collect()}


def test_column_list():
    spec = TableSpec("s", "t", "a", "a BIGINT NOT NULL, b STRING", columns_text="b,\n a,\n")
    assert spec.columns == ["b", "a"]
    assert spec.required == ["a"]
    with pytest.raises(ValueError, match="typo"):
        _ = TableSpec("s", "t", "a", "a BIGINT", columns_text="a, typo").columns


def test_project_cast(spark):
    raw = spark.createDataFrame([(1, 7, "extra")], "k int, v int, x string").withColumn("t", F.lit(None)).withColumn("seq", F.lit("9"))
    out = ingest.project_cast(raw, SPEC)
    assert out.dtypes == [("k", "bigint"), ("v", "string"), ("t", "timestamp_ntz"), ("seq", "bigint")]
    assert out.first().seq == 9
    assert ingest.project_cast(raw, SPEC, evolve=True).columns == ["k", "v", "t", "seq", "x"]
    with pytest.raises(ValueError, match="lacks columns: seq"):
        ingest.project_cast(raw.drop("seq"), SPEC)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ingest.project_cast(raw.withColumn("seq", F.lit("nine")), SPEC).collect()


def test_window_is_half_open(spark):
    df = frame(spark, (1, "before", -1, 0), (2, "start", 0, 0), (3, "end", 24, 0), (4, "null", None, 0))
    kept = ingest.window_filter(df, "t", Window(T0, T0 + timedelta(days=1)))
    assert values(kept) == {2: "start"}


def test_window_of_schedule():
    w = Window.of_schedule(datetime(2024, 3, 11, 2), datetime(2024, 3, 12, 2))
    assert w == Window(datetime(2024, 3, 11, 9), datetime(2024, 3, 12, 9))
    w = Window.of_schedule(datetime(2024, 3, 11, 2), datetime(2024, 3, 12, 2), window_end="2024-03-20 00:00:00")
    assert w == Window(datetime(2024, 3, 11, 9), datetime(2024, 3, 20))
    cet = timezone(timedelta(hours=1))
    w = Window.of_schedule(datetime(2024, 3, 11, 3, tzinfo=cet), datetime(2024, 3, 12, 3, tzinfo=cet))
    assert w == Window(datetime(2024, 3, 11, 9), datetime(2024, 3, 12, 9))


def test_split_windows_cover():
    w = Window(datetime(2024, 1, 15), datetime(2024, 4, 2))
    months = w.split("month")
    assert [m.start for m in months] == [datetime(2024, 1, 15), datetime(2024, 2, 1), datetime(2024, 3, 1), datetime(2024, 4, 1)]
    assert months[-1].end == w.end and all(a.end == b.start for a, b in zip(months, months[1:]))
    assert len(w.split("day")) == 78


def test_dedup_latest(spark):
    df = frame(spark, (1, "old", 1, 1), (1, "tie low", 5, 2), (1, "tie high", 5, 3), (2, "null", None, 9), (2, "dated", 0, 1))
    assert values(dedup_latest(df, ["k"], "t", ["seq"])) == {1: "tie high", 2: "dated"}


def test_evolution(spark):
    base = frame(spark, (1, "a", 1, 1))
    same, outcome = ingest.evolve_schema(base, base)
    assert outcome == "no_changes" and same.columns == base.columns
    wide, outcome = ingest.evolve_schema(base, base.withColumn("n", F.lit(1)).withColumn("m", F.lit("x")))
    assert outcome == "added:n,m" and wide.dtypes[-2:] == [("n", "int"), ("m", "string")]
    again, outcome = ingest.evolve_schema(wide, base.withColumn("n", F.lit(1)))
    assert outcome == "no_changes" and again.columns == wide.columns
    with pytest.raises(SchemaConflict, match="v is string in the target, int incoming"):
        ingest.evolve_schema(base, base.withColumn("v", F.lit(1)))


def test_merge_cases(spark):
    target = frame(spark, (1, "t1", 5, 0), (2, "t2", 5, 0), (3, "t3", 5, 0), (4, "t4", None, 0), (5, "t5", 5, 0), (7, "t7", 5, 0))
    incoming = frame(
        spark,
        (1, "newer", 6, 0),
        (2, "equal", 5, 0),
        (3, "older", 4, 0),
        (4, "target time null", 9, 0),
        (5, "own time null", None, 0),
        (6, "inserted", 1, 0),
        (6, "inserted later", 2, 0),
    )
    expected = {1: "newer", 2: "t2", 3: "t3", 4: "t4", 5: "t5", 6: "inserted later", 7: "t7"}
    merged = merge.merge_upsert(target, incoming, "k", "t", tie_break=["seq"])
    assert values(merged) == expected and merged.count() == 7
    deleted = merge.merge_upsert(target, incoming, "k", "t", delete_missing=True, tie_break=["seq"])
    assert values(deleted) == {k: v for k, v in expected.items() if k != 7}


def test_merge_new_and_absent_columns(spark):
    target = frame(spark, (1, "a", 1, 10), (2, "b", 1, 20))
    incoming = frame(spark, (1, "a2", 2, 0), (3, "c", 2, 0)).drop("seq").withColumn("extra", F.lit("x"))
    merged = merge.merge_upsert(target, incoming, "k", "t")
    got = {r.k: (r.v, r.seq, r.extra) for r in merged.collect()}
    assert got == {1: ("a2", 10, "x"), 2: ("b", 20, None), 3: ("c", None, "x")}


ROW = st.tuples(st.integers(0, 5), st.sampled_from("abc"), st.one_of(st.none(), st.integers(0, 6)), st.integers(0, 99))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, max_size=8), st.lists(ROW, max_size=8))
def test_merge_properties(spark, old, new):
    """Against a plain-Python merge; and merging the same increment again changes nothing."""

    def newest(batch):
        out = {}
        for k, v, h, s in batch:
            rank = (h is not None, h or 0, s, v)
            if k not in out or rank > out[k][0]:
                out[k] = (rank, v, h, s)
        return {k: x[1:] for k, x in out.items()}

    stored, offered = newest(old), newest(new)
    want = dict(stored)
    for k, (v, h, s) in offered.items():
        if k not in stored:
            want[k] = (v, h, s)
        elif h is not None and stored[k][1] is not None and h > stored[k][1]:
            want[k] = (v, h, s)
    target = dedup_latest(frame(spark, *old), ["k"], "t", ["seq", "v"])
    incoming = frame(spark, *new)
    once = merge.merge_upsert(target, incoming, "k", "t", tie_break=["seq", "v"])
    twice = merge.merge_upsert(once, incoming, "k", "t", tie_break=["seq", "v"])
    as_dict = lambda df: {r.k: (r.v, r.t, r.seq) for r in df.collect()}
    assert as_dict(once) == {k: (v, at(h), s) for k, (v, h, s) in want.items()}
    assert as_dict(twice) == as_dict(once)


def test_backfill_by_day_equals_one_window(spark):
    feed = frame(spark, *[(i % 3, f"v{i}", i * 5, i) for i in range(40)])
    whole = Window(T0, T0 + timedelta(days=10))
    none = feed.limit(0)
    folded = none
    for w in whole.split("day"):
        folded = pipeline.ingest_relation(folded, feed, SPEC, w, ["seq"]).transform(
            lambda d: spark.createDataFrame(d.collect(), d.schema)
        )
    fused = pipeline.backfill_relation(none, feed, SPEC, whole.split("day"), ["seq"])
    assert values(folded) == values(fused) and len(values(fused)) == 3


def test_insert_ignore(spark):
    target = spark.createDataFrame([("A", 1)], "code string, n int")
    new = spark.createDataFrame([("A", 9), ("B", 3), ("B", 2), (None, 5)], "code string, n int")
    got = {(r.code, r.n) for r in merge.insert_ignore(target, new, ["code"], ["n"]).collect()}
    assert got == {("A", 1), ("B", 2), (None, 5)}


def test_upsert_columns(spark):
    target = spark.createDataFrame([(1, "old", "keep"), (2, "same", "keep")], "id int, name string, kind string")
    new = spark.createDataFrame([(1, "new", "ignored"), (3, "third", "taken")], "id int, name string, kind string")
    got = {r.id: (r.name, r.kind) for r in merge.upsert_columns(target, new, "id", ["name"]).collect()}
    assert got == {1: ("new", "keep"), 2: ("same", "keep"), 3: ("third", "taken")}


def test_lookback(spark):
    df = frame(spark, (1, "in", 0, 0), (2, "out", -1, 0))
    assert values(ingest.lookback(df, "t", date(2024, 1, 4))) == {1: "in"}


@pytest.mark.parametrize("hours, status", [(25, "pass"), (26, "warn"), (49, "warn"), (50, "error"), (None, "error")])
def test_freshness(spark, hours, status):
    df = frame(spark, (1, "x", 0 if hours is not None else None, 0))
    as_of = T0 + timedelta(hours=hours or 0)
    assert ingest.freshness(df, SPEC, as_of).first().status == status


def test_contract_gaps(spark):
    bad = rows(spark, "branches", {"branch_id": 1, "city": None}, {"branch_id": 2})
    gaps = {r.column_name: r.nulls for r in ingest.contract_gaps(bad, SPECS["branches"]).collect()}
    assert gaps["city"] == 1 and sum(gaps.values()) == 1 and "phone" not in gaps


def test_hot_key_ranking(spark):
    """One key holds most rows; every operator agrees with its plain window form."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"),
        (F.lit(T0.isoformat()).cast("timestamp_ntz") + F.expr("make_dt_interval(0, 0, id * 37 % 9001)")).alias("t"),
        "id",
    )
    df = dedup_latest(df, ["k", "t"], "t", ["id"])
    df.createOrReplaceTempView("hot")
    plain = spark.sql("SELECT *, lead(t) OVER (PARTITION BY k ORDER BY t) AS nxt FROM hot")
    for bucket in ("DAY", "HOUR", "MINUTE"):
        mine = next_value(df, "k", "t", "nxt", bucket)
        assert mine.exceptAll(plain.select(*mine.columns)).count() == 0
        assert mine.count() == df.count()
    flagged = flag_latest(df, "k", "id", newest_first("t", "id"))
    best = top1_per_group(df, ["k"], newest_first("t", "id"))
    assert flagged.where("is_latest").select("id").exceptAll(best.select("id")).count() == 0
    assert flagged.count() == df.count() and flagged.where("is_latest").count() == best.count()


def test_required_columns_are_enforced(spark):
    spec = TableSpec("core_banking", "things", "k", "k BIGINT NOT NULL, v STRING NOT NULL, t TIMESTAMP_NTZ", ("v",), loaded_at="t")
    df = frame(spark, (1, "a", 1, 0), (None, "b", 1, 0), (None, None, 1, 0), (4, None, None, 0))
    assert [r.k for r in ingest.required_only(df, spec, "aside").collect()] == [1]
    assert sorted(r.null_columns for r in ingest.set_aside(df, spec).collect()) == ["k", "k,v", "v"]
    assert ingest.required_only(df.limit(1), spec).count() == 1
    with pytest.raises(Exception, match="null in required columns"):
        ingest.required_only(df, spec).collect()
    with pytest.raises(ValueError, match="on_null"):
        ingest.required_only(df, spec, "skip")


def test_missing_required_source_column_is_an_error(spark):
    from helpers import mini, rows
    from ledgerloom.plans.staging import typed_source

    cat = mini(spark, accounts=rows(spark, "accounts").drop("balance"))
    with pytest.raises(ValueError, match="accounts.*balance"):
        typed_source(cat, "accounts")
    assert "dpd" in typed_source(mini(spark, accounts=rows(spark, "accounts").drop("dpd")), "accounts").columns
