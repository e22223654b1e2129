from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom import functions as fn
from ledgerloom.config import RunContext, resolve_execution_date, target_schema


def one(spark, make, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(make(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    "text, expected",
    [
        ("kota bogor-barat", "Kota Bogor-Barat"),
        ("o'hare", "O'hare"),
        ("JAWA (BARAT)", "Jawa (Barat)"),
        ("a_b.c/d", "A_B.C/D"),
        ("  two  spaces ", "  Two  Spaces "),
        ("", ""),
        (None, None),
        ("éric", "Éric"),
    ],
)
def test_title_words(spark, text, expected):
    assert one(spark, fn.title_words, text) == expected


@pytest.mark.parametrize(
    "text, expected", [("Jonathan", "Jo***an"), ("ab", "ab***ab"), ("a", "a***a"), ("", "***"), (None, None)]
)
def test_mask_pii(spark, text, expected):
    assert one(spark, fn.mask_pii, text) == expected
    assert one(spark, lambda c: fn.mask_pii(c, "prod"), text) == text


@pytest.mark.parametrize(
    "score, band",
    [(850, "exceptional"), (800, "exceptional"), (799, "very_good"), (740, "very_good"), (739, "good")]
    + [(670, "good"), (669, "fair"), (580, "fair"), (579, "poor"), (None, "poor")],
)
def test_credit_band(spark, score, band):
    assert one(spark, fn.credit_band, score, "int") == band


@pytest.mark.parametrize(
    "dpd, bucket, rate",
    [(0, "current", "0.01"), (1, "dpd_1_30", "0.05"), (30, "dpd_1_30", "0.05"), (31, "dpd_31_60", "0.15")]
    + [(60, "dpd_31_60", "0.15"), (61, "dpd_61_90", "0.50"), (90, "dpd_61_90", "0.50"), (91, "npl", "1.00")]
    + [(None, "unknown", None), (-1, "unknown", None)],
)
def test_dpd(spark, dpd, bucket, rate):
    assert one(spark, fn.dpd_bucket, dpd, "int") == bucket
    got = one(spark, fn.provision_rate, dpd, "int")
    assert (None if got is None else str(got)) == rate


def test_income_rank(spark):
    labels = ["0-3jt", "3-5jt", "5-10jt", "10-25jt", "25-50jt", ">50jt", "other", None]
    assert [one(spark, fn.income_band_sort, x) for x in labels] == [1, 2, 3, 4, 5, 6, 0, 0]


def test_calendar_differences_count_boundaries(spark):
    df = spark.createDataFrame([(date(2024, 12, 31), date(2025, 1, 1))], "a date, b date")
    r = df.select(
        fn.calendar_years(F.col("b"), F.col("a")).alias("y"),
        fn.calendar_months(F.col("b"), F.col("a")).alias("m"),
        fn.days_between(F.col("b"), F.col("a")).alias("d"),
    ).first()
    assert (r.y, r.m, r.d) == (1, 1, 1)


def test_whole_hours_and_zone(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 59), datetime(2024, 1, 1, 2, 0))], "a timestamp_ntz, b timestamp_ntz"
    )
    r = df.select(
        fn.whole_hours(F.col("b"), F.col("a")).alias("h"), fn.to_business_time(F.col("b")).alias("z")
    ).first()
    assert r.h == 1
    assert r.z == datetime(2024, 1, 1, 9, 0)


@pytest.mark.parametrize("day, business", [(date(2024, 6, 28), True), (date(2024, 6, 29), False), (date(2024, 6, 30), False), (date(2024, 7, 1), True)])
def test_business_day(spark, day, business):
    assert one(spark, fn.is_business_day, day, "date") is business


def test_partition_key(spark):
    assert one(spark, fn.partition_key, date(2024, 3, 9), "date") == 202403
    assert one(spark, lambda c: fn.partition_key(c, "DAY"), date(2024, 3, 9), "date") == 20240309
    with pytest.raises(ValueError, match="granularity"):
        fn.partition_key(F.col("v"), "WEEK")


def test_safe_divide(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 2.0), (3.0, 2.0)], "a double, b double")
    got = [r.r for r in df.select(fn.safe_divide(F.col("a"), F.col("b")).alias("r")).collect()]
    assert got == [None, None, 1.5]


def test_audit_columns(spark):
    ctx = RunContext(as_of=date(2024, 1, 2), env="ci", invocation_id="run-7")
    r = spark.range(1).select(*[c.alias(n) for n, c in fn.audit_columns(ctx, "m").items()]).first()
    assert r.asDict() == {
        "dbt_updated_at": datetime(2024, 1, 2),
        "dbt_invocation_id": "run-7",
        "dbt_model_name": "m",
        "dbt_target": "ci",
    }


def test_run_settings():
    assert resolve_execution_date({"execution_date": "2024-02-29"}, date(2024, 5, 1)) == date(2024, 2, 29)
    assert resolve_execution_date(None, date(2024, 3, 1)) == date(2024, 2, 29)
    assert target_schema("prod", "d", " marts ") == "marts"
    assert target_schema("prod", "d") == "d"
    assert target_schema("ci", "d", "marts ") == "ci_marts"
    assert target_schema("anything", "d") == "dev_d"
