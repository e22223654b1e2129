from __future__ import annotations

from datetime import date
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import sampling
from ledgerloom.sources import SPECS, jdbc_options, month_predicates, read_source, reference_dim
from ledgerloom.sources.contracts import INGESTED, TRANSACTIONS
from ledgerloom.sources.readers import sources_from_jdbc


def test_contracts():
    assert len(SPECS) == 13 and set(INGESTED) <= set(SPECS)
    for spec in SPECS.values():
        assert spec.key in spec.required and spec.loaded_at in spec.columns
        assert set(spec.cluster_by) <= set(spec.columns)
    assert SPECS["accounts"].schema["balance"].dataType.simpleString() == "decimal(20,2)"
    assert not SPECS["accounts"].schema["balance"].nullable and SPECS["accounts"].schema["dpd"].nullable


def test_jdbc_options():
    core = jdbc_options(SPECS["accounts"], {"url": "jdbc:postgresql://db/core", "user": "u", "password": "p"}, (1, 900, 30))
    assert core["dbtable"] == "public.accounts" and core["user"] == "u"
    assert [core[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == ["account_id", "1", "900", "30"]
    txn = jdbc_options(SPECS["transactions"], {"url": "jdbc:mysql://db/txn"})
    assert txn["url"] == "jdbc:mysql://db/txn?connectionTimeZone=Asia/Jakarta&useCursorFetch=true"
    assert txn["dbtable"] == "transactions" and "useCursorFetch" not in core["url"]
    set_ = jdbc_options(SPECS["transactions"], {"url": "jdbc:mysql://db/txn?useCursorFetch=false"})
    assert set_["url"] == "jdbc:mysql://db/txn?useCursorFetch=false&connectionTimeZone=Asia/Jakarta"
    assert txn["preferTimestampNTZ"] == "true" and "partitionColumn" not in txn


def test_month_predicates_cover_every_date_once(spark):
    predicates = month_predicates("d", date(2024, 11, 5), date(2025, 2, 1))
    assert len(predicates) == 6
    days = spark.sql("SELECT explode(sequence(DATE '2024-09-01', DATE '2025-04-30')) AS d")
    hits = sum((F.expr(p).cast("int") for p in predicates[1:]), F.expr(predicates[0]).cast("int"))
    assert days.where(hits != 1).count() == 0


def test_jdbc_scan_by_month_or_key():
    """What is asked of the reader; nothing is connected to."""
    asked = {}

    class Reader:
        def format(self, name):
            return self

        def options(self, **options):
            asked["options"] = options
            return self

        def load(self):
            return "by key"

        def jdbc(self, url, table, predicates, properties):
            asked.update(url=url, table=table, predicates=predicates, properties=properties)
            return "by month"

    session = SimpleNamespace(read=Reader())
    to = {"url": "jdbc:mysql://db/txn", "user": "u"}
    months = ("transaction_date", date(2024, 1, 1), date(2024, 3, 1))
    assert read_source(session, SPECS["transactions"], connection=to, months=months, bounds=(1, 2, 3)) == "by month"
    assert len(asked["predicates"]) == 5 and asked["table"] == "transactions"
    assert "partitionColumn" not in asked["properties"] and asked["properties"]["user"] == "u"
    found = sources_from_jdbc(session, {TRANSACTIONS: to})
    assert found["merchants"]() == "by key" and asked["options"]["dbtable"] == "merchants"
    assert "customers" not in found


def test_read_source(spark, tmp_path):
    spark.range(3).withColumnRenamed("id", "branch_id").write.parquet(str(tmp_path / "b"))
    df = read_source(spark, SPECS["branches"], path=str(tmp_path / "b"))
    df.createOrReplaceTempView("branches_v")
    assert read_source(spark, SPECS["branches"], table="branches_v").count() == 3
    with pytest.raises(ValueError, match="exactly one"):
        read_source(spark, SPECS["branches"], path="x", table="y")


def test_reference_dims(spark):
    sizes = {n: reference_dim(spark, n).count() for n in ("transaction_types", "payment_methods", "merchant_categories", "product_types")}
    assert sizes == {"transaction_types": 15, "payment_methods": 8, "merchant_categories": 15, "product_types": 7}


@pytest.mark.parametrize("n, fraction, expected", [(1, 0.008, 1), (124, 0.008, 1), (1000, 0.008, 8), (5000, 0.5, 2500), (100, 1.0, 100), (0, 0.5, 0)])
def test_sample_fraction_is_exact(spark, n, fraction, expected):
    df = spark.range(n).withColumnRenamed("id", "k")
    got = sampling.sample_fraction(df, "k", fraction, seed=3)
    assert got.count() == expected == got.distinct().count()
    again = sampling.sample_fraction(df.repartition(3), "k", fraction, seed=3)
    assert got.exceptAll(again).count() == 0
    brute = df.orderBy(sampling.key_hash("k", 3), "k").limit(expected)
    assert got.exceptAll(brute).count() == 0


def test_sample_n(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    a, b = sampling.sample_n(df, "k", 20, 1), sampling.sample_n(df, "k", 20, 2)
    assert a.count() == 20 and a.exceptAll(b).count() > 0


def test_weighted_choice(spark):
    weights = {"a": 70, "b": 25, "c": 5}
    df = spark.range(20000).select(sampling.weighted_choice("id", weights).alias("c"))
    got = {r.c: r["count"] / 20000 for r in df.groupBy("c").count().collect()}
    assert all(abs(got[k] - w / 100) < 0.01 for k, w in weights.items())
    assert spark.range(2).select(sampling.weighted_choice("id", {"only": 3}).alias("c")).distinct().first().c == "only"
