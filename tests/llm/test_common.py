from __future__ import annotations

import random

from pyspark.sql import functions as F

from ledgerloom.llm import common


def test_components_of_any_graph(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (200, 201), (201, 200)]
    edges += [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(45)]
    root = {}

    def find(k):
        root.setdefault(k, k)
        while root[k] != k:
            k = root[k]
        return k

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: find(k) for k in linked}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hashed_sample_is_whole_and_stable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = common.hashed_sample(df, 5000, 300, "k")
    b = common.hashed_sample(df.repartition(7), 5000, 300, "k")
    assert a.count() == 300 and a.exceptAll(b).count() == 0
    first = df.orderBy(F.pmod(F.xxhash64("k"), F.lit(1 << 32)), "k").limit(300)
    assert a.exceptAll(first).count() == 0
    assert common.hashed_sample(df, 5000, 9000, "k").count() == 5000


def test_bucket_is_crc32_of_the_text(spark):
    import zlib

    rows = spark.range(50).select("id", common.bucket("id", 10).alias("b")).collect()
    assert all(r.b == zlib.crc32(str(r.id).encode()) % 10 for r in rows)
