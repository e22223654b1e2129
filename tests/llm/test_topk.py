from __future__ import annotations

import duckdb
import numpy as np

from ledgerloom.llm import topk
from ledgerloom.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, score long, row_block int, id string"


def rows_of(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def brute(rows, queries, k):
    """Every query against every other row, in whole numbers of any size."""
    whole = {(i, tuple(int(np.floor(256.0 * x)) for x in v)) for i, v in rows}
    out = []
    for q, v in whole:
        if q in queries:
            near = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SCHEMA)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    want = con.sql(f"SELECT query_id, rank, vec_id, score FROM ({ORACLE['op12_threshold_topk']})").fetchall()
    assert rows_of(QUERIES["op12_threshold_topk"](spark, SMALL)) == sorted(want)


def test_blocks_ties_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(-3, 4, (300, 5)) / 256.0  # few values: many ties
    x[40:120] = x[7]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(300, [0.0] * 5), (350, [0.5, 0.5]), (351, [0.25, 0.5]), (400, []), (401, []), (7, x[7].tolist()), (20, x[21].tolist())]
    odd = [(500, None), (501, [1.0, None, 1.0, 1.0, 1.0]), (550, [float("nan")] * 5), (551, [float("inf")] * 5), (None, x[3].tolist())]
    df = frame(spark, rows + odd)
    got = topk.search(df, df.where("vec_id % 10 = 0"), row_block=40, query_block=7)
    assert rows_of(got) == brute(rows, set(range(0, 600, 10)), 5)
    assert rows_of(topk.search(df, df.where("vec_id = 20"), top=1000)) == brute(rows, {20}, 1000)
    assert rows_of(topk.search(df.where("vec_id < 0"), df.where("vec_id < 0"))) == []
    assert rows_of(topk.search(df.where("vec_id = 300"), df.where("vec_id = 300"))) == []


def test_large_numbers_stay_exact(spark):
    rows = [(i, [1e6 + i, -3e6, 7.0 * i]) for i in range(60)]
    df = frame(spark, rows)
    assert rows_of(topk.search(df, df.where("vec_id % 50 = 0"))) == brute(rows, {0, 50}, 5)


def test_walk_ends_at_the_threshold():
    """On rows with a few large components the lists are left early; a bar from elsewhere ends the walk earlier still."""
    rng = np.random.default_rng(5)
    x = np.floor(256 * rng.normal(size=(4000, 32)) * (rng.random((4000, 32)) < 0.06))
    lists, none = topk.Lists(x), np.zeros(0, np.int64)
    for query in x[:40]:
        at, scores, depth = lists.top(query, 5, none)
        want = np.lexsort((np.arange(4000), -(x @ query)))[:5]
        assert at.tolist() == want.tolist() and scores.tolist() == (x @ query)[want].tolist()
        if np.count_nonzero(query):
            assert depth <= 1000
            again, _, less = lists.top(query, 5, none, scores[-1])
            assert again.tolist() == at.tolist() and less <= depth
