from __future__ import annotations

import duckdb
import numpy as np

from ledgerloom.llm import ann
from ledgerloom.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, rep long, part int"


def brute(rows, queries, top=20):
    """{query: [(id, score)]} over all usable rows."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for q in queries:
        at = int(np.flatnonzero(ids == q)[0])
        dots = x @ x[at]
        order = [j for j in np.lexsort((ids, -dots)) if ids[j] != q][:top]
        out[q] = [(int(ids[j]), float(dots[j])) for j in order]
    return out


def answers(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(got[r.query_id]) == r.rank
    return got


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in w}) / len(w) for q, w in want.items()])


def test_small_table_is_exact(spark):
    rows = duckdb.sql("SELECT vec_id, embedding FROM '/root/testdata/sf0.01/embeddings.parquet'").fetchall()
    got = answers(QUERIES["op5_learned_partitions"](spark, "/root/testdata/sf0.01"))
    want = brute(rows, [i for i, _ in rows if i % 20 == 0])
    assert set(got) == set(want) and recall(got, want) >= 0.9
    for q, near in got.items():
        true = {i: s for i, s in brute(rows, [q], len(rows))[q]}
        assert all(abs(s - true[i]) < 1e-12 for i, s in near) and len(near) == 20


def test_routed_recall_and_blocks(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    x = (centres[rng.integers(0, 40, 3000)] + 0.4 * rng.normal(size=(3000, 16))).astype(np.float32)
    x[100:400] = x[7]  # one vector in 301 rows
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame([(i, v, None, 1) for i, v in rows], SCHEMA)
    got = answers(ann.search(df, df.where("vec_id % 20 = 0"), fineness=3.0, block=60, sample=1200))
    want = brute(rows, range(0, 3000, 20))
    assert recall(got, want) >= 0.9 and all(len(g) == 20 for g in got.values())
    assert got[100] == want[100] and [i for i, _ in got[120]][:3] == [7, 100, 101]


def test_unusable_rows_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (40, None), (60, [nan, 1.0]), (80, [0.0, 0.0]), (100, [None, 1.0]), (120, [inf, 1.0])]
    rows += [(140, []), (None, [1.0, 1.0]), (3, [1.0, 0.0]), (4, [1.0, 0.0]), (160, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(*r, None, 1) for r in rows], SCHEMA)
    got = answers(ann.search(df, df.where("vec_id % 20 = 0")))
    assert got == {0: [(3, 1.0), (4, 1.0), (20, 0.5)], 20: [(0, 0.5), (3, 0.5), (4, 0.5)]}
    assert ann.search(df.limit(0), df.limit(0)).count() == 0


def test_cut_is_balanced_and_better_than_the_first():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(800, 8))
    graph = ann.nearest(x, x, 10, True)
    first = ann.split_halves(x, 8, rng)
    labels = ann.balance_cut(graph, first, 8)
    assert np.bincount(labels, minlength=8).max() <= 105
    inside = [(labels[graph] == labels[:, None]).mean(), (first[graph] == first[:, None]).mean()]
    assert inside[0] > inside[1]
