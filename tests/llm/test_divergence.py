from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np

from ledgerloom.llm import divergence
from ledgerloom.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, value long, term string, n long, rank int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least=3, top=200):
    """The contract's rows, from Python integers over the full matrix."""
    docs = [("" if x is None else x for x in row) for row in rows]
    by_lang = defaultdict(list)
    for text, lang, source in docs:
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in TERM.findall(text)]
        by_lang[lang].append((source, Counter(words)))
    out = []
    for lang, own in by_lang.items():
        df = Counter(w for _, c in own for w in c)
        kept = {w for w, n in df.items() if n >= least}
        groups = defaultdict(Counter)
        for source, c in own:
            groups[source].update({w: n for w, n in c.items() if w in kept})
        every = Counter()
        for c in groups.values():
            every.update(c)

        def share(c, w):
            return 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept))

        for source, c in groups.items():
            parts = {"pair": {}, "term": {}}
            for other, d in groups.items():
                if other != source:
                    parts["pair"][other] = sum((share(c, w) - share(d, w)) ** 2 // share(d, w) for w in kept)
            for w in kept:
                p, q = share(c, w), share(every, w)
                if c[w] > 0 and p > q:
                    parts["term"][w] = (p - q) ** 2 // q
            for part, items in parts.items():
                order = sorted(items.items(), key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, source, part, i, v, n + 1) for n, (i, v) in enumerate(order) if part == "pair" or n < top]
    return sorted(out)


def rows_of(df):
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in df.collect())


ODD = [
    ("Same words HERE Été été x1y", "en", "a"), ("same words here été", "en", "a"), ("same WORDS here x y y", "en", "b"), ("same words y", "en", "b"),
    (None, "en", "empty"), ("", "en", None), ("12 34", "en", "c"), ("rare one", "en", "c"), ("same same same same", "en", "d"), ("only here", "xx", "a"),
    ("also", "xx", "b"), (None, None, None), ("\U0001f600 \U0001f600", None, "z"), ("\U0001f600", None, "z"), ("\U0001f600 ￮", None, "y"), ("￮ ￮", None, "y"), ("￮", None, "y"),
]


def test_odd_rows_in_any_blocks(spark):
    docs = spark.createDataFrame([(i, *row, 1, "t", 2, 3) for i, row in enumerate(ODD)], SCHEMA)
    want = plain(ODD)
    assert rows_of(divergence.audit(docs)) == want
    assert rows_of(divergence.audit(docs, group_block=2, term_block=2)) == want
    assert rows_of(divergence.audit(docs, top_terms=1)) == plain(ODD, top=1)
    assert divergence.audit(docs.where("doc_id < 0")).count() == 0


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = con.sql(f"SELECT lang, source, part, item, value, rank FROM ({ORACLE['op11_source_divergence']})").fetchall()
    assert rows_of(QUERIES["op11_source_divergence"](spark, SMALL)) == sorted(want)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert rows_of(divergence.audit(docs, group_block=6, term_block=300)) == sorted(want)


def test_joint_walk_equals_the_full_matrix():
    rng = np.random.default_rng(1)
    for n, width, share in ((1, 1, 1.0), (5, 37, 0.2), (9, 300, 0.02), (3, 8, 0.0), (12, 64, 0.9)):
        dense = rng.integers(1, 1000, (n, width)) * (rng.random((n, width)) < share)
        totals = dense.sum(1) + width
        rows, cols = np.nonzero(dense)
        p = [[1 + 10**9 * (int(c) + 1) // int(t) for c in row] for row, t in zip(dense, totals)]
        want = [[sum((a - b) ** 2 // b for a, b in zip(x, y)) for y in p] for x in p]
        for most in (1, 1 << 8, 1 << 20):
            got = divergence.divergences(rows, cols, dense[rows, cols], totals, width, None, most)
            assert got.tolist() == want
        half = divergence.divergences(rows, cols, dense[rows, cols], totals, width, n // 2)
        assert all(half[i, j] == want[i][j] for i in range(n // 2) for j in range(n // 2, n))


def test_shares_of_large_counts_are_exact():
    counts, totals = [1, 10**9, 2 * 10**14, 7 * 10**13 + 1], [3, 10**9 + 7, 2 * 10**14 + 9, 2 * 10**14 + 9]
    got = divergence.per_unit(np.array(counts), np.array(totals))
    assert got.tolist() == [1 + 10**9 * c // t for c, t in zip(counts, totals)]


def test_sums_handed_on_early_add_up(spark):
    docs = spark.createDataFrame([(t or "", lang or "", s or "") for t, lang, s in ODD * 3], "text string, lang string, source string").coalesce(1)

    def added(most):
        rows = divergence.term_counts(docs.select("lang", "source", "text"), most).collect()
        sums = defaultdict(lambda: (0, 0))
        for r in rows:
            n, d = sums[r.lang, r.source, r.term]
            sums[r.lang, r.source, r.term] = n + r.n, d + r.docs
        return len(rows), dict(sums)

    few, want = added(10**6)
    assert few == len(want)
    for most in (1, 4, 12):
        many, got = added(most)
        assert got == want and many > few


def test_a_cell_is_priced_once_for_all_pairs(monkeypatch):
    """Tables and sorted lists of quadrants give the same; the share of a cell is not worked out again for each pair."""
    rng = np.random.default_rng(3)
    rows, cols = np.nonzero(rng.random((40, 300)) < 0.3)
    order = rng.permutation(len(rows))
    rows, cols = rows[order], cols[order]
    counts, totals = rng.integers(1, 9, len(rows)), rng.integers(5_000, 10**6, 40)
    priced, whole = [], divergence.per_unit
    monkeypatch.setattr(divergence, "per_unit", lambda n, total: priced.append(len(n)) or whole(n, total))
    got = divergence.divergences(rows, cols, counts, totals, 300)
    assert sum(priced) <= len(rows) + 2 * len(totals)
    matrix = np.zeros((40, 300), np.int64)
    matrix[rows, cols] = counts
    p = whole(matrix + 1, totals[:, None])
    for i in range(40):
        assert (got[i] == ((p[i] - p) ** 2 // p).sum(1)).all()
    init = divergence.Quadtree.__init__
    for most in (0, 900):  # every level as a list; only the lower ones
        monkeypatch.setattr(divergence.Quadtree, "__init__", lambda self, *args, most=most: init(self, *args, most=most))
        assert (divergence.divergences(rows, cols, counts, totals, 300) == got).all()
