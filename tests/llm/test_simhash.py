from __future__ import annotations

import random

import duckdb
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import simhash
from ledgerloom.llm.queries import QUERIES
from llm_rows import SMALL, docs_of


def plain_fingerprint(text: str) -> int:
    words = [w.lower() for w in (text or "").encode().split()]
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: dict[int, int], radius: int = 3) -> dict[int, int]:
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def test_query_equals_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    prints = {i: plain_fingerprint(t) for i, t in rows}
    want = {i: (f"{prints[i]:016x}", c) for i, c in plain_components(prints).items()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op8_simhash_bktree"](spark, SMALL).collect()}
    assert got == want
    assert len({c for _, c in got.values()}) < len(got)


def test_split_shards_lose_no_link(spark):
    rng = random.Random(1)
    codes = [rng.getrandbits(64) for _ in range(20)]
    for base in list(codes):  # chains of near codes, and many codes that share blocks
        for _ in range(15):
            codes.append(codes[-1] ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
            codes.append(base ^ sum(1 << rng.randrange(12) for _ in range(3)))
    codes = sorted(set(codes))
    prints = dict(enumerate(codes))
    want = plain_components(prints)
    df = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "fp long")
    for limit in (8, 10_000):
        found = {(r.a & (2**64 - 1), r.b & (2**64 - 1)) for r in simhash.links(df, max_shard=limit).collect()}
        assert all((a ^ b).bit_count() <= 64 for a, b in found)
        root = {c: c for c in codes}

        def find(c):
            while root[c] != c:
                c = root[c]
            return c

        for a, b in found:
            x, y = sorted((find(a), find(b)))
            root[y] = x
        assert {i: codes.index(find(c)) for i, c in prints.items()} == want


def test_edge_rows(spark):
    long = "word " * 50_000
    docs = docs_of(spark, [(5, None), (3, ""), (9, " \n"), (7, "one"), (8, "ONE"), (1, long), (2, long), (2, long), (None, "x y")])
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert got == {5: 3, 3: 3, 9: 3, 7: 7, 8: 7, 1: 1, 2: 1, None: None}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 7]
    assert simhash.near_duplicates(docs.where(F.lit(False))).count() == 0


def test_repeated_key_stays_once(spark):
    kept = simhash.keep_one(docs_of(spark, [(1, "a b c d"), (1, "a b c d"), (4, "p q r s t")]))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4]
