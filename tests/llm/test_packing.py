from __future__ import annotations

import bisect
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import packing
from ledgerloom.llm.queries import QUERIES
from llm_rows import SMALL, docs_of


def check_places(rows, capacity=packing.CAPACITY):
    """Sequences are gapless from 0 and not too long; returns how many there are."""
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_query_equals_the_tokenizer(spark):
    rows = QUERIES["op1_best_fit_packing"](spark, SMALL).collect()
    plain = Tokenizer.from_file(packing.TOKENIZER)
    want = set()
    for i, text in duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall():
        ids = [*plain.encode(text, add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.add((i, piece, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())))
    assert {tuple(r)[:5] for r in rows} == want and len(rows) == len(want)
    assert check_places(rows) <= -(-sum(r.length for r in rows) // 2048) * 1.02 + 1


def one_at_a_time(lengths, capacity=2048):
    """Sequences that sequential best-fit decreasing needs."""
    gaps, n = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, length)
        if at < len(gaps):
            gap = gaps.pop(at)
        else:
            gap, n = capacity, n + 1
        bisect.insort(gaps, gap - length)
    return n


@pytest.mark.parametrize("name", ["any", "tiny", "copies", "thirds", "over_half", "one", "none"])
def test_packs_tightly(spark, name):
    rng = random.Random(3)
    lengths = {
        "any": [rng.randrange(1, 2049) for _ in range(3000)],
        "tiny": [rng.randrange(1, 30) for _ in range(3000)],
        "copies": [700] * 2000 + [5] * 400 + [2048] * 3,
        "thirds": [rng.randrange(600, 700) for _ in range(900)],
        "over_half": [1500] * 50,
        "one": [7],
        "none": [],
    }[name]
    found = spark.createDataFrame(
        [(i, 0, 0, n, 0) for i, n in enumerate(lengths)],
        "doc_id long, piece int, start long, length long, ids_crc32 long",
    )
    rows = packing.pack(found).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(lengths)))
    assert check_places(rows) <= one_at_a_time(lengths) * 1.01 + 1


def test_edge_texts(spark):
    odd = [
        None, "", " ", "a  b", "a\n b", "tail ", "　x y", "<|endoftext|> a", "don't  stop  now", "\n\n", "é" * 3,
        "word " * 9000, "x" * 5000, "  a", "a \tb", "1234 ### !",
    ]
    docs = docs_of(spark, [*enumerate(odd), (None, "no key"), (3, "a  b")])
    plain = Tokenizer.from_file(packing.TOKENIZER)
    got = {}
    rows = packing.pieces(docs, with_ids=True).where(F.col("doc_id").isNotNull()).collect()
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        got.setdefault(r.doc_id, []).extend(r.ids)
    got[3] = got[3][: len(got[3]) // 2]  # the row stands there twice
    assert got == {i: [*plain.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(odd)}
    packed = packing.pack(packing.pieces(docs, with_ids=True))
    assert check_places(packed.collect()) >= 1
    assert packing.sequences(packed).where(F.size("ids") > 2048).count() == 0
    total = packing.sequences(packed).select(F.sum(F.size("ids"))).first()[0]
    assert total == packing.pieces(docs).select(F.sum("length")).first()[0]
