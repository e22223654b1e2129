from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from ledgerloom.llm import suffix_dedup as s
from ledgerloom.llm.queries import QUERIES
from llm_rows import SMALL, docs_of


def plain(texts: list[bytes], length: int):
    """Per text the bytes that go, and those that stay."""
    places = defaultdict(list)
    for i, t in enumerate(texts):
        for p in range(len(t) - length + 1):
            places[t[p : p + length]].append((i, p))
    gone = [np.zeros(len(t), bool) for t in texts]
    for at in places.values():
        if len(at) > 1:
            for i, p in at:
                gone[i][p : p + length] = True
    return gone


def rows_of(texts, gone):
    out = []
    for t, g in zip(texts, gone):
        kept = bytes(np.frombuffer(t, np.uint8)[~g])
        runs = int((np.diff(g.astype(int), prepend=0) == 1).sum())
        out.append((len(t), int(g.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_query_equals_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    texts = [(t or "").encode() for _, t in rows]
    want = dict(zip((i for i, _ in rows), rows_of(texts, plain(texts, 400))))
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op7_common_prefix_dedup"](spark, SMALL).collect()}
    assert got == want and sum(w[1] for w in want.values()) > 0


def some_texts(rng: random.Random) -> list[str]:
    """Random texts with shared, nested, overlapping and periodic passages."""

    def word(n):
        return "".join(rng.choice("abcdé \n") for _ in range(n))

    passages = [word(n) for n in (19, 20, 21, 40, 75, 130)]
    texts = ["".join(rng.choice([word(rng.randrange(30)), rng.choice(passages), rng.choice(passages)[5:30]]) for _ in range(6)) for _ in range(60)]
    near = word(200)
    texts += [near[:k] + "#" + near[k + 1 :] for k in range(0, 200, 23)] + [near, near, "ab" * 60, "a" * 90, "", "x", near[60:90]]
    return texts


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("max_group", [3, 10_000])
def test_any_texts(spark, seed, max_group):
    texts = some_texts(random.Random(seed))
    raw = [t.encode() for t in texts]
    want = {i: r for i, r in enumerate(rows_of(raw, plain(raw, 20)))}
    found = s.dedup(docs_of(spark, enumerate(texts)), length=20, gram=8, max_group=max_group).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in found}
    assert got == want


def test_intervals_are_those_of_the_tree():
    parts = sorted([b"aab", b"aac", b"aba", b"abb", b"abbc", b"b"])
    found = sorted(s.intervals(s.common(parts), 1))
    assert found == [(1, 0, 4), (2, 0, 1), (2, 2, 4), (3, 3, 4)]


def test_groups_have_all_occurrences_and_left_diversity():
    # All four share "ABCD" after two bytes; the first three go on with "EF", the first and third with "EFyy".
    contexts = [b"xxABCDEFyy", b"zxABCDEFqq", b"kkABCDEFyy", b"kkABCD"]
    groups = {right: (diverse, sorted(zip(m.tolist(), left.tolist()))) for right, diverse, m, left in s.repeats(contexts, [2] * 4, 6)}
    assert groups[8] == (1, [(0, 0), (2, 0)])
    assert groups[6] == (2, [(0, 1), (1, 1), (2, 0)])
    assert groups[4] == (2, [(2, 2), (3, 2)])
    same = {right: diverse for right, diverse, *_ in s.repeats([b"abXXXXXX1", b"abXXXXXX2"], [2, 2], 6)}
    assert same == {6: 0}  # part of a repeat that begins further left


def test_long_text_is_cut_in_stretches(monkeypatch):
    rng = np.random.default_rng(4)
    text = rng.integers(97, 100, 5000, dtype=np.uint8).tobytes()

    def anchors():
        out = set()
        for owner, key, anchor, most, least in s.anchor_rows([b"", text, text[:300]], 40, 16):
            for o, k, a, hi, lo in zip(owner, key, anchor, most, least):
                out.update((int(o), int(k), int(a), int(d)) for d in range(lo, hi + 1))
        return out

    whole = anchors()
    assert len(whole) == (5000 - 39) + (300 - 39)
    monkeypatch.setattr(s, "CHUNK", 150)
    assert anchors() == whole


def test_edge_rows(spark):
    long = "".join(random.Random(8).choice("abcdefgh ") for _ in range(200_000))
    docs = docs_of(spark, [(1, None), (None, "a" * 500), (2, long), (2, long), (3, long[1000:1399]), (4, long[:400]), (5, "b" * 399)])
    got = sorted(((r.doc_id or 0, r.n_removed, r.n_bytes) for r in s.dedup(docs).collect()))
    assert got == [(0, 500, 500), (1, 0, 0), (2, 200_000, 200_000), (2, 200_000, 200_000), (3, 0, 399), (4, 400, 400), (5, 0, 399)]
    assert s.dedup(docs.limit(0)).count() == 0
