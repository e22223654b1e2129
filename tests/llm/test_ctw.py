from __future__ import annotations

import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np

from ledgerloom.llm import ctw
from ledgerloom.llm.queries import QUERIES
from llm_rows import SMALL, docs_of


def plain_tree(texts, depth):
    """Counts by (context, bits so far), and weighted probabilities by recursion."""
    n = defaultdict(lambda: [0, 0])
    for t in texts:
        data = b"\0" * depth + t
        for i in range(depth, len(data)):
            bits = f"{data[i]:08b}"
            for d in range(depth + 1):
                for j in range(8):
                    n[data[i - d : i], bits[:j]][int(bits[j])] += 1
    children = defaultdict(set)
    for context, bits in n:
        if context:
            children[context[1:], bits].add((context, bits))

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)

    memo = {}

    def weighted(node):
        if node not in memo:
            own = kt(*n[node])
            if len(node[0]) == depth:
                memo[node] = (own, 1.0)
            else:
                deeper = sum(weighted(c)[0] for c in children[node])
                both = np.logaddexp(own, deeper)
                memo[node] = (both - math.log(2), math.exp(own - both))
        return memo[node]

    def predict(context, byte):
        out, bits = 0.0, f"{byte:08b}"
        for j in range(8):
            path = [(context[len(context) - d :], bits[:j]) for d in range(depth + 1)]
            path = [x for x in path if x in n]
            p = 0.5
            for at, node in reversed(list(enumerate(path))):
                own = (n[node][1] + 0.5) / (sum(n[node]) + 1)
                share = 1.0 if at == len(path) - 1 else weighted(node)[1]
                p = share * own + (1 - share) * p
            out += math.log10(p if bits[j] == "1" else 1 - p)
        return out

    return predict


def plain_score(predict, text, depth):
    data = b"\0" * depth + text
    return sum(predict(data[i - depth : i], data[i]) for i in range(depth, len(data)))


def test_tree_equals_recursion(spark):
    texts = ["the cat sat on the mat", "the hat", "Thé cät", "", "abababababab" * 4]
    docs = docs_of(spark, [*enumerate(texts)])
    tree = ctw.train_tree(ctw.counts(docs, depth=3), depth=3, share=0.0)
    predict = plain_tree([ctw.lowered(t) for t in texts], 3)
    for t in [*texts, "zzz", "the bat"]:
        raw = ctw.lowered(t)
        grams = np.concatenate([g for g, _ in ctw.contexts([raw], 3)] or [np.zeros(0, np.uint64)])
        assert abs(tree.log10_of(grams).sum() - plain_score(predict, raw, 3)) < 1e-4
        assert np.allclose(tree.cached(grams), tree.log10_of(grams))
    context = np.uint64(int.from_bytes(b"eht", "big") << 8)  # after "the"
    assert abs((10 ** tree.log10_of(context | np.arange(256, dtype=np.uint64))).sum() - 1) < 1e-4


def plain_base(rows):
    train, tokens = Counter(), {}
    for i, text in rows:
        tokens[i] = [*ctw.lowered(text or "").split(), None]
        if zlib.crc32(str(i).encode()) % 10:
            train.update(tokens[i])
    n, v = train.total(), len(train)
    return {
        i: (len(t), sum(x in train for x in t), n, sum(math.log10((train[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t))
        for i, t in tokens.items()
    }


def test_query_equals_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    want = plain_base(rows)
    got = {r.doc_id: r for r in QUERIES["op3_context_tree_lm"](spark, SMALL).collect()}
    assert set(got) == set(want)
    for i, (n, known, total, base) in want.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert abs(r.base_score - base) < 1e-6 * abs(base) and r.score < 0
        assert r.held_out == (zlib.crc32(str(i).encode()) % 10 == 0)
    sizes = {i: len(t.encode()) for i, t in rows}
    out = [r for r in got.values() if r.held_out]
    assert sum(r.bits_per_byte * sizes[r.doc_id] for r in out) / sum(sizes[r.doc_id] for r in out) < 3.2


def test_rare_words_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(ctw, "FREQUENT", 0.2)  # nearly all words take the join
    pairs = [(i, f"alpha beta w{i} w{i % 7} beta") for i in range(60)] + [(100, None), (101, ""), (102, "né  \t x\n")]
    want = plain_base(pairs)
    rows = ctw.scores(docs_of(spark, [*pairs, *pairs[:9]])).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in [*pairs, *pairs[:9]])
    once = ctw.scores(docs_of(spark, pairs)).collect()
    assert len({r.train_tokens for r in rows}) == 1
    for r in once:
        assert (r.n_tokens, r.n_known) == want[r.doc_id][:2] and abs(r.base_score - want[r.doc_id][3]) < 1e-9
    both = {r.doc_id: r.base_score for r in rows if r.doc_id < 9}
    assert len(both) == 9 and all(len({r.base_score for r in rows if r.doc_id == i}) == 1 for i in both)


def test_edge_rows(spark):
    docs = docs_of(spark, [(None, "a b"), (1, "é" * 70_000), (2, "x")])
    assert len(ctw.scores(docs).collect()) == 3
    assert ctw.scores(docs.limit(0)).count() == 0
    only_held_out = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 10 == 0)
    (r,) = ctw.scores(docs_of(spark, [(only_held_out, "ab")])).collect()
    assert (r.n_known, r.train_tokens) == (0, 0) and abs(r.score - 16 * math.log10(0.5)) < 1e-9


def test_stretches_join(monkeypatch):
    texts = [b"hello world" * 9, b"", b"x", b"abc" * 40]
    whole = np.concatenate([g for g, _ in ctw.contexts(texts, 4)])
    monkeypatch.setattr(ctw, "CHUNK", 7)
    parts = list(ctw.contexts(texts, 4))
    assert np.array_equal(np.concatenate([g for g, _ in parts]), whole)
    assert np.array_equal(np.bincount(np.concatenate([o for _, o in parts]), minlength=4), [len(t) for t in texts])


def test_rare_grams_keep_their_depth(spark, monkeypatch):
    """More than 2^21 bytes: under a share of 2^-18 a context seen fewer than 8 times was cut off."""
    rare = [(1_000 + i, f"qzj{chr(97 + i)}w xvk{chr(97 + i)}q") for i in range(20)]
    pairs = [(i, f"the quiet word {i % 7} of an ordinary page " * 600) for i in range(100)] + rare + [*rare[:2]]
    docs = docs_of(spark, pairs)
    train = docs.where(~ctw.held_out())
    whole = ctw.train_tree(ctw.counts(train), share=0.0)
    total = train.selectExpr("sum(length(text))").first()[0]
    assert total * 2.0**-18 > 7
    for share in (ctw.SHARE, 2.0**-4):
        monkeypatch.setattr(ctw, "SHARE", share)
        got = {r.doc_id: r.score for r in ctw.scores(docs).collect()}
        for i, text in pairs:
            grams = np.concatenate([g for g, _ in ctw.contexts([ctw.lowered(text)])])
            assert abs(got[i] - whole.cached(grams).sum()) < 1e-6 * abs(got[i]), (share, i)


def test_a_worker_takes_grams_subtree_by_subtree():
    """Stretches hold whole subtrees, lose nothing, and bound what a task works on at once."""
    rng = np.random.default_rng(7)
    grams = np.unique(rng.integers(0, 1 << 40, 400_000, dtype=np.uint64) & np.uint64(0x0F0FFFFFFF))
    rng.shuffle(grams)
    n = rng.integers(1, 9, len(grams))
    parts = list(ctw.whole_subtrees(grams, 4, 2, n, most=1000))
    assert len(parts) > 100 and max(len(g) for g, _ in parts) < 1000 + 3000
    roots = [set((g >> np.uint64(24)).tolist()) for g, _ in parts]
    assert sum(map(len, roots)) == len(set.union(*roots))
    assert dict(zip(grams.tolist(), n.tolist())) == {g: c for p in parts for g, c in zip(*(x.tolist() for x in p))}

    def nodes(found):
        return sorted((d, *x) for d, *own in found for x in zip(*(y.tolist() for y in own)))

    assert nodes(ctw.subtrees(grams, n, 4, 2)) == nodes(s for p in parts for s in ctw.subtrees(*p, 4, 2))


def test_memory_of_a_stretch_of_text_is_bounded():
    raw = [np.random.default_rng(i).integers(97, 123, 1 << 20, dtype=np.uint8).tobytes() for i in range(4)]
    tracemalloc.start()
    sizes = [len(g) for g, _ in ctw.contexts(raw)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) == 4 << 20 and peak < 64e6
