from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm import alignment
from ledgerloom.llm.alignment import Fragment, Tokens, composed
from ledgerloom.llm.queries import QUERIES
from llm_rows import DOCS, SMALL, docs_of

BYTE_LEVEL = {**{chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}}
BYTE_LEVEL |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in BYTE_LEVEL.values())}


def plain(texts):
    """Per text the contract's columns, from whole-text encodings and byte ranges compared one with another."""
    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found, total = [], Counter()
    for text in texts:
        raw, links, groups, a, b = (" " + (text or "")).encode(), [], [], [], []
        if text:
            enc = a_model.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(BYTE_LEVEL[c] for c in t)) for i, t in zip(enc.ids, enc.tokens)]
            ids = b_model.encode(text)
            names = [b_model.id_to_piece(i) for i in ids]
            b = [(i, bytes([int(n[3:5], 16)]) if b_model.is_byte(i) else n.replace("▁", " ").encode()) for i, n in zip(ids, names)]
            if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
                a, b = [], []
        ranges = []
        for tokens in (a, b):
            at, out = 0, []
            for i, x in tokens:
                out.append((i, at, at + len(x)))
                at += len(x)
            ranges.append(out)
        ends = sorted({e for _, _, e in ranges[0]} & {e for _, _, e in ranges[1]})
        for begin, end in zip([0, *ends], ends):
            own = [[t for t in r if begin < t[2] <= end] for r in ranges]
            groups.append("|".join(",".join(str(i) for i, _, _ in o) for o in own))
            links += [(i, j) for i, s, e in own[0] for j, s2, e2 in own[1] if max(s, s2) < min(e, e2)]
        total.update(links)
        found.append((len(a), len(b), groups, links))
    best = defaultdict(int)
    for (_, j), n in total.items():
        best[j] = max(best[j], n)
    return [
        (na, nb, len(g), len(k), sum(total[x] == best[x[1]] for x in k), sum(total[x] for x in k), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for na, nb, g, k in found
    ]


def rows_of(df):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(((r.doc_id, *(r[n] for n in names)) for r in df.collect()), key=str)


ODD = [
    None, "", " ", "a", "a  b", "tail \n", "\n\nx\ty", "<|endoftext|> <s> </s> <unk>", "low▁line", "naïve café 你好 \U0001f600\U0001f600",
    "don't 1234567 ... !!!", "x" * 3000, "one two " * 900, "　wide space", "line\nline\r\nline", "same", "same", "你好" * 700, "a\x00b",
]


def test_odd_texts_whole_and_in_fragments(spark):
    docs = docs_of(spark, list(enumerate(ODD)) + [(None, "same"), (15, "other")])
    want = sorted(((i, *x) for i, x in zip([*range(len(ODD)), None, 15], plain([*ODD, "same", "other"]))), key=str)
    assert rows_of(alignment.alignment(docs)) == want
    pieces = alignment.alignment(docs, long_text=40, chunk=7, fan=2, frequent=40)
    assert rows_of(pieces) == want


def test_table_equals_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    want = sorted(((i, *x) for (i, _), x in zip(rows, plain([t for _, t in rows]))), key=str)
    assert rows_of(QUERIES["op13_fragment_alignment"](spark, SMALL)) == want
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert rows_of(alignment.alignment(docs, long_text=900, chunk=500, fan=3, frequent=1000)) == want


def test_empty_table_and_other_names(spark):
    assert alignment.alignment(spark.createDataFrame([], DOCS)).count() == 0
    docs = docs_of(spark, [(1, "some words")]).selectExpr("doc_id AS code", "text AS total", "'x' AS text", "1 AS n", "2 AS b")
    (r,) = alignment.alignment(docs, key="code", text="total").collect()
    assert (r.code, r.n_groups) == (1, 2)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=25), st.lists(st.integers(1, 4), min_size=1, max_size=25), st.sets(st.integers(1, 100), max_size=8), st.randoms())
def test_fragments_compose_in_any_order(a, b, borders, rnd):
    short, long_ = sorted((a, b), key=sum)
    short += [1] * (sum(long_) - sum(short))
    ends = [[sum(x[: i + 1]) for i in range(len(x))] for x in (a, b)]
    ids = [list(range(len(x))) for x in (a, b)]
    borders = [0, *sorted(x for x in borders if x < ends[0][-1]), ends[0][-1]]
    parts = []
    for s, e in zip(borders, borders[1:]):
        own = [[(i, x) for i, x in zip(ids[k], ends[k]) if s < x <= e] for k in (0, 1)]
        parts.append(Fragment.of(Tokens(*(list(col) for o in own for col in (zip(*o) if o else ((), ()))))))
    whole = Fragment.of(Tokens(ids[0], ends[0], ids[1], ends[1])).groups()
    while len(parts) > 1:
        i = rnd.randrange(len(parts) - 1)
        parts[i : i + 2] = [composed([Fragment(), parts[i], parts[i + 1]])]
    groups, n, links = parts[0].groups()
    assert (";".join(groups), n, links.tolist()) == (";".join(whole[0]), whole[1], whole[2].tolist())
    assert n == ";".join(groups).count(";") + 1
