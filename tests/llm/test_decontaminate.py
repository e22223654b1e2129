from __future__ import annotations

import duckdb
import numpy as np

from ledgerloom.llm import decontaminate as d
from ledgerloom.llm.queries import QUERIES
from llm_rows import SMALL, docs_of

ITEMS = "item_id long, text string, slots string, hash long"
QUESTION = "A farmer called Anna sells 12 apples for 3 dollars each and later Anna buys 12 pears from her neighbour Tom today."
FILL = "some other words that fill the page before and after what matters here "


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], ITEMS)


def plain(docs, items, least=0.8):
    """All documents against all items, windows as tuples of placeholder words.

    An item is its windows of five words with three plain ones, else all its windows, and itself if it is shorter.
    """

    def read(text):
        words = d.tokens_of(text or "")
        if not words:
            return [], [], []
        kinds = d.template(words, d.Words())[1].tolist()
        names = [d._EDGE.sub("", w).casefold() for w in words]
        return [n if k == d.TEXT else f"<{k}>" for n, k in zip(names, kinds)], names, kinds

    def cut(shown, names, kinds, width):
        out = {}
        for p in range(len(shown) - width + 1):
            span = range(p, p + width)
            out.setdefault(tuple(shown[j] for j in span), []).append((p, [names[j] for j in span if kinds[j]]))
        return out

    own = {}
    for i, text in items:
        shown, names, kinds = read(text)
        wins = cut(shown, names, kinds, min(5, len(shown))) if shown else {}
        telling = {w: at for w, at in wins.items() if sum(not (x[:1] == "<" and x[-1:] == ">") for x in w) >= (len(w) + 1) // 2}
        kept = {w: at[0] for w, at in (telling or wins).items()}
        if (text or "").split()[:1] and names[0].isalpha() and (text or "").split()[0][0].isupper() and kinds[0] == d.TEXT:
            for w, (p, slots) in list(kept.items()):
                if p == 0 and not (text or "").split()[0][1:].isupper():  # as it is read within a sentence
                    kept[f"<{d.NAME}>", *w[1:]] = 0, [names[0], *slots]
        own[i] = kept, kinds.count(d.TEXT) < 3
    found = set()
    for key, text in docs:
        parts = read(text)
        there = {}
        for width in {len(w) for wins, _ in own.values() for w in wins}:
            there |= cut(*parts, width)
        for i, (wins, exact) in own.items():
            lines = {}
            for w, (p, slots) in wins.items():
                for q, values in there.get(w, []):
                    lines.setdefault(q - p, []).append((p, list(zip(slots, values))))
            groups = [*lines.values(), [x for v in lines.values() for x in v]]
            for g in groups:
                pairs = {x for _, s in g for x in s}
                same = len({a for a, _ in pairs}) == len(pairs) and not (exact and any(a != b for a, b in pairs))
                if wins and same and len({p for p, _ in g}) >= least * len({p for p, _ in wins.values()}):
                    found.add((key, i))
    return found


def test_query_equals_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()
    got = {(r.doc_id, r.item_id) for r in QUERIES["op6_template_decontamination"](spark, SMALL).collect()}
    assert got == plain(docs, items)
    assert {(i, j) for i, t in docs for j, b in items if b in t} <= got


def test_changed_slots_must_be_consistent(spark):
    changed = QUESTION.replace("12", "35").replace("Anna", "Maria").replace("3 dollars", "8 euros")
    docs = [
        (1, FILL + QUESTION + FILL),
        (2, FILL + changed + " " + FILL),
        (3, FILL + changed.replace("35 pears", "36 pears") + FILL),  # one number, two values
        (4, FILL * 3),
        (5, FILL + QUESTION.replace("Tom today", "Tom once again today")),
        (6, changed + " " + FILL + QUESTION),
        (7, QUESTION.upper()[:40]),
    ]
    items = [(9, QUESTION), (8, "too short here"), (7, None), (6, ""), (None, QUESTION)]
    rows = d.contaminated(docs_of(spark, docs), items_of(spark, items)).collect()
    got = {(r.doc_id, r.item_id): r.verbatim for r in rows}
    assert set(got) == plain(docs, items[:4])
    assert {k for k, _ in got} == {1, 2, 5, 6}
    assert got[1, 9] and not got[2, 9]


def test_items_of_numbers_and_short_items_are_found(spark):
    """Every item that has a word is found in its exact copy; one that is hardly more than slots only there."""
    sums = "Compute 12 km + 35 km + 48 km"
    items = [(1, sums), (2, "Is 7 prime"), (3, "12 kg 13 kg 14 kg"), (4, "why"), (5, " "), (6, "Tell me why now")]
    docs = [
        (1, FILL + sums + " " + FILL), (2, FILL + "Compute 5 km + 6 km + 7 km"), (3, FILL + "Compute 5 km + 5 km + 7 km"),
        (4, "is 7 prime"), (5, FILL + "is 8 prime"), (6, FILL + "12 kg 13 kg 14 kg"), (7, FILL + "1 kg 2 kg 3 kg"), (8, "Why?"),
        (9, "tell me why now"), (10, FILL), (11, "Compute 5 km + 6 miles"), (12, ""), (13, None),
    ]
    got = {(r.doc_id, r.item_id) for r in d.contaminated(docs_of(spark, docs), items_of(spark, items)).collect()}
    assert got == plain(docs, items)
    assert got == {(1, 1), (2, 1), (3, 1), (4, 2), (6, 3), (8, 4), (9, 4), (9, 6)}


def test_another_text_under_the_key_of_a_hit_stays(spark):
    docs = docs_of(spark, [(1, QUESTION), (1, FILL), (1, QUESTION), (2, FILL), (3, None)])
    kept = d.keep_clean(docs, items_of(spark, [(1, QUESTION)])).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == [(1, FILL), (2, FILL), (3, None)]


def test_glued_units_and_placeholders():
    assert d.tokens_of("run 5km, then (10kg) rest 3x") == ["run", "5", "km,", "then", "10", "kg)", "rest", "3x"]
    kinds = d.template("He saw 5 km and Bob. Then km".split(), d.Words())[1].tolist()
    assert kinds == [d.TEXT, d.TEXT, d.NUMBER, d.UNIT, d.TEXT, d.NAME, d.TEXT, d.TEXT]


def test_edge_rows(spark):
    long = "same words again and again " * 20_000
    docs = docs_of(spark, [(1, None), (2, ""), (3, long), (3, long), (None, QUESTION), (4, QUESTION)])
    items = items_of(spark, [(1, "same words again and again same words again and again"), (2, QUESTION)])
    rows = d.contaminated(docs, items).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in rows) == [(0, 2), (3, 1), (4, 2)]
    kept = d.keep_clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2]
    assert d.contaminated(docs.limit(0), items).count() == 0
    assert d.contaminated(docs, items.limit(0)).count() == 0


def test_filter_has_a_fixed_size(spark):
    df = spark.createDataFrame([(int(x),) for x in np.arange(-5, 70_000, 7)], "hash long")
    bits = np.unpackbits(np.frombuffer(d.bitmap(df), np.uint8), bitorder="little")
    assert len(bits) == 2**d.SLOT_BITS
    assert set(np.flatnonzero(bits)) == {x % 2**d.SLOT_BITS for x in range(-5, 70_000, 7)}
