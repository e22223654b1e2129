from __future__ import annotations

import re
import textwrap
from collections import Counter
from functools import cache

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import licences as lic
from ledgerloom.llm.queries import QUERIES
from llm_rows import SMALL, docs_of

#: What the test tables' licence lines are, by pattern.
RULES = (
    ("MIT", "^Released under the MIT License"), ("Apache-2.0", "^Licensed under the Apache License"),
    ("GPL", "^This work is licensed under the GNU General"), ("CC-BY-NC", "^Licensed under CC BY-NC"),
)


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    return lic.train(lic.examples(lic.ready(spark), docs))


def plain_units(text):
    """Lines and blocks of several lines, numbered apart."""
    text = text or ""
    blocks = [(k, b) for k, b in enumerate(re.split(r"\n(?:[ \t\r]*\n)+", text)) if "\n" in b.strip(" ")]
    return [("line", k, b) for k, b in enumerate(text.split("\n"))] + [("block", k, b) for k, b in blocks]


def plain_words(body):
    return re.findall("[a-z]+|[0-9]+", body.lower())


@cache
def _parts(families, vocabulary):
    return {g: i for i, g in enumerate(vocabulary.vocabulary)}, families.coefficientMatrix.toArray(), families.interceptVector.toArray()


def plain_model(model):
    return _parts(model.families, model.vocabulary)


def plain_verdict(body, model):
    """(probability, family) by the fitted weights, word for word: no paragraph is left out beforehand."""
    w = plain_words(body)
    grams = {" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)}
    index, weights, bias = plain_model(model)
    logits = weights[:, [index[g] for g in grams if g in index]].sum(1) + bias
    p = np.exp(logits - logits.max())
    p /= p.sum()
    unknown = min(max(p[0], 1e-12), 1 - 1e-12)
    belief = 1 / (1 + np.exp(-(model.slope * np.log((1 - unknown) / unknown) + model.offset)))
    guess = model.names[1 + int(np.argmax(p[1:]))]
    mine, best = set(zip(w, w[1:])), 0.0
    for t in lic.TEMPLATES[guess]:
        theirs = set(zip(plain_words(t), plain_words(t)[1:]))
        best = max(best, len(mine & theirs) / max(4, min(len(mine), len(theirs))))
    if any(n in grams for n in lic.NAMES[guess]):
        allowed = {x for h in lic.HEADINGS[guess] for x in plain_words(h)} | set(lic.FILLER)
        best = max(best, sum(x in allowed or x[0].isdigit() for x in set(w)) / len(set(w)))
    return belief, guess if belief >= 0.5 and best >= 0.8 else lic.UNKNOWN


def test_query_equals_a_plain_recomputation(spark, model):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet' WHERE doc_id % 4 = 0 OR text LIKE '%icense%'").fetchall()
    want, lines = {}, {}
    for i, t in rows:
        for unit, k, body in plain_units(t):
            belief, family = plain_verdict(body, model)
            if family != lic.UNKNOWN:
                want[i, unit, k] = family
            for name, rule in RULES:
                if unit == "line" and re.search(rule, body):
                    lines[i, unit, k] = name
    keys = {i for i, _ in rows}
    found = QUERIES["op10_licence_classifier"](spark, SMALL).collect()
    got = {(r.doc_id, r.unit, r.paragraph): r.family for r in found if r.family != lic.UNKNOWN and r.doc_id in keys}
    assert got == want and lines.items() <= got.items() and len(set(lines.values())) > 2
    assert all(r.probability >= 0.5 for r in found)


def test_nothing_that_confirmation_accepts_is_left_out_beforehand(spark, model):
    """Pieces of templates of any length, alone and among other words."""
    bodies = []
    for name, templates in lic.TEMPLATES.items():
        for t in templates:
            w = t.split()
            bodies += [" ".join(w[i : i + n]) for n in (2, 3, 5, 9, 20) for i in range(0, len(w), 3)]
            bodies += ["some words " + " ".join(w[: len(w) * 9 // 10]) + " and then others", " ".join(w[::-1])]
        bodies += list(lic.HEADINGS[name])
    rows = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "doc_id long, body string")
    kept = {r.doc_id for r in rows.where(lic.possible(F.col("body"))).collect()}
    family = {r.doc_id: r.family for r in lic.classify(rows, model).collect()}
    accepted = {i for i, f in family.items() if f != lic.UNKNOWN}
    assert accepted <= kept and len(accepted) > 50
    assert all(family[i] == plain_verdict(b, model)[1] for i, b in enumerate(bodies))


def test_wrapped_notices_headings_and_identifiers(spark, model):
    wrapped = {i: (n, textwrap.fill(b, 72)) for i, (n, b) in enumerate((n, b) for n, bs in lic.TEMPLATES.items() for b in bs if len(b) > 100)}
    docs = docs_of(spark, [(i, f"A title\n\n{b}\n\nThe end.") for i, (_, b) in wrapped.items()])
    got = {(r.doc_id, r.paragraph): r.family for r in lic.classify(lic.paragraphs(docs), model).collect() if r.unit == "block"}
    assert got == {(i, 1): n for i, (n, _) in wrapped.items()}
    short = {
        "MIT License": "MIT", "The MIT License (MIT)": "MIT", "SPDX-License-Identifier: MIT": "MIT", "Apache-2.0": "Apache-2.0",
        "Released under GPLv3.": "GPL", "BSD-3-Clause": "BSD", "CC BY-SA 4.0": "CC-BY-SA", "MPL-2.0": "MPL", "# ISC License": "ISC",
    }
    found = lic.classify(lic.paragraphs(docs_of(spark, enumerate(short))), model).collect()
    assert {list(short)[r.doc_id]: r.family for r in found} == short
    plain = ["Komm mit", "mit", "We went by car and by bus", "Die Apache sind ein Volk", "Version 2.0", "", "the license"]
    assert {r.family for r in lic.classify(lic.units(docs_of(spark, enumerate(plain))), model).collect()} == {lic.UNKNOWN}


def test_templates_and_others(spark, model):
    rows = [(i, f"{b}\n") for i, (_, b) in enumerate((n, b) for n, bs in lic.TEMPLATES.items() for b in bs)]
    names = [n for n, bs in lic.TEMPLATES.items() for _ in bs]
    got = {r.doc_id: r.family for r in lic.classify(lic.paragraphs(docs_of(spark, rows)), model).collect()}
    assert [names[i] for i in range(len(names)) if got.get(i) != names[i]] == []
    unseen = [
        "The library's licence card is free.", "You need permission from the warden to enter.", "Copyright law is hard.",
        "Licensed under the Zebra Community Agreement, version 9.", "It ships under a licence that nobody has read.",
    ]
    found = lic.classify(lic.units(docs_of(spark, enumerate(unseen))), model).collect()
    assert len(found) == len(unseen) and {r.family for r in found} == {lic.UNKNOWN}


def test_unseen_wordings(spark, model):
    lines = {
        "MIT": "This little tool is released under the MIT License.",
        "Apache-2.0": "The whole book is licensed under the Apache License, Version 2.0.",
        "GPL": "Mind that this work is licensed under the GNU General Public License, version 3 too.",
    }
    found = lic.classify(lic.paragraphs(docs_of(spark, enumerate(lines.values()))), model).collect()
    assert [r.family for r in sorted(found, key=lambda r: r.doc_id)] == list(lines)
    assert all(r.probability > 0.5 and r.similarity >= 0.8 for r in found)


def test_similarity_equals_sets(spark, model):
    body = "Released under the MIT License. And more words under the sun."
    (r,) = lic.classify(lic.paragraphs(docs_of(spark, [(1, body)])), model).collect()
    w = re.findall("[a-z]+|[0-9]+", body.lower())
    mine = set(zip(w, w[1:]))
    best = 0
    for t in lic.TEMPLATES[r.guess]:
        v = re.findall("[a-z]+|[0-9]+", t.lower())
        theirs = set(zip(v, v[1:]))
        best = max(best, len(mine & theirs) / max(4, min(len(mine), len(theirs))))
    assert abs(r.similarity - best) < 1e-12


def test_edge_rows(spark, model):
    long = "ordinary words " * 30_000 + "\nReleased under the MIT License."
    docs = docs_of(spark, [(1, None), (2, ""), (3, long), (3, long), (None, "license"), (4, "\n\ncopyright\n")])
    rows = lic.classify(lic.units(docs), model).where("unit = 'line'").collect()
    assert Counter((r.doc_id, r.paragraph, r.family) for r in rows) == {
        (1, 0, lic.UNKNOWN): 1, (2, 0, lic.UNKNOWN): 1, (3, 0, lic.UNKNOWN): 2, (3, 1, "MIT"): 2, (None, 0, lic.UNKNOWN): 1,
        (4, 0, lic.UNKNOWN): 1, (4, 1, lic.UNKNOWN): 1, (4, 2, lic.UNKNOWN): 1, (4, 3, lic.UNKNOWN): 1,
    }
    assert {(r.doc_id, r.family) for r in lic.classify(lic.paragraphs(docs), model).collect() if r.unit == "line"} == {(3, "MIT")}
    assert lic.licences(docs.limit(0)).count() == 0
