from __future__ import annotations

import zlib

import duckdb
import numpy as np

from ledgerloom.llm import quality
from ledgerloom.llm.queries import QUERIES
from llm_rows import docs_of

MEDIUM = "/root/testdata/sf0.01"


def test_held_out_rows_are_told_apart(spark):
    rows = QUERIES["op4_pu_quality"](spark, MEDIUM).collect()
    docs = duckdb.sql(f"SELECT doc_id FROM '{MEDIUM}/documents.parquet'").fetchall()
    assert sorted(r.doc_id for r in rows) == sorted(i for (i,) in docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    label = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{MEDIUM}/labels.parquet'").fetchall())
    own = [(label[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in label]
    good, bad = ([s for q, s in own if q == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([(s >= 0.5) == q for q, s in own]) > 0.95


def test_prior_is_estimated():
    rng = np.random.default_rng(2)
    p = rng.normal(1, 1, 5000)
    u = np.concatenate([rng.normal(1, 1, 3500), rng.normal(-3, 1, 1500)])
    assert abs(quality.class_prior(p, u) - 0.7) < 0.05


def test_labels_of_zero_and_held_out_rows_are_not_learned_from(spark):
    docs = docs_of(spark, [(i, f"text {i}") for i in range(60)])
    found = quality.features(docs)
    labels = spark.createDataFrame([(i, i % 2, 9) for i in range(30)] + [(1, 0, 9)], "doc_id long, quality int, n_chars int")
    p, u = quality.samples(found, labels, "doc_id", 100)
    kept = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert len(p) == sum(i % 2 and i < 30 and i != 1 for i in kept) and len(u) == sum(i >= 30 for i in kept)
    assert len(quality.samples(found, labels, "doc_id", 5)[0]) == 5


def test_edge_rows(spark):
    docs = docs_of(spark, [(1, None), (1, None), (2, ""), (None, "a"), (3, " \n\t"), (4, "wörd " * 40_000), (5, "\x00")])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == 7 and {r.score for r in rows} == {0.5}
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (None, 1, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows)
    assert quality.classify(docs.limit(0), labels).count() == 0
    assert quality.keep_good(docs, labels).columns == docs.columns


def test_another_text_under_the_key_of_a_rejected_row_stays(spark):
    """Each row is judged by its own text, and as ``classify`` judges it."""
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    verdict = {r.doc_id: r.predicted for r in quality.classify(docs, labels).collect()}
    plain = quality.keep_good(docs, labels).collect()
    assert sorted(r.doc_id for r in plain) == sorted(i for i, v in verdict.items() if v)
    text = {r.doc_id: r.text for r in docs.collect()}
    bad, good = (next(i for i, v in sorted(verdict.items()) if v == w and text[i]) for w in (0, 1))
    both = docs.unionByName(docs.where(docs.doc_id == good).withColumn("doc_id", quality.F.lit(bad).cast("long")))
    kept = {(r.doc_id, r.text) for r in quality.keep_good(both, labels).collect()}
    assert (bad, text[good]) in kept and (bad, text[bad]) not in kept
