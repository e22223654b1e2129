from __future__ import annotations

import duckdb
import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerloom.llm import decontaminate, packing, quality
from llm_rows import DOCS, SMALL, docs_of
from test_decontaminate import QUESTION, items_of
from test_decontaminate import plain as plain_matches
from test_packing import check_places
from test_secrets import plain_base
from test_simhash import plain_components, plain_fingerprint


def test_run_equals_brute_force(spark):
    """Each stage again over what the one before left, row by row in Python; the model's verdicts are taken over."""
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    verdict = {r.doc_id: r.predicted for r in quality.classify(docs, labels).collect()}
    left = {i: t for i, t in rows if verdict[i]}
    first = plain_components({i: plain_fingerprint(t) for i, t in left.items()})
    left = {i: t for i, t in left.items() if first[i] == i}
    bad = {i for i, _ in plain_matches(left.items(), items)}
    left = {i: t for i, t in left.items() if i not in bad}
    assert 0 < len(left) < len(rows) and bad
    plain, want = Tokenizer.from_file(packing.TOKENIZER), {}
    for i, text in left.items():
        at, out = 0, ""
        for begin, _, end in plain_base(text):
            if begin >= at:
                out += text[at:begin] + "[secret]"
            at = max(at, end)
        want[i] = len(plain.encode(out + text[at:], add_special_tokens=False).ids) + 1
    rows = corpus_pipeline.run(spark, SMALL).collect()
    got: dict[int, int] = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want
    assert check_places(rows) <= np.ceil(sum(want.values()) / 2048) * 1.03 + 1


def test_stages_take_any_documents(spark, tmp_path):
    good = "the quiet words of an ordinary page go on and on about this and that "
    pairs = [(1, None), (2, ""), (3, good * 900), (4, good * 900), (5, good + QUESTION + " " + good), (None, good), (6, "token=abcdefgh12 " + good)]
    docs = docs_of(spark, pairs).select("doc_id", "text", "lang", "source", "n_chars", "count")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    items_of(spark, [(1, QUESTION), (2, None)]).write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    assert {r.doc_id for r in docs.collect()} == {None, 1, 3, 6}
    texts = {r.doc_id: r.text for r in spark.read.parquet(str(tmp_path / "secrets")).collect()}
    assert texts[6].startswith("[secret] the quiet") and texts[3] == good * 900


def test_no_documents(spark, tmp_path):
    docs = spark.createDataFrame([], DOCS)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    items_of(spark, []).write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0
        docs = docs if "text" in docs.columns else None


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "secrets", "packing"]
    assert decontaminate.WIDTH == 5 and corpus_pipeline.ORACLE_SQL is None


def test_rows_that_repeat_a_key_are_told_apart(spark):
    """Documents are decided on by key and text: another text under a key that goes is not lost."""
    a, b, c = ("the one about " + x * 40 for x in ("rivers and their banks ", "a trip to town ", "what the cook said "))
    pairs = [(1, a), (2, a), (2, b), (3, c), (3, c), (3, b), (4, ""), (4, None), (None, a), (None, a)]
    left = corpus_pipeline.near_dedup(spark, docs_of(spark, pairs).select("doc_id", "text", "lang", "source", "n_chars"), "")
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) in (
        sorted([(1, a), (2, b), (3, c), (4, x), (None, a), (None, a)], key=str) for x in ("", None)
    )
