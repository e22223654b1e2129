"""Small documents tables, with columns whose names the operators use themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, count long, start long, value string"


def docs_of(spark: SparkSession, pairs) -> DataFrame:
    rows = [(i, t, None, "s", None if t is None else len(t), 1, None, "x") for i, t in pairs]
    return spark.createDataFrame(rows, DOCS)
