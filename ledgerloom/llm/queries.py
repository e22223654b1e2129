"""The registered queries of this package: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import alignment, ann, ctw, decontaminate, divergence, licences, packing, quality, secrets, simhash, suffix_dedup, topk, warc
from ledgerloom.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


@query
def op8_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 2048 tokens."""
    found = packing.pack(packing.pieces(read(spark, sf_dir, "documents")))
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op9_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as its record reads back from the archives."""
    found = warc.archive(read(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


ORACLE["op9_warc_normaliser"] = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages
), f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT
    page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
    CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first <> page_id THEN first END AS refers_to, true AS intact
FROM p LEFT JOIN f USING (d)
"""


@query
def op4_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op6_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that is found in it."""
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op2_secret_randomness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    found = secrets.secrets(read(spark, sf_dir, "documents"))

    def count(rank: int) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.spelled(F.col("base")), 256).alias("base_sha256"),
        secrets.spelled(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


@query
def op3_context_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and context-tree scores of every document."""
    return ctw.scores(read(spark, sf_dir, "documents"))


@query
def op7_common_prefix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document when repeated strings of 400 bytes are removed."""
    found = suffix_dedup.dedup(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op5_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id 20 divides."""
    rows = read(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.where("vec_id % 20 = 0"))


@query
def op10_licence_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence family of every line and block that is believed to be a licence's."""
    found = licences.licences(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "unit", "paragraph", "family", "guess", "probability", "similarity")


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every source of a language differs from the others, and the words that it favours."""
    return divergence.audit(read(spark, sf_dir, "documents"))


ORACLE["op11_source_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (
    SELECT id, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM d
), kept AS (
    SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 3
), langs AS (SELECT lang, sum(n) AS n, count(*) AS v FROM kept GROUP BY lang),
cells AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
sums AS (SELECT lang, source, sum(n) AS n FROM cells GROUP BY lang, source),
groups AS (
    SELECT g.lang, g.source, CAST(coalesce(s.n, 0) AS HUGEINT) AS n, CAST(coalesce(l.v, 0) AS HUGEINT) AS v, CAST(l.n AS HUGEINT) AS lang_n
    FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN sums s USING (lang, source) LEFT JOIN langs l USING (lang)
), full_ AS (
    SELECT g.lang, g.source, k.term, 1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (g.n + g.v) AS p, coalesce(c.n, 0) AS own,
        1 + (1000000000 * (CAST(k.n AS HUGEINT) + 1)) // (g.lang_n + g.v) AS q
    FROM groups g JOIN kept k USING (lang) LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM full_ a JOIN full_ b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), both_ AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM full_ WHERE own > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM both_ QUALIFY part = 'pair' OR rank <= 200
"""


@query
def op12_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 rows with the highest integer inner product for every vector whose id 50 divides."""
    rows = read(spark, sf_dir, "embeddings")
    return topk.search(rows, rows.where("vec_id % 50 = 0"))


ORACLE["op12_threshold_topk"] = """
WITH v AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT q.vec_id AS query_id, CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id) AS INTEGER) AS rank,
    c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
QUALIFY rank <= 5
"""


@query
def op13_fragment_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of every document under two tokenizers, weighed by the whole corpus."""
    return alignment.alignment(read(spark, sf_dir, "documents"))
