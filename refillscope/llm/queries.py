"""The registered queries of the corpus operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refillscope.llm import perspectives
from refillscope.llm.archives import pages_to_warc
from refillscope.llm.exact_index import exact_duplicates
from refillscope.llm.hard_negatives import mine_hard_negatives
from refillscope.llm.langid import language_report
from refillscope.llm.length_histogram import length_histogram, suffix_sums
from refillscope.llm.line_dedup import line_report
from refillscope.llm.metric_join import cosine_components
from refillscope.llm.packing import pack_documents
from refillscope.llm.partenum import jaccard_components
from refillscope.llm.runs import periodic_runs, repeat_tails, run_digests
from refillscope.llm.shared import materialise
from refillscope.llm.templates import contaminated
from refillscope.llm.unit_dedup import repeated_units


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in a sequence of 4096 tokens."""
    return pack_documents(_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    return language_report(_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums over the histogram of encoded lengths, for every length as a context limit."""
    return suffix_sums(materialise(length_histogram(_table(spark, sf_dir, "documents")), "length-histogram"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of every document that an earlier line nearly equals as a set of words."""
    return line_report(_table(spark, sf_dir, "documents"), width=1, min_words=1)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of every document."""
    return exact_duplicates(_table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op7_perspective_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the perspective of each participant."""
    return perspectives.rotate_perspectives(_table(spark, sf_dir, "conversations"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through ARC and WARC archives and back."""
    found = pages_to_warc(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated lines and sentences of all documents, all but the first occurrence."""
    return repeated_units(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, as they are or with other slot values."""
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, after one label in seven is moved on."""
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.expr("vec_id % 7 = 0"), F.expr("(label + 1) % 10")).otherwise(F.col("label"))
    return mine_hard_negatives(vectors.withColumn("label", label), F.expr("vec_id % 100 = 0"))


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every vector."""
    return cosine_components(_table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, after one in ten gets a repeated tail."""
    return run_digests(periodic_runs(repeat_tails(_table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_harmonic_packing": op1_harmonic_packing,
    "op2_language_id": op2_language_id,
    "op3_token_counts": op3_token_counts,
    "op4_line_dedup": op4_line_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_perspective_chat": op7_perspective_chat,
    "op8_warc": op8_warc,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_embedding_near_dedup": op12_embedding_near_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op5_exact_dedup": """
WITH normal AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS plain FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(plain) AS text_sha256
FROM normal WINDOW w AS (PARTITION BY plain)
""",
    "op7_perspective_chat": perspectives.SQL,
    "op8_warc": """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
judged AS (
    SELECT page_id, payload, max(page_id) OVER (PARTITION BY payload) AS kept, strlen(payload) AS size FROM payloads
)
SELECT page_id, size AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN size >= 1000 AND kept <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= 1000 AND kept <> page_id THEN kept END AS refers_to
FROM judged
""",
    "op11_hard_negatives": """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
    SELECT a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id AS other_id,
           CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
    FROM rows a JOIN rows c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
""",
    "op12_embedding_near_dedup": """
WITH RECURSIVE rows AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM rows a JOIN rows b ON a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.9
),
reached AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION
    SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
),
components AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
degrees AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM components LEFT JOIN degrees USING (vec_id)
""",
}
