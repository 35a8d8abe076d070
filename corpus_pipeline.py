"""A training corpus from ``documents``: identify, clean, de-duplicate, decontaminate, pack.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns of
``docs``; a column ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refillscope.llm.langid import fit, held_out, identified, sample_rows
from refillscope.llm.line_dedup import duplicate_lines, remove_lines
from refillscope.llm.packing import pack_documents
from refillscope.llm.partenum import jaccard_components
from refillscope.llm.shared import materialise
from refillscope.llm.templates import decontaminate


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is predicted with some certainty; those without text or letters go."""
    return identified(docs, fit(sample_rows(docs, ~held_out(F.col("doc_id")))))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that nearly equal an earlier line of the corpus as sets of words."""
    out = remove_lines(docs, duplicate_lines(docs, width=1, min_words=1))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; documents without an id stay."""
    found = jaccard_components(docs)
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("_copy")).distinct()
    gone = materialise(gone, "near-copies")
    return docs.join(gone, docs["doc_id"] == gone["_copy"], "left_anti")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; rows without an id are judged too."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, with their places in sequences."""
    return pack_documents(docs)


STAGES = [
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("benchmark decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: SQL cannot express the similarity joins, the language model and the tokenizer; tests
#: hold every stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents`` in turn."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
