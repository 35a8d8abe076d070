"""Presentation layer and file sinks.

The typed layer keeps real types and NULLs. The presentation layer renames to the
export headers, renders dates as ``dd/MM/yyyy`` and the zero-denominator sentinel.
Files are written by the executors, one folder per product (``slug=...``) plus one
consolidated folder; nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refillscope.functions.temporal import format_day_first
from refillscope.schema import ADHERENCE_EXPORT_HEADERS, AIC_HEADER, SUMMARY_EXPORT_HEADERS, ZERO_DENOMINATOR_SENTINEL

_DATE_COLUMNS = ("first_at", "last_at")

# Rows of an output file at most.
ROWS_PER_FILE = 5_000_000


def _render(name: str):
    if name in _DATE_COLUMNS:
        return format_day_first(name)
    if name in ("patient_id", "prod"):
        return F.col(name).cast("string")
    return F.col(name)


def summary_presentation(summary_with_product: DataFrame) -> DataFrame:
    """Delivery summary with export headers and AIC code; keeps ``slug`` for per-product files."""
    cols = [_render(c).alias(h) for c, h in SUMMARY_EXPORT_HEADERS.items()]
    return summary_with_product.select(*cols, F.col("aic").alias(AIC_HEADER), "slug")


def adherence_presentation(adherence: DataFrame) -> DataFrame:
    """Adherence with export headers and AIC code, ``0000`` for a zero denominator."""
    cols = []
    for c, h in ADHERENCE_EXPORT_HEADERS.items():
        if c == "adherence_pct":
            value = (
                F.when(F.col("denominator_days") == 0, F.lit(ZERO_DENOMINATOR_SENTINEL))
                .otherwise(F.col("adherence_pct").cast("string"))
            )
            cols.append(value.alias(h))
        else:
            cols.append(_render(c).alias(h))
    return adherence.select(*cols, F.col("aic").alias(AIC_HEADER), "slug")


def _writer(df: DataFrame, fmt: str, mode: str):
    writer = df.write.mode(mode).format(fmt).option("maxRecordsPerFile", ROWS_PER_FILE)
    return writer.option("header", "true") if fmt == "csv" else writer


def write_per_product(
    df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite", slugs: Sequence[str] = ()
) -> None:
    """One folder per product (``slug=<name>``), written in parallel by the executors.

    Rows are rebalanced on the slug first: one or a few files per product, a large one split
    over several tasks. Partitioning by the alphabetic slug (not the AIC code) keeps partition
    values from being re-read as numbers; the AIC code is a text column of its own. Each of
    ``slugs`` without a row gets a file of headers alone.
    """
    rows = df.hint("rebalance", "slug")
    _writer(rows, fmt, mode).partitionBy("slug").save(path)
    if slugs:
        written = df.sparkSession.read.format(fmt).schema(df.schema).load(path)
        present = {r[0] for r in written.where(F.col("slug").isin(list(slugs))).select("slug").distinct().collect()}
        for slug in sorted(set(slugs) - present):
            empty = df.sparkSession.createDataFrame([], df.drop("slug").schema)
            _writer(empty, fmt, mode).save(f"{path.rstrip('/')}/slug={slug}")


def write_consolidated(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """All products in one output (X4). ``slug`` is dropped; ``PROD`` identifies the product."""
    _writer(df.drop("slug"), fmt, mode).save(path)
