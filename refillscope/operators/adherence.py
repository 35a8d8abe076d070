"""Adherence per (product, patient): therapy days supplied over days covered.

``adherence_pct = round(100 * therapy_days_total / denominator_days, 2)`` with
``denominator_days = whole days(first -> last delivery) + therapy days of the last
therapy row``. NULL when the denominator is 0; not capped at 100.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refillscope.functions.numeric import percentage_2dp
from refillscope.functions.temporal import whole_days
from refillscope.operators.summary import SUMMARY_COLUMNS
from refillscope.schema import CANONICAL_KEYS


def filter_products(df: DataFrame, product_keys: Sequence, column: str = "prod") -> DataFrame:
    """Keep rows of the listed products (F1, F2).

    The key list comes from the product dimension held in configuration, so it is
    an ``IN`` literal that Catalyst pushes into the scan.
    """
    return df.where(F.col(column).isin(list(product_keys)))


def attach_products(df: DataFrame, products: DataFrame, column: str = "prod") -> DataFrame:
    """Attach ``prod_desc, slug, aic`` from the product dimension.

    The dimension is a handful of configured rows, so the broadcast is bounded.
    """
    return df.join(F.broadcast(products), on=column, how="inner")


def therapy_days_total(therapy: DataFrame, keys: Sequence[str] = CANONICAL_KEYS) -> DataFrame:
    """Per key: sum of therapy days."""
    return therapy.groupBy(*keys).agg(F.sum("therapy_days").alias("therapy_days_total"))


def last_therapy_days(
    therapy: DataFrame, keys: Sequence[str] = CANONICAL_KEYS, ts: str = "dispensed_at"
) -> DataFrame:
    """Per key: therapy days of the latest therapy row (A6); on a date tie, the greatest."""
    latest = F.max(F.struct(F.col(ts).alias("_ts"), F.col("therapy_days").alias("_days")))
    return therapy.groupBy(*keys).agg(latest.alias("_latest")).select(
        *keys, F.col("_latest._ts").alias("last_therapy_at"), F.col("_latest._days").alias("last_therapy_days")
    )


def therapy_measures(therapy: DataFrame, keys: Sequence[str] = CANONICAL_KEYS, ts: str = "dispensed_at"):
    """A6 and A7 in one aggregate (J8 disappears)."""
    latest = F.max(F.struct(F.col(ts).alias("_ts"), F.col("therapy_days").alias("_days")))
    return therapy.groupBy(*keys).agg(
        F.sum("therapy_days").alias("therapy_days_total"), latest.alias("_latest")
    ).select(*keys, "therapy_days_total", F.col("_latest._days").alias("last_therapy_days"))


ADHERENCE_COLUMNS = ("prod", "prod_desc", "patient_id", *SUMMARY_COLUMNS) + (
    "adherence_pct",
    "therapy_days_total",
    "denominator_days",
)


def adherence(
    summary: DataFrame,
    therapy: DataFrame,
    products: DataFrame,
    keys: Sequence[str] = CANONICAL_KEYS,
    ts: str = "dispensed_at",
) -> DataFrame:
    """The adherence record per key (J7, E2, F4, P7), with ``slug`` and ``aic`` of its product.

    Keys missing from either extract drop out (inner join), as in the reference.
    """
    keys = list(keys)
    measures = therapy_measures(therapy, keys, ts)
    joined = summary.join(measures, on=keys, how="inner")
    denominator = (whole_days("first_at", "last_at").cast("double") + F.col("last_therapy_days")).alias(
        "denominator_days"
    )
    with_ratio = joined.select(
        *keys,
        *SUMMARY_COLUMNS,
        F.col("therapy_days_total").cast("double").alias("therapy_days_total"),
        denominator,
    ).withColumn("adherence_pct", percentage_2dp("therapy_days_total", "denominator_days"))
    return attach_products(with_ratio, products).select(*ADHERENCE_COLUMNS, "slug", "aic")


def union_products(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union of per-product results computed separately."""
    frames = list(frames)
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
