"""Invariants that must hold whatever the partitioning, input order or thresholds."""

import pytest
from pyspark.sql import functions as F

from tables import SF_SMALL
from refillscope.operators import adherence as adh
from refillscope.operators import intervals as iv
from refillscope.operators import summary as sm
from refillscope.plans import catalog
from scan_helpers import hot_options
from refillscope.sources.testtables import tables_product_dimension


def _summary_rows(deliveries, **options):
    scan = iv.scan_deliveries(deliveries, catalog.KEYS, **options)
    return sorted(tuple(r) for r in sm.delivery_summary(deliveries, scan, catalog.KEYS).collect())


@pytest.fixture(scope="module")
def deliveries(spark):
    # Materialised locally once so that every variant below starts from the same rows.
    rows = catalog.product_filter(spark, SF_SMALL).collect()
    return spark.createDataFrame(rows, catalog.product_filter(spark, SF_SMALL).schema)


def test_independent_of_partitioning_and_order(deliveries):
    reference = _summary_rows(deliveries.coalesce(1))
    for parts, seed in ((4, 1), (16, 2)):
        shuffled = deliveries.orderBy(F.rand(seed)).repartition(parts)
        assert _summary_rows(shuffled) == reference
    assert _summary_rows(deliveries.repartition(7), **hot_options(deliveries, 3, 2, catalog.KEYS)) == reference


def test_summary_invariants(spark, deliveries):
    scan = iv.scan_deliveries(deliveries, catalog.KEYS, **hot_options(deliveries, 4, 2, catalog.KEYS))
    summary = sm.delivery_summary(deliveries, scan, catalog.KEYS)
    rows = summary.collect()
    assert all(r["late"] <= r["deliveries"] for r in rows)
    assert all(r["first_at"] <= r["last_at"] for r in rows)
    assert sum(r["deliveries"] for r in rows) == deliveries.count()
    assert len(rows) == deliveries.select(*catalog.KEYS).distinct().count()


def test_interval_numbers_are_a_permutation(deliveries):
    intervals = iv.delivery_intervals(deliveries, catalog.KEYS, **hot_options(deliveries, 3, 2, catalog.KEYS))
    per_key = intervals.groupBy(*catalog.KEYS).agg(
        F.count(F.lit(1)).alias("c"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.countDistinct("n").alias("d")
    )
    bad = per_key.where("lo <> 1 OR hi <> c OR d <> c").count()
    assert bad == 0
    assert intervals.where("gap_days < 0").count() == 0


def test_adherence_null_iff_zero_denominator(spark):
    result = catalog.adherence(spark, SF_SMALL)
    assert result.where("(adherence_pct IS NULL) <> (denominator_days = 0)").count() == 0
    assert result.where("adherence_pct > 100").count() > 0  # not capped (Q13)
    products = {r["prod"] for r in tables_product_dimension(spark).collect()}
    assert {r["prod"] for r in result.select("prod").distinct().collect()} <= products
    assert set(adh.ADHERENCE_COLUMNS) <= set(result.columns)
