"""Skew: one key holding a third of the rows, and a large group of identical copies.

The skewed input is derived from the generated tables: a third of the deliveries
are relabelled to a single patient, and one real delivery is repeated many times.
A variant squeezes half of the hot key's rows into a burst of a few hours.
Results must equal a plain whole-key computation in DuckDB, and no (key, run)
group may exceed the run budget.
"""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tables import SF_ORACLE
from oracle_compare import normalise
from refillscope.operators import intervals as iv
from refillscope.operators import summary as sm
from refillscope.plans import catalog
from scan_helpers import hot_options
from refillscope.plans.oracle import _MEASURES, _ND, _intervals

ROWS_PER_RUN = 1_500
CHUNK_ROWS = 700
COPIES = 5_000


def _skewed(spark, tmp_path_factory, with_burst):
    base = catalog.product_filter(spark, SF_ORACLE).select("prod", "patient_id", "dispensed_at", "qty")
    hot = F.pmod(F.xxhash64("patient_id", "dispensed_at", "qty"), F.lit(3)) == 0
    # Half of the hot key's rows form a burst: their times squeezed into ~11 hours.
    burst = hot & (F.pmod(F.xxhash64("qty", "patient_id"), F.lit(2)) == 0) & F.lit(with_burst)
    squeezed = F.timestamp_add(
        "SECOND",
        (F.unix_seconds(F.col("dispensed_at").cast("timestamp")) / 5000).cast("int"),
        F.lit("2000-06-01 00:00:00").cast("timestamp_ntz"),
    )
    relabelled = base.select(
        F.when(hot, F.lit("PROMO")).otherwise(F.col("prod")).alias("prod"),
        F.when(hot, F.lit(-1)).otherwise(F.col("patient_id")).cast("bigint").alias("patient_id"),
        F.when(burst, squeezed).otherwise(F.col("dispensed_at")).alias("dispensed_at"),
        "qty",
    )
    one = base.orderBy("prod", "patient_id", "dispensed_at", "qty").limit(1)
    copies = one.select(
        F.lit("LARGE").alias("prod"),
        F.lit(-2).cast("bigint").alias("patient_id"),
        "dispensed_at",
        "qty",
        F.explode(F.sequence(F.lit(1), F.lit(COPIES))).alias("_copy"),
    ).drop("_copy")
    data = relabelled.unionByName(copies)
    path = os.path.join(str(tmp_path_factory.mktemp("skew")), "deliveries.parquet")
    data.write.parquet(path)
    return spark.read.parquet(path), path


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    return _skewed(spark, tmp_path_factory, with_burst=False)


@pytest.fixture(scope="module")
def skewed_burst(spark, tmp_path_factory):
    return _skewed(spark, tmp_path_factory, with_burst=True)


def _duck(path, select):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW src AS SELECT * FROM read_parquet('{path}/*.parquet')")
    sql = "WITH " + ",".join([_intervals("src").strip(), _ND.strip(), _MEASURES.strip()]) + "\n" + select
    res = con.execute(sql)
    return [d[0] for d in res.description], res.fetchall()


@pytest.mark.parametrize("fixture", ["skewed", "skewed_burst"])
def test_hot_key_results_match_whole_key_computation(spark, fixture, request):
    data, path = request.getfixturevalue(fixture)
    hot_rows = data.where("patient_id = -1").count()
    assert hot_rows > data.count() / 4  # the hot key really holds a large share

    scan = iv.scan_deliveries(data, catalog.KEYS, **hot_options(data, ROWS_PER_RUN, CHUNK_ROWS, catalog.KEYS))
    measures = sm.delivery_measures(scan, catalog.KEYS).select(*catalog.KEYS, "mean_days", "deliveries", "late")
    got = normalise(measures.columns, [tuple(r) for r in measures.collect()])
    want = normalise(
        *_duck(
            path,
            "SELECT m.prod, m.patient_id, m.mean_days, m.deliveries, l.late FROM means m "
            "JOIN late l ON m.prod = l.prod AND m.patient_id = l.patient_id",
        )
    )
    assert got == want

    intervals = iv.delivery_intervals(data, catalog.KEYS, **hot_options(data, ROWS_PER_RUN, CHUNK_ROWS, catalog.KEYS))
    got_iv = normalise(intervals.columns, [tuple(r) for r in intervals.collect()])
    assert got_iv == normalise(*_duck(path, "SELECT * FROM intervals"))


@pytest.mark.parametrize("fixture", ["skewed", "skewed_burst"])
def test_no_run_exceeds_its_budget(spark, fixture, request):
    """Runs are ranges of the sorted rows, so a burst is split like any other stretch."""
    data, _ = request.getfixturevalue(fixture)
    scan = iv.scan_deliveries(data, catalog.KEYS, **hot_options(data, ROWS_PER_RUN, CHUNK_ROWS, catalog.KEYS))
    per_run = scan.chunks.groupBy(*catalog.KEYS, "_run").agg(
        F.count(F.lit(1)).alias("chunk_rows"), F.sum("_len").alias("rows")
    )
    hot = per_run.where("patient_id = -1").collect()
    assert len(hot) >= 4  # the hot key is spread over several runs
    # Chunk rows per run (what one window task holds) stay near the budget.
    assert max(r["chunk_rows"] for r in per_run.collect()) <= 2 * ROWS_PER_RUN
    # The copy group is represented by a handful of chunk rows, not thousands of rows.
    copies = per_run.where("patient_id = -2").collect()
    assert sum(r["rows"] for r in copies) == COPIES
    assert sum(r["chunk_rows"] for r in copies) == -(-COPIES // CHUNK_ROWS)


def test_a_null_key_and_a_burst_within_one_second_are_split(spark):
    """Rows of a NULL key, all in one second and half of them in one microsecond, stay within budget."""
    data = spark.range(4_000).select(
        F.lit("PROMO").alias("prod"),
        F.lit(None).cast("bigint").alias("patient_id"),
        F.timestamp_add("MICROSECOND", F.greatest(F.col("id") - 2_000, F.lit(0)).cast("int"), F.lit("2022-01-01 10:00:00").cast("timestamp_ntz")).alias("dispensed_at"),
        (F.col("id") % 1_500 + 1).cast("double").alias("qty"),
    )
    options = hot_options(data, 100, 10, catalog.KEYS)
    scan = iv.scan_deliveries(data, catalog.KEYS, **options)
    runs = scan.chunks.groupBy("_run").agg(F.count(F.lit(1)).alias("n")).collect()
    assert len(runs) > 20 and max(r["n"] for r in runs) <= 200
    plain = iv.delivery_intervals(data, catalog.KEYS)
    split = iv.delivery_intervals(data, catalog.KEYS, **options)
    assert sorted(map(repr, split.collect())) == sorted(map(repr, plain.collect()))
    spark.catalog.clearCache()
    assert sorted(map(repr, split.collect())) == sorted(map(repr, plain.collect()))
