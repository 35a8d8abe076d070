"""Every catalog query against its DuckDB oracle SQL, on the generated tables.

sf0.001 runs every query; the scan-based queries also run with tiny thresholds so
that every key takes the hot-key path (runs, stitching, chunked copies).
"""

import pytest

from tables import SF_SMALL
from oracle_compare import compare
from refillscope.plans import catalog

SCAN_QUERIES = ["delivery_intervals", "delivery_measures", "delivery_summary", "adherence", "event_intervals"]


def _assert_all_match(report):
    bad = {k: v for k, v in report.items() if not (v.get("rows_match") and v.get("columns_match"))}
    assert not bad, bad


def test_every_query_matches_oracle(spark):
    from __spark_entry__ import oracle_sql, queries

    names = list(catalog.QUERIES)
    assert set(names) <= set(oracle_sql()) & set(queries())
    _assert_all_match(compare(spark, SF_SMALL, names, verbose=False))


@pytest.mark.parametrize(
    "options",
    [{"rows_per_run": 5, "chunk_rows": 3}],
)
def test_hot_key_path_matches_oracle(spark, options):
    saved = dict(catalog.SCAN_OPTIONS)
    catalog.SCAN_OPTIONS.update(options)
    try:
        _assert_all_match(compare(spark, SF_SMALL, SCAN_QUERIES, verbose=False))
    finally:
        catalog.SCAN_OPTIONS.clear()
        catalog.SCAN_OPTIONS.update(saved)


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
    assert df.columns == list(entry(spark).columns)
