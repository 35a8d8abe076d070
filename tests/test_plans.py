"""Physical-plan checks: the plans we want at scale, not only the right rows."""

import os
import re

import pyarrow.parquet as pq
from tables import SF_SMALL
from refillscope.operators import intervals as iv
from refillscope.plans import catalog
from refillscope.sources import testtables
from scan_helpers import hot_options

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_no_cross_join_in_any_query(spark):
    for name, query in catalog.QUERIES.items():
        plan = _plan(query(spark, SF_SMALL))
        assert not any(node in plan for node in PYTHON_NODES), name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_product_filter_pushed_to_scan_and_columns_pruned(spark):
    plan = _plan(catalog.product_filter(spark, SF_SMALL))
    assert "PushedFilters: [In(p_type, [ECONOMY,LARGE,PROMO,SMALL])" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan


def _row_window_partitions(plan: str) -> list[list[str]]:
    """Partition columns of every window ordered by the delivery time."""
    out = []
    for spec in re.findall(r"row_number\(\) windowspecdefinition\(([^)]*?) ASC", plan):
        columns = [c.split("#")[0].strip() for c in spec.split(",")]
        if columns[-1] == "dispensed_at":
            out.append(columns[:-1])
    return out


def test_hot_path_never_windows_a_whole_key(spark):
    """With hot keys, the consecutive-row window is partitioned by (key, run), not the key alone."""
    deliveries = catalog.product_filter(spark, SF_SMALL)
    plan = _plan(iv.delivery_intervals(deliveries, catalog.KEYS, **hot_options(deliveries, 4, 2, catalog.KEYS)))
    partitions = _row_window_partitions(plan)
    assert partitions and all(p == ["prod", "patient_id", "_run"] for p in partitions), partitions
    # No answer depends on cached blocks or on where a row happens to lie.
    assert "InMemoryTableScan" not in plan and "SPARK_PARTITION_ID" not in plan.upper()


def test_plain_path_shuffles_delivery_rows_once(spark):
    """Without hot keys (every key within rows_per_run) the scan is one per-key window."""
    plan = _plan(catalog.delivery_measures(spark, SF_SMALL))
    assert _row_window_partitions(plan) == [["prod", "patient_id"]]
    assert "left_anti" not in plan.lower() and "LeftAnti" not in plan  # no hot-key branch at all
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    # One shuffle in total: the window's key partitioning also serves the per-key aggregate.
    assert len(exchanges) == 1, exchanges


def test_summary_aggregates_combine_map_side(spark):
    plan = _plan(catalog.delivery_summary(spark, SF_SMALL))
    # Every per-key aggregate is planned as partial + final around its exchange.
    assert plan.count("partial_") >= 3
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_adherence_uses_two_hash_exchanges(spark):
    """SURVEY section 5: adherence shuffles once per extract; everything else is broadcast
    or reuses the key partitioning (demographics ride along the scan's window)."""
    plan = _plan(catalog.adherence_consolidated(spark, SF_SMALL))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(exchanges) <= 2, exchanges
    assert not any(node in plan for node in PYTHON_NODES)


def test_ordinary_path_has_no_generate(spark):
    assert "Generate" not in _plan(catalog.delivery_intervals(spark, SF_SMALL))


def test_building_a_scan_runs_no_job(spark):
    """Only finding hot keys counts rows; a scan without them is a plan and nothing else."""
    deliveries = catalog.product_filter(spark, SF_SMALL)
    spark.sparkContext.setJobGroup("scan", "scan")
    iv.delivery_intervals(deliveries, catalog.KEYS, hot=None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("scan")
    spark.sparkContext.setJobGroup("", "")


def test_typing_computes_each_text_once(spark):
    """References to a parsed text do not copy its parsing: the code stays small enough for the JVM to compile."""
    for query in (catalog.dispensing_text_typed, catalog.therapy_text_typed, catalog.ingest_rejects, catalog.extract_patients):
        plan = query(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        regexes = re.findall(r"RLIKE|regexp_\w+\(", plan)
        assert 0 < len(regexes) <= 40, len(regexes)


def test_typing_is_not_repeated_by_filters(spark):
    """Valid rows and rejects are told apart by values: no filter or join computes the typing again."""
    extracts = {catalog.dispensing_text_typed: 1, catalog.therapy_text_typed: 1, catalog.ingest_rejects: 2, catalog.extract_patients: 1, catalog.extract_change_report: 1}
    for query, typed in extracts.items():
        plan = query(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("try_make_timestamp_ntz(") == typed, query.__name__
        # Lambdas are interpreted row by row.
        assert "lambdafunction" not in plan, query.__name__


def test_typing_runs_on_written_lines(spark, monkeypatch):
    """Extracts are made of lines that are joined once and lie in short files: no join's few tasks do the typing."""
    monkeypatch.setattr(testtables, "LINES_PER_FILE", 1_000)
    for query in (catalog.dispensing_text_typed, catalog.therapy_text_typed, catalog.ingest_rejects, catalog.extract_patients, catalog.extract_change_report):
        found = query(spark, SF_SMALL)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan, query.__name__
        files = found.inputFiles()
        assert len({os.path.dirname(f) for f in files}) == 1, query.__name__
        rows = [pq.read_metadata(f.removeprefix("file://")).num_rows for f in files]
        assert max(rows) <= 1_000 < sum(rows), query.__name__
