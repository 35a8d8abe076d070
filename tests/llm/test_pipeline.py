"""The pipeline's stages on the small tables, each against the brute force of its operator."""

import corpus_pipeline as cp
import pytest

from llm_helpers import SF_SMALL, as_rows, documents
from refillscope.llm.queries import ORACLE_SQL, QUERIES
from refillscope.llm.shared import materialise
from test_line_dedup import brute_force as removed_lines
from test_packing import check_packing
from test_partenum import brute_force as components
from test_templates import brute_force as leaks


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, steps = docs.columns, dict(cp.STAGES)

    def go(name, docs):
        return materialise(steps[name](spark, docs, SF_SMALL), "test")

    one = go("language ID", docs)
    assert one.columns == columns and {d for d, t in pairs(docs) if any(c.isalpha() for c in t or "")} == {d for d, _ in pairs(one)}

    two = go("line dedup", one)
    gone = set(removed_lines(pairs(one), 1, 1))
    want = [(d, "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone)) for d, t in pairs(one)]
    assert two.columns == columns and sorted(pairs(two)) == sorted(want)
    assert all(r["n_chars"] == len(r["text"]) for r in two.collect())

    three = go("n-gram Jaccard join", two)
    keep = {d for d, _, c in components(pairs(two)) if d == c}
    assert three.columns == columns and {d for d, _ in pairs(three)} == keep

    four = go("benchmark decontamination", three)
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {d for d, _ in leaks(pairs(three), items)}
    assert four.columns == columns and {d for d, _ in pairs(four)} == keep - hit

    five = go("packing", four)
    assert check_packing(five.collect(), dict(pairs(four))) < 0.02


def test_stages_on_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "one two three four five six"), (3, "one two three four five six"), (None, "seven eight nine"), (4, "x " * 50_000)]
    docs = documents(spark, rows).withColumnRenamed("source", "_copy")
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns, name
        empty = stage(spark, documents(spark, []), SF_SMALL)
        assert as_rows(empty) == [] and empty.columns == documents(spark, []).columns
    kept = as_rows(cp.jaccard_stage(spark, docs, SF_SMALL), "doc_id")
    assert kept == sorted([(1,), (2,), (3,), (3,), (4,), (None,)], key=repr)


def test_registered():
    from __spark_entry__ import oracle_sql, queries

    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLE_SQL) <= set(oracle_sql()) and [n for n, _ in cp.STAGES][-1] == "packing"
    for n in range(1, 14):
        assert len([q for q in queries() if q.startswith(f"op{n}_")]) == 1


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_match_their_sql(spark, name):
    from oracle_compare import compare

    report = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert report["rows_match"] and report["columns_match"], report
