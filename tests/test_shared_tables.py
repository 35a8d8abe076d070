"""Written intermediates: their shuffles end with the write, and dropped tables leave the folder."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from refillscope.shared import drop_table, materialise


def test_materialise_and_drop(spark):
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    df = spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count()
    table = materialise(df, "sums")
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before
    assert sorted(r["count"] for r in table.collect()) == [142] * 1 + [143] * 6
    (path,) = {os.path.dirname(f.removeprefix("file://")) for f in table.inputFiles()}
    twice = table.union(materialise(table, "again"))
    assert twice.count() == 14
    drop_table(table, df)  # a frame that is no table is left alone
    drop_table(table)
    assert not os.path.exists(path)


def test_a_failed_write_restores_the_setting(spark):
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    with pytest.raises(AnalysisException):
        materialise(spark.range(1).select(F.expr("array()").alias("void")).selectExpr("void", "void"), "twice")
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before
