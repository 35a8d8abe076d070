"""Intermediate tables in the folder that the driver and all executors share.

A written table ends a lineage and survives lost executors, unlike blocks cached on them.
"""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()

# Spark's setting by which a statement's shuffle files go when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only for a local master without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="shared-tables-")
    return _LOCAL_DIRS[context.applicationId]


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the statements run here are removed when these end, not at some garbage collection."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def materialise(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back (lineage ends there); ``options`` are the writer's."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    with _shuffles_end(spark):
        df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def drop_table(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` that no frame still in use reads."""
    for table in tables:
        if path := _PATHS.pop(table, None):
            jvm = table.sparkSession._jvm
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
