"""Session construction for tests and the bench."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "refillscope",
    extra_conf: dict | None = None,
) -> SparkSession:
    """A local session configured like the cluster jobs expect (AQE on, UTC, no UI).

    On a cluster the caller's own ``SparkSession`` is used instead; nothing in the
    library creates sessions.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
