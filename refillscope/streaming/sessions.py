"""Therapy sessions from deliveries that arrive over time (Structured Streaming, event time).

A delivery supplies its patient for the whole days of ``qty`` and a grace time. Deliveries
within the supply of those before continue a session; a session that has ended is a refill
that was due and not picked up. Two incremental queries, each with its own checkpoint:

1. ``admit`` splits arriving rows into admitted ones and rejects with a reason. A row is
   ``late`` if its time is not after the watermark, the latest time of earlier batches less
   ``delay_days``: its session may be closed already. A ledger has one row per batch.
2. ``close_sessions`` keeps one row of state per open session (Spark's ``session_window``
   with a gap per row, no Python in the plan) and appends a session once the watermark passes
   its end. Spark's watermark never runs ahead of the one in the ledger, so it drops nothing.

``run_arrivals`` runs both over what has arrived and stops. After a failure it is simply run
again: a batch that was not committed overwrites its own folder, and the second query starts
only when the first has committed.
"""

from __future__ import annotations

import os
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRACE_DAYS = 30
DELAY_DAYS = 30
# A delivery that would supply for longer is an error of the extract.
MAX_SUPPLY_DAYS = 36_500

_LEDGER = "reason string, rows long, latest timestamp_ntz, batch long"
# Sessions of one key are merged in each map task before the shuffle.
_LOCAL_MERGE = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"

# Watermarks need an instant: the wall clock read as UTC, whatever the session's time zone.
MOMENT = "_moment"


def instant(wall: Column) -> Column:
    """A TIMESTAMP_NTZ as the instant at which a clock in UTC shows it."""
    elapsed = wall - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    part = lambda unit: F.extract(F.lit(unit), elapsed).cast("decimal(18,6)")
    return F.timestamp_seconds(part("DAY") * 86_400 + part("HOUR") * 3_600 + part("MINUTE") * 60 + part("SECOND"))


def wall_clock(moment: Column) -> Column:
    """The inverse of ``instant``."""
    seconds = (F.unix_micros(moment) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def session_totals(deliveries: DataFrame, keys: list[str], grace_days: int = GRACE_DAYS) -> DataFrame:
    """``keys, session_start, session_end, deliveries, supplied_days, last_delivery`` of admitted deliveries.

    Works on batch and streaming frames. A delivery at the very end of a supply continues the session.
    """
    days = F.floor("qty").cast("long")
    # One microsecond more, so that windows which only touch are one session; it is taken off the end again.
    seconds = ((days + F.lit(grace_days)) * 86_400).cast("decimal(18,6)") + F.lit("0.000001").cast("decimal(18,6)")
    gap = F.make_interval(secs=seconds.cast("decimal(18,6)"))
    timed = deliveries if MOMENT in deliveries.columns else deliveries.withColumn(MOMENT, instant(F.col("dispensed_at")))
    found = timed.groupBy(*keys, F.session_window(MOMENT, gap).alias("session")).agg(
        F.count(F.lit(1)).alias("deliveries"),
        F.sum(days).alias("supplied_days"),
        F.max("dispensed_at").alias("last_delivery"),
    )
    end = wall_clock(F.col("session.end")) - F.expr("INTERVAL '0.000001' SECOND")
    start = wall_clock(F.col("session.start"))
    return found.select(*keys, start.alias("session_start"), end.alias("session_end"), "deliveries", "supplied_days", "last_delivery")


def reject_reason(keys: list[str], watermark: Column) -> Column:
    """Why a delivery is not admitted: ``no_key``, ``no_time``, ``no_supply`` (not 1 to 36,500 days) or ``late``; else null."""
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    supply = F.coalesce(F.col("qty").between(1, MAX_SUPPLY_DAYS), F.lit(False))
    return (
        F.when(no_key, "no_key")
        .when(F.col("dispensed_at").isNull(), "no_time")
        .when(~supply, "no_supply")
        .when(F.col("dispensed_at") <= watermark, "late")
    )


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def ledger(spark: SparkSession, work_dir: str) -> DataFrame:
    """``reason, rows, latest, batch``: rows of each batch by reject reason (null: admitted) and their latest time."""
    path = f"{work_dir}/ledger"
    if not _exists(spark, path):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(path)


def watermark_before(spark: SparkSession, work_dir: str, batch_id: int, delay_days: int = DELAY_DAYS) -> Column:
    """The watermark that the batches before ``batch_id`` have set, as a literal; null before the first."""
    earlier = ledger(spark, work_dir).where((F.col("batch") < batch_id) & F.col("reason").isNull())
    latest = earlier.agg(F.max("latest")).first()[0]
    text = None if latest is None else (latest - timedelta(days=delay_days)).isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def admit_batch(batch: DataFrame, batch_id: int, work_dir: str, keys: list[str], delay_days: int = DELAY_DAYS) -> None:
    """Write one micro-batch, split by admission, and its ledger rows; both overwrite an earlier attempt."""
    spark = batch.sparkSession
    judged = batch.withColumn("reason", reject_reason(keys, watermark_before(spark, work_dir, batch_id, delay_days)))
    judged = judged.withColumn("status", F.when(F.col("reason").isNull(), "admitted").otherwise("rejected"))
    path = f"{work_dir}/arrived/batch={batch_id}"
    judged.write.mode("overwrite").partitionBy("status").parquet(path)
    written = spark.read.schema(judged.schema).parquet(path)
    counts = written.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"), F.max("dispensed_at").alias("latest"))
    counts.write.mode("overwrite").parquet(f"{work_dir}/ledger/batch={batch_id}")


def admit(incoming: DataFrame, work_dir: str, keys: list[str], delay_days: int = DELAY_DAYS) -> None:
    """Admit or reject all rows of a streaming frame that have arrived since the last run."""
    writer = incoming.writeStream.foreachBatch(lambda batch, k: admit_batch(batch, k, work_dir, keys, delay_days))
    writer = writer.option("checkpointLocation", f"{work_dir}/checkpoints/admit")
    writer.trigger(availableNow=True).start().awaitTermination()


def close_sessions(
    spark: SparkSession, work_dir: str, schema, keys: list[str], grace_days: int = GRACE_DAYS, delay_days: int = DELAY_DAYS
) -> dict | None:
    """Append the sessions that admitted rows let close to ``<work_dir>/sessions``; returns the last progress report."""
    before = spark.conf.get(_LOCAL_MERGE)
    spark.conf.set(_LOCAL_MERGE, "true")
    try:
        admitted = spark.readStream.schema(schema).parquet(f"{work_dir}/arrived/batch=*/status=admitted")
        timed = admitted.withColumn(MOMENT, instant(F.col("dispensed_at"))).withWatermark(MOMENT, f"{delay_days} days")
        writer = session_totals(timed, keys, grace_days).writeStream.format("parquet").outputMode("append")
        writer = writer.option("path", f"{work_dir}/sessions").option("checkpointLocation", f"{work_dir}/checkpoints/sessions")
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query.lastProgress
    finally:
        spark.conf.set(_LOCAL_MERGE, before)


def run_arrivals(
    incoming: DataFrame, work_dir: str, keys: list[str], grace_days: int = GRACE_DAYS, delay_days: int = DELAY_DAYS
) -> dict | None:
    """Admit what has arrived, then close the sessions that ended; to be run again whenever files arrive, or after a failure.

    ``incoming`` is a streaming frame with the keys, ``dispensed_at`` and ``qty``; ``work_dir`` a folder that
    driver and executors share. Options must stay the same over all runs of a folder.
    """
    work_dir = work_dir.rstrip("/")
    admit(incoming, work_dir, keys, delay_days)
    if not _exists(incoming.sparkSession, os.path.join(work_dir, "arrived")):
        return None
    return close_sessions(incoming.sparkSession, work_dir, incoming.schema, keys, grace_days, delay_days)


def session_schema(keys: list[str], deliveries: DataFrame):
    """Columns of the closed sessions of ``deliveries``."""
    return session_totals(deliveries.select(*keys, "dispensed_at", "qty"), keys).schema


def closed_sessions(spark: SparkSession, work_dir: str, schema) -> DataFrame:
    """The sessions closed so far."""
    return spark.read.schema(schema).parquet(f"{work_dir}/sessions")


def replay(arrivals: DataFrame, number: str, batches: int, work_dir: str, keys: list[str], **options) -> None:
    """Let a table arrive in ``batches`` deliveries by the column ``number`` (0, 1, ...), each followed by a run."""
    spark = arrivals.sparkSession
    columns = [*keys, "dispensed_at", "qty"]
    arrivals.select(*columns, number).write.partitionBy(number).parquet(f"{work_dir}/source")
    source = spark.read.schema(arrivals.select(*columns, number).schema).parquet(f"{work_dir}/source")
    for k in range(batches):
        source.where(F.col(number) == k).select(*columns).write.parquet(f"{work_dir}/incoming/part-{k}")
        incoming = spark.readStream.schema(arrivals.select(*columns).schema).parquet(f"{work_dir}/incoming/part-*")
        run_arrivals(incoming, work_dir, keys, **options)
