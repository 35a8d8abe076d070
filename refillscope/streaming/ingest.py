"""Incremental ingest of extract files (S1-S3 as a Structured Streaming source).

Extracts arriving in a folder are read with the file source, typed by the same
functions as the batch readers and split into valid rows and rejects. Each
micro-batch is written to its own ``batch=<id>`` folder with overwrite, so a
replayed batch (after a failure between write and commit) replaces its own output
instead of duplicating it. The batch pipeline then reads the accumulated tables.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from refillscope.schema import DISPENSING_HEADERS, THERAPY_HEADERS
from refillscope.sources.extracts import by_name, csv_columns, csv_reader_options, stage, type_dispensing, type_therapy

_KINDS = {
    "dispensing": (DISPENSING_HEADERS, type_dispensing),
    "therapy": (THERAPY_HEADERS, type_therapy),
}


def read_extract_stream(spark: SparkSession, source_dir: str, kind: str = "dispensing", options=None) -> DataFrame:
    """Streaming DataFrame of new CSV extract files, by column name like the batch reader.

    The header is that of the files present at the start (the documented one if there are
    none yet); a later file with another header stops the query rather than load shifted.
    """
    headers, _ = _KINDS[kind]
    try:
        columns = csv_columns(spark, source_dir, options)
    except AnalysisException:  # no file yet
        columns = []
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns or headers])
    opts = {"maxFilesPerTrigger": "1000"} | csv_reader_options(options)
    return by_name(spark.readStream.format("csv").options(**opts).schema(schema).load(source_dir), headers)


def start_extract_ingest(
    spark: SparkSession,
    source_dir: str,
    output_dir: str,
    checkpoint_dir: str,
    kind: str = "dispensing",
    available_now: bool = True,
    processing_time: str = "1 minute",
    options: dict | None = None,
    decimal_comma: bool = False,
) -> StreamingQuery:
    """Start the ingest; rows go to ``<output>/batch=<id>/status=valid`` and ``status=rejected``.

    A micro-batch is typed and written once (``stage``).

    ``available_now`` processes every file present and stops (scheduled runs);
    otherwise the query keeps polling every ``processing_time``.
    """
    _, typer = _KINDS[kind]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        stage(typer(batch, decimal_comma), os.path.join(output_dir, f"batch={batch_id}"))

    writer = (
        read_extract_stream(spark, source_dir, kind, options)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_dir)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
