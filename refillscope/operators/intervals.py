"""Delivery intervals (W1 records) and normalised gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refillscope.functions.numeric import safe_ratio
from refillscope.functions.temporal import whole_days
from refillscope.operators.ordered_scan import (
    DEFAULT_CHUNK_ROWS,
    DEFAULT_ROWS_PER_RUN,
    HotKeys,
    Scan,
    expand_rows,
    ordered_scan,
)
from refillscope.schema import CANONICAL_KEYS


def scan_deliveries(
    deliveries: DataFrame,
    keys: Sequence[str] = CANONICAL_KEYS,
    ts: str = "dispensed_at",
    qty: str = "qty",
    *,
    hot: HotKeys | None = None,
    rows_per_run: int = DEFAULT_ROWS_PER_RUN,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    carry: Sequence[str] = (),
) -> Scan:
    """The chunked consecutive scan of deliveries, ordered by ``(ts, qty)`` per key.

    ``hot`` holds the hot keys of the deliveries (``find_hot_keys``), None if none is hot.
    ``carry`` names extra columns to keep on the scan rows (the delivery summary
    carries the demographics, so it needs no second pass over the deliveries).
    """
    return ordered_scan(
        deliveries,
        keys,
        ts,
        qty,
        hot=hot,
        rows_per_run=rows_per_run,
        chunk_rows=chunk_rows,
        carry=carry,
    )


def delivery_intervals(
    deliveries: DataFrame,
    keys: Sequence[str] = CANONICAL_KEYS,
    ts: str = "dispensed_at",
    qty: str = "qty",
    *,
    scan: Scan | None = None,
    hot: HotKeys | None = None,
    rows_per_run: int = DEFAULT_ROWS_PER_RUN,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """One record per delivery: ``keys, base_at, next_at, qty, gap_days, n``.

    Row ``n = 1`` of a key is ``(d1, NULL, q1, 0)``. Row ``n > 1`` pairs the previous
    delivery with this one: ``base_at = d[n-1]``, ``next_at = d[n]``,
    ``qty = q[n-1]`` and ``gap_days`` = whole days between them.
    """
    keys = list(keys)
    scan = scan or scan_deliveries(
        deliveries, keys, ts, qty, hot=hot, rows_per_run=rows_per_run, chunk_rows=chunk_rows
    )
    rows = expand_rows(scan.chunks, keys, ts, qty, spread=scan.hot is not None)
    return rows.select(
        *keys,
        F.col("base_ts").alias("base_at"),
        F.col("next_ts").alias("next_at"),
        F.col("base_qty").alias("qty"),
        F.when(F.col("_row_has_prev"), whole_days("base_ts", "next_ts"))
        .otherwise(F.lit(0).cast("bigint"))
        .alias("gap_days"),
        F.col("n"),
    )


def normalised_days(intervals: DataFrame) -> DataFrame:
    """Add ``normalised_days = gap_days / qty`` (NULL when the quantity is 0 or NULL)."""
    return intervals.withColumn("normalised_days", safe_ratio("gap_days", "qty"))
