"""As-of join: every delivery with the therapy row in force at its time.

Deliveries and therapy rows become one tagged sequence per key, ordered by time; the last
therapy row seen is carried forward. That is one shuffle of both inputs and one sort, in
place of a range join. A hot key is cut into runs of both kinds of rows together
(``ordered_scan``), and what a run inherits comes from a table of one row per run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refillscope.functions.temporal import whole_days
from refillscope.operators.ordered_scan import (
    DEFAULT_CHUNK_ROWS,
    DEFAULT_ROWS_PER_RUN,
    HotKeys,
    cut_runs,
    from_earlier_runs,
)
from refillscope.schema import CANONICAL_KEYS


def tagged_rows(
    deliveries: DataFrame, therapy: DataFrame, keys: Sequence[str] = CANONICAL_KEYS, ts: str = "dispensed_at", *, inclusive: bool = True
) -> DataFrame:
    """``keys, ts, _row``: both inputs, ``_row`` a struct of kind and value that orders rows of one time.

    A therapy row comes before the deliveries of its time if it is in force for them
    (``inclusive``) and after them if not. Rows with a null time stand nowhere and are left out.
    """

    def tagged(own: DataFrame, value: str, therapy_row: bool) -> DataFrame:
        place = F.lit(int(therapy_row != inclusive))
        row = F.struct(place.alias("place"), F.lit(therapy_row).alias("therapy"), F.col(value).cast("double").alias("value"))
        return own.where(F.col(ts).isNotNull()).select(*keys, ts, row.alias("_row"))

    return tagged(deliveries, "qty", False).unionByName(tagged(therapy, "therapy_days", True))


def therapy_in_force(
    tagged: DataFrame,
    keys: Sequence[str] = CANONICAL_KEYS,
    ts: str = "dispensed_at",
    *,
    hot: HotKeys | None = None,
    rows_per_run: int = DEFAULT_ROWS_PER_RUN,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """One row per delivery of ``tagged_rows``: ``keys, ts, qty, therapy_at, therapy_days, days_since, uncovered_days``.

    The therapy row is the latest one at the delivery's time or before it (strictly before,
    if the rows were tagged so); of several at one time, that with the most therapy days, a
    null counting least. ``days_since`` are whole days from it to the delivery,
    ``uncovered_days`` those beyond its therapy days. All four are null where no therapy row
    precedes the delivery. Deliveries are never lost or repeated; null keys are a key.
    ``hot`` holds the hot keys of the tagged rows.
    """
    keys = list(keys)
    rows, hot_rows = cut_runs(tagged, keys, ts, "_row", hot=hot, rows_per_run=rows_per_run, chunk_rows=chunk_rows)
    seen = F.when(F.col("_row.therapy"), F.struct(F.col(ts).alias("at"), F.col("_row.value").alias("days")))
    rows = from_earlier_runs(rows, hot_rows, keys, {"_inherited": F.max(seen)})
    so_far = (
        Window.partitionBy(*keys, "_run")
        .orderBy(F.col(ts), F.col("_row"), F.col("_chunk"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    known = F.coalesce(F.last(seen, ignorenulls=True).over(so_far), F.col("_inherited"))
    found = rows.select(*keys, ts, "_row", "_len", known.alias("_known")).where(~F.col("_row.therapy"))
    if hot_rows is not None:  # each copy of a delivery is a row again
        found = found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_len"))))
    found = found.select(
        *keys, ts, F.col("_row.value").alias("qty"), F.col("_known.at").alias("therapy_at"), F.col("_known.days").alias("therapy_days")
    ).withColumn("days_since", whole_days("therapy_at", ts))
    beyond = F.col("days_since") - F.col("therapy_days")
    # A null or NaN number of therapy days says nothing about cover.
    return found.withColumn("uncovered_days", F.when(beyond.isNotNull() & ~F.isnan(beyond), F.greatest(F.lit(0.0), beyond)))
