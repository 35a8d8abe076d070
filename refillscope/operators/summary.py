"""Per (product, patient) delivery measures and the delivery summary.

Definitions, per key with deliveries ordered by ``(date, qty)``:

- normalised gap of delivery i > 1: whole days since delivery i-1 divided by the
  quantity of delivery i-1; delivery 1 contributes 0 / q1;
- mean days: the mean of the normalised gaps (delivery 1 included), rounded half
  to even, as an integer; gaps with an unusable quantity are left out;
- late pickups: normalised gaps strictly above ``mean + grace_days``;
- deliveries, first and last delivery date;
- demographics: the variant on the latest delivery (ties: greatest values).

Everything is computed from the chunked scan in the same stage as the scan
window, then one aggregate per key combines map-side; see ``delivery_measures``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refillscope.functions.numeric import half_even_mean, safe_ratio, usable_quantity
from refillscope.functions.temporal import whole_days
from refillscope.operators.ordered_scan import Scan, same
from refillscope.schema import CANONICAL_KEYS, DEFAULT_GRACE_DAYS, DEMOGRAPHIC_COLUMNS
from refillscope.shared import materialise


def _first_copy_gap(ts: str, qty: str) -> Column:
    """Normalised gap of a chunk's first row: to its predecessor, or 0 for the first row of a key."""
    gap = F.when(F.col("_has_prev"), whole_days("_prev_ts", ts)).otherwise(F.lit(0).cast("bigint"))
    divisor = F.when(F.col("_has_prev"), F.col("_prev_qty")).otherwise(F.col(qty))
    return safe_ratio(gap, divisor)


def _with_gaps(chunks: DataFrame, ts: str, qty: str) -> DataFrame:
    """Per chunk: ``_gap`` of its first row and ``_zeros``, the later copies with a usable quantity.

    Later copies in a chunk each follow an identical copy: a gap of 0 over their own
    quantity, so 0.0 when the quantity is usable and NULL otherwise.
    """
    zeros = F.when(usable_quantity(qty), F.col("_len") - 1).otherwise(F.lit(0).cast("bigint"))
    return chunks.withColumn("_gap", _first_copy_gap(ts, qty)).withColumn("_zeros", zeros)


def _hot_key_totals(scan: Scan, keys: list[str], ts: str, qty: str) -> DataFrame:
    """Gap sum and count of every hot key (one row per hot key, so bounded)."""
    gaps = _with_gaps(scan.hot_chunks, ts, qty)
    return gaps.groupBy(*keys).agg(
        F.sum("_gap").alias("_key_sum"),
        (F.count("_gap") + F.sum("_zeros")).alias("_key_count"),
        F.lit(True).alias("_is_hot"),
    )


def delivery_measures(
    scan: Scan,
    keys: Sequence[str] = CANONICAL_KEYS,
    ts: str = "dispensed_at",
    qty: str = "qty",
    grace_days: int = DEFAULT_GRACE_DAYS,
) -> DataFrame:
    """Per key: ``first_at, last_at, mean_days, deliveries, late``.

    Columns the scan carries (``scan.carry``) come out too, taken from the latest
    delivery (ties: greatest values), as in ``demographics_one_row``.

    The mean is needed before the late count, so each chunk must see its key's
    totals. An ordinary key is entirely inside its ``(key, run 0)`` window partition,
    so a window sum over ``(key, run)`` gives them in the same stage as the scan. A
    hot key spans several runs; its totals come from a table with a row for each hot key. One
    aggregate then produces every measure, combining map-side.
    """
    keys = list(keys)
    gaps = _with_gaps(scan.chunks, ts, qty)
    run = Window.partitionBy(*keys, "_run")
    with_run_totals = gaps.select(
        "*",
        F.sum("_gap").over(run).alias("_run_sum"),
        (F.count("_gap").over(run) + F.sum("_zeros").over(run)).alias("_run_count"),
    )
    if scan.hot_chunks is None:  # every key is one run: its run totals are its totals
        joined = with_run_totals
        total, count = F.col("_run_sum"), F.col("_run_count")
    else:
        totals = materialise(_hot_key_totals(scan, keys, ts, qty), "hot-totals")
        matched = with_run_totals.join(totals, same(with_run_totals, totals, keys), "left")
        extra = ("_key_sum", "_key_count", "_is_hot")
        joined = matched.select(*[with_run_totals[c] for c in with_run_totals.columns], *[totals[c] for c in extra])
        hot = F.coalesce(F.col("_is_hot"), F.lit(False))
        total = F.when(hot, F.col("_key_sum")).otherwise(F.col("_run_sum"))
        count = F.when(hot, F.col("_key_count")).otherwise(F.col("_run_count"))
    mean = half_even_mean(F.coalesce(total, F.lit(0.0)), count)
    threshold = mean + F.lit(grace_days)
    late = F.when(F.col("_gap") > threshold, F.lit(1)).otherwise(F.lit(0)).cast("bigint") + F.when(
        F.lit(0) > threshold, F.col("_zeros")
    ).otherwise(F.lit(0).cast("bigint"))
    carried = list(scan.carry)
    latest = (
        [F.max(F.struct(F.col(ts).alias("_ts"), *[F.col(c) for c in carried])).alias("_latest")] if carried else []
    )
    measures = (
        joined.select(*keys, ts, *carried, "_len", mean.alias("_mean"), late.alias("_late"))
        .groupBy(*keys)
        .agg(
            F.min(ts).alias("first_at"),
            F.max(ts).alias("last_at"),
            F.max("_mean").alias("mean_days"),
            F.sum("_len").alias("deliveries"),
            F.sum("_late").alias("late"),
            *latest,
        )
    )
    if not carried:
        return measures
    return measures.select("*", *[F.col(f"_latest.{c}").alias(c) for c in carried]).drop("_latest")


def gap_statistics(scan: Scan, keys: Sequence[str] = CANONICAL_KEYS, ts: str = "dispensed_at", qty: str = "qty"):
    """Per key: ``deliveries, first_at, last_at, mean_days``."""
    keys = list(keys)
    return delivery_measures(scan, keys, ts, qty).select(*keys, "deliveries", "first_at", "last_at", "mean_days")


def late_pickups(
    scan: Scan,
    keys: Sequence[str] = CANONICAL_KEYS,
    ts: str = "dispensed_at",
    qty: str = "qty",
    grace_days: int = DEFAULT_GRACE_DAYS,
) -> DataFrame:
    """Per key: ``late`` = normalised gaps strictly above ``mean_days + grace_days``."""
    keys = list(keys)
    return delivery_measures(scan, keys, ts, qty, grace_days).select(*keys, "late")


def first_last_delivery(deliveries: DataFrame, keys: Sequence[str] = CANONICAL_KEYS, ts: str = "dispensed_at"):
    """Per key: first and last delivery date (A1, A2; J1 is one aggregate)."""
    return deliveries.groupBy(*keys).agg(F.min(ts).alias("first_at"), F.max(ts).alias("last_at"))


def delivery_count(deliveries: DataFrame, keys: Sequence[str] = CANONICAL_KEYS) -> DataFrame:
    """Per key: number of deliveries (A4b: the largest running number is the row count)."""
    return deliveries.groupBy(*keys).agg(F.count(F.lit(1)).alias("deliveries"))


def patient_demographics(
    deliveries: DataFrame, keys: Sequence[str] = CANONICAL_KEYS, columns: Sequence[str] = DEMOGRAPHIC_COLUMNS
) -> DataFrame:
    """Distinct ``(key, demographics)`` variants."""
    return deliveries.select(*keys, *columns).distinct()


def demographics_one_row(
    deliveries: DataFrame,
    keys: Sequence[str] = CANONICAL_KEYS,
    ts: str = "dispensed_at",
    columns: Sequence[str] = DEMOGRAPHIC_COLUMNS,
) -> DataFrame:
    """One demographic variant per key: the one on the latest delivery (A5).

    Ties on the latest date go to the greatest values, compared column by column;
    a NULL counts as smaller than any value. One ``max(struct)`` aggregate, combined
    map-side.
    """
    latest = F.max(F.struct(F.col(ts).alias("_ts"), *[F.col(c) for c in columns])).alias("_latest")
    return deliveries.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in columns])


SUMMARY_COLUMNS = (
    "sex",
    "birth_date",
    "birth_town",
    "residence_town",
    "health_unit",
    "first_at",
    "last_at",
    "mean_days",
    "deliveries",
    "late",
)


def delivery_summary(
    deliveries: DataFrame,
    scan: Scan,
    keys: Sequence[str] = CANONICAL_KEYS,
    ts: str = "dispensed_at",
    qty: str = "qty",
    grace_days: int = DEFAULT_GRACE_DAYS,
) -> DataFrame:
    """The 11-column summary per key (P4, J5, J6): demographics, dates and measures.

    When the scan carries the demographic columns (``scan_deliveries(...,
    carry=DEMOGRAPHIC_COLUMNS)``) they come out of the measures aggregate itself (A5
    folded in: no second pass over the deliveries); otherwise they are aggregated
    separately and joined.
    """
    keys = list(keys)
    measures = delivery_measures(scan, keys, ts, qty, grace_days)
    if set(DEMOGRAPHIC_COLUMNS) <= set(scan.carry):
        return measures.select(*keys, *SUMMARY_COLUMNS)
    people = demographics_one_row(deliveries, keys, ts)
    return people.join(measures, on=keys, how="inner").select(*keys, *SUMMARY_COLUMNS)
