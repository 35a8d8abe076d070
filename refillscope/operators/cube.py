"""Adherence and late pickups by every combination of product, health unit and sex."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refillscope.functions.numeric import percentage_2dp

CUBE_COLUMNS = ("prod", "health_unit", "sex")


def adherence_cube(records: DataFrame, by: Sequence[str] = CUBE_COLUMNS) -> DataFrame:
    """One row per member of the cube: ``by, level, patients, deliveries, late, late_pct, adherence_pct``.

    ``records`` are adherence records. Percentages are of the pooled sums (late pickups of all
    deliveries, therapy days of all covered days); null where the divisor is 0. ``level`` is
    the grouping id: its bits, first column highest, are 1 for the columns summed over. So a
    total (bit 1) is told from the rows whose member is null (bit 0). One shuffle, of
    partial sums. An empty input gives an empty result, also without a grand total.
    """
    sums = records.cube(*by).agg(
        F.grouping_id(*by).cast("bigint").alias("level"),
        F.count("patient_id").alias("patients"),
        F.sum("deliveries").alias("deliveries"),
        F.sum("late").alias("late"),
        F.sum("therapy_days_total").alias("_supplied"),
        F.sum("denominator_days").alias("_span"),
    )
    return sums.select(
        *by,
        "level",
        "patients",
        "deliveries",
        "late",
        percentage_2dp("late", "deliveries").alias("late_pct"),
        percentage_2dp("_supplied", "_span").alias("adherence_pct"),
    )
