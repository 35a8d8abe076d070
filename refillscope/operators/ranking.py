"""Frames over days, exact ranks and n-tiles of large groups, and the top rows of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refillscope.operators.ordered_scan import same
from refillscope.schema import CANONICAL_KEYS
from refillscope.shared import materialise


def trailing_supply(
    therapy: DataFrame, keys: Sequence[str] = CANONICAL_KEYS, ts: str = "dispensed_at", days: str = "therapy_days", window_days: int = 90
) -> DataFrame:
    """Per key and delivery day: ``day, rows, day_supply, trailing_rows, trailing_supply``.

    The trailing sums are over the ``window_days`` calendar days that end with this one, so all
    deliveries of a day share them. Rows are summed up per day before the RANGE frame is taken:
    however many rows a key has, the frame's partition has no more than one row per calendar
    day. Rows without a time are left out; null and NaN therapy days count as no supply.
    """
    day = F.to_date(F.col(ts)).alias("day")
    supply = F.coalesce(F.nanvl(F.col(days).cast("double"), F.lit(0.0)), F.lit(0.0))
    per_day = therapy.where(F.col(ts).isNotNull()).groupBy(*keys, day).agg(F.count(F.lit(1)).alias("rows"), F.sum(supply).alias("day_supply"))
    frame = Window.partitionBy(*keys).orderBy(F.unix_date("day")).rangeBetween(1 - window_days, 0)
    return per_day.select(
        *keys, "day", "rows", "day_supply", F.sum("rows").over(frame).alias("trailing_rows"), F.sum("day_supply").over(frame).alias("trailing_supply")
    )


def exact_ranks(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``rank`` (from 1 on) and ``group_rows`` by the exact order of ``order`` within ``group``.

    A group may hold any share of the rows: rows are dealt out by ranges of ``(group, order)``
    and written with the number of their range. Ranks then follow from exact counts per range,
    whatever its bounds. ``order`` has to tell rows apart for ranks to be the same in each run;
    nulls come first.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(ranges, *group, *order).withColumn("_range", F.spark_partition_id())
    dealt = materialise(dealt, "ranges")
    counts = dealt.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    across = Window.partitionBy(*group)
    before = across.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *group, "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(across).alias("group_rows")
    )
    within = Window.partitionBy(*group, "_range").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    local = dealt.withColumn("_place", F.row_number().over(within))
    joined = local.join(counts, same(local, counts, [*group, "_range"]))
    return joined.select(*[local[c] for c in df.columns], (counts["_before"] + local["_place"]).alias("rank"), counts["group_rows"])


def n_tiles(df: DataFrame, group: Sequence[str], order: Sequence[str], tiles: int, name: str = "tile") -> DataFrame:
    """``exact_ranks`` with the tile of each row: as equal as possible, larger ones first."""
    size, extra = F.expr(f"group_rows div {int(tiles)}"), F.col("group_rows") % int(tiles)
    large = extra * (size + 1)
    place = F.col("rank") - 1
    tile = F.when(place < large, F.floor(place / (size + 1))).otherwise(extra + F.floor(F.try_divide(place - large, size)))
    return exact_ranks(df, group, order).withColumn(name, (tile + 1).cast("int"))


def top_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column], count: int) -> DataFrame:
    """The first ``count`` rows of each group with their ``place``.

    Spark keeps that many rows of a group in each task before anything is shuffled
    (``WindowGroupLimit``), so a group of a third of all rows sends a few rows per task.
    """
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("place", place).where(F.col("place") <= count)
