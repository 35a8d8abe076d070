"""Days covered by supply: the union of overlapping supply intervals per key.

A therapy row supplies ``therapy_days`` days from the day of its delivery on. Supplies of a
key overlap (a refill ahead of time, several packs on a day) or leave gaps. Along the rows in
order of their first day, the furthest end so far tells what a row adds: nothing below it,
the rest beyond it, and a gap if the row begins after it. So the union takes one ordered pass
and no join of intervals. This is the "days covered" reading of adherence: unlike the sum
of therapy days, a day counts once.

A hot key is cut into runs (``ordered_scan``). The furthest end within a run needs no other
run's rows, and the greatest end of all earlier runs comes from a table of one row per run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refillscope.functions.numeric import percentage_2dp
from refillscope.operators.ordered_scan import DEFAULT_ROWS_PER_RUN, HotKeys, cut_runs, from_earlier_runs
from refillscope.schema import CANONICAL_KEYS

# Copies of a supply are one row whatever their number: only their count is needed.
_ALL_COPIES = 2**40


def supplies(therapy: DataFrame, keys: Sequence[str], ts: str = "dispensed_at", days: str = "therapy_days") -> DataFrame:
    """``keys, _day, _days``: the rows that supply any days, with the midnight of their first day.

    Rows with a null time, or null, NaN, infinite, zero or negative days supply nothing.
    """
    number = F.col(days).cast("double")
    usable = F.col(ts).isNotNull() & (number > 0) & (number < float("inf"))
    day = F.to_date(F.col(ts)).cast("timestamp_ntz")
    return therapy.where(usable).select(*keys, day.alias("_day"), number.alias("_days"))


def supply_timeline(
    therapy: DataFrame,
    keys: Sequence[str] = CANONICAL_KEYS,
    ts: str = "dispensed_at",
    days: str = "therapy_days",
    *,
    hot: HotKeys | None = None,
    rows_per_run: int = DEFAULT_ROWS_PER_RUN,
) -> DataFrame:
    """The supplies of each key in order, with what each adds to those before.

    ``keys, _len, start, end`` (in days since 1970), ``added`` days that no earlier row covers,
    ``gap`` days without cover just before the row, ``stretch``: the start of the covered
    stretch that the row belongs to. Supplies that meet end to end are one stretch.
    """
    keys = list(keys)
    rows, hot_rows = cut_runs(
        supplies(therapy, keys, ts, days), keys, "_day", "_days", hot=hot, rows_per_run=rows_per_run, chunk_rows=_ALL_COPIES
    )

    def spanned(own: DataFrame | None) -> DataFrame | None:
        start = F.unix_date(F.to_date("_day")).cast("double")
        return None if own is None else own.withColumn("start", start).withColumn("end", start + F.col("_days"))

    rows, hot_rows = spanned(rows), spanned(hot_rows)
    in_run = Window.partitionBy(*keys, "_run").orderBy("start", "end", "_chunk")
    before = in_run.rowsBetween(Window.unboundedPreceding, -1)
    until = in_run.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def judged(own: DataFrame | None) -> DataFrame | None:
        if own is None:
            return None
        own = from_earlier_runs(own, hot_rows, keys, {"_reached": F.max("end")})
        own = own.withColumn("_reached", F.greatest(F.max("end").over(before), "_reached"))
        opens = F.col("_reached").isNull() | (F.col("start") > F.col("_reached"))
        return own.withColumn("_opens", F.when(opens, F.col("start")))

    rows, hot_rows = judged(rows), judged(hot_rows)
    rows = from_earlier_runs(rows, hot_rows, keys, {"_opened": F.max("_opens")})
    new = F.col("_opens").isNotNull()
    return rows.select(
        *keys,
        "_len",
        "_days",
        "start",
        "end",
        F.when(new, F.col("_days")).otherwise(F.greatest(F.lit(0.0), F.col("end") - F.col("_reached"))).alias("added"),
        F.when(new & F.col("_reached").isNotNull(), F.col("start") - F.col("_reached")).otherwise(F.lit(0.0)).alias("gap"),
        F.greatest(F.max("_opens").over(until), "_opened").alias("stretch"),
    )


def days_covered(timeline: DataFrame, keys: Sequence[str] = CANONICAL_KEYS) -> DataFrame:
    """Per key: covered, supplied and uncovered days, gaps, and the share of days covered.

    ``first_day``, ``span_days`` (first day to the end of the last cover), ``covered_days``,
    ``supplied_days``, ``overlap_days`` (supplied twice), ``gap_days``, ``gaps``,
    ``longest_gap``, ``covered_pct`` (of the span, two decimals). Keys without supply are absent.
    """
    per_key = timeline.groupBy(*keys).agg(
        F.min("start").alias("_first"),
        F.max("end").alias("_end"),
        F.sum("added").alias("covered_days"),
        F.sum(F.col("_days") * F.col("_len")).alias("supplied_days"),
        F.sum("gap").alias("gap_days"),
        F.sum((F.col("gap") > 0).cast("bigint")).alias("gaps"),
        F.max("gap").alias("longest_gap"),
    )
    span = F.col("_end") - F.col("_first")
    spanned = per_key.withColumn("span_days", span).withColumn("overlap_days", F.col("supplied_days") - F.col("covered_days"))
    return spanned.select(
        *keys,
        F.date_from_unix_date(F.col("_first").cast("int")).alias("first_day"),
        "span_days",
        "covered_days",
        "supplied_days",
        "overlap_days",
        "gap_days",
        "gaps",
        "longest_gap",
        percentage_2dp("covered_days", "span_days").alias("covered_pct"),
    )


def supply_stretches(timeline: DataFrame, keys: Sequence[str] = CANONICAL_KEYS) -> DataFrame:
    """Per key and covered stretch: ``from_day, covered_days, supplied_days, supplies, gap_before`` (0 for the first)."""
    per_stretch = timeline.groupBy(*keys, "stretch").agg(
        (F.max("end") - F.min("start")).alias("covered_days"),
        F.sum(F.col("_days") * F.col("_len")).alias("supplied_days"),
        F.sum("_len").alias("supplies"),
        F.max("gap").alias("gap_before"),
    )
    from_day = F.date_from_unix_date(F.col("stretch").cast("int")).alias("from_day")
    return per_stretch.select(*keys, from_day, "covered_days", "supplied_days", "supplies", "gap_before")
