"""Consecutive-row scan per key (O1 + W1), safe for hot keys and hot copy groups.

The reference sorts each product's rows by (patient, date) and walks them with a
per-partition loop, pairing every delivery with the one before it. A plain
``Window.partitionBy(key)`` expresses that, but it places every row of a key in one
task; a key holding a third of all rows would then hold a third of the job.

This module keeps the same semantics with bounded work per task:

1. ``find_hot_keys`` counts rows per key (partial aggregation, key columns only) and
   writes the keys with more than ``rows_per_run`` rows, at most ``total_rows /
   rows_per_run`` of them. It is one pass per input, made by the caller and handed to
   every scan of that input; a caller that knows an upper bound of the input's rows within
   ``rows_per_run`` needs no pass, as no key can be hot.
2. Rows of ordinary keys go straight to one window partitioned by ``(key, run)``, the run
   being the same for all: the single shuffle a plain per-key window needs. Without hot
   keys this is the whole plan, and building it runs no job.
3. Rows of hot keys are first collapsed: identical ``(key, ts, qty)`` rows become
   one row with a count (combined map-side, before the shuffle), and a count above
   ``chunk_rows`` is split into several chunk rows. Runs are cut by exact counts per day;
   days above the budget are cut per second, then per timestamp, quantity and chunk (see
   ``_hot_runs``). A run id is a function of the data alone, whatever is cached or lost.
4. Within a run, ``lag`` / ``row_number`` over ``(key, run)`` give each chunk its
   predecessor. The first chunk of a later run takes its predecessor from the tail
   of the key's previous run, through a table with one row per hot run.

The result has one row per chunk (an ordinary row is a chunk of one).
``expand_rows`` turns it back into one row per input row; the summary operators
aggregate it directly.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refillscope.shared import materialise

# A key with more rows than this is split into several runs, each scanned by its
# own task. The hot-key table holds at most total_rows / DEFAULT_ROWS_PER_RUN rows.
DEFAULT_ROWS_PER_RUN = 2_000_000

# Largest number of identical input rows one chunk row stands for.
DEFAULT_CHUNK_ROWS = 50_000


# A bounded table is broadcast up to so many rows, and joined by shuffle beyond.
MAX_BROADCAST_ROWS = 1_000_000

# Run id of every row of an ordinary key; hot runs have longer ones.
_NO_RUN = "cast(array() as array<bigint>)"


class Scan(NamedTuple):
    """Result of ``ordered_scan``.

    ``chunks``: one row per chunk with the keys, ``ts``, ``qty``, ``_run``, ``_chunk``,
    ``_len``, ``_has_prev``, ``_prev_ts``, ``_prev_qty``, ``_before``; hash-partitioned
    on ``(keys, _run)``.
    ``hot``: one row per hot key with ``_rows``. None when no key is hot.
    ``hot_chunks``: the same chunk rows as ``chunks``, for hot keys only. Per-key
    totals of a hot key are aggregated from it (one row per hot key). None when no
    key is hot.
    ``carry``: extra columns carried on every chunk row (identical copies keep the
    greatest combination of them, compared in order).
    """

    chunks: DataFrame
    hot: DataFrame | None
    hot_chunks: DataFrame | None
    carry: tuple = ()


class HotKeys(NamedTuple):
    """Keys with more than ``rows_per_run`` rows (a written table with ``_rows``) and how many there are."""

    table: DataFrame
    count: int


def _order(ts: str, qty: str) -> list[Column]:
    return [F.col(ts).asc_nulls_first(), F.col(qty).asc_nulls_first(), F.col("_chunk").asc()]


def find_hot_keys(
    df: DataFrame, keys: Sequence[str], rows_per_run: int = DEFAULT_ROWS_PER_RUN, most_rows: int | None = None
) -> HotKeys | None:
    """The keys with more than ``rows_per_run`` rows; None when there are none.

    ``most_rows``: an upper bound of the input's rows. Within ``rows_per_run`` nothing is
    counted; otherwise this is one pass over the key columns.
    """
    if most_rows is not None and most_rows <= rows_per_run:
        return None
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    table = materialise(per_key.where(F.col("_rows") > F.lit(int(rows_per_run))), "hot-keys")
    count = table.count()
    return HotKeys(table, count) if count else None


def same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Null-safe equality of the columns of two frames."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition


def small(df: DataFrame, rows: int) -> DataFrame:
    """A table of a known number of rows, to be broadcast if that is small."""
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def collapse_copies(
    df: DataFrame, keys: Sequence[str], ts: str, qty: str, chunk_rows: int, carry: Sequence[str] = ()
) -> DataFrame:
    """One row per chunk of identical ``(keys, ts, qty)`` rows, with ``_chunk`` and ``_len``.

    Extra columns that are functions of the grouping (such as ``_run``) may be
    included in ``keys``. ``carry`` columns keep, per group, their greatest
    combination (a ``max(struct)``; the group shares one ``ts``).
    """
    carried = [F.max(F.struct(*[F.col(c) for c in carry])).alias("_carry")] if carry else []
    counted = df.groupBy(*keys, ts, qty).agg(F.count(F.lit(1)).alias("_cnt"), *carried)
    last_chunk = F.expr(f"(_cnt - 1) div {int(chunk_rows)}")
    return counted.select(
        *keys,
        ts,
        qty,
        "_cnt",
        *[F.col(f"_carry.{c}").alias(c) for c in carry],
        F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)).alias("_chunk"),
    ).select(
        *keys,
        ts,
        qty,
        *carry,
        "_chunk",
        F.least(F.lit(int(chunk_rows)).cast("bigint"), F.col("_cnt") - F.col("_chunk") * int(chunk_rows)).alias(
            "_len"
        ),
    )


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    qty: str,
    *,
    hot: HotKeys | None = None,
    rows_per_run: int = DEFAULT_ROWS_PER_RUN,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    carry: Sequence[str] = (),
) -> Scan:
    """Pair every row with its predecessor in ``(ts, qty)`` order within ``keys``.

    ``hot`` comes from ``find_hot_keys`` on the same rows with the same ``rows_per_run``;
    the rows of these keys are cut into runs of about that size.

    Returns a ``Scan``; its ``chunks`` frame has, per chunk of identical rows:

    - ``_run``: the run of the key the chunk belongs to (empty unless the key is hot); runs
      of a key sort in the order of their rows,
    - ``_len``: input rows the chunk stands for,
    - ``_has_prev``: whether an input row precedes the chunk's first row in its key,
    - ``_prev_ts`` / ``_prev_qty``: that preceding row's values,
    - ``_before``: number of input rows of the key before the chunk.
    """
    keys, carry = list(keys), tuple(carry)
    rows, hot_chunks = cut_runs(df, keys, ts, qty, hot=hot, rows_per_run=rows_per_run, chunk_rows=chunk_rows, carry=carry)
    if hot_chunks is None:
        return Scan(_pair_with_predecessor(rows, None, keys, ts, qty, carry), None, None, carry)
    stitch = _stitch_table(hot_chunks, keys, ts, qty)
    return Scan(
        _pair_with_predecessor(rows, stitch, keys, ts, qty, carry),
        hot.table,
        _pair_with_predecessor(hot_chunks, stitch, keys, ts, qty, carry),
        carry,
    )


def cut_runs(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    qty: str,
    *,
    hot: HotKeys | None = None,
    rows_per_run: int = DEFAULT_ROWS_PER_RUN,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    carry: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame | None]:
    """Chunk rows ``keys, ts, qty, carry, _run, _chunk, _len`` of all keys, and those of the hot keys alone.

    A row of an ordinary key is a chunk of its own, in the key's only run. Without hot keys
    the second frame is None. ``qty`` may be of any type that can be ordered, also a struct.
    """
    keys, carry = list(keys), tuple(carry)
    rows = df.select(*keys, ts, qty, *carry)

    def plain(own: DataFrame) -> DataFrame:
        one = [F.lit(0).cast("bigint").alias("_chunk"), F.lit(1).cast("bigint").alias("_len")]
        return own.select(*[own[c] for c in (*keys, ts, qty, *carry)], F.expr(_NO_RUN).alias("_run"), *one)

    if hot is None:
        return plain(rows), None
    table = small(hot.table.select(*keys), hot.count)
    ordinary = plain(rows.join(table, same(rows, hot.table, keys), "left_anti"))
    hot_rows = rows.join(table, same(rows, hot.table, keys), "left_semi")
    hot_chunks = _hot_runs(hot_rows, keys, ts, qty, int(rows_per_run), chunk_rows, carry)
    return ordinary.unionByName(hot_chunks), hot_chunks


def from_earlier_runs(
    rows: DataFrame, hot_rows: DataFrame | None, keys: Sequence[str], totals: dict[str, Column]
) -> DataFrame:
    """``rows`` with what the earlier runs of each row's key leave behind, by name; null in a key's first run.

    ``totals`` has, by name, an aggregate of the rows of a run; over the earlier runs the
    greatest of them is taken, so it has to be one that a later run does not lower.
    """
    keys = list(keys)
    if hot_rows is None:
        empty = rows.groupBy().agg(*[t.alias(n) for n, t in totals.items()]).schema
        return rows.select("*", *[F.lit(None).cast(empty[n].dataType).alias(n) for n in totals])
    # One row per hot run; whether that is small enough to be broadcast is left to Spark.
    each = hot_rows.groupBy(*keys, "_run").agg(*[t.alias(n) for n, t in totals.items()])
    earlier = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    stitch = materialise(each.select(*keys, "_run", *[F.max(n).over(earlier).alias(n) for n in totals]), "hot-stitch")
    joined = rows.join(stitch, same(rows, stitch, [*keys, "_run"]), "left")
    return joined.select(*[rows[c] for c in rows.columns], *[stitch[n] for n in totals])


def _hot_runs(
    hot_rows: DataFrame, keys: list[str], ts: str, qty: str, budget: int, chunk_rows: int, carry: tuple = ()
) -> DataFrame:
    """Chunk rows of the hot keys, each with the run it falls into: at most ``2 * budget`` chunk rows.

    A key's chunks are counted per day. The exact number before a day, divided by the budget,
    numbers its run, so a run is a stretch of whole days. A day above the budget is a part of
    its own, cut likewise per second, then per timestamp, quantity and chunk. The run id is
    the list of these numbers, twice the quotient, plus one for a part that is cut further:
    the ids sort as the rows do.
    """
    chunks = materialise(collapse_copies(hot_rows, keys, ts, qty, chunk_rows, carry), "hot-chunks")
    columns = chunks.columns
    second = F.make_timestamp_ntz(
        *[part(ts) for part in (F.year, F.month, F.dayofmonth, F.hour, F.minute)], F.floor(F.second(ts)).cast("decimal(16,6)")
    )
    levels = [F.to_date(ts), second, F.col(ts), F.col(qty), F.col("_chunk")]
    pending = chunks.withColumn("_part", F.expr(_NO_RUN))
    done = None
    for level, bucket in enumerate(levels):
        pending = pending.withColumn("_bucket", bucket)
        place = [*keys, "_part", "_bucket"]
        counts = pending.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"))
        before = (
            Window.partitionBy(*keys, "_part")
            .orderBy(F.col("_bucket").asc_nulls_first())
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        full = (F.col("_n") > budget) if level + 1 < len(levels) else F.lit(False)
        ahead = F.coalesce(F.sum("_n").over(before), F.lit(0).cast("bigint"))
        number = F.lit(2) * F.floor(ahead / budget) + full.cast("bigint")
        marks = counts.select(*place, F.concat("_part", F.array(number)).alias("_run"), full.alias("_full"))
        marks = materialise(marks, "hot-marks")
        cut = pending.join(marks, same(pending, marks, place)).select(
            *[pending[c] for c in columns], marks["_run"], marks["_full"]
        )
        settled = cut.where(~F.col("_full")).drop("_full")
        done = settled if done is None else done.unionByName(settled)
        if marks.where("_full").isEmpty():
            break
        pending = materialise(cut.where("_full").select(*columns, F.col("_run").alias("_part")), "hot-part")
    return done.select(*keys, ts, qty, *carry, "_run", "_chunk", "_len")


def _stitch_table(hot_chunks: DataFrame, keys: list[str], ts: str, qty: str) -> DataFrame:
    """Hot keys only: per run, the last row and the row count of the key's earlier runs.

    One row per hot run. Its size is left to Spark, which broadcasts it only if it is small.
    """
    tails = hot_chunks.groupBy(*keys, "_run").agg(
        F.sum("_len").alias("_run_len"),
        F.max(F.struct(F.col(ts).alias("ts"), F.col(qty).alias("qty"), F.col("_chunk").alias("chunk"))).alias(
            "_tail"
        ),
    )
    across = Window.partitionBy(*keys).orderBy("_run")
    return tails.select(
        *keys,
        "_run",
        F.lag("_tail.ts").over(across).alias("_run_prev_ts"),
        F.lag("_tail.qty").over(across).alias("_run_prev_qty"),
        F.coalesce(
            F.sum("_run_len").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint")
        ).alias("_before_runs"),
        (F.row_number().over(across) > 1).alias("_has_prev_run"),
    )


def _pair_with_predecessor(
    chunks: DataFrame, stitch: DataFrame | None, keys: list[str], ts: str, qty: str, carry: tuple = ()
) -> DataFrame:
    """The window over ``(keys, _run)`` plus the broadcast stitch for the first chunk of a run.

    Without hot keys (``stitch`` is None) every key is one run and nothing is stitched.
    """
    in_run = Window.partitionBy(*keys, "_run").orderBy(*_order(ts, qty))
    earlier = F.coalesce(
        F.sum("_len").over(in_run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint")
    )
    if stitch is None:  # every chunk is a single row
        earlier = (F.row_number().over(in_run) - 1).cast("bigint")
    local = chunks.select(
        *keys,
        "_run",
        ts,
        qty,
        *carry,
        "_chunk",
        "_len",
        F.row_number().over(in_run).alias("_rn"),
        F.lag(ts).over(in_run).alias("_lag_ts"),
        F.lag(qty).over(in_run).alias("_lag_qty"),
        earlier.alias("_before_local"),
    )
    first_in_run = F.col("_rn") == 1
    if stitch is None:
        joined = local.select(
            "*",
            F.lit(False).alias("_has_prev_run"),
            F.lit(None).cast(local.schema[ts].dataType).alias("_run_prev_ts"),
            F.lit(None).cast(local.schema[qty].dataType).alias("_run_prev_qty"),
            F.lit(0).cast("bigint").alias("_before_runs"),
        )
    else:
        stitch = materialise(stitch, "hot-stitch")
        matched = local.join(stitch, same(local, stitch, [*keys, "_run"]), "left")
        extra = ("_has_prev_run", "_run_prev_ts", "_run_prev_qty", "_before_runs")
        joined = matched.select(*[local[c] for c in local.columns], *[stitch[c] for c in extra])
    has_prev_run = F.coalesce(F.col("_has_prev_run"), F.lit(False))
    return joined.select(
        *keys,
        ts,
        qty,
        *carry,
        "_run",
        "_chunk",
        "_len",
        F.when(first_in_run, has_prev_run).otherwise(F.lit(True)).alias("_has_prev"),
        F.when(first_in_run, F.col("_run_prev_ts")).otherwise(F.col("_lag_ts")).alias("_prev_ts"),
        F.when(first_in_run, F.col("_run_prev_qty")).otherwise(F.col("_lag_qty")).alias("_prev_qty"),
        (F.coalesce(F.col("_before_runs"), F.lit(0).cast("bigint")) + F.col("_before_local")).alias("_before"),
    )


def expand_rows(scan: DataFrame, keys: Sequence[str], ts: str, qty: str, spread: bool = True) -> DataFrame:
    """One output row per input row from a chunked scan (the interval records of W1).

    Within a chunk all rows are identical copies: the first takes the chunk's
    predecessor, every later copy follows an identical copy (gap 0, same quantity).
    Columns: keys, ``base_ts``, ``next_ts``, ``base_qty``, ``_row_has_prev`` and
    ``n`` (1-based position within the key).

    The chunks of one large copy group all sit in one run, so with ``spread`` the
    chunk rows are first rebalanced on their unique sort key: every chunk (at most
    ``chunk_rows`` rows once expanded) is expanded by whichever task receives it.
    Without hot keys (``spread=False``) every chunk is a single row.
    """
    keys = list(keys)
    pos = F.lit(1).cast("bigint").alias("_pos")
    if spread:
        scan = scan.hint("rebalance", *keys, ts, qty, "_chunk")
        pos = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_len"))).alias("_pos")
    rows = scan.select(*keys, ts, qty, "_len", "_has_prev", "_prev_ts", "_prev_qty", "_before", pos)
    first_copy = F.col("_pos") == 1
    has_prev = (~first_copy) | F.col("_has_prev")
    return rows.select(
        *keys,
        F.when(has_prev & first_copy, F.col("_prev_ts")).otherwise(F.col(ts)).alias("base_ts"),
        F.when(has_prev, F.col(ts)).alias("next_ts"),
        F.when(has_prev & first_copy, F.col("_prev_qty")).otherwise(F.col(qty)).alias("base_qty"),
        has_prev.alias("_row_has_prev"),
        (F.col("_before") + F.col("_pos")).alias("n"),
    )
