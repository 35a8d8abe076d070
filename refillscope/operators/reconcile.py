"""Reconciliation of two versions of an extract as bags of lines, by counted signed unions.

Both versions become one frame with a sign; a group's sum of signs says how many copies of a
line came or went. Repeated lines count, null values are values, and no rows are joined. The
signs are summed up before the shuffle, so a large group of copies is one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _signed(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    def one(own: DataFrame, sign: int) -> DataFrame:
        return own.select(*columns, F.lit(sign).cast("bigint").alias("_sign"))

    return one(old, -1).unionByName(one(new, 1))


def _copies(sign: int) -> Column:
    return F.sum(F.when(F.col("_sign") == sign, 1).otherwise(0)).cast("bigint")


def line_changes(old: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The lines whose number of copies differs: ``columns, change, copies``.

    ``change`` is ``added`` or ``removed``, ``copies`` by how many. This is the bag difference
    both ways (EXCEPT ALL) in one shuffle.
    """
    sums = _signed(old, new, columns).groupBy(*columns).agg(F.sum("_sign").alias("_net")).where("_net <> 0")
    return sums.select(*columns, F.when(F.col("_net") > 0, "added").otherwise("removed").alias("change"), F.abs("_net").alias("copies"))


def line_report(changes: DataFrame, identity: Sequence[str]) -> DataFrame:
    """Changes by line identity: ``identity, added, removed, changed``.

    Of lines with one identity, as many as both came and went are ``changed``; ``added`` and
    ``removed`` are the rest. Only lines that differ are shuffled again.
    """
    came = F.sum(F.when(F.col("change") == "added", F.col("copies")).otherwise(0))
    went = F.sum(F.when(F.col("change") == "removed", F.col("copies")).otherwise(0))
    sums = changes.groupBy(*identity).agg(came.alias("_came"), went.alias("_went"))
    both = F.least("_came", "_went")
    return sums.select(*identity, (F.col("_came") - both).alias("added"), (F.col("_went") - both).alias("removed"), both.alias("changed"))


def key_presence(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key of either version: ``keys, old_lines, new_lines, presence`` (``both``, ``only_old``, ``only_new``)."""
    sums = _signed(old, new, keys).groupBy(*keys).agg(_copies(-1).alias("old_lines"), _copies(1).alias("new_lines"))
    presence = F.when(F.col("old_lines") == 0, "only_new").when(F.col("new_lines") == 0, "only_old").otherwise("both")
    return sums.withColumn("presence", presence)
