"""Helpers of the corpus operators: bounded bitmaps, connected components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refillscope.shared import drop_table, materialise, shared_path

__all__ = ["connected_components", "drop_table", "in_bitmap", "materialise", "membership_bitmap", "partitions", "release_unused", "shared_path", "slices"]

# Largest membership bitmap: 2**27 bits are 16 MB, whatever the number of keys.
MAX_BITMAP_BITS = 27


# Rows of a batch whose texts a task holds as Python strings at once.
SLICE_ROWS = 500


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches, a few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def release_unused() -> None:
    """Return to the system what earlier tasks of this worker left unused in the pool of Arrow."""
    pa.default_memory_pool().release_unused()


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def membership_bitmap(keys: DataFrame, column: str, bits_per_key: int = 16) -> Broadcast:
    """Bitmap of the low bits of a well-mixed BIGINT column, broadcast to the tasks.

    About ``bits_per_key`` bits a key, between 2**16 and 2**27 bits in all, so its size has a fixed
    bound. A key of ``keys`` is always found; others are let through now and then, so an
    exact join must follow. Only the words of the bitmap reach the driver.
    """
    spark = keys.sparkSession
    bits = min(MAX_BITMAP_BITS, max(16, math.ceil(math.log2(bits_per_key * (keys.count() + 1)))))
    slot = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    words = (
        keys.where(F.col(column).isNotNull())
        .select(F.shiftright(slot, 6).alias("word"), slot.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("set"))
        .collect()
    )
    bitmap = np.zeros(1 << (bits - 6), dtype=np.uint64)
    for word, value in words:
        bitmap[word] = value & 0xFFFFFFFFFFFFFFFF
    return spark.sparkContext.broadcast(bitmap)


def in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each 64-bit key, whether its slot of the bitmap is set."""
    slots = keys.astype(np.uint64) & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[(slots >> np.uint64(6)).astype(np.int64)] >> (slots & np.uint64(63))) & np.uint64(1) == 1


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether each ``u`` has a single edge ``(u, v)`` and no ``v`` has one of its own."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("v").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    ends = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return ends.where("out > 1 or (out = 1 and into = 1)").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` of every id in an undirected edge list ``(a, b)`` of BIGINTs.

    The component is its smallest id. Alternates large-star and small-star steps (Kiveris
    et al., "Connected Components in MapReduce and Beyond") until the edges are a forest
    of stars; each round's edges are written to the shared folder, and those before dropped. Loops and repeated
    edges are allowed; ids without an edge to another id are not returned.
    """

    def smallest(pairs: DataFrame) -> DataFrame:
        # Written first, so that its join is between two shuffled inputs and Spark may split hot ids.
        return materialise(pairs.groupBy("u").agg(F.min("v").alias("low")), "components-low")

    stars = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    stars = materialise(stars, "components")
    while not _is_star_forest(stars):
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = smallest(both)
        low = lowest.select("u", F.least("u", "low").alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        large = materialise(large, "components-large")
        drop_table(stars, lowest)
        small = large.join(large.groupBy("u").agg(F.min("v").alias("low")), "u")
        stars = small.select("u", F.col("low").alias("v")).unionByName(
            small.where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
        )
        stars = materialise(stars.distinct(), "components")
        drop_table(large)
    ids = stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ids.unionByName(ids.select(F.col("component").alias("id"), "component").distinct())
