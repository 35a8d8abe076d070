"""Operator 1: harmonic packing of token sequences into bins of a fixed capacity.

Lengths fall into reciprocal-capacity classes: a bin of class j holds exactly j pieces of
``capacity // j`` tokens. Documents may be cut, so each one is cut into full bins, then
greedily into the largest class length that fits, until a piece of at most
``sqrt(capacity)`` tokens is left, which has a class of its own length. So every class has a
single length, there are at most ``2 * sqrt(capacity)`` of them, and a filled bin wastes no
more than ``capacity % length`` tokens.

Each class is filled on its own. Its pieces are dealt to buckets by a hash of their
document; buckets are counted, and the running count gives every bucket its first rank, so
all buckets rank their pieces independently. Rank and fixed count give bin and offset. What
is left over of each class, less than a bin's worth, is bounded by the capacity alone; those
few bins are planned from the class counts (largest length first) and joined by rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refillscope.llm.shared import materialise, release_unused, slices
from refillscope.llm.tokens import default_tokenizer, encoder, token_bytes

DEFAULT_CAPACITY = 4096
DEFAULT_END_ID = 2
# Pieces of a bucket on average.
BUCKET_PIECES = 2048


def cut(length: int, capacity: int) -> list[int]:
    """Piece lengths of a document: full bins, class lengths, and a short rest."""
    pieces = [capacity] * (length // capacity)
    rest = length % capacity
    small = isqrt(capacity)
    while rest:
        per_bin = capacity // rest
        take = rest if rest <= small or capacity // per_bin == rest else capacity // (per_bin + 1)
        pieces.append(take)
        rest -= take
    return pieces


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = DEFAULT_CAPACITY, end_id: int = DEFAULT_END_ID) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` of the pieces of each document, its end id included."""
    path = tokenizer or default_tokenizer()
    end = end_id.to_bytes(4, "little")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_unused()
        chunks = encoder(path)
        for batch in slices(batches):
            columns: list[list] = [[] for _ in names]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                raw = memoryview(token_bytes(text, chunks) + end)
                start = 0
                for length in cut(len(raw) // 4, capacity):
                    crc = zlib.crc32(raw[4 * start : 4 * (start + length)])
                    for column, value in zip(columns, (doc_id, start, length, crc, len(raw) // 4), strict=True):
                        column.append(value)
                    start += length
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def plan_rest(left: dict[int, int], capacity: int) -> list[list[tuple[int, int]]]:
    """Bins for the left-over pieces, each a list of (length, number), the largest lengths that fit first."""
    left = {length: n for length, n in left.items() if n}
    bins = []
    while left:
        room, own = capacity, []
        for length in sorted(left, reverse=True):
            n = min(left[length], room // length)
            if n:
                own.append((length, n))
                room -= n * length
                left[length] -= n
        left = {length: n for length, n in left.items() if n}
        bins.append(own)
    return bins


def harmonic_pack(cut_pieces: DataFrame, capacity: int = DEFAULT_CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces whose lengths are those of ``cut``.

    Sequences are numbered from 0 without gaps; offsets within one start at 0 without gaps.
    The input is read more than once and should be a written table.
    """
    spark = cut_pieces.sparkSession
    # At most 2 * sqrt(capacity) rows.
    counts = {r["length"]: r["n"] for r in cut_pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes, first = [], 0
    for length, n in sorted(counts.items()):
        per_bin = capacity // length
        classes.append((length, per_bin, n // per_bin * per_bin, first, -(-n // BUCKET_PIECES)))
        first += n // per_bin
    rest = []
    used = dict.fromkeys(counts, 0)
    for own in plan_rest({length: n % (capacity // length) for length, n in counts.items()}, capacity):
        offset = 0
        for length, n in own:
            for _ in range(n):
                rest.append((length, used[length], first, offset))
                used[length] += 1
                offset += length
        first += 1
    # Both tables are bounded by the capacity: a row for each class, less than a bin for each class.
    class_rows = spark.createDataFrame(classes, "length long, _per_bin long, _whole long, _first long, _buckets long")
    rest_rows = spark.createDataFrame(rest, "length long, _left long, _rest_sequence long, _rest_offset long")

    dealt = cut_pieces.join(F.broadcast(class_rows), "length")
    dealt = dealt.withColumn("_bucket", F.expr("pmod(xxhash64(doc_id, start), _buckets)"))
    sizes = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    own = Window.partitionBy("length", "_bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = dealt.withColumn("_place", F.row_number().over(own) - 1).join(materialise(ahead, "bucket-ranks"), ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_ahead") + F.col("_place")).withColumn("_left", F.col("_rank") - F.col("_whole"))
    planned = ranked.join(F.broadcast(rest_rows), ["length", "_left"], "left")
    filled = F.col("_left") < 0
    return planned.select(
        *cut_pieces.columns,
        F.when(filled, F.expr("_first + _rank div _per_bin")).otherwise(F.col("_rest_sequence")).alias("sequence_id"),
        F.when(filled, F.expr("_rank % _per_bin * length")).otherwise(F.col("_rest_offset")).alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = DEFAULT_CAPACITY) -> DataFrame:
    """Pack all documents: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` per piece.

    Reads ``doc_id`` and ``text`` alone. Null and empty texts are a piece of the end id only.
    A null ``doc_id`` is carried along, and rows that share a ``doc_id`` are packed each on
    its own. An empty input gives no pieces.
    """
    return harmonic_pack(materialise(pieces(docs, tokenizer, capacity), "pieces"), capacity)
