"""Operator 5: exact duplicates through an extendible-hash index on shared files.

Texts are keyed by 64 bits of a hash. The index is built in the shared folder:

- *log*: one small row for each document (key, id, digest), written once;
- *directory*: starts with one bucket and doubles whenever an overfull bucket uses all of
  its bits, up to ``MAX_DEPTH`` bits; a bucket that is still overfull then simply chains more
  entries. It is made from the number of distinct keys under each prefix, a table of at most
  ``2**MAX_DEPTH`` rows;
- *bucket files*: the distinct keys with their number of rows, by bucket. A bucket is a
  contiguous range of keys.

Keys with a single row are settled. For the others the texts are fetched, equal ones merged
in the map tasks first, and the task that owns a bucket walks its keys in order: it chains
the texts of a key and compares them byte by byte, so that texts which only share a hash
stay apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refillscope.llm.setjoin import runs_of
from refillscope.llm.shared import in_bitmap, materialise, membership_bitmap, partitions, shared_path

# Entries a bucket holds before it is split, and the most bits the directory may use.
BUCKET_ENTRIES = 1024
MAX_DEPTH = 16
# Bytes of distinct texts that a map task merges before it sends them on.
MERGE_BYTES = 64_000_000


def text_key(raw: bytes) -> int:
    """The 64-bit key of a normalised text, as a signed integer."""
    value = xxhash.xxh3_64_intdigest(raw)
    return value - (1 << 64) if value >> 63 else value


def _normal(text: str | None) -> bytes:
    """UTF-8 with A-Z, and nothing else, in lower case; null is empty."""
    return text.encode("utf-8", "surrogatepass").lower() if text else b""


def build_directory(prefixes: dict[int, int], entries: int = BUCKET_ENTRIES, depth: int = MAX_DEPTH) -> list[int]:
    """The directory: for each of ``2**depth`` prefixes the number of its bucket.

    ``prefixes`` has the entries under each prefix that has any. Buckets are split one bit at
    a time and the directory doubles when a bucket is as deep as it; the result is spelled
    out at full depth.
    """
    below = [0] * (1 << depth)
    for prefix, n in prefixes.items():
        below[prefix] = n
    held = [0]
    for n in below:
        held.append(held[-1] + n)
    # A bucket is (bits, number of bits): the prefixes that begin with these bits.
    full, done = [(0, 0)], []
    while full:
        bits, used = full.pop()
        first, after = bits << (depth - used), (bits + 1) << (depth - used)
        if held[after] - held[first] > entries and used < depth:
            full += [(2 * bits + 1, used + 1), (2 * bits, used + 1)]
        else:
            done.append((first, after))
    directory = [0] * (1 << depth)
    for number, (first, after) in enumerate(sorted(done)):
        directory[first:after] = [number] * (after - first)
    return directory


def _log(hasher):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [_normal(t) for t in batch.column("text").to_pylist()]
            columns = [
                batch.column("doc_id"),
                pa.array([hasher(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "digest"])

    return run


def _merged(bitmap: Broadcast, hasher):
    """Texts of repeated keys, equal ones of a task as one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(held), 500):
                rows = list(held.items())[at : at + 500]
                columns = [
                    pa.array([r[1][0] for r in rows], pa.int64()),
                    pa.array([r[0] for r in rows], pa.binary()),
                    pa.array([r[1][1] for r in rows], pa.int64()),
                    pa.array([r[1][2] for r in rows], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "body", "largest", "rows"])
            held.clear()

        for batch in batches:
            texts = [_normal(t) for t in batch.column("text").to_pylist()]
            keys = pa.array([hasher(t) for t in texts], pa.int64()).to_numpy()
            wanted = in_bitmap(bitmap.value, keys)
            for doc_id, text, key, good in zip(batch.column("doc_id").to_pylist(), texts, keys.tolist(), wanted.tolist(), strict=True):
                if good:
                    entry = held.get(text)
                    if entry is None:
                        held[text] = [key, doc_id, 1]
                        size += len(text)
                    else:
                        entry[1] = doc_id if entry[1] is None else entry[1] if doc_id is None else max(entry[1], doc_id)
                        entry[2] += 1
            if size >= MERGE_BYTES:
                yield from flush()
                size = 0
        yield from flush()

    return run


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk the keys of the owned buckets: chain the texts of each, comparing bytes."""
    for (_, key), pieces in runs_of(batches, ("bucket", "key")):
        chain: list[list] = []
        for piece in pieces:
            for body, largest, rows in zip(*(piece.column(c).to_pylist() for c in ("body", "largest", "rows")), strict=True):
                for link in chain:
                    if link[0] == body:
                        link[1] = largest if link[1] is None else link[1] if largest is None else max(link[1], largest)
                        link[2] += rows
                        break
                else:
                    chain.append([body, largest, rows])
        columns = [
            pa.array([key] * len(chain), pa.int64()),
            pa.array([hashlib.sha256(x[0]).digest() for x in chain], pa.binary()),
            pa.array([x[1] for x in chain], pa.int64()),
            pa.array([x[2] for x in chain], pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "digest", "keep_id", "group_size"])


def exact_duplicates(docs: DataFrame, entries: int = BUCKET_ENTRIES, depth: int = MAX_DEPTH, hasher=text_key) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null is empty. Of equal texts the
    largest ``doc_id`` stays; rows that also share that id are the same document, and all of
    them are ``kept``. A null ``doc_id`` comes after all others: it stays only where all are
    null (``keep_id`` is null then). Only ``doc_id`` and ``text`` are read. An empty input
    gives an empty result. ``hasher`` maps normalised bytes to the 64-bit key.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    log = materialise(texts.mapInArrow(_log(hasher), "doc_id long, key long, digest binary"), "index-log")

    keys = materialise(log.groupBy("key").agg(F.count(F.lit(1)).alias("rows")), "index-keys")
    prefix = F.shiftrightunsigned("key", 64 - depth).cast("int")
    used = {r["prefix"]: r["n"] for r in keys.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n")).collect()}
    directory = list(enumerate(build_directory(used, entries, depth)))
    # No more than 2**depth rows.
    directory = F.broadcast(spark.createDataFrame(directory, "prefix int, bucket int"))
    path = shared_path(spark, "index-buckets")
    routed = keys.withColumn("prefix", prefix).join(directory, "prefix").select("bucket", "key", "rows")
    routed = routed.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket", "key")
    routed.write.partitionBy("bucket").parquet(path)
    buckets = spark.read.schema("key long, rows long, bucket int").parquet(path)

    chained = buckets.where("rows > 1").select("bucket", "key")
    merged = texts.mapInArrow(_merged(membership_bitmap(chained, "key"), hasher), "key long, body binary, largest long, rows long")
    owned = merged.join(chained, "key").repartition(partitions(spark), "bucket").sortWithinPartitions("bucket", "key")
    settled = materialise(owned.mapInArrow(_own, "key long, digest binary, keep_id long, group_size long"), "index-chains")

    judged = log.join(settled, ["key", "digest"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return judged.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
