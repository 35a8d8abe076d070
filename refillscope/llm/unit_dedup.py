"""Operator 9: repeated passages by hashes of normalised lines, sentences or paragraphs.

A unit is normalised (lower case, only letters and digits, single spaces) and hashed to
128 bits. Hashes are grouped over the whole corpus; the earliest occurrence, by ``doc_id``
and then by place, stays, every other one goes with its offsets in the original text.

The text is read twice: first only hashes are grouped (equal ones meet in the map tasks
already), then the units whose hash is in a bounded bitmap of the repeated ones are joined
with these exactly. So the shuffles carry hashes, never texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refillscope.llm.shared import in_bitmap, materialise, membership_bitmap

# What a unit of each kind is. A sentence ends at a full stop, question or
# exclamation mark before white space, and at the end of its line.
UNITS = {
    "line": re.compile(r"[^\n]+"),
    "sentence": re.compile(r"[^\n.!?]+(?:[.!?]+(?!\s)[^\n.!?]+)*[.!?]*"),
    "paragraph": re.compile(r"(?:[^\n]+\n?)+"),
}
DEFAULT_UNITS = ("line", "sentence")
# Units of fewer words are too common by chance to be called repeats.
DEFAULT_MIN_WORDS = 8

_JUNK = re.compile(r"[\W_]+")


def normalise(unit: str) -> str:
    return _JUNK.sub(" ", unit.lower()).strip()


def _units(text: str, kinds: tuple[str, ...], min_words: int) -> Iterator[tuple[int, int, int, str]]:
    """``(kind, start, end, normalised text)`` of the units of a text that are long enough."""
    for k, kind in enumerate(kinds):
        for found in UNITS[kind].finditer(text):
            start, end = found.span()
            if end - start >= 2 * min_words - 1:
                plain = normalise(found.group())
                if plain.count(" ") >= min_words - 1:
                    yield k, start, end, plain


def _hashed(kinds: tuple[str, ...], min_words: int, bitmap: Broadcast | None):
    names = ["hi", "lo", "doc_id", "unit", "start", "stop", "first"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                seen = set()
                for kind, start, end, plain in _units(text, kinds, min_words) if text and doc_id is not None else ():
                    raw = xxhash.xxh3_128_digest(plain.encode("utf-8", "surrogatepass"))
                    key = (kind, raw)
                    first = key not in seen
                    seen.add(key)
                    hi, lo = (int.from_bytes(x, "big", signed=True) for x in (raw[:8], raw[8:]))
                    rows.append((hi, lo, doc_id, kind, start, end, first))
                if len(rows) >= 20_000:
                    yield from packed(rows)
                    rows = []
        yield from packed(rows)

    def packed(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
        if bitmap is not None and rows:
            out = out.filter(pa.array(in_bitmap(bitmap.value, out.column("lo").to_numpy())))
        yield out

    return run


_SCHEMA = "hi long, lo long, doc_id long, unit int, start int, stop int, first boolean"


def repeated_units(
    docs: DataFrame, units: tuple[str, ...] = DEFAULT_UNITS, min_words: int = DEFAULT_MIN_WORDS
) -> DataFrame:
    """Occurrences to remove: ``doc_id, unit, start, stop, keep_doc_id, occurrences``.

    ``start`` and ``stop`` are offsets in code points into the original text, ``unit`` the
    kind of unit, ``keep_doc_id`` the document whose first occurrence stays. With several
    kinds of units each is treated on its own, so spans may nest; ``remove_spans`` merges
    them. Reads ``doc_id`` and ``text`` alone. Null and empty texts have no units; rows
    with a null ``doc_id`` are left alone; rows that share a ``doc_id`` count as the same
    document, whose first occurrence stays in each. An empty input gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    every = texts.mapInArrow(_hashed(units, min_words, None), _SCHEMA)
    groups = every.groupBy("hi", "lo", "unit").agg(F.min("doc_id").alias("keep_doc_id"), F.count(F.lit(1)).alias("occurrences"))
    groups = materialise(groups.where("occurrences > 1"), "repeated-units")
    bitmap = membership_bitmap(groups, "lo")
    likely = texts.mapInArrow(_hashed(units, min_words, bitmap), _SCHEMA)
    found = likely.join(groups, ["hi", "lo", "unit"]).where("doc_id <> keep_doc_id or not first")
    names = F.array(*[F.lit(u) for u in units])
    return found.select("doc_id", F.get(names, F.col("unit")).alias("unit"), "start", "stop", "keep_doc_id", "occurrences")


def remove_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` without the given ``(doc_id, start, stop)`` spans of their texts; other columns stay as they are."""
    own = spans.groupBy("doc_id").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("_spans"))
    own = materialise(own, "spans").withColumnRenamed("doc_id", "_span_doc")
    joined = docs.join(own, docs["doc_id"] == own["_span_doc"], "left")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    folded = F.aggregate(
        own["_spans"],
        start,
        lambda state, span: F.struct(
            F.greatest(state["at"], span["stop"]).alias("at"),
            F.concat(
                state["text"],
                F.substring(docs["text"], state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0))),
            ).alias("text"),
        ),
        lambda state: F.concat(state["text"], F.substring(docs["text"], state["at"] + 1, F.length(docs["text"]))),
    )
    text = F.when(own["_spans"].isNull(), docs["text"]).otherwise(folded)
    return joined.select(*[(text if c == "text" else docs[c]).alias(c) for c in docs.columns])
