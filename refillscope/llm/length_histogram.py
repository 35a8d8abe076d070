"""Operator 3: exact token counts from a histogram of encoded lengths.

Documents are counted by encoded length, within each map task first. Sums over the
histogram from its long end then answer totals, quantiles and truncated totals for every
context limit, without a second look at the texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refillscope.llm.tokens import default_tokenizer, encoder, token_bytes

# Lengths of a block: suffix sums run within blocks, and over the blocks' totals.
BLOCK_LENGTHS = 1024


def length_histogram(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``length, docs``: how many documents are encoded in that many tokens.

    Reads ``text`` alone; null and empty texts have length 0, repeated rows count each. An
    empty input gives an empty histogram.
    """
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, counts = encoder(path), Counter()
        for batch in batches:
            counts.update(len(token_bytes(t, chunks)) // 4 for t in batch.column("text").to_pylist())
        columns = [pa.array(list(x), pa.int64()) for x in (counts.keys(), counts.values())]
        yield pa.RecordBatch.from_arrays(columns, names=["length", "docs"])

    return docs.select("text").mapInArrow(run, "length long, docs long").groupBy("length").agg(F.sum("docs").alias("docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """One row per length, also a context limit, with exact sums over all documents.

    ``docs, tokens``: of this length; ``docs_at_least, tokens_at_least``: of this length or
    more; ``truncated_tokens``: what is left of all documents if each is cut to this length;
    ``cumulative``: the share of documents of this length or less; ``total_docs,
    total_tokens``.
    """
    rows = histogram.select(
        "length", "docs", (F.col("length") * F.col("docs")).alias("tokens"), F.expr(f"length div {BLOCK_LENGTHS}").alias("block")
    )
    totals = rows.groupBy("block").agg(F.sum("docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    # As many rows as the longest document has blocks.
    every = Window.orderBy(F.col("block").desc())
    later = every.rowsBetween(Window.unboundedPreceding, -1)
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select(
        "block",
        *[F.coalesce(F.sum(f"block_{c}").over(later), F.lit(0)).alias(f"later_{c}") for c in ("docs", "tokens")],
        *[F.sum(f"block_{c}").over(whole).alias(f"total_{c}") for c in ("docs", "tokens")],
    )
    down = Window.partitionBy("block").orderBy(F.col("length").desc())
    sums = rows.join(totals, "block").select(
        "length",
        "docs",
        "tokens",
        *[(F.sum(c).over(down) + F.col(f"later_{c}")).alias(f"{c}_at_least") for c in ("docs", "tokens")],
        "total_docs",
        "total_tokens",
    )
    return sums.select(
        "*",
        (F.col("total_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_tokens"),
        ((F.col("total_docs") - F.col("docs_at_least") + F.col("docs")) / F.col("total_docs")).alias("cumulative"),
    )


def truncated_totals(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """``context_limit, tokens, docs_cut`` for any limits: tokens left if documents are cut to the limit."""
    sums = [
        F.struct(
            F.lit(int(limit)).cast("long").alias("context_limit"),
            F.coalesce(F.sum(F.least("length", F.lit(int(limit))) * F.col("docs")), F.lit(0)).alias("tokens"),
            F.coalesce(F.sum(F.when(F.col("length") > int(limit), F.col("docs")).otherwise(0)), F.lit(0)).alias("docs_cut"),
        )
        for limit in limits
    ]
    return histogram.agg(F.array(*sums).alias("rows")).select(F.inline("rows"))


def length_quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """``share, length``: the least length that at least this share of documents does not exceed."""
    found = [
        F.struct(F.lit(float(s)).alias("share"), F.min(F.when(F.col("cumulative") >= float(s), F.col("length"))).alias("length"))
        for s in shares
    ]
    return sums.agg(F.array(*found).alias("rows")).select(F.inline("rows"))
