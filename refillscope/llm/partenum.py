"""Operator 6: exact Jaccard join of documents on word shingles by PartEnum signatures.

Method (after Arasu, Ganti and Kaushik, "Efficient Exact Set-Similarity Joins"). Two sets of
a and b elements with Jaccard similarity of at least t differ in at most
``(a + b) * (1 - t) / (1 + t)`` elements. Sets are put into bands of nearly equal size
(each band ends at twice its start; a set close to its band's end also takes part in the next
band). Each band cuts the domain of shingles into a fixed number of partitions; a set is
projected on them. At most k partitions can hold a difference, so sets that are similar
enough agree in all but k of their non-empty projections, and hence share one of the
first k + 1 in any order that all sets follow. The subsets enumerated are single partitions;
large projections come first, as few unrelated sets share them. A set with no more than k
non-empty projections sends all of them and a signature that stands for its band, so no
pair is lost.

Sets that share a signature, and whose sketches let them be similar, form candidate families,
which are verified block by block. Equal sets are one from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refillscope.llm import setjoin as sj
from refillscope.llm.shared import (
    connected_components,
    drop_table,
    in_bitmap,
    materialise,
    membership_bitmap,
    partitions,
    release_unused,
)
from refillscope.llm.shingles import digest, digests, distinct_sets, mix, rank_in_group, shingles, word_hashes

DEFAULT_WIDTH = 5
DEFAULT_THRESHOLD = Fraction(4, 5)

# Partitions of a band for each element of its largest set: 3 to 4 elements a projection there.
_PARTITIONS_PER_ELEMENT = 0.28
_LEAST_PARTITIONS = 4

# Documents whose sets a task holds together.
_STEP = 250

_BAND = np.uint64(0xD6E8FEB86659FD93)
_PART = np.uint64(0xA0761D6478BD642F)
_CONTENT = np.uint64(0xE7037ED1A0B428DB)

_BLOCKS = "kind int, shard int, nodes binary, keys binary, sizes binary"
_ROWS = "kind int, doc_id long, other long, n int, hi long, lo long, sketch binary"
_DOCS, _PAIRS, _POSTINGS, _NO_ID, _GROUPS, _SETS = range(6)


def signatures(
    values: np.ndarray, bounds: np.ndarray, threshold: Fraction = DEFAULT_THRESHOLD
) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of sets ``values[bounds[i]:bounds[i+1]]`` and the set each belongs to.

    Any two sets with Jaccard similarity of at least ``threshold`` share a signature. Empty
    sets have none.
    """
    p, q = threshold.numerator, threshold.denominator
    sizes = np.diff(bounds)
    filled = np.flatnonzero(sizes)
    size = sizes[filled]
    band = np.frexp(size.astype(np.float64))[1] - 1  # 2**band <= size < 2**(band + 1)
    end = np.left_shift(1, band + 1)
    largest = size * q // p  # of a partner
    crosses = largest >= end
    entry_set = np.concatenate([filled, filled[crosses]])
    entry_band = np.concatenate([band, band[crosses] + 1])
    partner = np.concatenate([np.minimum(largest, end - 1), largest[crosses]])
    differ = (sizes[entry_set] + partner) * (q - p) // (q + p)
    parts = np.ceil(_PARTITIONS_PER_ELEMENT * np.left_shift(1, entry_band + 1)).astype(np.int64) + _LEAST_PARTITIONS

    count = sizes[entry_set]
    entry = np.repeat(np.arange(len(entry_set)), count)
    at = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(bounds[entry_set], count)
    element = values[at]
    salt = entry_band[entry].astype(np.uint64) * _BAND
    high = mix(element + salt) >> np.uint64(32)
    part = ((high * parts[entry].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    place = np.concatenate([[0], np.cumsum(parts)])[entry] + part
    order = np.argsort(place)
    starts, _ = sj.sorted_runs(place[order])
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    content = np.add.reduceat(mix(element * _CONTENT)[order], starts)
    held = np.diff(np.append(starts, len(order)))
    head = order[starts]
    owner = entry[head]
    signature = mix(content + salt[head] + (part[head].astype(np.uint64) + np.uint64(1)) * _PART)

    order = np.lexsort((signature, -held, owner))
    signature, owner = signature[order], owner[order]
    keep = rank_in_group(owner) <= differ[owner]
    weak = np.flatnonzero(np.bincount(owner, minlength=len(entry_set)) <= differ)
    weak_signature = mix(entry_band[weak].astype(np.uint64) * _BAND)
    return np.concatenate([signature[keep], weak_signature]), entry_set[np.concatenate([owner[keep], weak])]


def _document_sets(batch: pa.RecordBatch, width: int):
    hashes, counts = word_hashes(batch.column("text").to_pylist())
    values, owner, bounds = distinct_sets(*shingles(hashes, counts, width), batch.num_rows)
    return values, bounds


def _block(kind: int, shard: int, nodes=None, keys=None, sizes=None) -> dict:
    raw = [x if x is None or isinstance(x, bytes) else x.tobytes() for x in (nodes, keys, sizes)]
    return dict(zip(("kind", "shard", "nodes", "keys", "sizes"), (kind, shard, *raw), strict=True))


def _as_batch(rows: list[dict]) -> pa.RecordBatch:
    types = (("kind", pa.int32()), ("shard", pa.int32()), *((c, pa.binary()) for c in ("nodes", "keys", "sizes")))
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(types)))


def _map(width: int, threshold: Fraction, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_unused()
        keys, nodes, seen, turn = [], [], set(), 0

        def flush() -> Iterator[pa.RecordBatch]:
            if keys:
                key, node = np.concatenate(keys), np.concatenate(nodes)
                order = sj.by_shard(key, bits)
                key, node = key[order], node[order]
                for shard, rows in sj.shard_slices(key, bits):
                    yield _as_batch([_block(_POSTINGS, shard, sj.packed(node[rows]), sj.packed(key[rows]))])
            for x in (keys, nodes, seen):
                x.clear()

        gathered = 0
        for whole in batches:
            # Batches are cut so that one of many long texts stays small in memory.
            for at in range(0, whole.num_rows, _STEP):
                batch = whole.slice(at, _STEP)
                values, bounds = _document_sets(batch, width)
                raw, pairs = digests(values, bounds)
                ids = batch.column("doc_id")
                known = np.asarray(ids.is_valid())
                doc_id = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = np.diff(bounds).astype(np.int32)
                for kind, rows in ((_DOCS, known), (_NO_ID, ~known)):
                    if rows.any():
                        turn += 1
                        home = hash((int(doc_id[0]), turn)) % (1 << bits)
                        yield _as_batch([_block(kind, home, doc_id[rows], pairs[rows], sizes[rows])])
                # Of equal sets in this task, one stands for all.
                fresh = np.zeros(len(doc_id), dtype=bool)
                for i in np.flatnonzero(known & (sizes > 0)).tolist():
                    if raw[i] not in seen:
                        seen.add(raw[i])
                        fresh[i] = True
                if fresh.any():
                    chosen = np.repeat(fresh, sizes)
                    cut = np.concatenate([[0], np.cumsum(sizes[fresh], dtype=np.int64)])
                    marks = b"".join(sj.sketches(values[chosen], cut))
                    yield _as_batch([_block(_SETS, home, pairs[fresh], marks, sizes[fresh])])
                    key, owner = signatures(values[chosen], cut, threshold)
                    keys.append(key)
                    nodes.append(pairs[fresh, 1][owner])
                    gathered += len(key)
                if gathered >= sj.FLUSH_POSTINGS:
                    yield from flush()
                    gathered = 0
        yield from flush()

    return run


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(kind: int, **columns) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        columns["kind"] = np.full(size, kind, dtype=np.int32)
        types = {"kind": pa.int32(), "n": pa.int32(), "sketch": pa.binary()}
        names = ("kind", "doc_id", "other", "n", "hi", "lo", "sketch")
        made = [pa.array(columns[c], types.get(c, pa.int64())) if c in columns else pa.nulls(size, types.get(c, pa.int64())) for c in names]
        return pa.RecordBatch.from_arrays(made, names=list(names))

    for (shard,), pieces in sj.runs_of(batches, ("shard",)):
        keys, nodes = [], []
        for piece in pieces:
            for kind, raw, key, size in zip(*(piece.column(c).to_pylist() for c in ("kind", "nodes", "keys", "sizes")), strict=True):
                if kind == _POSTINGS:
                    nodes.append(sj.unpacked(raw).view(np.int64))
                    keys.append(sj.unpacked(key))
                    continue
                node = np.frombuffer(raw, dtype=np.int64)
                n = np.frombuffer(size, dtype=np.int32)
                if kind == _SETS:
                    hi, lo = np.ascontiguousarray(node.reshape(-1, 2).T)
                    ends = 8 * np.cumsum(sj.sketch_words(n))
                    marks = [key[a:b] for a, b in zip([0, *ends.tolist()[:-1]], ends.tolist(), strict=True)]
                    yield rows(kind, hi=hi, lo=lo, n=n, sketch=marks)
                    continue
                hi, lo = np.ascontiguousarray(np.frombuffer(key, dtype=np.int64).reshape(-1, 2).T)
                yield rows(kind, n=n, hi=hi, lo=lo, **({"doc_id": node} if kind == _DOCS else {}))
        if keys:
            a, b, group, member = sj.key_groups(np.concatenate(keys), np.concatenate(nodes))
            yield rows(_PAIRS, lo=a, other=b)
            yield rows(_GROUPS, lo=member, other=sj.key_in(shard, group).view(np.int64))


def _members(bitmap):
    """Rows whose id is in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            found = in_bitmap(bitmap.value, ids) & np.asarray(batch.column("doc_id").is_valid())
            yield batch.filter(pa.array(found))

    return run


def _verify(width: int, threshold: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, low, high), pieces in sj.runs_of(batches, ("family", "low", "high")):
            ids, block, sets = [], [], []
            for piece in pieces:
                # Texts are smaller than their sets on the way; rows of one id are told apart by their set.
                values, bounds = _document_sets(piece, width)
                wanted = zip(piece.column("hi").to_pylist(), piece.column("lo").to_pylist(), strict=True)
                for k, pair in enumerate(wanted):
                    own = values[bounds[k] : bounds[k + 1]]
                    if digest(own) == pair:
                        ids.append(piece.column("node")[k].as_py())
                        block.append(piece.column("block")[k].as_py())
                        sets.append(own)
            ids = np.array(ids, dtype=np.int64)
            found = sj.similar_pairs(sets, np.array(block), low, high, threshold.numerator, threshold.denominator)
            # A spanning forest has the same components as all links of the block pair.
            root = list(range(len(ids)))

            def top(x: int, root=root) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            kept = []
            for i, j in zip(found[0].tolist(), found[1].tolist(), strict=True):
                a, b = top(i), top(j)
                if a != b:
                    root[a] = b
                    kept.append((i, j))
            if kept:
                i, j = np.array(kept).T
                yield pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(ids[j])], names=["a", "b"])

    return run


def _likely(rows: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """Links ``a, b`` between sets that share a signature, by their sketches."""
    p, q = threshold.numerator, threshold.denominator

    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("sketch").alias(f"sketch_{name}"))

    pairs = rows.where(F.col("kind") == _PAIRS).select(F.col("lo").alias("a"), F.col("other").alias("b")).distinct()
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").where(F.expr(f"n_a * {q} >= n_b * {p} and n_b * {q} >= n_a * {p}"))
    groups = rows.where(F.col("kind") == _GROUPS).select(F.col("other").alias("group"), F.col("lo").alias("node"))
    members = groups.join(sets, "node")
    links = sj.group_links(members, threshold, lambda batch: batch.column("sketch").to_pylist())
    return sj.likely_pairs(pairs, threshold).unionByName(links)


def jaccard_components(
    docs: DataFrame, width: int = DEFAULT_WIDTH, threshold: Fraction = DEFAULT_THRESHOLD
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_shingles, component_id``.

    Only the columns ``doc_id`` and ``text`` are read; others may have any name. Words are
    what ASCII white space separates, A-Z lower-cased. A document's set is its distinct
    ``width``-word shingles; a document of fewer words has its whole sequence as one, a
    document without words (or with null text) has the empty set, 0 shingles and no link.
    ``component_id`` is the smallest ``doc_id`` that links lead to, itself included. Rows
    that share a ``doc_id`` are one document for that purpose and so share a component; a
    null ``doc_id`` has no links and a null component. An empty input gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bits = sj.shard_bits(docs)
    posted = texts.mapInArrow(_map(width, threshold, bits), _BLOCKS)
    dealt = posted.repartition(partitions(docs.sparkSession), "shard").sortWithinPartitions("shard")
    rows = materialise(dealt.mapInArrow(_reduce, _ROWS), "partenum")

    sets = rows.where(F.col("kind") == _SETS).select("hi", "lo", "n", "sketch").distinct()
    sets = materialise(sets.select(sj.node_of("lo").alias("node"), "n", "sketch"), "partenum-sets")
    likely = materialise(_likely(rows, sets, threshold), "partenum-links")
    drop_table(sets)
    near = materialise(sj.families(likely, connected_components), "partenum-families")
    drop_table(likely)
    own = rows.where((F.col("kind") == _DOCS) & (F.col("n") > 0)).select("doc_id", "n", "hi", "lo")
    kinds = own.groupBy("n", "hi", "lo").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
    kinds = materialise(kinds, "partenum-kinds")
    copied = kinds.where("rep <> last").select("n", "hi", "lo", "rep")
    twins = own.join(copied, ["n", "hi", "lo"]).where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    reps = kinds.withColumn("node", sj.node_of("lo")).join(near, "node").select("family", "n", "hi", "lo", F.col("rep").alias("node"))
    reps = materialise(reps, "partenum-reps")
    drop_table(near)
    dealt = sj.blocks(reps)
    drop_table(reps)
    bitmap = membership_bitmap(dealt, "node")
    texts = texts.mapInArrow(_members(bitmap), "doc_id long, text string").withColumnRenamed("doc_id", "node")
    pairs = sj.block_pairs(dealt.join(texts, "node").select("family", "node", "block", "blocks", "hi", "lo", "text"))
    links = pairs.mapInArrow(_verify(width, threshold), "a long, b long")
    links = links.unionByName(twins)
    component = materialise(connected_components(links), "partenum-components")

    found = rows.where(F.col("kind").isin(_DOCS, _NO_ID)).select("doc_id", F.col("n").cast("long").alias("n_shingles"))
    found = found.join(component.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))

