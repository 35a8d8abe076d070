"""What the exact set joins share: postings by shard, candidate families, block-wise verification.

A join runs in three steps. Map tasks emit *postings* (key, node): nodes that are similar
enough share a key. Postings travel as packed blocks, one for each shard of the key space.
Where few nodes share a key, reducers send each pair of them, otherwise the key's nodes as a
*group*. Pairs, and the nodes of a group among each other, are compared by *sketches* that
never tell similar sets apart: a key that many unlike sets have in common links none of them.
The connected components of the links that are left are candidate *families*: every pair to
be found lies within one family. Families are then cut into blocks, and each pair of blocks
is verified by one task with the full sets.

A sketch has the parity of a set's elements in each of ``B`` hash slots, ``B`` a power of two
that goes with the set's size. Two sets differ in at least as many elements as their sketches
do in bits, and those of more slots are folded to those of the other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refillscope.llm.shared import materialise, partitions
from refillscope.llm.shingles import mix

# Least number of shards, and shards for each shuffle partition beyond that.
MIN_SHARDS = 256
SHARDS_PER_PARTITION = 4
# Postings a map task gathers before it sends them on.
FLUSH_POSTINGS = 750_000
# Sets and set elements of one block of a family.
BLOCK_SETS = 1024
BLOCK_ELEMENTS = 2_000_000
# Up to so many nodes of a key, all pairs are candidates.
FEW = 16
# Groups of up to so many rows are compared many at a time, up to so many words of sketches or pairs of rows together.
_SMALL_GROUP, _GROUP_WORDS, _GROUP_PAIRS = 512, 100_000, 1_000_000

# A set's node: the low bits of its digest. Sets of equal nodes are candidates of the same others, no more.
NODE_BITS = 48
# Fixed value: tells the slots of sketches from other uses of an element.
PARITY = np.uint64(0xA0761D6478BD642F)


def shard_bits(df: DataFrame) -> int:
    """log2 of the number of shards; it grows with the session's shuffle partitions."""
    return max(MIN_SHARDS, SHARDS_PER_PARTITION * partitions(df.sparkSession) - 1).bit_length()


def sorted_runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each run of equal keys, and for each row the start of its run."""
    new = np.concatenate([[True], keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=bool)
    starts = np.flatnonzero(new)
    return starts, np.repeat(starts, np.diff(np.append(starts, len(keys))))


def distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    keep = np.ones(len(a), dtype=bool)
    keep[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[keep], b[keep]


def by_shard(keys: np.ndarray, bits: int) -> np.ndarray:
    """The order of keys by shard alone (narrow numbers are sorted by counting); within a shard they stay as given."""
    return np.argsort((keys >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint64), kind="stable")


def shard_slices(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Slices of a key array in the order of its shards (the top bits of the key)."""
    shards = (keys >> np.uint64(64 - bits)).astype(np.int64)
    starts, _ = sorted_runs(shards)
    for a, b in zip(starts.tolist(), [*starts.tolist()[1:], len(keys)], strict=True):
        yield int(shards[a]), slice(a, b)


def node_of(digest: str) -> Column:
    """The node of a set, by the column of its digest's low half."""
    return F.col(digest).bitwiseAND(F.lit((1 << NODE_BITS) - 1))


def packed(values: np.ndarray) -> bytes:
    """The low 48 bits of 64-bit values, in six bytes each."""
    return np.ascontiguousarray(values).astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), dtype=np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def key_in(shard: int, keys: np.ndarray) -> np.ndarray:
    """Packed keys of a shard, with their shard instead of the bits they have lost."""
    return keys + np.uint64((shard << 48) & 0xFFFFFFFFFFFFFFFF)


def runs_of(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """Group sorted Arrow batches by the given columns: one (key, pieces) for each run of equal keys."""
    at, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        change[0] = True
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(change).tolist()
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            key = tuple(c[a] if c.dtype == object else c[a].item() for c in columns)
            if key != at:
                if held:
                    yield at, held
                at, held = key, []
            held.append(batch.slice(a, b - a))
    if held:
        yield at, held


def families(links: DataFrame, components: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``(node, family)`` for the nodes of candidate links ``(a, b)``."""
    return components(links).select(F.col("id").alias("node"), F.col("component").alias("family"))


def blocks(reps: DataFrame) -> DataFrame:
    """Give each set (``family, node, n``, other columns are kept) its block of its family.

    Families of one set have nothing to verify and go. A family has as many blocks as
    keep one within ``BLOCK_SETS`` sets and ``BLOCK_ELEMENTS`` elements on average.
    """
    sizes = reps.groupBy("family").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("elements"))
    wanted = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("elements") / BLOCK_ELEMENTS))
    sizes = sizes.where("sets > 1").select("family", F.least("sets", wanted).cast("int").alias("blocks"))
    sized = reps.join(materialise(sizes, "family-sizes"), "family")
    return materialise(sized.withColumn("block", F.expr("pmod(xxhash64(node), blocks)").cast("int")), "family-blocks")


def block_pairs(sets: DataFrame) -> DataFrame:
    """Send each set to every pair of blocks that has its own: once in a family of a single block."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = sets.withColumn("other", other).withColumn("low", F.least("block", "other"))
    spread = spread.withColumn("high", F.greatest("block", "other")).drop("other", "blocks")
    spread = spread.repartition(partitions(sets.sparkSession), "family", "low", "high")
    return spread.sortWithinPartitions("family", "low", "high")


def sketch_words(sizes: np.ndarray) -> np.ndarray:
    """64-bit words of the sketches of sets: two to four slots for each element, 128 at least."""
    return np.maximum(2, np.left_shift(4, np.frexp(np.maximum(sizes, 1).astype(np.float64))[1] - 1) // 64)


def sketches(values: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """The sketch of each set ``values[bounds[i]:bounds[i + 1]]`` of distinct elements."""
    sizes = np.diff(bounds)
    words = sketch_words(sizes)
    ends = np.cumsum(words)
    slot = mix(values + PARITY) & np.repeat(64 * words - 1, sizes).astype(np.uint64)
    slot = slot.astype(np.int64) + np.repeat(64 * (ends - words), sizes)
    odd = np.bincount(slot, minlength=64 * int(words.sum())).astype(np.uint8) & 1
    raw = np.packbits(odd, bitorder="little").tobytes()
    return [raw[8 * a : 8 * b] for a, b in zip((ends - words).tolist(), ends.tolist(), strict=True)]


def _folded(own: list[bytes], words: int) -> np.ndarray:
    """Sketches of at least so many words as rows of so many, each at their places."""
    out = np.empty((len(own), words), dtype=np.uint64)
    lengths = np.array([len(x) // 8 for x in own], dtype=np.int64)
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        part = np.frombuffer(b"".join([own[k] for k in rows.tolist()]), "<u8").reshape(len(rows), length)
        while part.shape[1] > words:
            half = part.shape[1] // 2
            part = part[:, :half] ^ part[:, half:]
        out[rows] = part
    return out


def may_be_similar(n_a, sketch_a: np.ndarray, n_b, sketch_b: np.ndarray, threshold: Fraction) -> np.ndarray:
    """Whether sizes and sketches (rows of as many words) let sets be similar; sides are alike in shape or broadcast."""
    p, q = threshold.numerator, threshold.denominator
    apart = np.bitwise_count(sketch_a ^ sketch_b).sum(axis=-1, dtype=np.int64)
    return (q * n_a >= p * n_b) & (q * n_b >= p * n_a) & (apart * (p + q) <= (n_a + n_b) * (q - p))


def likely_pairs(pairs: DataFrame, threshold: Fraction) -> DataFrame:
    """The ``a, b`` of rows ``a, n_a, sketch_a, b, n_b, sketch_b`` that may be similar; a null sketch lets a pair through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (batch.column(c).to_pylist() for c in ("sketch_a", "sketch_b"))
            n_a, n_b = (batch.column(c).to_numpy().astype(np.int64) for c in ("n_a", "n_b"))
            words = np.array([0 if x is None or y is None else min(len(x), len(y)) // 8 for x, y in zip(one, other, strict=True)], dtype=np.int64)
            keep = words == 0
            for k in np.unique(words[~keep]).tolist():
                rows = np.flatnonzero(words == k)
                sides = [_folded([x[i] for i in rows.tolist()], k) for x in (one, other)]
                keep[rows] = may_be_similar(n_a[rows], sides[0], n_b[rows], sides[1], threshold)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return pairs.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def key_groups(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of the nodes of each key with up to ``FEW``; key and node of the others."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    key, node = key[fresh], node[fresh]
    starts, _ = sorted_runs(key)
    count = np.diff(np.append(starts, len(key)))
    count = np.repeat(count, count)
    many = count > FEW
    few_key, few_node = key[(count > 1) & ~many], node[(count > 1) & ~many]
    found = [(node[:0], node[:0])]
    for step in range(1, min(FEW, len(few_key))):
        same = few_key[step:] == few_key[:-step]
        found.append((few_node[:-step][same], few_node[step:][same]))
    return *distinct_pairs(*(np.concatenate(x) for x in zip(*found, strict=True))), key[many], node[many]


def _lowest(rows: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of so many rows the lowest that links ``(a, b)`` lead to."""
    low = np.arange(rows)
    while len(a):
        least = np.minimum(low[a], low[b])
        after = low.copy()
        np.minimum.at(after, a, least)
        np.minimum.at(after, b, least)
        np.minimum.at(after, low[a], least)
        np.minimum.at(after, low[b], least)
        after = after[after]
        if (after == low).all():
            break
        low = after
    return low


def _links_of_small(group: np.ndarray, n: np.ndarray, sketch: np.ndarray, threshold: Fraction) -> np.ndarray:
    """For each row of many groups the lowest row of its own that likely pairs lead to."""
    found, rows = [(n[:0], n[:0])], np.arange(len(group))
    for step in range(1, _SMALL_GROUP):
        a = rows[:-step][group[:-step] == group[step:]] if step < len(rows) else rows[:0]
        if not len(a):
            break
        a = a[may_be_similar(n[a], sketch[a], n[a + step], sketch[a + step], threshold)]
        found.append((a, a + step))
    return _lowest(len(group), *(np.concatenate(x) for x in zip(*found, strict=True)))


def _links_of_large(n: np.ndarray, sketch: np.ndarray, threshold: Fraction) -> np.ndarray:
    """The same for a single group. Each row is compared with those that nothing has reached yet."""
    p, q = threshold.numerator, threshold.denominator
    low, rest = np.arange(len(n)), np.argsort(n, kind="stable")
    sizes, own = n[rest], sketch[rest]
    while len(rest):
        first, reached = rest[0], [(n[rest[0]], own[0])]
        rest, sizes, own = rest[1:], sizes[1:], own[1:]
        while reached and len(rest):
            size, mark = reached.pop()
            a, b = np.searchsorted(sizes, [-(-size * p // q), size * q // p + 1])
            found = a + np.flatnonzero(may_be_similar(size, mark, sizes[a:b], own[a:b], threshold))
            if len(found):
                low[rest[found]] = first
                reached += zip(sizes[found], own[found], strict=True)
                keep = np.ones(len(rest), bool)
                keep[found] = False
                rest, sizes, own = rest[keep], sizes[keep], own[keep]
    return low


def group_links(members: DataFrame, threshold: Fraction, sketch_of: Callable[[pa.RecordBatch], list[bytes]]) -> DataFrame:
    """Links ``a, b`` between the nodes of each group (``group, node, n`` and what ``sketch_of`` reads).

    Nodes of a group are connected by its links if likely pairs of the group connect them.
    """

    def links(node: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
        a, b = distinct_pairs(node, node[low])
        return pa.RecordBatch.from_arrays([pa.array(a[a != b]), pa.array(b[a != b])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}

        def judged(words: int) -> pa.RecordBatch:
            node, n, own = (list(x) for x in zip(*held.pop(words), strict=True))
            group = np.repeat(np.arange(len(node)), [len(x) for x in node])
            return links(np.concatenate(node), _links_of_small(group, np.concatenate(n), np.concatenate(own), threshold))

        for _, pieces in runs_of(batches, ("group",)):
            table = pa.Table.from_batches(pieces)
            node, n = table.column("node").to_numpy(), table.column("n").to_numpy().astype(np.int64)
            raw = [x for piece in pieces for x in sketch_of(piece)]
            words = min(map(len, raw)) // 8
            own = _folded(raw, words)
            if len(node) > _SMALL_GROUP:
                yield links(node, _links_of_large(n, own, threshold))
                continue
            held.setdefault(words, []).append((node, n, own))
            sizes = np.array([len(x[0]) for x in held[words]])
            if sizes.sum() * words >= _GROUP_WORDS or (sizes * sizes).sum() >= 2 * _GROUP_PAIRS:
                yield judged(words)
        for words in list(held):
            yield judged(words)

    dealt = members.repartition(partitions(members.sparkSession), "group").sortWithinPartitions("group")
    return dealt.mapInArrow(run, "a long, b long")


def similar_pairs(sets: list[np.ndarray], block: np.ndarray, low: int, high: int, num: int, den: int):
    """Positions ``(i, j)``, i < j, of sets with ``den * |intersection| >= num * |union|``.

    In a pair of two blocks only pairs across them are of interest, in a single block all.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    if len(sets) < 2:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    used = counts[inverse] > 1
    column = (np.cumsum(counts > 1) - 1)[inverse[used]]
    row, width = row[used], int((counts > 1).sum())
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    step = max(1, 8_000_000 // len(sets))
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for at in range(0, width, step):
        a, b = np.searchsorted(column, [at, at + step])
        part = np.zeros((len(sets), min(step, width - at)), dtype=np.float32)
        part[row[a:b], column[a:b] - at] = 1
        common += part @ part.T
    inter = np.rint(common).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - inter
    linked = np.triu((den * inter >= num * union) & (union > 0), 1)
    if low != high:
        linked &= block[:, None] != block[None, :]
    return np.nonzero(linked)
