"""Operator 4: near-duplicate lines by an exact set-similarity join.

Lines are sets of tokens (``width``-word shingles, 5 words by default; ``width=1`` makes
them plain words). Tokens are ordered by rarity over the whole corpus, so that

- *prefix filter*: two lines with Jaccard similarity of at least t share one of the first
  ``n - ceil(t * n) + 1`` tokens of each;
- *length filter*: a partner has between ``t * n`` and ``n / t`` tokens;
- *positional filter*: a shared token at position i leaves ``n - i`` tokens of the line,
  which bounds the size of the partners it can still reach.

Rarity is a count for each of a fixed number of hash slots: a table of bounded size that
all tasks get. A slot of several tokens changes their order alone, never a result: any
order that all lines follow is exact.

A single word is a weak key, so at ``width=1`` keys are pairs of words. Two similar sets share
at least b + 1 of the first ``n - ceil(t * n) + b + 1`` tokens of each; with the tokens dealt
into b buckets by a hash, two of these fall into one bucket. So the pairs within buckets are
enough, about twice as many as the plain prefix has tokens. The second token of the pair, at
position j, has at most b - 1 other shared tokens before it, which leaves ``n - j + b`` tokens.
The number b goes with the size of the smaller set, by bands that end at twice their start.

Where few lines share a key, each pair of them is a candidate, and those whose parity
signatures differ in more bits than similar sets may differ in tokens are dropped. Otherwise,
lines with a common key are put into groups along their sizes as far as the filters allow, and
signatures (sketches of more bits for long lines) tell which lines of a group are linked.
Linked lines are candidate families. Large families are cut into blocks by size, and blocks
that may hold similar sets are verified: first by signatures, then by the sets themselves.
A line is removed if a line before it, by ``(doc_id, line number)``, is similar enough,
whether that one stays or not.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
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
from refillscope.llm.shingles import digests, distinct_sets, line_hashes, mix, rank_in_group, shingles, word_hashes

DEFAULT_WIDTH = 5
DEFAULT_THRESHOLD = Fraction(4, 5)
# Lines of fewer words are left alone.
DEFAULT_MIN_WORDS = 5
# log2 of the number of slots of the rarity table, which holds 8 bytes each.
RARITY_BITS = 17
# Buckets of a size band, as a multiple of the tokens in which sets at the band's start may differ.
_BUCKETS = 1.4
# From this threshold on, sets that are similar but not equal share two tokens.
PAIR_THRESHOLD = Fraction(3, 4)

# Groups of up to so many sets are verified together, up to so many elements at a time.
_SMALL, _ELEMENTS = 64, 400_000
# Rows of a larger group whose signatures are compared with all others at a time.
_BAND = 256
# Products of the membership matrix that take as long as sorting one element (estimated; both ways are exact).
_SORTING = 1000

# Up to so many lines of a key, all pairs are candidates.
FEW = sj.FEW
# Lines of so many tokens or more have a sketch besides the parity signature.
_LONG = 64

_BLOCKS = "kind int, shard int, nodes binary, keys binary, sizes binary, places binary, sketches binary"
_ROWS = "kind int, hi long, lo long, doc_id long, sig_a long, sig_b long, line int, n int, first boolean, other long, sketch binary"
_LINES, _GROUPS, _POSTINGS, _PAIRS = 0, 1, 2, 3
# Documents that are hashed together.
_STEP = 500
# Fixed value: tells the first token of a pair from the second.
_PAIR = np.uint64(0x9E3779B97F4A7C15)
_BUCKET = np.uint64(0xD6E8FEB86659FD93)
# Spreads the lines of a document (the product of a line number fits a BIGINT); more than any line number.
_LINE_STEP, _PLACES = 2654435761, 1 << 32


class _Lines:
    """The lines of a batch with at least ``min_words`` words, and their token sets."""

    def __init__(self, batch: pa.RecordBatch, width: int, min_words: int):
        hashes, counts, document, number = line_hashes(batch.column("text").to_pylist())
        enough = counts >= min_words
        hashes = hashes[np.repeat(enough, counts)]
        counts = counts[enough]
        self.document = document[enough]
        self.number = number[enough].astype(np.int32)
        self.count = len(counts)
        self.tokens, self.owner = shingles(hashes, counts, width)

    def sets(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return distinct_sets(self.tokens, self.owner, self.count)


# Neighbouring slots of the rarity table whose counts travel together.
_SLOT_BLOCK = 1 << 10


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - RARITY_BITS)).astype(np.int64)


def token_rarity(texts: DataFrame, width: int, min_words: int) -> Broadcast:
    """Place of each of the ``2**RARITY_BITS`` hash slots when they are ordered by how often their tokens occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << RARITY_BITS, dtype=np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, _STEP):
                batch = whole.slice(at, _STEP)
                if width == 1 and min_words <= 1:  # every word counts, whatever its line
                    tokens = mix(word_hashes(batch.column("text").to_pylist())[0])
                else:
                    tokens = _Lines(batch, width, min_words).tokens
                total += np.bincount(_slots(tokens), minlength=len(total))
        blocks = total.reshape(-1, _SLOT_BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        counts = pa.array([blocks[k].tobytes() for k in used.tolist()], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), counts], names=["block", "counts"])

    def summed(own: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in own.column("counts").to_pylist())
        return pa.table({"block": own.column("block")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    kind = "block int, counts binary"
    # As many rows as blocks reach the driver, and each task sends as many at most.
    counts = texts.mapInArrow(run, kind).groupBy("block").applyInArrow(summed, kind).toArrow()
    rarity = np.zeros(1 << RARITY_BITS, dtype=np.int64).reshape(-1, _SLOT_BLOCK)
    for block, raw in zip(counts.column("block").to_pylist(), counts.column("counts").to_pylist(), strict=True):
        rarity[block] = np.frombuffer(raw, np.int64)
    rarity = rarity.ravel()
    place = np.empty(len(rarity), dtype=np.int64)
    place[np.argsort(rarity, kind="stable")] = np.arange(len(rarity))
    return texts.sparkSession.sparkContext.broadcast(place)


def _bands(sizes: np.ndarray, threshold: Fraction) -> Iterator[tuple[int, np.ndarray]]:
    """Size bands, each ending at twice its start, and the owners that look for partners there.

    A pair meets in the band of its smaller set, so a set takes part in its own band and in
    that of the smallest partner it may have.
    """
    least = (sizes * threshold.numerator + threshold.denominator - 1) // threshold.denominator
    band, lower = (np.frexp(np.maximum(x, 1).astype(np.float64))[1] - 1 for x in (sizes, least))
    for k in range(1, int(band.max(initial=0)) + 1):
        yield k, (band == k) | (lower == k)


def bucket_count(band: int, threshold: Fraction) -> int:
    """Buckets of a band: about as many as its prefixes are long, but fewer than the tokens that similar sets share."""
    start = 1 << band
    shared = -(-start * threshold.numerator // threshold.denominator)
    return max(1, min(shared - 1, round(_BUCKETS * start * (1 - threshold))))


def _stable_order(keys: np.ndarray) -> np.ndarray:
    """Stable order of whole numbers from 0 on: places ride in the low bits of what is sorted by value, if both fit."""
    bits = len(keys).bit_length()
    if int(keys.max(initial=0)).bit_length() + bits > 63:
        return np.argsort(keys, kind="stable")
    return np.sort((keys << bits) | np.arange(len(keys))) & ((1 << bits) - 1)


def prefixes(
    values: np.ndarray, owner: np.ndarray, sizes: np.ndarray, rarity: np.ndarray, threshold: Fraction, pairs: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the prefixes of sets, rarest first: key, owner and position.

    The values of each owner ascend, as do the owners; ``rarity`` has the place of each hash
    slot. With ``pairs`` the keys are pairs of tokens of one bucket. The position of a key is
    that of its (second) token, less the tokens that may be shared before it.
    Sets that are similar only to equal ones have no keys.
    """
    order = _stable_order((owner << RARITY_BITS) + rarity[_slots(values)])
    values, place = values[order], rank_in_group(owner)
    p, q = threshold.numerator, threshold.denominator
    least = (sizes * p + q - 1) // q
    same = (2 * sizes * p + p + q - 1) // (p + q)
    alone = (sizes * q // p == sizes) & (least == sizes) & (same == sizes)
    if not pairs or threshold < PAIR_THRESHOLD:
        keep = (place < (sizes - least + 1)[owner]) & ~alone[owner]
        return values[keep], owner[keep], place[keep]
    found = [(values[:0], owner[:0], place[:0])]
    present = np.bincount(owner, minlength=len(sizes))
    begins = np.cumsum(present) - present
    for band, inside in _bands(sizes, threshold):
        buckets = bucket_count(band, threshold)
        who = np.flatnonzero(inside & ~alone)
        long = np.minimum(present, sizes - least + buckets + 1)[who]
        rows = np.repeat(begins[who] - (np.cumsum(long) - long), long) + np.arange(long.sum())
        # Tokens of one owner and bucket side by side, still rarest first.
        group = owner[rows] * buckets + (mix(values[rows] + _BUCKET) % np.uint64(buckets)).astype(np.int64)
        by_group = _stable_order(group)
        rows, group = rows[by_group], group[by_group]
        count = rank_in_group(group)
        second = np.repeat(np.arange(len(rows)), count)
        first = np.arange(len(second)) - np.repeat(np.cumsum(count) - count, count) + second - count[second]
        key = mix(values[rows[first]] * _PAIR + values[rows[second]] + np.uint64(band))
        found.append((key, owner[rows[second]], np.maximum(place[rows[second]] - buckets, 0)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def parity_signatures(values: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """128 bits for each set, in two columns: the parity of its tokens in each of 128 hash slots.

    Two sets differ in at least as many tokens as their signatures do in bits. Sketches fold to them.
    """
    out = np.zeros((owners, 2), dtype=np.uint64)
    if len(values):
        slot = mix(values + sj.PARITY) & np.uint64(127)
        bit = np.uint64(1) << (slot & np.uint64(63))
        starts, _ = sj.sorted_runs(owner)
        for half in range(2):
            own = np.where(slot >> np.uint64(6) == half, bit, np.uint64(0))
            out[owner[starts], half] = np.bitwise_xor.reduceat(own, starts)
    return out.view(np.int64)


def few_pairs(
    key: np.ndarray, node: np.ndarray, size: np.ndarray, place: np.ndarray, threshold: Fraction
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs that the filters let through of keys with up to ``FEW`` rows, and which rows are left to ``chain_links``."""
    p, q = threshold.numerator, threshold.denominator
    reach = np.minimum((size - place) * (p + q) // p - size, size * q // p)
    # Most keys are those of a single row, which has no partner: one sort by the key alone leaves them out.
    order = np.argsort(key)
    alike = key[order[1:]] == key[order[:-1]]
    order = order[np.append(alike, False) | np.insert(alike, 0, False)] if len(order) else order
    order = order[np.lexsort((node[order], size[order], key[order]))]
    fresh = np.ones(len(order), bool)  # several tasks may have sent a line that is copied
    fresh[1:] = (key[order[1:]] != key[order[:-1]]) | (node[order[1:]] != node[order[:-1]])
    order = order[fresh]
    starts, own = sj.sorted_runs(key[order])
    count = np.diff(np.append(starts, len(order)))[np.searchsorted(starts, own)] if len(order) else own
    left = np.zeros(len(key), bool)
    left[order[count > FEW]] = True
    order = order[(count > 1) & (count <= FEW)]
    key, node, size, reach = key[order], node[order], size[order], reach[order]
    found = [(node[:0], node[:0])]
    for step in range(1, FEW):
        if len(key) <= step:
            break
        a, b = slice(None, -step), slice(step, None)
        pair = (key[a] == key[b]) & (node[a] != node[b]) & (size[b] <= reach[a]) & (size[a] <= reach[b])
        found.append((np.minimum(node[a], node[b])[pair], np.maximum(node[a], node[b])[pair]))
    return *sj.distinct_pairs(*(np.concatenate(x) for x in zip(*found, strict=True))), left


def _chains(
    key: np.ndarray, node: np.ndarray, size: np.ndarray, place: np.ndarray, threshold: Fraction
) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by key and size, and for each row but the first whether it goes on with the one before it.

    With ``place`` tokens of a set of n before the shared one, the overlap is at most
    ``n - place``; it has to be ``t / (1 + t)`` of the sizes' sum, so a partner has at most
    ``(n - place) * (1 + t) / t - n`` tokens, and ``n / t`` at most. Along ascending sizes a
    node goes on unless its size is beyond the reach of all before it.
    """
    p, q = threshold.numerator, threshold.denominator
    reach = np.minimum((size - place) * (p + q) // p - size, size * q // p)
    order = np.lexsort((node, size, key))
    key, size, reach = key[order], size[order], reach[order]
    if len(key) < 2:
        return order, np.zeros(0, bool)
    # The largest reach so far within a key: keys are raised above each other, so that one running maximum serves all.
    group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
    base = group * (np.int64(max(size.max(), reach.max())) + 1)
    furthest = np.maximum.accumulate(base + reach.clip(0)) - base
    return order, (key[1:] == key[:-1]) & (size[1:] <= furthest[:-1])


def chain_links(
    key: np.ndarray, node: np.ndarray, size: np.ndarray, place: np.ndarray, threshold: Fraction
) -> tuple[np.ndarray, np.ndarray]:
    """Links between the nodes of each key such that all pairs the filters let through are connected."""
    order, goes_on = _chains(key, node, size, place, threshold)
    one, other = node[order[1:]][goes_on], node[order[:-1]][goes_on]
    return sj.distinct_pairs(one[one != other], other[one != other])


def chain_groups(
    key: np.ndarray, node: np.ndarray, size: np.ndarray, place: np.ndarray, threshold: Fraction
) -> tuple[np.ndarray, np.ndarray]:
    """Group and node of the chains of two nodes or more: all pairs that the filters let through are in one group."""
    order, goes_on = _chains(key, node, size, place, threshold)
    key, node = key[order], node[order]
    begins = np.concatenate([np.ones(min(1, len(key)), bool), ~goes_on])
    chain = np.cumsum(begins) - 1
    starts = np.flatnonzero(begins)
    # Chains of a key are told apart by their number in it.
    group = mix(key[starts] * _PAIR + rank_in_group(key[starts]).astype(np.uint64))
    fresh = np.ones(len(key), bool)
    fresh[1:] = (chain[1:] != chain[:-1]) | (node[1:] != node[:-1])
    kept = fresh & (np.bincount(chain[fresh], minlength=len(starts)) > 1)[chain]
    return group[chain[kept]].view(np.int64), node[kept]


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers in two bytes each if they fit, else in four."""
    return values.astype("<u2" if values.max(initial=0) < 1 << 16 else "<u4").tobytes()


def _wide(raw: bytes, count: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * count else "<u4").astype(np.int64)


def _record(rows: list[tuple]) -> pa.RecordBatch:
    names = ("kind", "shard", "nodes", "keys", "sizes", "places", "sketches")
    types = (pa.int32(), pa.int32(), *[pa.binary()] * 5)
    columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
    return pa.RecordBatch.from_arrays(columns, names=list(names))


def _map(width: int, min_words: int, threshold: Fraction, bits: int, rarity: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_unused()
        postings, seen, turn, gathered = [], set(), 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            if postings:
                key, node, size, place = (np.concatenate(x) for x in zip(*postings, strict=True))
                order = sj.by_shard(key, bits)
                key, node, size, place = key[order], node[order], size[order], place[order]
                yield _record(
                    [
                        (_POSTINGS, shard, sj.packed(node[r]), sj.packed(key[r]), _narrow(size[r]), _narrow(place[r]), None)
                        for shard, r in sj.shard_slices(key, bits)
                    ]
                )
            postings.clear()
            seen.clear()

        for whole in batches:
            for at in range(0, whole.num_rows, _STEP):
                batch = whole.slice(at, _STEP).filter(whole.slice(at, _STEP).column("doc_id").is_valid())
                lines = _Lines(batch, width, min_words)
                if not lines.count:
                    continue
                values, owner, bounds = lines.sets()
                sizes = np.diff(bounds)
                raw, pairs = digests(values, bounds)
                doc_id = batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)[lines.document]
                fresh, first = np.zeros(lines.count, bool), np.ones(lines.count, bool)
                # A line is the first of its kind in its document unless it follows an equal one there.
                order = np.lexsort((pairs[:, 0], pairs[:, 1], lines.document))
                kind = np.column_stack([pairs, lines.document])[order]
                first[order[1:]] = (kind[1:] != kind[:-1]).any(axis=1)
                for i in np.flatnonzero(first).tolist():
                    if raw[i] not in seen:  # of equal lines in this task, one stands for all
                        seen.add(raw[i])
                        fresh[i] = True
                turn += 1
                home = hash((int(doc_id[0]), turn)) % (1 << bits)
                head = np.column_stack([pairs, doc_id, parity_signatures(values, owner, lines.count)])
                long = sizes >= _LONG
                cut = np.concatenate([[0], np.cumsum(sizes[long])])
                marks = b"".join(sj.sketches(values[long[owner]], cut))
                yield _record([(_LINES, home, head.tobytes(), lines.number.tobytes(), sizes.astype(np.int32).tobytes(), first.tobytes(), marks)])
                chosen = fresh[owner]
                token, who, place = prefixes(values[chosen], owner[chosen], sizes, rarity.value, threshold, width == 1)
                if len(token):
                    postings.append((token, pairs[who, 1], sizes[who].astype(np.int32), place.astype(np.int32)))
                gathered += len(token)
                if gathered >= sj.FLUSH_POSTINGS:
                    yield from flush()
                    gathered = 0
        yield from flush()

    return run


def _reduce(threshold: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "hi", "lo", "doc_id", "sig_a", "sig_b", "line", "n", "first", "other", "sketch"]

        def linked(a: np.ndarray, b: np.ndarray, kind: int) -> pa.RecordBatch:
            long, number, yes, raw = (pa.nulls(len(a), t) for t in (pa.int64(), pa.int32(), pa.bool_(), pa.binary()))
            columns = [pa.array(np.full(len(a), kind, dtype=np.int32)), long, pa.array(a), long, long, long, number, number, yes, pa.array(b), raw]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for (shard,), pieces in sj.runs_of(batches, ("shard",)):
            postings = []
            for piece in pieces:
                for kind, *raw in zip(*(c.to_pylist() for c in piece.columns), strict=True):
                    _, nodes, keys, sizes, places, marks = raw
                    if kind == _POSTINGS:
                        count = len(nodes) // 6
                        postings.append((sj.unpacked(keys), sj.unpacked(nodes).view(np.int64), _wide(sizes, count), _wide(places, count)))
                        continue
                    head = np.frombuffer(nodes, dtype=np.int64).reshape(-1, 5)
                    columns = [pa.array(np.full(len(head), _LINES, dtype=np.int32))]
                    columns += [pa.array(np.ascontiguousarray(head[:, k])) for k in range(5)]
                    columns += [pa.array(np.frombuffer(x, dtype=np.int32)) for x in (keys, sizes)]
                    columns += [pa.array(np.frombuffer(places, dtype=bool)), pa.nulls(len(head), pa.int64())]
                    n = np.frombuffer(sizes, dtype=np.int32)
                    ends = 8 * np.cumsum(np.where(n >= _LONG, sj.sketch_words(n), 0))
                    sketches = [marks[a:b] or None for a, b in zip([0, *ends.tolist()[:-1]], ends.tolist(), strict=True)]
                    columns.append(pa.array(sketches, pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=names)
            if postings:
                own = [np.concatenate(x) for x in zip(*postings, strict=True)]
                a, b, left = few_pairs(*own, threshold)
                yield linked(a, b, _PAIRS)
                own[0] = sj.key_in(shard, own[0])
                group, node = chain_groups(*(x[left] for x in own), threshold)
                yield linked(node, group, _GROUPS)

    return run


def _line_key(doc_id, line):
    """A number for a line of a document, alike for columns and arrays (in 64 bits each); others may have it too."""
    return doc_id ^ (line * _LINE_STEP) if isinstance(line, np.ndarray) else doc_id.bitwiseXOR(line * F.lit(_LINE_STEP))


def _member_sets(wanted_places: Broadcast, wanted_lines: Broadcast, width: int, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _STEP):
                batch = whole.slice(at, _STEP).filter(whole.slice(at, _STEP).column("doc_id").is_valid())
                # Only lines at wanted places are hashed and made sets.
                split = [text.split("\n") if text else [] for text in batch.column("text").to_pylist()]
                counts = np.array([len(x) for x in split], dtype=np.int64)
                ids = np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64), counts)
                number = np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts)
                places = np.flatnonzero(in_bitmap(wanted_places.value, _line_key(ids, number)))
                texts = list(chain.from_iterable(split))
                texts = pa.array([texts[i] for i in places.tolist()], pa.large_string())
                lines = _Lines(pa.RecordBatch.from_arrays([texts], names=["text"]), width, min_words)
                if not lines.count:
                    continue
                values, _, bounds = lines.sets()
                _, pairs = digests(values, bounds)
                likely = np.flatnonzero(in_bitmap(wanted_lines.value, np.ascontiguousarray(pairs[:, 1])))
                found = places[lines.document[likely]]
                columns = [pa.array(ids[found]), pa.array(number[found].astype(np.int32))]
                columns += [pa.array(pairs[likely, k]) for k in (0, 1)]
                columns.append(pa.array([values[bounds[k] : bounds[k + 1]].tobytes() for k in likely.tolist()], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "line", "hi", "lo", "elements"])

    return run


def line_kinds(lines: DataFrame) -> DataFrame:
    """Each distinct line, its first ``place`` by ``(doc_id, line)``, and its number of copies.

    Copies of a line meet in the map tasks already, so a common line is no hot key of the joins that follow. A place
    is one decimal number: the least is found in a hash table, that of a struct by sorting all lines.
    """
    place = F.col("doc_id").cast("decimal(19,0)") * F.lit(_PLACES).cast("decimal(10,0)") + F.col("line").cast("decimal(10,0)")
    own = [c for c in ("hi", "lo", "n", "sig_a", "sig_b", "sketch") if c in lines.columns]
    return lines.groupBy(*own).agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("copies"))


def _of_place() -> tuple[Column, Column]:
    """Document and line of a ``place``."""
    line = f"pmod(place, {_PLACES})"
    return F.expr(f"(place - {line}) div {_PLACES}"), F.expr(line).cast("int")


def size_blocks(reps: DataFrame, threshold: Fraction) -> DataFrame:
    """Give each set (``family, node, n``, other columns are kept) its block of its family and the blocks that it meets.

    Families of one set have nothing to verify and go. A family that fits a block is one. A larger one is cut by
    size into classes, so wide that similar sets are in the same or in neighbouring ones, and each class by a hash
    into blocks. A set meets the blocks ``[first, last)``, its own among them.
    """
    sets, elements = F.count(F.lit(1)), F.sum("n")
    fits = (sets <= sj.BLOCK_SETS) & (elements <= sj.BLOCK_ELEMENTS)
    sizes = reps.groupBy("family").agg(sets.alias("sets"), fits.alias("fits")).where("sets > 1").drop("sets")
    # A trifle wider than the threshold asks for, against rounding.
    width = max(-math.log(threshold), 1e-6) * (1 + 1e-6)
    size_class = F.when(F.col("fits"), 0).otherwise(F.floor(F.log("n") / width))
    sized = reps.join(materialise(sizes, "family-sizes"), "family").withColumn("class", size_class.cast("long")).drop("fits")
    parts = F.least(sets, F.greatest(F.ceil(sets / sj.BLOCK_SETS), F.ceil(elements / sj.BLOCK_ELEMENTS))).cast("int")
    along = Window.partitionBy("family").orderBy("class")  # one row for each size class

    def beside(column: str, step: int) -> Column:
        near = F.lag("class", step).over(along) == F.col("class") - step
        return F.when(near, F.lag(column, step).over(along)).otherwise(F.col(column)).cast("int")

    classes = sized.groupBy("family", "class").agg(parts.alias("parts")).withColumn("end", F.sum("parts").over(along))
    classes = classes.withColumn("start", F.col("end") - F.col("parts"))
    classes = classes.select("family", "class", "start", "parts", beside("start", 1).alias("first"), beside("end", -1).alias("last"))
    dealt = sized.join(materialise(classes, "family-classes"), ["family", "class"])
    block = (F.col("start") + F.expr("pmod(xxhash64(node), parts)")).cast("int")
    return materialise(dealt.withColumn("block", block).drop("class", "start", "parts"), "family-blocks")


def block_pairs(sets: DataFrame) -> DataFrame:
    """Send each set to every pair of blocks in which its own meets another or itself."""
    spread = sets.withColumn("other", F.explode(F.expr("sequence(first, last - 1)")))
    spread = spread.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    spread = spread.drop("other", "first", "last").repartition(partitions(sets.sparkSession), "family", "low", "high")
    return spread.sortWithinPartitions("family", "low", "high")


class _Sets:
    """Verified rows: token sets with the group that each is compared in, distinct within it."""

    def __init__(self, groups: list[tuple[bool, list[pa.RecordBatch]]], threshold: Fraction):
        table = pa.Table.from_batches([piece for _, pieces in groups for piece in pieces])
        rows = [sum(piece.num_rows for piece in pieces) for _, pieces in groups]
        group = np.repeat(np.arange(len(groups)), rows)
        hi, lo = (table.column(c).to_numpy() for c in ("hi", "lo"))
        # Rows that repeat a document and line bring the same set again.
        order = np.lexsort((lo, hi, group))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (np.diff(group[order]) != 0) | (np.diff(hi[order]) != 0) | (np.diff(lo[order]) != 0)
        keep = np.sort(order[fresh])
        self.table = table.take(pa.array(keep))
        self.group = group[keep]
        self.across = np.repeat(np.array([across for across, _ in groups]), rows)[keep]
        self.block = self.table.column("block").to_numpy()
        raw = self.table.column("elements").combine_chunks().cast(pa.large_binary())
        bounds = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
        self.values = np.frombuffer(raw.buffers()[2], np.uint64, (bounds[-1] - bounds[0]) // 8, bounds[0])
        self.bounds = (bounds - bounds[0]) // 8
        self.sizes = np.diff(self.bounds)
        self.signature = parity_signatures(self.values, np.repeat(np.arange(len(keep)), self.sizes), len(keep)).view(np.uint64)
        self.p, self.q = threshold.numerator, threshold.denominator

    def _may(self, a, b) -> np.ndarray:
        """Whether sizes and signatures let two sets be similar; ``a`` and ``b`` index rows alike in shape or broadcast."""
        one, other, p, q = self.sizes[a], self.sizes[b], self.p, self.q
        apart = sum(np.bitwise_count(self.signature[a, k] ^ self.signature[b, k]).astype(np.int64) for k in range(2))
        allowed = (q * one >= p * other) & (q * other >= p * one) & (apart * (p + q) <= (one + other) * (q - p))
        return allowed & (~self.across[a] | (self.block[a] != self.block[b]))

    def candidates_within_groups(self) -> tuple[np.ndarray, np.ndarray]:
        """Candidate pairs of groups of few rows each."""
        found, rows = [], np.arange(len(self.group))
        for step in range(1, _SMALL):
            a = rows[:-step][self.group[:-step] == self.group[step:]] if step < len(rows) else rows[:0]
            if not len(a):
                break
            a = a[self._may(a, a + step)]
            found.append((a, a + step))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (rows[:0], rows[:0])

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Candidate pairs of one group, by bands of rows."""
        rows = np.arange(len(self.group))
        for at in range(0, len(rows), _BAND):
            a, b = np.nonzero(np.triu(self._may(rows[at : at + _BAND, None], rows[None, at:]), 1))
            yield a + at, b + at

    def similar(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs among the given ones that are similar, by the tokens of both side by side."""
        both = self.sizes[a] + self.sizes[b]
        kept, ends, at = np.zeros(len(a), bool), np.cumsum(both), 0
        while at < len(a):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _ELEMENTS, side="right")))
            sides = np.column_stack([a[at:to], b[at:to]]).ravel()
            sizes = self.sizes[sides]
            token = self.token[np.repeat(self.bounds[:-1][sides] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
            key = np.sort(np.repeat(np.arange(to - at), both[at:to]) * self.tokens + token)
            shared = np.bincount(key[1:][key[1:] == key[:-1]] // self.tokens, minlength=to - at)
            kept[at:to] = self.q * shared >= self.p * (both[at:to] - shared)
            at = to
        return a[kept], b[kept]

    def pairs(self, low: int, high: int, small: bool) -> tuple[np.ndarray, np.ndarray]:
        """All similar pairs within groups; ``low`` and ``high`` are the blocks of a single group."""
        found, self.token, counts = np.unique(self.values, return_inverse=True, return_counts=True)
        self.tokens = np.int64(max(1, len(found)))
        if small:
            return self.similar(*self.candidates_within_groups())
        bands = list(self.candidates())
        work = sum(int(self.sizes[x].sum()) for band in bands for x in band)
        if work * _SORTING > len(self.group) ** 2 * int((counts > 1).sum()):
            # Most pairs are alike: the product of the membership matrix is cheaper, and as exact.
            sets = np.split(self.values, self.bounds[1:-1])
            return sj.similar_pairs(sets, self.block, low, high, self.p, self.q)
        return tuple(np.concatenate(x) for x in zip(*(self.similar(*band) for band in bands), strict=True))

    def removed(self, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        """The later line of each pair, with the earliest line that it is similar to."""
        doc, line = (self.table.column(c).to_numpy() for c in ("doc_id", "line"))
        rank = np.lexsort((line, doc))
        place = np.empty(len(rank), dtype=np.int64)
        place[rank] = np.arange(len(rank))
        earliest = np.full(len(rank), len(rank))
        np.minimum.at(earliest, np.where(place[i] > place[j], i, j), np.minimum(place[i], place[j]))
        gone = np.flatnonzero(earliest < len(rank))
        witness = rank[earliest[gone]]
        hi, lo = (self.table.column(c).to_numpy()[gone] for c in ("hi", "lo"))
        columns = [pa.array(x) for x in (hi, lo, doc[witness], line[witness])]
        return pa.RecordBatch.from_arrays(columns, names=["hi", "lo", "before_doc", "before_line"])


def _verify(threshold: Fraction):
    """Judge the pairs of each (family, low, high); groups of few sets are judged many at a time."""

    def judged(groups: list, low: int = 0, high: int = 0, small: bool = True) -> Iterator[pa.RecordBatch]:
        sets = _Sets(groups, threshold)
        i, j = sets.pairs(low, high, small)
        if len(i):
            yield sets.removed(i, j)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, elements = [], 0
        for (_, low, high), pieces in sj.runs_of(batches, ("family", "low", "high")):
            if sum(piece.num_rows for piece in pieces) > _SMALL:
                yield from judged([(low != high, pieces)], low, high, small=False)
                continue
            held.append((low != high, pieces))
            elements += sum(piece.column("elements").nbytes for piece in pieces) // 8
            if elements >= _ELEMENTS:
                yield from judged(held)
                held, elements = [], 0
        if held:
            yield from judged(held)

    return run


def _likely(pairs: DataFrame, kinds: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs whose signatures and sketches do not tell them apart."""
    p, q = threshold.numerator, threshold.denominator
    own = kinds.select(sj.node_of("lo").alias("node"), "n", "sig_a", "sig_b", "sketch")

    def side(name: str) -> DataFrame:
        return own.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n", "sig_a", "sig_b", "sketch")])

    both = pairs.distinct().join(side("a"), "a").join(side("b"), "b")
    bits = sum(F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in ("sig_a", "sig_b"))
    return sj.likely_pairs(both.where(bits * (p + q) <= (F.col("n_a") + F.col("n_b")) * (q - p)), threshold)


def _sketches(batch: pa.RecordBatch) -> list[bytes]:
    """The sketches of lines; that of a short one is its signature."""
    short = np.column_stack([batch.column(c).to_numpy() for c in ("sig_a", "sig_b")]).tobytes()
    return [short[16 * k : 16 * k + 16] if x is None else x for k, x in enumerate(batch.column("sketch").to_pylist())]


def duplicate_lines(
    docs: DataFrame,
    width: int = DEFAULT_WIDTH,
    threshold: Fraction = DEFAULT_THRESHOLD,
    min_words: int = DEFAULT_MIN_WORDS,
) -> DataFrame:
    """The lines to remove: ``doc_id, line, before_doc`` (0-based line number; a document of an earlier match).

    Reads ``doc_id`` and ``text`` alone. Lines end at LF; words are what ASCII white space
    separates, A-Z lower-cased. Lines of fewer than ``min_words`` words, null and empty texts
    and rows with a null ``doc_id`` are left alone. Rows that share a ``doc_id`` count as the
    same document: the first occurrence of a line is kept in each of them. An empty input
    gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rarity = token_rarity(texts, width, min_words)
    posted = texts.mapInArrow(_map(width, min_words, threshold, sj.shard_bits(docs), rarity), _BLOCKS)
    dealt = posted.repartition(partitions(spark), "shard").sortWithinPartitions("shard")
    rows = materialise(dealt.mapInArrow(_reduce(threshold), _ROWS), "lines")
    lines = rows.where(F.col("kind") == _LINES).select("hi", "lo", "doc_id", "line", "n", "first", "sig_a", "sig_b", "sketch")
    kinds = materialise(line_kinds(lines), "line-kinds")
    groups = rows.where(F.col("kind") == _GROUPS).select(F.col("other").alias("group"), F.col("lo").alias("node"))
    members = groups.join(kinds.select(sj.node_of("lo").alias("node"), "n", "sig_a", "sig_b", "sketch"), "node")
    links = sj.group_links(members, threshold, _sketches)
    pairs = rows.where(F.col("kind") == _PAIRS).select(F.col("lo").alias("a"), F.col("other").alias("b"))
    likely = materialise(links.unionByName(_likely(pairs, kinds, threshold)), "line-links")
    near = materialise(sj.families(likely, connected_components), "line-families")
    drop_table(likely)
    # The first occurrence of each line that has a candidate partner.
    doc_id, line = _of_place()
    reps = kinds.withColumn("node", sj.node_of("lo")).join(near, "node")
    reps = reps.select("family", "hi", "lo", "n", doc_id.alias("doc_id"), line.alias("line"), F.col("lo").alias("node"))
    reps = materialise(reps, "line-reps")
    drop_table(near)
    blocks = size_blocks(reps, threshold)
    drop_table(reps)
    places = blocks.select(_line_key(F.col("doc_id"), F.col("line").cast("long")).alias("place"))
    read_again = _member_sets(membership_bitmap(places, "place"), membership_bitmap(blocks, "lo"), width, min_words)
    sets = texts.mapInArrow(read_again, "doc_id long, line int, hi long, lo long, elements binary")
    sets = blocks.drop("n", "node").join(sets, ["doc_id", "line", "hi", "lo"])
    pairs = block_pairs(sets)
    gone = pairs.mapInArrow(_verify(threshold), "hi long, lo long, before_doc long, before_line int")
    gone = gone.groupBy("hi", "lo").agg(F.min("before_doc").alias("near_doc"))

    judged = kinds.join(gone, ["hi", "lo"], "left").where("copies > 1 or near_doc is not null")
    judged = materialise(judged.select("hi", "lo", doc_id.alias("first_doc"), "near_doc"), "line-verdicts")
    drop_table(kinds)
    found = lines.join(judged, ["hi", "lo"]).where("near_doc is not null or doc_id <> first_doc or not first")
    return found.select("doc_id", "line", F.least("near_doc", "first_doc").alias("before_doc"))


def line_report(docs: DataFrame, **options) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_lines, n_removed, removed_lines`` (ascending line numbers).

    Null text counts as no line at all, empty text as one empty line.
    """
    gone = _by_document(duplicate_lines(docs, **options))
    ends = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("text").isNull(), 0).otherwise(1 + ends).cast("long").alias("n_lines"),
    )
    joined = base.join(gone, "doc_id", "left")
    empty = F.array().cast("array<int>")
    return joined.select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", empty).alias("removed_lines"),
    )


def _by_document(lines: DataFrame) -> DataFrame:
    """Line numbers of each document; no more than it has lines."""
    return lines.groupBy("doc_id").agg(F.sort_array(F.collect_set("line")).alias("removed"))


def remove_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``docs`` without the given ``(doc_id, line)`` lines; all rows and other columns stay as they are."""
    gone = materialise(_by_document(lines), "removed-lines").withColumnsRenamed({"doc_id": "_gone_doc", "removed": "_gone"})
    joined = docs.join(gone, docs["doc_id"] == gone["_gone_doc"], "left")
    kept = F.filter(F.split(docs["text"], "\n", -1), lambda _, k: ~F.array_contains(gone["_gone"], k))
    text = F.when(gone["_gone"].isNull(), docs["text"]).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[(text if c == "text" else docs[c]).alias(c) for c in docs.columns])
