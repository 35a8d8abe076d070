"""Operator 12: near-duplicate embeddings by an exact metric range join.

Two vectors have a cosine of at least t when their unit vectors lie within
``r = sqrt(2 - 2t)`` of each other. Pivots partition the unit vectors into cells, each
vector into that of its nearest pivot. By the triangle inequality a partner of a vector can
lie in another cell only if the vector is within r of the hyperplane between the two pivots;
then a copy of it goes there. Of two cells only one, settled by their numbers, gets the
copies of the other, so a pair meets once. The cells are then joined independently.

Within a cell the distances x to its pivot decide most pairs. Members are cut into shells
by x; two shells whose largest x add up to r at most hold linked pairs alone, which are
counted and never formed (a dense group around a pivot is such a shell); two whose x differ
by more than r hold none. All other pairs of shells are compared in blocks of bounded size,
each pair of blocks by one task. Equal vectors are one member with a weight.

The pivots are the densest of a bounded sample, none within r of another. The shells are
laid out on the driver from counts of ``BINS`` distances a cell, so from bounded data.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refillscope.llm.setjoin import runs_of
from refillscope.llm.shared import connected_components, materialise, partitions
from refillscope.llm.vectors import matrix, packed, stack, widened

DEFAULT_THRESHOLD = 0.9
# Vectors of a cell on average, the most cells, and the sample that their pivots are chosen from.
CELL_VECTORS = 4096
MAX_CELLS = 1024
SAMPLE_VECTORS = 2048
# Distances to a pivot (0 to 2) are counted in so many bins.
BINS = 512
# Vectors and components of a block.
BLOCK_VECTORS = 4096
BLOCK_COMPONENTS = 1_000_000
# Slack of every bound; pairs that it leaves open are compared.
_SLACK = 1e-6
# Rows of a product of two blocks that are made at a time.
_STEP = 512

_LINKS = "node long, lo long, links long, other long"
_DEALT = "pair long, side int, node long, lo long, weight long, vector binary"
_COUNTS = "cell int, home boolean, bin int, vectors long, weight long, node long"


def _digested(dtype: str):
    """The vectors as bytes with a digest; both null for rows that link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id")
            rows, vectors = matrix(batch.column("embedding"))
            some = (vectors != 0).any(axis=1) & np.asarray(ids.is_valid())[rows]
            blobs: list[bytes | None] = [None] * batch.num_rows
            digests = np.zeros((batch.num_rows, 2), np.int64)
            for k, blob in zip(rows[some].tolist(), packed(vectors[some].astype(dtype)).to_pylist(), strict=True):
                blobs[k] = blob
                digests[k] = np.frombuffer(xxhash.xxh3_128_digest(blob), ">i8")
            none = np.array([b is None for b in blobs], dtype=bool)
            columns = [ids, pa.array(digests[:, 0], mask=none), pa.array(digests[:, 1], mask=none), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "hi", "lo", "vector"])

    return run


def _unit(blobs: list[bytes], dtype: str) -> np.ndarray:
    """Unit vectors in doubles."""
    points = stack(blobs, dtype).astype(np.float64)
    # Scaled first, so that squares neither overflow nor vanish.
    points /= np.abs(points).max(axis=1, initial=0, keepdims=True)
    return points / np.sqrt((points * points).sum(axis=1, keepdims=True))


def choose_pivots(sample: np.ndarray, radius: float, wanted: int) -> np.ndarray:
    """Up to ``wanted`` rows of the sample, those with most others within half the radius first, none within it of another."""
    squares = 2 - 2 * sample @ sample.T
    density = (squares <= radius * radius / 4).sum(axis=1)
    chosen: list[int] = []
    for k in np.argsort(-density, kind="stable").tolist():
        if len(chosen) == wanted:
            break
        if not chosen or squares[k, chosen].min() > radius * radius:
            chosen.append(k)
    return sample[chosen]


def _owner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of two cells compares their pairs."""
    return np.where((a + b) % 2 == 0, np.minimum(a, b), np.maximum(a, b))


def _members(batch: pa.RecordBatch, pivots: np.ndarray, radius: float, dtype: str):
    """Rows of the batch that belong to cells: row, cell, whether it is the row's own, and the bin of the distance."""
    points = _unit(batch.column("vector").to_pylist(), dtype)
    width = max(points.shape[1], pivots.shape[1])
    points, centres = widened(points, width), widened(pivots, width)
    squares = (2 - 2 * points @ centres.T).clip(0)
    home = squares.argmin(axis=1)
    own = squares[np.arange(len(points)), home]
    gaps = np.sqrt((2 - 2 * centres @ centres.T).clip(0))
    cells = np.arange(len(centres))
    # The distance to the hyperplane between two pivots is the difference of squares over twice their gap.
    near = squares - own[:, None] <= 2 * gaps[home] * (radius + _SLACK)
    row, cell = np.nonzero(near & (_owner(home[:, None], cells) == cells) | (cells == home[:, None]))
    bins = np.minimum((np.sqrt(squares[row, cell]) * (BINS / 2)).astype(np.int64), BINS - 1)
    return row, cell, cell == home[row], bins


def _count(pivots, radius: float, dtype: str):
    """Vectors, weight and smallest node by cell, kind and bin, summed up over the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(pivots.value) * 2 * BINS
        vectors, weights, least = np.zeros(size, np.int64), np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
        for batch in batches:
            if batch.num_rows:
                row, cell, home, bins = _members(batch, pivots.value, radius, dtype)
                key = (cell * 2 + ~home) * BINS + bins
                vectors += np.bincount(key, minlength=size)
                np.add.at(weights, key, batch.column("weight").to_numpy()[row])
                np.minimum.at(least, key, batch.column("node").to_numpy()[row])
        used = np.flatnonzero(vectors)
        columns = [(used // (2 * BINS)).astype(np.int32), used // BINS % 2 == 0, (used % BINS).astype(np.int32), vectors[used], weights[used], least[used]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cell", "home", "bin", "vectors", "weight", "node"])

    return run


class Layout:
    """The shells of all cells and, by shell, what its members need to know.

    ``shell`` has the shell of each cell, kind (own members, copies) and bin; ``links`` the
    weight of the members that one of a shell is surely linked with, ``itself`` whether
    they are those of its own shell too, ``centre`` a node that all of them are linked with.
    Shells are cut into ``parts`` blocks from ``first`` on; ``spans`` are the two ranges of
    blocks (of own members and of copies) to compare with.
    """

    def __init__(self, counts, cells: int, radius: float, block: int):
        self.shell = np.full((cells, 2, BINS), -1, np.int64)
        vectors, weights = (np.zeros(self.shell.shape, np.int64) for _ in range(2))
        node = np.zeros(self.shell.shape, np.int64)
        places = tuple(counts[c] for c in ("cell", "kind", "bin"))
        vectors[places], weights[places], node[places] = counts["vectors"], counts["weight"], counts["node"]
        parts, links, itself, centre, spans = [], [], [], [], []
        first = [0]
        for cell in range(cells):
            low, high, heavy, kinds, base = [], [], [], [], len(parts)
            for kind in range(2):
                held = block + 1
                for b in np.flatnonzero(vectors[cell, kind]).tolist():
                    if held + vectors[cell, kind, b] > block:
                        held = 0
                        low.append(2 * b / BINS), high.append(0.0), heavy.append(0), kinds.append(kind), parts.append(0)
                    held += int(vectors[cell, kind, b])
                    high[-1], heavy[-1] = 2 * (b + 1) / BINS, heavy[-1] + int(weights[cell, kind, b])
                    parts[-1] = -(-held // block)
                    self.shell[cell, kind, b] = len(parts) - 1
            first += (first[-1] + np.cumsum(parts[base:])).tolist()
            low, high, kinds = np.array(low), np.array(high), np.array(kinds)
            paired = (kinds[:, None] == 0) | (kinds[None, :] == 0)
            sure = paired & (high[:, None] + high[None, :] <= radius - _SLACK)
            open_ = paired & ~sure & (np.maximum(low[:, None] - high[None, :], low[None, :] - high[:, None]) <= radius + _SLACK)
            links += (sure @ np.array(heavy, np.int64)).tolist()
            itself += np.diag(sure).tolist()
            # The innermost shell of own members, which holds the pivot, is linked with all that are surely linked at all.
            centre += [int(node[cell, 0][vectors[cell, 0] > 0][0]) if (kinds == 0).any() else 0] * len(kinds)
            for s in range(len(kinds)):
                found = []
                for kind in range(2):
                    others = np.flatnonzero(open_[s] & (kinds == kind))  # neighbours, as shells ascend
                    found += [first[base + others[0]], first[base + others[-1] + 1]] if len(others) else [0, 0]
                spans.append(found)
        self.parts, self.links, self.itself = np.array(parts, np.int64), np.array(links, np.int64), np.array(itself, bool)
        self.centre, self.first = np.array(centre, np.int64), np.array(first, np.int64)
        self.spans = np.array(spans, np.int64).reshape(-1, 4)


def _sure(pivots, layout, radius: float, dtype: str):
    """Links that shells decide: their weight for each member, and one edge for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = layout.value
        for batch in batches:
            if not batch.num_rows:
                continue
            row, cell, home, bins = _members(batch, pivots.value, radius, dtype)
            shell = plan.shell[cell, (~home).astype(np.int64), bins]
            node, weight = (batch.column(c).to_numpy()[row] for c in ("node", "weight"))
            links = plan.links[shell] - np.where(plan.itself[shell], weight, 0)
            some = links > 0
            columns = [node[some], batch.column("lo").to_numpy()[row][some], links[some], plan.centre[shell[some]]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "lo", "links", "other"])

    return run


def _deal(pivots, layout, radius: float, dtype: str):
    """A copy of each member for every pair of blocks that it is compared in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = layout.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                row, cell, home, bins = _members(batch, pivots.value, radius, dtype)
                shell = plan.shell[cell, (~home).astype(np.int64), bins]
                mixed = (batch.column("lo").to_numpy()[row] & 0x7FFFFFFF) % plan.parts[shell]
                mine = plan.first[shell] + mixed
                for kind in range(2):
                    start, stop = plan.spans[shell, 2 * kind], plan.spans[shell, 2 * kind + 1]
                    count = stop - start
                    if not count.any():
                        continue
                    member = np.repeat(np.arange(len(row)), count)
                    block = np.arange(len(member)) - np.repeat(np.cumsum(count) - count, count) + start[member]
                    own = mine[member]
                    pair = np.minimum(own, block) * plan.first[-1] + np.maximum(own, block)
                    base = batch.take(pa.array(row[member]))
                    columns = [pa.array(pair), pa.array((own > block).astype(np.int32))]
                    columns += [base.column(c) for c in ("node", "lo", "weight", "vector")]
                    yield pa.RecordBatch.from_arrays(columns, names=["pair", "side", "node", "lo", "weight", "vector"])

    return run


class _Roots:
    """Connected sets of 0 to size - 1."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Unite the ends of the given pairs."""
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            x, y = (self._top(z) for z in (x, y))
            self.root[max(x, y)] = min(x, y)
        while (up := self.root[self.root]).tolist() != self.root.tolist():
            self.root = up

    def _top(self, x: int) -> int:
        while self.root[x] != x:
            x = self.root[x]
        return x


def linked(left: np.ndarray, right: np.ndarray | None, left_weight, right_weight, threshold: float):
    """Weights of the linked partners on both sides, and a root for each member (right after left).

    Without a right side, the pairs within the left one.
    """
    same = right is None
    if same:
        right, right_weight = left, left_weight
    shift = 0 if same else len(left)
    counts, roots = np.zeros(shift + len(right), np.int64), _Roots(shift + len(right))
    for at in range(0, len(left), _STEP):
        mask = left[at : at + _STEP] @ right.T >= threshold
        if same:
            mask &= np.arange(len(right)) > np.arange(at, at + len(mask))[:, None]
        if not mask.any():
            continue
        counts[at : at + len(mask)] += mask @ right_weight
        counts[shift:] += left_weight[at : at + len(mask)] @ mask
        # First one partner for each column, which unites most; then what is still apart.
        column = np.flatnonzero(mask.any(axis=0))
        roots.join(mask[:, column].argmax(axis=0) + at, column + shift)
        i, j = np.nonzero(mask)
        a, b = roots.root[i + at], roots.root[j + shift]
        apart = np.unique(np.column_stack([a, b])[a != b], axis=0)
        if len(apart):
            roots.join(apart[:, 0], apart[:, 1])
    return counts, roots.root


def _compare(threshold: float, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_,), pieces in runs_of(batches, ("pair",)):
            table = pa.Table.from_batches(pieces)
            side = table.column("side").to_numpy()
            order = np.argsort(side, kind="stable")
            points = _unit(table.column("vector").to_pylist(), dtype)[order]
            node, lo, weight = (table.column(c).to_numpy()[order] for c in ("node", "lo", "weight"))
            cut = int((side == 0).sum())
            if cut in (0, len(side)):
                # A block with itself, or one whose partner is empty, which is no pair of blocks at all.
                counts, root = linked(points, None, weight, None, threshold)
            else:
                counts, root = linked(points[:cut], points[cut:], weight[:cut], weight[cut:], threshold)
            some = counts > 0
            columns = [node[some], lo[some], counts[some], node[root[some]]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "lo", "links", "other"])

    return run


def cosine_components(vectors: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """One row for each row of ``vectors``: ``vec_id, n_links, component_id, kept``.

    Reads ``vec_id`` and ``embedding`` alone. Two rows are linked when the cosine of their
    vectors, in double precision, is at least ``threshold`` (above 0). ``n_links`` counts the
    other rows that a row is linked with, ``component_id`` is the smallest ``vec_id`` that
    links lead to, itself included, ``kept`` whether that is its own. Vectors that are null,
    empty or zero or hold null or non-finite components link with nothing; those of unlike
    length count as if zeros followed the shorter. Rows that share a ``vec_id`` are rows of
    their own with links of their own, but one for components. A null ``vec_id`` links with
    nothing, has a null component and is kept. An empty input gives an empty result.
    """
    spark, spread = vectors.sparkSession, partitions(vectors.sparkSession)
    kind = vectors.schema["embedding"].dataType
    dtype = "<f4" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "<f8"
    radius = math.sqrt(2 - 2 * threshold)
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = materialise(base.mapInArrow(_digested(dtype), "vec_id long, hi long, lo long, vector binary"), "vector-digests")
    classes = rows.where("vector is not null").groupBy("hi", "lo")
    classes = classes.agg(F.min(F.struct("vec_id", "vector")).alias("first"), F.count(F.lit(1)).alias("weight"))
    reps = materialise(classes.select(F.col("first.vec_id").alias("node"), "hi", "lo", "weight", "first.vector"), "vector-classes")

    total = reps.count()
    sample = reps.orderBy(F.xxhash64("hi", "lo"), "node").limit(SAMPLE_VECTORS).select("vector")
    sample = _unit([bytes(r[0]) for r in sample.collect()], dtype) if total else np.zeros((0, 0))
    wanted = max(1, min(MAX_CELLS, -(-total // CELL_VECTORS)))
    pivots = choose_pivots(sample, radius, wanted) if total else sample
    shared = spark.sparkContext.broadcast(pivots)
    work = reps.select("node", "lo", "weight", "vector")
    counts = work.mapInArrow(_count(shared, radius, dtype), _COUNTS).groupBy("cell", "home", "bin")
    counts = counts.agg(F.sum("vectors").alias("vectors"), F.sum("weight").alias("weight"), F.min("node").alias("node")).toArrow()
    block = max(64, min(BLOCK_VECTORS, BLOCK_COMPONENTS // max(1, pivots.shape[1])))
    table = {c: counts.column(c).to_numpy() for c in counts.column_names} | {"kind": 1 - counts.column("home").to_numpy().astype(np.int64)}
    layout = spark.sparkContext.broadcast(Layout(table, len(pivots), radius, block))

    sure = work.mapInArrow(_sure(shared, layout, radius, dtype), _LINKS)
    dealt = work.mapInArrow(_deal(shared, layout, radius, dtype), _DEALT)
    dealt = dealt.repartition(spread, "pair").sortWithinPartitions("pair")
    links = materialise(sure.unionByName(dealt.mapInArrow(_compare(threshold, dtype), _LINKS)), "vector-links")

    # Equal vectors hang on their first row.
    own = reps.select("hi", "lo", "node", "weight")
    copies = rows.join(own.where("weight > 1"), ["hi", "lo"]).select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
    edges = links.select(F.col("node").alias("a"), F.col("other").alias("b")).unionByName(copies)
    component = materialise(connected_components(edges), "vector-components")
    totals = links.groupBy("node", "lo").agg(F.sum("links").alias("links"))
    totals = own.join(totals, ["node", "lo"], "left").select("hi", "lo", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    totals = materialise(totals.where("n_links > 0"), "vector-totals")
    found = rows.select("vec_id", "hi", "lo").join(totals, ["hi", "lo"], "left")
    found = found.join(component.withColumnRenamed("id", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
