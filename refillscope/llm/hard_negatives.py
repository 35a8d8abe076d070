"""Operator 11: hard negatives of anchors by bounds along a spanning tree of the anchors.

Vectors become whole numbers, ``floor(scale * x)``; the score of a row for an anchor is
their inner product. The anchors are put into blocks of near ones, and each block gets a
minimum spanning tree. With the score (or its bounds) at the parent anchor p, the score of
a candidate c at the child a lies within ``|a - p| * |c|`` of it (Cauchy-Schwarz). Only
candidates whose bounds reach into a window of interest are scored; their exact scores
then give the next children tighter bounds.

Two passes: the first finds each anchor's best rows of its own label (its positives), the
second the rows of other labels within the score window that each positive sets. In both,
every block of anchors meets every group of rows once; rows are dealt to groups by a hash
of their id, so a common vector or label is no hot key. Each meeting passes on only its
best few rows for each anchor, and a ranking over these ends the pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refillscope.llm.setjoin import runs_of
from refillscope.llm.shared import materialise, partitions
from refillscope.llm.vectors import dump, load, matrix, packed, stack, widened

# Anchors of a block, on average, and bytes of their vectors.
BLOCK_ANCHORS = 1024
BLOCK_BYTES = 8_000_000
# Anchors that other anchors are grouped by.
MAX_PIVOTS = 1024
# Rows that a group has at most, on average, and rows that are bounded at a time.
GROUP_ROWS = 32_768
_CHUNK = 2048
# Squared norms up to which inner products are whole numbers in doubles, and fit in 64 bits.
_EXACT = 2.0**53
_LARGEST = 2.0**62

_ROWS = "vec_id long, label int, vector binary"
_DEALT = "block int, group int, kind int, vec_id long, label int, vector binary, tree binary"
_TREE, _ROW = 0, 1


def _quantise(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = np.asarray(batch.column("vec_id").is_valid()) & np.asarray(batch.column("label").is_valid())
            batch = batch.filter(pa.array(known))
            rows, vectors = matrix(batch.column("embedding"))
            with np.errstate(over="ignore"):
                whole = np.floor(scale * vectors)
                fits = (whole * whole).sum(axis=1) < _LARGEST
            batch = batch.take(pa.array(rows[fits]))
            columns = [batch.column("vec_id"), batch.column("label"), packed(whole[fits].astype("<i4"))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "vector"])

    return run


def _nearest(pivots: list[bytes]):
    """Adds the position of the nearest pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = stack([*pivots, *batch.column("vector").to_pylist()], "<i4").astype(np.float64)
            centre, rows = both[: len(pivots)], both[len(pivots) :]
            cell = ((centre * centre).sum(axis=1) - 2 * rows @ centre.T).argmin(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    return run


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree of points: their order from the root on, each one's parent, and its edge."""
    count = len(vectors)
    points = vectors.astype(np.float64)
    norms = (points * points).sum(axis=1)
    order, parent, edge = np.zeros(count, np.int64), np.full(count, -1), np.zeros(count)
    nearest, left = np.full(count, np.inf), np.ones(count, bool)
    at = 0
    for k in range(count):
        order[k], left[at] = at, False
        away = (norms + norms[at] - 2 * (points @ points[at])).clip(0)
        closer = left & (away < nearest)
        nearest[closer], parent[closer] = away[closer], at
        if k + 1 < count:
            at = int(np.where(left, nearest, np.inf).argmin())
    known = parent >= 0
    # From the coordinates again: differences of squares lose digits for near points.
    edge[known] = np.sqrt(((points[known] - points[parent[known]]) ** 2).sum(axis=1))
    return order, parent, edge


def _plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One tree for each block of anchors."""
    for (block,), pieces in runs_of(batches, ("block",)):
        table = pa.Table.from_batches(pieces)
        vectors = stack(table.column("vector").to_pylist(), "<i4")
        order, parent, edge = spanning_tree(vectors)
        raw = dump(
            ids=table.column("vec_id").to_numpy(), labels=table.column("label").to_numpy(), vectors=vectors, order=order, parent=parent, edge=edge
        )
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([raw], pa.binary())], names=["block", "tree"])


def _best(scores: np.ndarray, ids: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:keep]
    return scores[order], ids[order]


class _Chunk:
    """Some candidate rows and what is known of their scores at the anchors of one tree."""

    def __init__(self, tree: dict[str, np.ndarray], ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        width = max(vectors.shape[1], tree["vectors"].shape[1])
        self.ids, self.labels, self.tree = ids, labels, tree
        rows, points = widened(vectors, width), widened(tree["vectors"], width)
        norms = [(x.astype(np.float64) ** 2).sum(axis=1) for x in (rows, points)]
        self.exact = max(x.max(initial=0) for x in norms) < _EXACT
        kind = np.float64 if self.exact else np.int64
        self.rows, self.points = rows.astype(kind), points.astype(kind)
        self.norm = np.sqrt(norms[0])
        self.low, self.high = {}, {}

    def scores(self, anchor: int, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of the wanted rows."""
        if 2 * len(wanted) > len(self.rows):
            return (self.rows @ self.points[anchor])[wanted]
        return self.rows[wanted] @ self.points[anchor]

    def bounds(self, anchor: int) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all scores at the anchor, from its parent's."""
        parent = int(self.tree["parent"][anchor])
        if not self.exact:
            low, high = np.full(len(self.rows), -np.inf), np.full(len(self.rows), np.inf)
        elif parent < 0:
            low = self.rows @ self.points[anchor]
            high = low.copy()
        else:
            # One more for rounding: exact scores are whole numbers.
            reach = self.tree["edge"][anchor] * self.norm * (1 + 1e-12) + 1
            low, high = self.low[parent] - reach, self.high[parent] + reach
        self.low[anchor], self.high[anchor] = low, high
        return low, high

    def note(self, anchor: int, wanted: np.ndarray, scores: np.ndarray) -> None:
        if self.exact:
            self.low[anchor][wanted] = self.high[anchor][wanted] = scores


def _meetings(batches: Iterator[pa.RecordBatch]):
    """For each block and group: block, its tree, and chunks of distinct rows."""
    for (block, _), pieces in runs_of(batches, ("block", "group")):
        table = pa.Table.from_batches(pieces)
        raw = table.column("tree")[0].as_py()
        if raw is None:  # no anchors in this block
            continue
        rows = table.slice(1)
        ids = rows.column("vec_id").to_numpy()
        fresh = np.ones(len(ids), bool)
        fresh[1:] = ids[1:] != ids[:-1]
        rows = rows.filter(pa.array(fresh))
        tree = load(raw)

        def chunks(rows=rows, tree=tree):
            for at in range(0, rows.num_rows, _CHUNK):
                part = rows.slice(at, _CHUNK)
                yield _Chunk(tree, part.column("vec_id").to_numpy(), part.column("label").to_numpy(), stack(part.column("vector").to_pylist(), "<i4"))

        yield block, tree, chunks()


def _positives(keep: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, tree, chunks in _meetings(batches):
            found = {}
            for chunk in chunks:
                for anchor in tree["order"].tolist():
                    low, high = chunk.bounds(anchor)
                    wanted = (chunk.labels == tree["labels"][anchor]) & (chunk.ids != tree["ids"][anchor])
                    best = found.get(anchor)
                    if best is not None and len(best[0]) == keep:
                        wanted &= high >= best[0][-1]
                    wanted = np.flatnonzero(wanted)
                    if not len(wanted):
                        continue
                    scores = chunk.scores(anchor, wanted)
                    chunk.note(anchor, wanted, scores)
                    ids = chunk.ids[wanted]
                    if best is not None:
                        scores, ids = np.concatenate([best[0], scores]), np.concatenate([best[1], ids])
                    found[anchor] = _best(scores, ids, keep)
            out = [(block, int(tree["ids"][a]), int(i), int(s)) for a, (scores, ids) in found.items() for s, i in zip(scores, ids, strict=True)]
            columns = zip(*out, strict=True) if out else [()] * 4
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["block", "anchor_id", "positive_id", "positive_score"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


def _with_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add to each block's tree the positives of its anchors."""
    for (block,), pieces in runs_of(batches, ("block",)):
        table = pa.Table.from_batches(pieces)
        tree = load(table.column("tree")[0].as_py())
        pairs = table.slice(1)
        order = np.argsort(tree["ids"])
        anchor = order[np.searchsorted(tree["ids"], pairs.column("anchor_id").to_numpy(), sorter=order)]
        tree |= {"anchor": anchor, "positive": pairs.column("positive_id").to_numpy(), "score": pairs.column("positive_score").to_numpy()}
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([dump(**tree)], pa.binary())], names=["block", "tree"])


def _negatives(keep: int, share: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tree, chunks in _meetings(batches):
            windows = {}
            for a, i, s in zip(*(tree[c].tolist() for c in ("anchor", "positive", "score")), strict=True):
                if (least := -((-share * s) // 100)) <= s:  # none for negative scores
                    windows.setdefault(a, []).append((i, s, least))
            found = {}
            for chunk in chunks:
                for anchor in tree["order"].tolist():
                    low, high = chunk.bounds(anchor)
                    if anchor not in windows:
                        continue
                    near = np.zeros(len(chunk.ids), bool)
                    for i, most, least in windows[anchor]:
                        best = found.get((anchor, i))
                        full = best is not None and len(best[0]) == keep
                        near |= (low <= most) & (high >= (best[0][-1] if full else least))
                    wanted = np.flatnonzero(near & (chunk.labels != tree["labels"][anchor]))
                    if not len(wanted):
                        continue
                    scores, ids = chunk.scores(anchor, wanted), chunk.ids[wanted]
                    chunk.note(anchor, wanted, scores)
                    for i, most, least in windows[anchor]:
                        inside = (scores >= least) & (scores <= most)
                        if not inside.any():
                            continue
                        own, who = scores[inside], ids[inside]
                        if (best := found.get((anchor, i))) is not None:
                            own, who = np.concatenate([best[0], own]), np.concatenate([best[1], who])
                        found[anchor, i] = _best(own, who, keep)
            known = dict(zip(zip(tree["anchor"].tolist(), tree["positive"].tolist(), strict=True), tree["score"].tolist(), strict=True))
            out = [
                (int(tree["ids"][a]), i, known[a, i], int(n), int(s))
                for (a, i), (scores, ids) in found.items()
                for s, n in zip(scores, ids, strict=True)
            ]
            columns = zip(*out, strict=True) if out else [()] * 5
            names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def _blocked(anchors: DataFrame) -> tuple[DataFrame, int]:
    """Anchors with their block, near ones together, and the number of blocks."""
    spark, count = anchors.sparkSession, anchors.count()
    if not count:
        return anchors.withColumn("block", F.lit(0)), 0
    widest = anchors.agg(F.max(F.octet_length("vector"))).first()[0] or 1
    size = max(16, min(BLOCK_ANCHORS, BLOCK_BYTES // max(1, widest)))
    wanted = min(MAX_PIVOTS, -(-count // size))
    if wanted == 1:
        return anchors.withColumn("block", F.lit(0)), 1
    pivots = [bytes(r[0]) for r in anchors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).select("vector").collect()]
    celled = materialise(anchors.mapInArrow(_nearest(pivots), f"{_ROWS}, cell int"), "anchor-cells")
    # At most MAX_PIVOTS rows: how many blocks each cell is cut into, and the number of its first.
    cells = sorted(tuple(r) for r in celled.groupBy("cell").count().collect())
    parts = [-(-n // size) for _, n in cells]
    first = np.cumsum([0, *parts]).tolist()
    plan = spark.createDataFrame([(c, p, f) for (c, _), p, f in zip(cells, parts, first, strict=False)], "cell int, parts int, first int")
    block = (F.col("first") + F.expr("pmod(xxhash64(vec_id), parts)")).cast("int")
    return celled.join(F.broadcast(plan), "cell").select("vec_id", "label", "vector", block.alias("block")), first[-1]


def mine_hard_negatives(
    vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, share: int = 80, scale: int = 256
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Reads ``vec_id, label, embedding`` alone (and what ``anchor`` names). Scores are inner
    products of the vectors ``floor(scale * x)``; higher come first, ties by smaller
    ``vec_id``. An anchor (a row for which ``anchor`` holds) has as positives its first
    ``positives`` other rows of its label, fewer if there are fewer. For each of them come
    the first ``negatives`` rows of other labels with ``share * positive_score <= 100 *
    negative_score <= 100 * positive_score``; a positive without such rows, or with a
    negative score, gives no row.

    Rows with a null id, label, vector or component, a NaN or infinite component, or so
    large that a score may not fit in 64 bits (a squared length of 2**62 after scaling)
    take no part. Vectors of unlike length count as if zeros followed the shorter; empty
    ones score 0. Rows that repeat a ``vec_id`` count once, with the smallest label, then
    the smallest vector. An empty input gives an empty result.
    """
    spark = vectors.sparkSession
    base = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), "embedding", anchor.alias("anchor")
    )
    rows = materialise(base.select("vec_id", "label", "embedding").mapInArrow(_quantise(scale), _ROWS), "whole-vectors")
    chosen = base.where("anchor").select("vec_id", "label", "embedding").mapInArrow(_quantise(scale), _ROWS)
    chosen = chosen.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    blocked, blocks = _blocked(materialise(chosen.select("vec_id", "row.label", "row.vector"), "anchors"))
    spread = partitions(spark)
    trees = blocked.repartition(spread, "block").sortWithinPartitions("block", "vec_id").mapInArrow(_plant, "block int, tree binary")
    trees = materialise(trees, "anchor-trees")
    groups = max(4 * spread, -(-rows.count() // GROUP_ROWS))

    def meet(trees: DataFrame) -> DataFrame:
        each = F.explode(F.sequence(F.lit(0), F.lit(max(0, blocks - 1))))
        dealt = rows.select(
            each.alias("block"), F.expr(f"pmod(xxhash64(vec_id), {groups})").cast("int").alias("group"), F.lit(_ROW).alias("kind"),
            "vec_id", "label", "vector", F.lit(None).cast("binary").alias("tree"),
        )
        every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
        planted = trees.select(
            "block", every.alias("group"), F.lit(_TREE).alias("kind"), F.lit(None).cast("long").alias("vec_id"),
            F.lit(None).cast("int").alias("label"), F.lit(None).cast("binary").alias("vector"), "tree",
        )
        met = planted.unionByName(dealt).repartition(spread, "block", "group")
        return met.sortWithinPartitions("block", "group", "kind", "vec_id", "label", "vector")

    near = meet(trees).mapInArrow(_positives(positives), "block int, anchor_id long, positive_id long, positive_score long")
    first = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    near = materialise(near.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives).drop("place"), "positives")
    blank = [F.lit(None).cast("long").alias(c) for c in ("anchor_id", "positive_id", "positive_score")]
    both = trees.select("block", F.lit(0).alias("kind"), "tree", *blank).unionByName(
        near.select("block", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("tree"), "anchor_id", "positive_id", "positive_score")
    )
    both = both.repartition(spread, "block").sortWithinPartitions("block", "kind")
    aimed = materialise(both.mapInArrow(_with_windows, "block int, tree binary"), "anchor-windows")
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    hard = meet(aimed).mapInArrow(_negatives(negatives, share), schema)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    hard = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return hard.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
