"""Operator 13: periodic runs of words by Lyndon arrays from the first phase of a suffix sorter.

A run is a stretch of words with a smallest period q that no neighbouring word extends.
Every run holds a Lyndon root: a factor of length q that is the longest Lyndon word at its
start, under the order of the words or its reverse (the "runs" theorem). The longest Lyndon
words at all positions, the Lyndon array, come directly from the groups of the first phase
of Baier's suffix sorter: positions are grouped by their first word; from the greatest
group down, each member's group word is appended to that of the nearest position before it
that is in a smaller group. In the end the length of a position's group word is that of its
longest Lyndon word. Each root is then extended both ways by longest common extensions.

A word that occurs once in a stretch is in no run and bounds those beside it, so texts are
first cut at such words, a few times over; this changes the time, not the result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_MIN_LENGTH = 12
# Rounds of cutting at words that occur once.
_CUTS = 4
# Documents whose results are sent on together.
_STEP = 500

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def lyndon_array(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each position, by grouping from the greatest word down."""
    ids = {rank: k for k, rank in enumerate(sorted(set(ranks)))}
    group = [ids[rank] for rank in ranks]
    word, members = [1] * len(ids), [[] for _ in ids]
    for at, g in enumerate(group):
        members[g].append(at)
    below, above = list(range(-1, len(ids) - 1)), list(range(1, len(ids) + 1))
    before = list(range(-1, len(ranks) - 1))  # a position before, nearer ones are in no smaller group
    out = [0] * len(ranks)  # 0: its group is still to come
    now = len(ids) - 1
    while now >= 0:
        mine = [i for i in members[now] if group[i] == now]
        for i in mine:
            out[i] = word[now]
        follows = Counter()
        for i in mine:
            j = before[i]
            while j >= 0 and out[j]:
                j = before[j]
            while i > j:  # later searches start there
                step, before[i] = before[i], j
                i = step
            if j >= 0:
                follows[j] += 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, times in follows.items():
            moved.setdefault((group[j], times), []).append(j)
        # New groups come right above the old one, those with more repeats above those with fewer.
        for g, times in sorted(moved, reverse=True):
            new = len(word)
            word.append(word[g] + times * word[now])
            members.append(moved[g, times])
            below.append(g)
            above.append(above[g])
            below[above[g]] = new
            above[g] = new
            for j in moved[g, times]:
                group[j] = new
        now = below[now]
    return out


def _common(raw: bytes, i: int, j: int) -> int:
    """Number of equal 4-byte items from ``i`` and from ``j > i`` on."""
    i, end, j, step = 4 * i, len(raw), 4 * j, 16
    start = j
    while j < end and raw[i : i + step] == raw[j : j + step]:
        i, j, step = i + step, j + step, 2 * step
    while j < end and step >= 4:
        if raw[i : i + step] == raw[j : j + step] and j + step <= end:
            i, j = i + step, j + step
        else:
            step //= 2
    return (min(j, end) - start) // 4


def runs_in(words: list, least: int) -> set[tuple[int, int, int]]:
    """``(start, length, period)`` of the runs of at least ``least`` items."""
    ids: dict = {}
    ranks = [ids.setdefault(w, len(ids)) for w in words]
    size = len(ranks)
    raw = np.array(ranks, "<u4").tobytes()
    back = np.array(ranks[::-1], "<u4").tobytes()
    found = set()
    for order in (ranks, [-r for r in ranks]):
        ends: dict[int, int] = {}
        for i, period in enumerate(lyndon_array(order)):
            stop = i + period
            if stop >= size and i == 0 or ends.get(period, 0) >= stop:
                continue  # nothing beside it, or a root of a run that is known
            right = _common(raw, i, stop) if stop < size and ranks[i] == ranks[stop] else 0
            left = _common(back, size - stop, size - i) if i and ranks[i - 1] == ranks[stop - 1] else 0
            if left + right >= period:
                ends[period] = stop + right
                if left + period + right >= least:
                    found.add((i - left, left + period + right, period))
    return found


def stretches(words: list, least: int) -> list[tuple[int, int]]:
    """Bounds of stretches of at least ``least`` words that hold all runs of that length."""
    found = [(0, len(words))]
    for _ in range(_CUTS):
        parts = []
        for a, b in found:
            own = words[a:b]
            counts = Counter(own)
            if len(counts) == len(own):
                continue
            cuts = [k for k, w in enumerate(own, a) if counts[w] == 1]
            for start, stop in zip([a, *(k + 1 for k in cuts)], [*cuts, b], strict=True):
                if stop - start >= least:
                    parts.append((start, stop))
        if parts == found:
            break
        found = parts
    return [(a, b) for a, b in found if b - a >= least]


def word_runs_of(words: list, least: int = DEFAULT_MIN_LENGTH) -> list[tuple[int, int, int]]:
    """All runs of at least ``least`` words, by start, then period."""
    found = [(a + s, n, p) for a, b in stretches(words, least) for s, n, p in runs_in(words[a:b], least)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def _scan(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _STEP):
                batch = whole.slice(at, _STEP)
                counts, spans, texts = [], [], []
                for text in batch.column("text").to_pylist():
                    # Splitting bytes knows just the six characters of ASCII white space.
                    words = text.encode("utf-8", "surrogatepass").split() if text else []
                    runs = word_runs_of(words, least)
                    if runs:
                        stays = bytearray(b"\1") * len(words)
                        for start, length, period in runs:
                            stays[start + period : start + length] = bytes(length - period)
                        texts.append(b" ".join([w for w, stay in zip(words, stays, strict=True) if stay]))
                    else:
                        texts.append(b" ".join(words))
                    counts.append(len(words))
                    spans.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs])
                collapsed = pa.array([t.decode("utf-8", "surrogatepass") for t in texts], pa.string())
                columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(_RUN)), collapsed]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, min_length: int = DEFAULT_MIN_LENGTH) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_words, runs, collapsed``.

    Reads ``doc_id`` and ``text`` alone. Words are what ASCII white space separates. A run is
    a stretch of at least ``max(min_length, 2 * period)`` words with that smallest period which
    no neighbouring word extends; ``runs`` are structs ``start, length, period`` by start,
    then period. ``collapsed`` is the text's words joined by single spaces, without those
    that lie in any run after its first period. Null and empty texts have no words, no
    runs and an empty collapsed text. Rows are judged each on its own, so ids may be null or
    repeat. An empty input gives an empty result. One narrow pass, without any shuffle.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_scan(min_length), _FOUND)


def _number(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary"))


def repeat_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with a repeated tail in the documents whose number h is divisible by 10.

    h is the CRC-32 of the decimal id, g = floor(h / 10). From word a = g % n on the text
    repeats its p words there, p = 1 + floor((n - a) / (3 + g % 8)). Texts without words and
    rows without an id stay as they are.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    base = base.withColumn("h", _number(F.col("doc_id")))
    base = base.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    base = base.withColumn("n", F.size("words").cast("long")).withColumn("g", F.expr("h div 10"))
    base = base.withColumn("a", F.expr("if(n > 0, g % n, null)"))
    base = base.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = "slice(flatten(array_repeat(slice(words, int(a + 1), int(p)), int((n - a + p - 1) div p))), 1, int(n - a))"
    planted = F.expr(f"array_join(concat(slice(words, 1, int(a)), {tail}), ' ')")
    return base.select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(planted).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """Counts, the longest run, and digests of all runs and of the collapsed text, by row of ``periodic_runs``."""
    longest = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    line = "concat(r.start, ',', r.length, ',', r.period, '\\n')"
    listed = F.expr(f"array_join(transform(runs, r -> {line}), '')")
    base = found.withColumn("best", longest)
    return base.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
