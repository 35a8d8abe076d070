"""Operator 13 against definitions: Lyndon words, maximal periodic stretches, planted tails."""

import hashlib
import random
import zlib

import pytest

from llm_helpers import SF_SMALL, as_rows, documents
from refillscope.llm.queries import op13_periodic_runs
from refillscope.llm.runs import lyndon_array, periodic_runs, word_runs_of


def longest_lyndon(items, i):
    return max(n for n in range(1, len(items) - i + 1) if all(items[i : i + n] < items[i + k : i + n] for k in range(1, n)))


def brute_force(words, least=12):
    found, n = [], len(words)
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            stop = i + p
            if stop - start >= max(least, 2 * p):
                own = words[start:stop]
                if not any(own[q:] == own[:-q] for q in range(1, p)):
                    found.append((start, stop - start, p))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def sequences(seed, count, longest):
    rng = random.Random(seed)
    for _ in range(count):
        out = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randrange(longest))]
        for _ in range(rng.randrange(3) if len(out) > 3 else 0):
            a, p = rng.randrange(len(out)), rng.randrange(1, 7)
            for i in range(a + p, min(len(out), a + rng.randrange(60))):
                out[i] = out[i - p]
        yield out


def test_lyndon_arrays_under_both_orders():
    for items in sequences(1, 400, 25):
        for own in (items, [-x for x in items]):
            assert lyndon_array(own) == [longest_lyndon(own, i) for i in range(len(own))]


@pytest.mark.parametrize("least", [1, 4, 12])
def test_runs_by_definition(least):
    for items in sequences(least, 400, 70):
        assert word_runs_of(items, least) == brute_force(items, least)


def test_long_texts():
    """Words of a Fibonacci string have runs of many periods; equal words are one run."""
    a, b = "a", "ab"
    while len(b) < 1500:
        a, b = b, b + a
    assert word_runs_of(list(b)) == brute_force(list(b))
    assert word_runs_of(["x"] * 200_000) == [(0, 200_000, 1)]


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    runs = brute_force(words)
    gone = {k for s, n, p in runs for k in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
    share = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, share, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_registered_query_on_small_texts(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r[0], " ".join((r[1] or "").split(" ")[:400])) for r in docs.select("doc_id", "text").collect()]
    loop = "a b c " * 6
    rows += [(None, loop), (-1, None), (-2, ""), (-3, " \t\n"), (-4, loop + "a"), (-4, loop + "a"), (-5, "x\x0by\x0c" * 9), (-6, "x y " * 12 + "é É " * 8)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = as_rows(op13_periodic_runs(spark, str(tmp_path)), *COLUMNS)
    want = sorted((expected(i, t) for i, t in rows), key=repr)
    assert got == want and sum(r[1] > 0 for r in want) > 15


def test_edge_cases(spark):
    docs = documents(spark, [(1, "a b " * 7 + "c"), (2, None), (2, "")]).selectExpr("doc_id", "text", "1 as runs", "2 as words", "3 as h", "4 as n")
    got = as_rows(periodic_runs(docs))
    assert got == [(1, 15, [(0, 14, 2)], "a b c"), (2, 0, [], ""), (2, 0, [], "")]
    assert as_rows(periodic_runs(documents(spark, []))) == []
    assert as_rows(periodic_runs(docs, min_length=15), "n_words") == [(0,), (0,), (15,)]
