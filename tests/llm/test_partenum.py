"""Operator 6 against a brute-force join of all pairs, and its signatures on random sets."""

import random
import re
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from refillscope.llm import shingles as sh
from refillscope.llm.partenum import jaccard_components, signatures
from refillscope.llm.shingles import distinct_sets, shingles, word_hashes

from llm_helpers import SF_SMALL, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute_force(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0]
            linked = a and b and 100 * len(a & b) >= 80 * len(a | b) and None not in (rows[i][0], rows[j][0])
            if (same_id or linked) and top(i) != top(j):
                root[top(i)] = top(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[top(i)] = min(low.get(top(i), doc), doc)
    return sorted(((d, len(s), None if d is None else low[top(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def result(df):
    return sorted((tuple(r) for r in jaccard_components(df).collect()), key=repr)


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert result(docs) == brute_force(rows)


def test_families_of_edited_copies(spark):
    rng = random.Random(7)
    words = ["w%d" % i for i in range(400)]
    rows = []
    for family in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([4, 7, 20, 90, 300]))]
        for copy in range(14):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 40)):
                text[rng.randrange(len(text))] = rng.choice(words)
            if rng.random() < 0.4:
                text = text[: len(text) - rng.randrange(0, 1 + len(text) // 6)]
            rows.append((len(rows) * 3 + family, " ".join(text).title() if copy % 2 else "\n".join(text)))
    rng.shuffle(rows)
    assert result(documents(spark, rows)) == brute_force(rows)


def test_edge_cases(spark):
    long = " ".join("x%d" % i for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "One  two"), (6, "one"), (None, "one"), (7, "one two"),
            (8, long), (9, long + " tail"), (10, "a b c d e f"), (10, "q r s t u v"), (11, "q r s t u v"), (12, "Ä b"), (13, "ä b")]
    assert result(documents(spark, rows)) == brute_force(rows)
    assert result(documents(spark, [])) == []


def test_clashing_columns(spark):
    df = documents(spark, [(1, "a b c"), (2, "a b c")]).selectExpr(
        "doc_id", "text", "'x' as node", "1 as family", "2 as n", "3 as kind", "4 as component_id", "5 as shard"
    )
    assert result(df) == [(1, 1, 1), (2, 1, 1)]


def test_short_and_long_sequences_have_different_shingles():
    hashes, counts = word_hashes(["a b", "a b c", "a b a b a b", "", None, "a b"])
    values, owner, bounds = distinct_sets(*shingles(hashes, counts, 5), 6)
    assert np.diff(bounds).tolist() == [1, 1, 2, 0, 0, 1]
    assert values[bounds[0]] == values[bounds[5]] and values[bounds[0]] != values[bounds[1]]


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 400), st.floats(0, 0.2), st.integers(0, 2**32))
def test_similar_sets_share_a_signature(size, rate, seed):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2**63, size, dtype=np.uint64)
    keep = rng.random(size) > rate * rng.random()
    b = np.concatenate([a[keep], rng.integers(0, 2**63, rng.integers(0, 1 + size // 8), dtype=np.uint64)])
    a, b = np.unique(a), np.unique(b)
    inter = len(np.intersect1d(a, b))
    key, owner = signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), Fraction(4, 5))
    if 5 * inter >= 4 * (len(a) + len(b) - inter):
        assert set(key[owner == 0].tolist()) & set(key[owner == 1].tolist())


def plain_lines(texts):
    out = []
    for i, text in enumerate(texts):
        for k, line in enumerate((text or "").split("\n")):
            words = (line.encode("utf-8", "surrogatepass").lower()).split()
            if words:
                out.append((i, k, words))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aBé \n\t\r\x0b\xa0"), max_size=40)), max_size=8), st.sampled_from([4, 9, 1 << 19]))
def test_words_and_lines_are_found_whatever_the_chunks(texts, chunk):
    before, sh._CHUNK = sh._CHUNK, chunk
    try:
        want = plain_lines(texts)
        hashes, counts, owner, number = sh.line_hashes(texts)
        assert list(zip(owner.tolist(), number.tolist(), counts.tolist())) == [(i, k, len(w)) for i, k, w in want]
        words = [w for _, _, own in want for w in own]
        values = hashes.tolist()
        assert len(values) == len(words) and len(set(zip(words, values))) == len(set(words)) == len(set(values))
        again, per_text = word_hashes(texts)
        assert again.tolist() == values
        assert per_text.tolist() == [len((t or "").encode("utf-8", "surrogatepass").split()) for t in texts]
    finally:
        sh._CHUNK = before


def test_long_words_and_texts():
    text = "a" * 300 + " " + "b" * 700_000 + " " + "c d\n" * 400_000
    hashes, counts, owner, number = sh.line_hashes([text, "c d"])
    assert counts.tolist()[:2] == [4, 2] and len(counts) == 400_001 and owner.tolist()[-1] == 1 and number.tolist()[-1] == 0
    assert len(set(hashes.tolist())) == 4 and number.tolist()[-2] == 399_999
