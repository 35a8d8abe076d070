"""Operator 4 against a brute-force comparison of all pairs of lines."""

import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import SF_SMALL, as_rows, documents
from refillscope.llm import line_dedup, setjoin, shingles
from refillscope.llm.line_dedup import (
    RARITY_BITS,
    _line_key,
    _of_place,
    chain_links,
    duplicate_lines,
    few_pairs,
    line_kinds,
    line_report,
    parity_signatures,
    prefixes,
    remove_lines,
)
from refillscope.llm.queries import QUERIES
from refillscope.llm.shingles import mix, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(line, width, least=5):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), line))
    if len(words) < max(1, least):
        return None
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute_force(rows, width=5, least=5):
    """Removed (doc_id, line) pairs."""
    lines = []
    for doc, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            own = tokens(line, width, least)
            if own and doc is not None:
                lines.append((doc, k, own))
    lines.sort(key=lambda r: r[:2])
    by_token, gone = {}, set()
    for i, (doc, k, own) in enumerate(lines):
        near = {j for t in own for j in by_token.get(t, ())}
        if any(5 * len(own & lines[j][2]) >= 4 * len(own | lines[j][2]) for j in near):
            gone.add((doc, k))
        for t in own:
            by_token.setdefault(t, []).append(i)
    return sorted(gone)


def removed(df, **options):
    return sorted((r["doc_id"], r["line"]) for r in duplicate_lines(df, **options).collect())


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert removed(docs) == brute_force(rows)


def test_registered_parameters_on_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute_force(rows, width=1, least=1)
    found = QUERIES["op4_line_dedup"](spark, SF_SMALL).select("doc_id", "removed_lines").collect()
    assert want and sorted((r[0], k) for r in found for k in r[1]) == want


def test_similar_sets_share_a_key():
    """Sets of all sizes with as many differences as the threshold allows, under an order of tokens that all follow."""
    rng = np.random.default_rng(5)
    rarity = rng.permutation(1 << RARITY_BITS)
    for size in [*range(4, 40), 47, 48, 63, 64, 65, 100, 127, 128, 129, 160, 300, 511, 512, 640]:
        for _ in range(6):
            left = rng.integers(0, 2**62, size).astype(np.uint64) * np.uint64(2)
            common = rng.integers(-(-4 * size // 5), size + 1)
            most = (5 * common - 4 * size) // 4  # tokens that only the right set may have
            right = np.concatenate([rng.choice(left, common, replace=False), rng.integers(0, 2**62, rng.integers(0, most + 1)).astype(np.uint64) * np.uint64(2) + np.uint64(1)])
            if 5 * common < 4 * (size + len(right) - common) or common == size == len(right):
                continue
            sets = [np.sort(left), np.sort(right)]
            sizes = np.array([len(x) for x in sets])
            key, owner, place = prefixes(np.concatenate(sets), np.repeat([0, 1], sizes), sizes, rarity, Fraction(4, 5), True)
            own = key, owner, sizes[owner], place
            assert len(chain_links(*own, Fraction(4, 5))[0]) and len(few_pairs(*own, Fraction(4, 5))[0]), (size, common, len(right))
            one, other = parity_signatures(np.concatenate(sets), np.repeat([0, 1], sizes), 2)
            assert sum(int(x ^ y).bit_count() for x, y in zip(one.view(np.uint64), other.view(np.uint64))) <= size + len(right) - 2 * common


def test_a_third_of_lines_under_one_pair_of_words(spark):
    rows = [(k, f"page {k} of 300") for k in range(300)] + [(1000 + k, f"w{k} v{k} page of {k} u{k % 7} t{k % 5}") for k in range(600)]
    docs = documents(spark, rows)
    assert removed(docs, width=1, min_words=1) == brute_force(rows, 1, 1)


def edited_lines(seed):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(60)]
    bases = [[rng.choice(words) for _ in range(rng.choice([5, 9, 14, 30, 60]))] for _ in range(8)]
    rows = []
    for doc in range(40):
        text = []
        for _ in range(rng.randrange(1, 6)):
            line = list(rng.choice(bases))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                line[rng.randrange(len(line))] = rng.choice(words)
            if rng.random() < 0.3:
                line = line[: len(line) - rng.randrange(0, 1 + len(line) // 5)]
            text.append(" ".join(line))
        rows.append((doc, "\n".join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width", [1, 5])
def test_edited_lines(spark, width):
    rows = edited_lines(width)
    assert removed(documents(spark, rows), width=width) == brute_force(rows, width)


@pytest.mark.parametrize("most", [3, 90])
def test_families_cut_into_blocks_by_size(spark, monkeypatch, most):
    """Blocks of few sets, so that similar lines of other sizes lie in other blocks."""
    monkeypatch.setattr(setjoin, "BLOCK_SETS", most)
    rng = random.Random(3)
    rows = [(k, " ".join(f"w{i}" for i in range(rng.randrange(1, 3), rng.randrange(4, 60)))) for k in range(250)]
    found = removed(documents(spark, rows), width=1, min_words=1)
    assert found and found == brute_force(rows, 1, 1)


def test_edge_cases(spark):
    long = " ".join("x%d" % i for i in range(20_000))
    same = "one two three four five six"
    rows = [(1, None), (2, ""), (3, same), (4, f"{same}\n{same}"), (5, same.upper()), (None, same), (6, "a b c d"), (7, "a b c d"),
            (8, long), (9, long + " z"), (10, f"x\n\n{same} "), (3, same)]
    assert removed(documents(spark, rows)) == [(4, 0), (4, 1), (5, 0), (9, 0), (10, 2)]
    assert removed(documents(spark, [])) == []
    report = {r["doc_id"]: r for r in line_report(documents(spark, rows)).collect()}
    assert (report[4]["n_lines"], report[4]["n_removed"], report[4]["removed_lines"]) == (2, 2, [0, 1])
    assert (report[1]["n_lines"], report[2]["n_lines"], report[1]["removed_lines"]) == (0, 1, [])
    assert line_report(documents(spark, rows)).count() == len(rows)


def test_removal_keeps_rows_and_clashing_columns(spark):
    same = "one two three four five six"
    docs = documents(spark, [(1, f"a\n{same}"), (2, f"b\n{same}\nc"), (3, None), (4, same)]).selectExpr(
        "doc_id", "text", "1 as removed", "2 as _gone", "3 as hi", "4 as family", "5 as line", "6 as kind"
    )
    out = remove_lines(docs, duplicate_lines(docs))
    assert out.columns == docs.columns
    assert as_rows(out, "doc_id", "text") == [(1, f"a\n{same}"), (2, "b\nc"), (3, None), (4, "")]


def test_first_places_of_lines_without_sorting_them(spark):
    most = 2**63 - 1
    rows = [(1, 7, 5, 0), (1, 7, 3, 4), (1, 7, 3, 2), (2, 7, -most - 1, 9), (2, 7, -2, 1), (3, 7, most, 2**31 - 1), (4, 7, -1, 3)]
    frame = spark.createDataFrame(rows, "hi long, lo long, doc_id long, line int").selectExpr("*", "1 n", "2L sig_a", "3L sig_b")
    kinds = line_kinds(frame)
    assert "SortAggregate" not in kinds._jdf.queryExecution().executedPlan().toString()
    found = {r[0]: r[1:] for r in kinds.select("hi", *_of_place(), "copies").collect()}
    assert found == {1: (3, 2, 3), 2: (-most - 1, 9, 2), 3: (most, 2**31 - 1, 1), 4: (-1, 3, 1)}
    assert [kind for _, kind in kinds.select(*_of_place()).dtypes] == ["bigint", "int"]


def test_line_keys_are_alike_in_columns_and_arrays(spark):
    rows = [(5, 0), (-7, 12), (2**63 - 1, 2**31 - 1), (-(2**63), 1)]
    frame = spark.createDataFrame(rows, "doc_id long, line long")
    keys = [r[0] for r in frame.select(_line_key(F.col("doc_id"), F.col("line"))).collect()]
    assert keys == _line_key(*np.array(rows, dtype=np.int64).T).tolist()


def test_rarity_orders_slots_by_their_counts_in_few_rows(spark):
    """The places of slots follow the counts of all words; tasks send blocks of slots, not a row for each slot."""
    words = [f"w{k}" for k in range(3_000)]
    texts = [(i, " ".join(words[: 3_000 - 7 * i])) for i in range(200)] + [(200, None), (201, "")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    place = line_dedup.token_rarity(df, 1, 1).value
    hashes = mix(word_hashes([t for _, t in texts if t])[0])
    counts = np.bincount(line_dedup._slots(hashes), minlength=1 << line_dedup.RARITY_BITS)
    assert sorted(place) == list(range(len(counts)))
    assert (np.diff(counts[np.argsort(place)]) >= 0).all()


def test_pairs_of_few_are_found_among_many_lone_keys():
    """Keys of one row are left out before sorting; pairs and what is left to chains stay as by brute force."""
    rng = np.random.default_rng(3)
    key = rng.integers(0, 2_000, 3_000).astype(np.uint64)
    key[:60] = 2_001
    node, size = rng.integers(-900, 900, 3_000), rng.integers(8, 11, 3_000)
    place = np.zeros(3_000, np.int64)
    a, b, left = line_dedup.few_pairs(key, node, size, place, Fraction(4, 5))
    rows, want, many = {}, set(), set()
    for k, n, s in zip(key.tolist(), node.tolist(), size.tolist(), strict=True):
        rows.setdefault(k, set()).add((n, s))
    for k, own in rows.items():
        nodes = {n for n, _ in own}
        if len(nodes) == len(own) <= line_dedup.FEW:
            want |= {(x, y) for x, s in own for y, t in own if x < y and 5 * min(s, t) >= 4 * max(s, t)}
        elif len(own) > line_dedup.FEW:
            many.add(k)
    assert want <= set(zip(a.tolist(), b.tolist(), strict=True))
    assert set(key[left].tolist()) == many
    for none in (0, 1):
        a, b, left = line_dedup.few_pairs(key[:none], node[:none], size[:none], place[:none], Fraction(4, 5))
        assert not len(a) and not len(b) and not left.any()


def test_postings_are_dealt_to_shards_without_sorting_keys():
    """Slices of shards hold the keys of each in the order given; arrays of a chunk of text fit a core's cache."""
    keys = np.random.default_rng(4).integers(0, 1 << 63, 5_000).astype(np.uint64) * np.uint64(2)
    for bits in (1, 8, 18):
        dealt = keys[setjoin.by_shard(keys, bits)]
        own = {shard: dealt[rows].tolist() for shard, rows in setjoin.shard_slices(dealt, bits)}
        assert own == {s: [k for k in keys.tolist() if k >> 64 - bits == s] for s in {k >> 64 - bits for k in keys.tolist()}}
    assert 8 * shingles._CHUNK <= 1 << 20


def test_words_are_hashed_by_blocks_and_told_apart():
    """Words of any length: equal ones alike wherever they stand, others not, up to the longest of a chunk."""
    rng = random.Random(5)
    words = ["".join(rng.choices("ab\x00\u00e9", k=n)) for n in [*range(1, 40), 255, 256, 257, 300] for _ in range(4)]
    words = sorted({w.encode().decode() for w in words})
    once, counts = word_hashes(words)
    assert counts.tolist() == [1] * len(words) and len(set(once.tolist())) == len(words)
    order = rng.sample(range(len(words)), len(words))
    joined, counts = word_hashes(["\t\n ".join(words[k].upper() if words[k].isascii() else words[k] for k in order), None, ""])
    assert counts.tolist() == [len(words), 0, 0] and joined.tolist() == once[order].tolist()


def test_orders_by_value_are_stable():
    """Places ride in the low bits; where they do not fit, the order is the same."""
    rng = np.random.default_rng(3)
    for most in (3, 1 << 40, (1 << 63) - 1):
        keys = rng.integers(0, most, 5000)
        keys[::3] = most - 1
        assert (line_dedup._stable_order(keys) == np.argsort(keys, kind="stable")).all()
    assert not len(line_dedup._stable_order(np.zeros(0, dtype=np.int64)))
