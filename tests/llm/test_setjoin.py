"""Candidate families of the set joins: unlike sets that share a key stay apart, similar ones together."""

import random
from fractions import Fraction

import numpy as np
import pytest

from llm_helpers import documents
from refillscope.llm import line_dedup, partenum, setjoin
from refillscope.llm.line_dedup import duplicate_lines, parity_signatures
from refillscope.llm.partenum import jaccard_components

THRESHOLD = Fraction(4, 5)


def kept(monkeypatch, module, name):
    """The number of sets that reach the blocks of families."""
    found, before = [], getattr(module, name)

    def counted(reps, *rest):
        found.append(reps.count())
        return before(reps, *rest)

    monkeypatch.setattr(module, name, counted)
    return found


def test_documents_with_a_common_passage_are_no_family(spark, monkeypatch):
    """Half of each text is the same passage: many share signatures, none is similar but the planted copies."""
    rng = random.Random(2)
    passage = [f"p{k}" for k in range(60)]
    rows = [(k, " ".join(passage + [f"w{rng.randrange(10**9)}" for _ in range(50)])) for k in range(400)]
    rows += [(1000 + k, rows[k][1] + " tail") for k in range(5)] + [(2000 + k, rows[k][1]) for k in range(3)]
    sets = kept(monkeypatch, partenum.sj, "blocks")
    found = {r["doc_id"]: r["component_id"] for r in jaccard_components(documents(spark, rows)).collect()}
    assert found == {k: k % 1000 for k, _ in rows}
    assert sum(sets) <= 40


@pytest.mark.parametrize("own", [10, 300])
def test_lines_with_a_rare_pair_of_words_are_no_family(spark, monkeypatch, own):
    """Thirty lines each share two rare words, the others are dealt from a few common ones: only planted copies are similar."""
    rng = random.Random(3)
    common = [f"c{k}" for k in range(4 * own)]
    lines = [" ".join([f"a{k % 16}", f"b{k % 16}", *rng.sample(common, own)]) for k in range(480)]
    rows = list(enumerate(lines)) + [(1000 + k, lines[k] + " tail") for k in range(4)] + [(2000, lines[7])]
    sets = kept(monkeypatch, line_dedup, "size_blocks")
    found = duplicate_lines(documents(spark, rows), width=1, min_words=1).collect()
    assert sorted(tuple(r) for r in found) == [(1000 + k, 0, k) for k in range(4)] + [(2000, 0, 7)]
    assert sum(sets) <= 40


def random_sets(rng, sizes):
    """Sets around a few centres, as values and bounds."""
    centres = [rng.integers(0, 2**63, 2 * max(sizes)).astype(np.uint64) for _ in range(6)]
    sets = []
    for size in sizes:
        own = centres[rng.integers(6)][: size - size // 6]
        sets.append(np.unique(np.concatenate([own, rng.integers(0, 2**63, rng.integers(0, 1 + size // 5)).astype(np.uint64)])))
    return sets, np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])])


def test_sketches_never_tell_similar_sets_apart():
    rng = np.random.default_rng(4)
    sets, values, bounds = random_sets(rng, rng.integers(6, 700, 160).tolist())
    raw = setjoin.sketches(values, bounds)
    assert [len(x) // 8 for x in raw] == setjoin.sketch_words(np.diff(bounds)).tolist()
    signature = parity_signatures(values, np.repeat(np.arange(len(sets)), np.diff(bounds)), len(sets))
    assert (setjoin._folded(raw, 2) == signature.view(np.uint64)).all()
    similar = likely = 0
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(np.intersect1d(a, sets[j]))
            words = min(len(raw[i]), len(raw[j])) // 8
            one, other = (setjoin._folded([raw[k]], words)[0] for k in (i, j))
            assert int(np.bitwise_count(one ^ other).sum()) <= len(a) + len(sets[j]) - 2 * common
            may = setjoin.may_be_similar(len(a), one, len(sets[j]), other, THRESHOLD)
            if 5 * common >= 4 * (len(a) + len(sets[j]) - common):
                similar += 1
                assert may
            likely += bool(may)
    assert 0 < similar <= likely < 2 * similar


def test_groups_are_linked_as_all_their_pairs():
    rng = np.random.default_rng(5)
    sizes = rng.integers(20, 90, 300)
    _, values, bounds = random_sets(rng, sizes.tolist())
    n, sketch = np.diff(bounds), setjoin._folded(setjoin.sketches(values, bounds), 2)
    group = np.sort(rng.integers(0, 9, len(n)))
    for own in (group, np.zeros_like(group)):
        want = np.arange(len(n))
        for _ in range(len(n)):
            before = want.copy()
            for i in range(len(n)):
                for j in np.flatnonzero((own == own[i]) & setjoin.may_be_similar(n[i], sketch[i], n, sketch, THRESHOLD)):
                    want[i] = want[j] = min(want[i], want[j])
            if (before == want).all():
                break
        assert len(np.unique(want)) < len(n)
        assert (setjoin._links_of_small(own, n, sketch, THRESHOLD) == want).all()
    low = setjoin._links_of_large(n, sketch, THRESHOLD)
    for k in np.unique(want):
        assert len(np.unique(low[want == k])) == 1
    assert len(np.unique(low)) == len(np.unique(want))


def test_pairs_and_groups_of_keys():
    rng = np.random.default_rng(6)
    key, node = rng.integers(0, 300, 2_000).astype(np.uint64), rng.integers(-50, 50, 2_000)
    key[:200] = 301
    a, b, many, member = setjoin.key_groups(key, node)
    rows = {k: {x for y, x in zip(key.tolist(), node.tolist(), strict=True) if y == k} for k in set(key.tolist())}
    few = {k: own for k, own in rows.items() if len(own) <= setjoin.FEW}
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == {(x, y) for own in few.values() for x in own for y in own if x < y}
    assert sorted(zip(many.tolist(), member.tolist(), strict=True)) == sorted((k, x) for k, own in rows.items() if k not in few for x in own)
    assert not any(len(x) for x in setjoin.key_groups(key[:0], node[:0]))
    assert setjoin.unpacked(setjoin.packed(node)).tolist() == [x & (2**48 - 1) for x in node.tolist()]
    assert setjoin.key_in((1 << 17) + 5, np.array([7], np.uint64)).tolist() == [(5 << 48) + 7]


def test_chains_become_groups_of_all_their_nodes():
    rng = np.random.default_rng(7)
    key, node = rng.integers(0, 20, 600).astype(np.uint64), rng.integers(-90, 90, 600)
    size = 5 + 40 * (node % 3) + node % 5
    own = key, node, size, np.zeros(600, np.int64), THRESHOLD
    group, member = line_dedup.chain_groups(*own)
    groups = {}
    for g, x in zip(group.tolist(), member.tolist(), strict=True):
        groups.setdefault(g, set()).add(x)
    assert min(map(len, groups.values())) > 1 and len(groups) > 20
    for k in range(20):
        nodes = sorted(set(node[key == k].tolist()))
        for a, b in ((a, b) for a in nodes for b in nodes if a < b):
            small, large = sorted(5 + 40 * (x % 3) + x % 5 for x in (a, b))
            assert 5 * small < 4 * large or any({a, b} <= x for x in groups.values())
    none = line_dedup.chain_groups(*(x[:0] for x in own[:4]), THRESHOLD)
    assert not len(none[0]) and not len(none[1])
