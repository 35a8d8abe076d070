"""Operator 1: every id lies in exactly one piece and sequences are gapless, against plain encoding."""

import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_helpers import SF_SMALL, documents
from refillscope.llm import tokens
from refillscope.llm.packing import cut, pack_documents, plan_rest
from refillscope.llm.tokens import default_tokenizer, encoder, token_bytes

TOKENIZER = Tokenizer.from_file(default_tokenizer())


def ids_of(text):
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")


def check_packing(rows, texts):
    """rows of pack_documents for texts by doc_id; returns the share of padding."""
    per_doc, per_sequence = {}, {}
    for r in rows:
        per_doc.setdefault(r["doc_id"], []).append(r)
        per_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert per_doc.keys() == texts.keys()
    for doc, own in per_doc.items():
        ids, at = ids_of(texts[doc]), 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    used = 0
    for own in per_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
        used += at
    assert sorted(per_sequence) == list(range(len(per_sequence)))
    return 1 - used / (4096 * len(per_sequence))


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert check_packing(pack_documents(docs).collect(), texts) < 0.02


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "word " * 9000), (4, "Ünï cöde x\x1cy  z\t\r\n'S 12345 <|endoftext|> Σς ﬁ"), (5, " "), (6, "x" * 20_000)]
    assert check_packing(pack_documents(documents(spark, rows)).collect(), dict(rows)) < 1
    assert pack_documents(documents(spark, [])).collect() == []
    twice = documents(spark, [(7, "a b"), (7, "a b"), (None, "c")]).withColumnsRenamed({"lang": "length", "source": "_rank"})
    found = pack_documents(twice).collect()
    assert len(found) == len({(r["sequence_id"], r["offset"]) for r in found})
    assert sorted((r["doc_id"] is None, r["doc_tokens"]) for r in found if r["start"] == 0) == [(False, 3), (False, 3), (True, 2)]


odd = st.text(st.sampled_from("abAB'sStT.,!?-_<|>%$12 éÉßſΣİ\u0301\u200d\u0130\u2167\n\x1c") , max_size=14)


@given(st.one_of(st.text(max_size=60), odd))
@settings(max_examples=2000, deadline=None)
def test_chunks_give_the_tokenizer_s_ids(text):
    assert token_bytes(text, encoder(default_tokenizer())) == ids_of(text)[:-1].tobytes()


def test_cut_and_plan():
    lengths = set()
    for n in range(1, 10_000):
        pieces = cut(n, 4096)
        assert sum(pieces) == n and max(pieces) <= 4096 and len(pieces) <= 2 + 5
        lengths.update(pieces)
    assert len(lengths) <= 128
    rng = random.Random(3)
    left = {x: rng.randrange(0, 4096 // x) for x in lengths}
    bins = plan_rest(left, 4096)
    placed = {}
    for own in bins:
        assert sum(a * n for a, n in own) <= 4096
        for a, n in own:
            placed[a] = placed.get(a, 0) + n
    assert placed == {a: n for a, n in left.items() if n}
    total = sum(a * n for a, n in left.items())
    assert len(bins) <= 1.02 * total / 4096 + 1


def test_chunks_that_come_once_do_not_fill_the_memory(monkeypatch):
    """A worker remembers few chunks that came once; those that come again stay, and all ids are the tokenizer's."""
    monkeypatch.setattr(tokens, "_REMEMBERED", 10)
    monkeypatch.setattr(tokens, "_ONCE", 20)
    chunks = tokens._Chunks(default_tokenizer())
    rare = [f"w{i}x," for i in range(300)]
    text = "  ".join(f"the {word} Cat" for word in rare)
    assert token_bytes(text, chunks) == ids_of(text)[:-1].tobytes()
    assert len(chunks) <= 10 and len(chunks._before) <= 10 and len(chunks._once) <= 20
    assert {"the", "Cat", ""} <= set(chunks) | set(chunks._before)
