"""Operator 5 against plain grouping, with colliding keys, and its directory."""

import hashlib
import re

from llm_helpers import SF_SMALL, as_rows, documents
from refillscope.llm.exact_index import build_directory, exact_duplicates


def brute_force(rows):
    plain = [re.sub("[A-Z]", lambda m: m.group().lower(), t or "") for _, t in rows]
    out = []
    for (doc, _), text in zip(rows, plain):
        ids = [d for (d, _), t in zip(rows, plain) if t == text]
        keep = max((d for d in ids if d is not None), default=None)
        out.append((doc, keep, len(ids), doc == keep, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert as_rows(exact_duplicates(docs, entries=8)) == brute_force(rows)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "Ä x"), (4, "ä x"), (5, "Ä X"), (6, "long " * 50_000), (7, "LONG " * 50_000), (None, "q"), (None, "q"), (None, "r"), (8, "r"), (9, "z"), (9, "z")]
    docs = documents(spark, rows).withColumnsRenamed({"lang": "key", "source": "digest", "n_chars": "bucket"})
    assert as_rows(exact_duplicates(docs)) == brute_force(rows)
    assert as_rows(exact_duplicates(documents(spark, []))) == []


def test_colliding_keys_are_told_apart_by_bytes(spark):
    rows = [(i, f"text {i % 7}") for i in range(60)]
    assert as_rows(exact_duplicates(documents(spark, rows), hasher=lambda raw: len(raw))) == brute_force(rows)


def test_directory_splits_overfull_buckets():
    assert set(build_directory({}, 4, 6)) == {0}
    used = {i: 1 for i in range(16)} | {40: 100}
    directory = build_directory(used, 4, 6)
    held = {}
    for prefix, n in used.items():
        held.setdefault(directory[prefix], []).append(n)
    assert directory == sorted(directory)  # contiguous ranges
    assert all(sum(v) <= 4 or len(v) == 1 for v in held.values())
