"""Operator 3 against plain counting."""

from tokenizers import Tokenizer

from llm_helpers import SF_SMALL, as_rows, documents
from refillscope.llm.length_histogram import length_histogram, length_quantiles, suffix_sums, truncated_totals
from refillscope.llm.tokens import default_tokenizer

TOKENIZER = Tokenizer.from_file(default_tokenizer())


def check(docs):
    lengths = sorted(len(TOKENIZER.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs.select("text").collect())
    histogram = length_histogram(docs)
    rows = {r["length"]: r for r in suffix_sums(histogram).collect()}
    assert sorted(rows) == sorted(set(lengths))
    for x, r in rows.items():
        more = [n for n in lengths if n >= x]
        assert (r["docs"], r["docs_at_least"], r["tokens_at_least"]) == (lengths.count(x), len(more), sum(more))
        assert r["truncated_tokens"] == sum(min(n, x) for n in lengths)
        assert (r["total_docs"], r["total_tokens"]) == (len(lengths), sum(lengths))
        assert abs(r["cumulative"] - sum(n <= x for n in lengths) / len(lengths)) < 1e-12
    limits = [0, 1, 100, 1000, 10**6]
    want = sorted((c, sum(min(n, c) for n in lengths), sum(n > c for n in lengths)) for c in limits)
    assert sorted(tuple(r) for r in truncated_totals(histogram, limits).collect()) == want
    if lengths:
        got = dict(as_rows(length_quantiles(suffix_sums(histogram), [0.5, 1.0])))
        assert got == {0.5: lengths[(len(lengths) + 1) // 2 - 1], 1.0: lengths[-1]}


def test_whole_table(spark):
    check(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b"), (4, "x y " * 20_000)]
    check(documents(spark, rows).withColumnsRenamed({"lang": "length", "source": "docs"}))
    check(documents(spark, []))
