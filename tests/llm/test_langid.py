"""Operator 2: held-out accuracy, and what it may and may not look at."""

import random
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from llm_helpers import as_rows, documents
from refillscope.llm import langid, shared, tokens
from refillscope.llm.langid import Model, fit, held_out, identified, language_report, predict, sample_rows, word_scores


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    out = [r for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert len(out) > 150 and np.mean([r["lang_pred"] == r["lang"] for r in out]) > 0.95


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    changed = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("q"))
    assert as_rows(language_report(changed)) == as_rows(language_report(docs))


def test_backoff_goes_from_words_to_shorter_grams():
    row = lambda *x: np.array(x, dtype=np.float32)
    model = Model(["a", "b"], [{"cat": row(-1, -9)}, {"<cat": row(-2, -8)}, {}, {"do": row(-3, -4)}, {"z": row(-5, -5)}])
    assert word_scores(model, "cat").tolist() == [-1, -9]
    assert np.allclose(word_scores(model, "cats"), [-0.8, -3.2])
    assert np.allclose(word_scores(model, "dog"), [-1.2, -1.6])
    assert np.allclose(word_scores(model, "zzz"), [-2, -2])
    assert word_scores(model, "ж") is None


def test_edge_cases(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(40)] + [(100 + i, "der hund und die katze", "de") for i in range(40)]
    rows += [(300, None, "en"), (301, "", "en"), (302, "12 34 -- !", "de"), (303, "мир жж", None), (304, "der hund " * 20_000, None), (None, "the dog", "xx"), (304, "the cat", None)]
    docs = documents(spark, rows).withColumnsRenamed({"source": "word", "n_chars": "level"})
    found = {(r["doc_id"], r["lang_pred"]): r["score"] for r in language_report(docs).collect()}
    assert {(300, "und"), (301, "und"), (302, "und"), (304, "de"), (304, "en"), (None, "en")} <= found.keys()
    assert found[300, "und"] == 0 and found[303, "de"] == 0.5
    model = fit(sample_rows(docs, F.lit(True)))
    kept = identified(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in kept.collect()} == {300, 301, 302, 303}
    assert language_report(documents(spark, [])).collect() == []
    assert as_rows(language_report(documents(spark, [(1, "a b", None)]))) == [(1, False, "und", 0.0)]


def test_rows_are_kept_by_their_predicted_language(spark):
    """A text between languages, in unknown letters or without any goes; one of a language stays."""
    words = {"aa": "alba alma casa rama", "bb": "kirk wyld bryk zwyk"}
    rows = [(k, " ".join(random.Random(k).choices(words[lang].split(), k=30)), lang) for k in range(40) for lang in words]
    model = fit(sample_rows(documents(spark, rows), F.lit(True)))
    mixed = " ".join(f"{a} {b}" for a, b in zip(*(words[x].split() for x in words)))
    docs = documents(spark, [(1, "alma casa"), (2, "wyld kirk bryk"), (3, mixed), (4, "привет мир"), (5, None), (6, "12 34"), (7, "")])
    score = {r["doc_id"]: r["score"] for r in predict(docs, model).collect()}
    kept = {r["doc_id"] for r in identified(docs, model).collect()}
    assert {1, 2} <= kept and not kept & {4, 5, 6, 7}
    assert (3 in kept) == (score[3] * 2 > 1.1)
    assert {r["doc_id"] for r in identified(docs, model, margin=2 * score[1]).collect()} <= {2, 3}


def test_texts_are_held_a_few_at_a_time():
    """A task gives back the chunks that its worker remembers of tokenizing, and takes and sends rows by few."""
    tables = [{"der": np.array([-1.0, -5.0], np.float32), "the": np.array([-5.0, -1.0], np.float32)}, {}, {}, {}, {}]
    sent = SimpleNamespace(value=langid.Model(["de", "en"], tables))
    tokens._ENCODERS["any"] = object()
    rows = 3 * shared.SLICE_ROWS + 7
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(rows)), "text": ["der the der", None] * (rows // 2) + ["1"] * (rows % 2)})
    found = list(langid._known(sent, 1.1)(iter([batch])))
    assert not tokens._ENCODERS
    assert max(x.num_rows for x in found) <= shared.SLICE_ROWS
    assert [i for x in found for i in x.column("doc_id").to_pylist()] == list(range(0, rows - 1, 2))


def test_a_fitted_model_is_one_array_for_each_size(spark):
    """The tables are rows of few arrays, not an array for each feature, and score as separate arrays do."""
    model = fit(documents(spark, [(k, text, lang) for k, (lang, text) in enumerate([("aa", "alma casa casa"), ("bb", "wyld kirk alma")])]).select("lang", "text"))
    assert all(isinstance(t.scores, np.ndarray) and t.scores.shape == (len(t), 2) for t in model.tables)
    loose = Model(model.languages, [{f: s.copy() for f, s in t.items()} for t in model.tables])
    for word in ("alma", "casal", "wyl", "k", "q"):
        one, other = word_scores(model, word), word_scores(loose, word)
        assert (one is None and other is None) or (one == other).all()
    counts = {"alma": (1, 1), "casa": (2, 0), "wyld": (0, 1), "kirk": (0, 1)}
    totals = np.array([3, 3]) + langid.SMOOTHING * len(counts)
    for word, own in counts.items():
        assert np.allclose(model.tables[0][word], np.log((np.array(own) + langid.SMOOTHING) / totals))
