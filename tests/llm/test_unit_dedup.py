"""Operator 9 against a plain-Python restatement, and removal by offsets."""

from llm_helpers import SF_SMALL, as_rows, documents
from refillscope.llm.unit_dedup import UNITS, normalise, remove_spans, repeated_units


def brute_force(rows, kinds=("line", "sentence"), min_words=8):
    groups = {}
    for doc, text in rows:
        for kind in kinds:
            for m in UNITS[kind].finditer(text or "") if doc is not None else ():
                plain = normalise(m.group())
                if len(plain.split()) >= min_words:
                    groups.setdefault((kind, plain), []).append((doc, *m.span()))
    out = []
    for (kind, _), places in groups.items():
        places.sort()
        out += [(doc, kind, a, b, places[0][0], len(places)) for doc, a, b in places[1:]]
    return sorted(out, key=repr)


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert as_rows(repeated_units(docs)) == brute_force(rows)


def test_paragraphs(spark):
    para = "One two three four.\nFive six seven eight nine"
    rows = [(1, f"x\n\n{para}\n\ny"), (2, f"{para}\n"), (3, para.upper().replace(" ", "  "))]
    found = as_rows(repeated_units(documents(spark, rows), ("paragraph",)), "doc_id", "keep_doc_id")
    assert found == [(2, 1), (3, 1)]


def test_edge_cases_and_removal(spark):
    same = "One, two three four five six seven eight!"
    long = " ".join("x%d" % i for i in range(20_000))
    rows = [(1, None), (2, ""), (3, f"é {same}"), (4, f"ö. {same} And more of it"), (5, f"{same}\n{same}\nrest"), (None, same), (6, long), (7, long), (8, "a b c")]
    docs = documents(spark, rows).withColumnsRenamed({"lang": "_spans", "source": "unit"})
    spans = repeated_units(docs)
    assert as_rows(spans, "doc_id", "unit", "start", "stop", "keep_doc_id") == [
        (5, "line", 0, 41, 5, )[:5], (5, "line", 42, 83, 5), (5, "sentence", 0, 41, 4), (5, "sentence", 42, 83, 4), (7, "line", 0, len(long), 6),
        (7, "sentence", 0, len(long), 6),
    ][1:]
    out = dict(as_rows(remove_spans(docs, spans), "doc_id", "text"))
    assert out[5] == "\n\nrest" and out[7] == "" and out[4] == rows[3][1] and out[1] is None
    assert remove_spans(docs, spans).columns == docs.columns
    assert as_rows(repeated_units(documents(spark, []))) == []
