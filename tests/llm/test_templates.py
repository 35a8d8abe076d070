"""Operator 10 against a brute-force comparison, and re-parameterised questions."""

import random

import numpy as np

from llm_helpers import SF_SMALL, as_rows, documents
from refillscope.llm.templates import (
    CASELESS,
    LITERAL,
    NAME,
    NUMBER,
    PLAIN_WORDS,
    RENAMED,
    TEMPLATE,
    UNIT,
    Keys,
    _Batch,
    _Tokens,
    consistent,
    contaminated,
    decontaminate,
    key_of,
    readings,
    template,
    window_hashes,
)


def brute_force(docs, items, width=8, coverage=0.8):
    pairs = []
    parsed = [(i, *template(t)) for i, t in items]
    for doc, text in docs:
        words, values = template(text)
        for item, own, own_values in parsed:
            size = min(width, len(own))
            spots = [k for k in range(len(own) - size + 1) if size and sum(v == "" for v in own_values[k : k + size]) >= min(PLAIN_WORDS, size)]
            best = 0
            for shift in range(-len(own), len(words)):
                hit = [k for k in spots if 0 <= k + shift and words[k + shift : k + shift + size] == own[k : k + size]]
                used = sorted({p for k in hit for p in range(k, k + size)})
                if hit and consistent([own_values[p] for p in used], [values[p + shift] for p in used]):
                    best = max(best, len(hit))
            if spots and best and best / len(spots) >= coverage:
                pairs.append((doc, item))
    return sorted(pairs, key=repr)


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_templates():
    words, values = template("Then Mary bought 3.5 kg of apples, for 12 dollars. Mary ate 3.5.")
    assert words == ["then", NAME, "bought", NUMBER, UNIT, "of", "apples", "for", NUMBER, UNIT, "mary", "ate", NUMBER]
    assert values[1] == "mary" and values[3] == "3.5" and values[10] == ""
    assert consistent(["a", "", "b", "a"], ["x", "", "y", "x"])
    assert not consistent(["a", "a"], ["x", "y"]) and not consistent(["a", "b"], ["x", "x"])


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute_force(rows, [tuple(r) for r in items.select("item_id", "text").collect()])
    assert want and as_rows(contaminated(docs, items), "doc_id", "item_id") == want
    kept = {r["doc_id"] for r in decontaminate(docs, items).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in want}


QUESTION = "If Mary has 12 apples and gives 5 apples to John while 12 stay in the box how many does she have"


def test_new_numbers_and_names_are_caught_only_if_consistent(spark):
    again = QUESTION.replace("Mary", "Alice").replace("John", "Bob").replace("12", "30").replace("5", "7")
    broken = QUESTION.replace("12 apples", "31 apples").replace("5", "7")
    docs = documents(spark, [(1, f"Some words. {QUESTION}? more"), (2, f"x y {again} z"), (3, broken), (4, "If Mary has nothing")])
    found = as_rows(contaminated(docs, benchmark(spark, [(9, QUESTION)])), "doc_id", "item_id", "verbatim")
    assert found == [(1, 9, True), (2, 9, False)]


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, QUESTION), (3, QUESTION.lower()), (3, QUESTION.lower()), (4, "a short one here now"), (5, "w " * 50_000 + "a short one here")]
    docs = documents(spark, rows).withColumnsRenamed({"lang": "hash", "source": "item_id", "n_chars": "at"})
    items = benchmark(spark, [(1, "a short one here"), (2, None), (3, ""), (None, QUESTION), (4, "5 6 7"), (1, "a short one here")])
    assert as_rows(contaminated(docs, items), "doc_id", "item_id") == [(4, 1), (5, 1)]
    assert decontaminate(docs, items).columns == docs.columns
    assert as_rows(contaminated(documents(spark, []), items)) == []
    assert as_rows(contaminated(docs, benchmark(spark, []))) == []
    assert decontaminate(docs, benchmark(spark, [])).count() == len(rows)


def every_reading(docs, items, width=8, coverage=0.8):
    """Pairs that a single alignment of some reading finds, by all shifts."""
    pairs = set()
    for item, text in items:
        views, any_window = readings(text), False
        for reading in (TEMPLATE, CASELESS, LITERAL, RENAMED):
            own, own_values, _ = views[reading]
            size = min(width, len(own))
            spots = [k for k in range(len(own) - size + 1) if size and sum(v == "" for v in own_values[k : k + size]) >= min(PLAIN_WORDS, size)]
            if reading == LITERAL and any_window:
                continue
            if reading == RENAMED and (len(own) < width or 2 * len(spots) < len(own) - size + 1):
                continue
            any_window |= bool(spots)
            for doc, whole in docs:
                words, values, _ = readings(whole)[reading]
                for shift in range(-len(own), len(words)):
                    hit = [k for k in spots if 0 <= k + shift and words[k + shift : k + shift + size] == own[k : k + size]]
                    used = sorted({p for k in hit for p in range(k, k + size)})
                    if spots and len(hit) / len(spots) >= coverage and consistent([own_values[p] for p in used], [values[p + shift] for p in used]):
                        pairs.add((doc, item))
    return sorted(pairs)


def rewritten(text, rng):
    """The item as it is, in another case, with other names or numbers, or with a word changed."""
    kind = rng.randrange(7)
    if kind == 0:
        return text.upper()
    if kind == 1:
        return text.lower()
    if kind == 2:
        return text.replace("Mary", "Alice").replace("Peter", "Mary")
    if kind == 3:
        return text.replace("Mary", "Anna Lee")
    if kind == 4:
        return text.replace("12", "40").replace("5", "9")
    if kind == 5:
        words = text.split()
        words[rng.randrange(len(words))] = "other"
        return " ".join(words)
    return text


ITEMS = [
    (1, "Mary has 12 apples and gives 5 apples to Peter while 12 stay in the box. Mary then eats one of them. How many does Peter have?"),
    (2, "Calculate 144 / 12 + 7 * 3 - 50 % 8"),
    (3, "A train goes 12 km in 5 minutes and then stops for a while before Mary gets on it with Peter and the dog"),
    (4, "short item"),
]


def test_all_readings_against_brute_force(spark):
    rng = random.Random(7)
    docs = []
    for k in range(120):
        item = rng.choice(ITEMS)[1]
        docs.append((k, f"{rng.choice(['', 'Some words before. ', 'x '])}{rewritten(item, rng)}{rng.choice(['', ' and more after it.'])}"))
    got = set(as_rows(contaminated(documents(spark, docs), benchmark(spark, ITEMS)), "doc_id", "item_id"))
    want = set(every_reading(docs, ITEMS))
    assert len(want) > 60 and want <= got
    # What joined alignments add: an item with one word or one run of names changed.
    texts = dict(docs)
    assert all("other" in texts[d] or "Anna Lee" in texts[d] or "ANNA" in texts[d] for d, _ in got - want)


def test_batches_read_as_single_texts():
    rng = random.Random(3)
    parts = ["Mary", "mary", "12", "3.5", "km", "KM", "Kg", "the", "The", ".", "!", "\n", "+4", "-7", "Ann", "O'Neil", "$", "°C", "Été", "ß", "İx", "and", ",", "a-b", "%", "x.Y", "\t"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(300)] + ["", None, " ", "...", "A", "A B. C D"]
    everything = np.full(1 << 10, ~np.uint64(0), dtype=np.uint64)
    read = _Batch(texts, _Tokens())
    for reading in (TEMPLATE, CASELESS, RENAMED):
        for size in (8, 3, 1):
            want = []
            for own, text in enumerate(texts):
                words, values, places = readings(text)[reading]
                for k, h in enumerate(window_hashes(words, size, reading).tolist() if size <= len(words) else []):
                    want.append((h, own, k, values[k : k + size], places[k : k + size]))
            assert sorted(read.hits(reading, size, everything)) == sorted(want)


def test_texts_of_one_id_are_judged_apart(spark):
    first, second = QUESTION[: len(QUESTION) // 2], QUESTION[len(QUESTION) // 2 :]
    rows = [(1, first), (1, second), (2, first), (3, QUESTION), (3, "nothing here"), (None, QUESTION), (None, "nothing here")]
    docs, items = documents(spark, rows), benchmark(spark, [(9, QUESTION)])
    assert as_rows(contaminated(docs, items), "doc_id", "item_id", "coverage") == [(3, 9, 1.0)]
    kept = as_rows(decontaminate(docs, items), "doc_id", "text")
    assert kept == sorted([r for r in rows if r[1] != QUESTION], key=repr)


def test_other_widths_join_alignments(spark):
    words = ["w" + chr(97 + k // 8) + chr(97 + k % 8) for k in range(52)]
    words, put_in = words[:40], words[40:]
    other = [*words[:20], *put_in, *words[20:]]
    docs, items = documents(spark, [(1, " ".join(other))]), benchmark(spark, [(9, " ".join(words))])
    assert as_rows(contaminated(docs, items, width=8, coverage=0.75), "doc_id") == []  # the parts lie 12 words apart
    assert as_rows(contaminated(docs, items, width=12, coverage=0.55), "doc_id") == [(1,)]


def test_texts_that_hold_a_window_are_candidates():
    """For any window and any text that has it, in any reading, the text's letters have the window's key."""
    rng = random.Random(11)
    parts = ["Mary", "mary", "12", "km", "KM", "the", "The", ".", "\n", "Ann", "O'Neil", "don't", "Été", "été", "İx", "K", "a-b", "x_y", "foo123bar", "привет", "—", "ß"]
    texts = [rng.choice([" ", "  ", "—", "_"]).join(rng.choice(parts) for _ in range(rng.randrange(6, 25))) for _ in range(200)]
    texts += [t.upper() for t in texts] + [t.lower() for t in texts] + ["x ".join(t.split("12")) + " Mary" for t in texts]
    by_window = {}
    for k, text in enumerate(texts):
        for reading in (TEMPLATE, CASELESS, RENAMED):
            words, values, _ = readings(text)[reading]
            for at, h in enumerate(window_hashes(words, 6, reading).tolist() if len(words) >= 6 else []):
                if sum(v == "" for v in values[at : at + 6]) >= PLAIN_WORDS:
                    by_window.setdefault(h, []).append((k, words[at : at + 6], values[at : at + 6], reading))

    class Bitmap:
        def __init__(self, key):
            self.value = np.zeros(1 << 10, np.uint64)
            slot = key & 0xFFFF  # 2**16 bits
            self.value[slot >> 6] |= np.uint64(1 << (slot & 63))

    shared = [v for v in by_window.values() if len({k for k, *_ in v}) > 1]
    assert len(shared) > 100
    for holders in shared[:400]:
        size, key = key_of(*holders[0][1:])
        own = sorted({k for k, *_ in holders})
        assert Keys([size], Bitmap(key), Bitmap(key >> 32)).candidates([texts[k] for k in own]) == list(range(len(own))), (holders[0], [texts[k] for k in own])
