"""Operator 10: benchmark decontamination by canonical templates.

Texts are read as words. Numbers, names and units become typed placeholders (a name is a
capitalised word that does not begin a sentence), all other words are lower-cased; what a
placeholder stands for is its slot value. Windows of template words of the benchmark
items are hash-joined with those of the documents. The matches of one document and item
are then aligned, and the slots must be consistent: along an alignment a value of the item
always stands for the same value of the document and the other way round. So copies are
caught word by word, and so are questions that were only given other numbers or names.
Every text is read in several ways (``readings``), and a match in one of them is enough.
Documents are read in batches (``_Batch``): a table knows each token once, and the readings
and their window hashes are array operations on token numbers. Before that, a scan of the
bytes alone leaves out texts that cannot match: a text that holds an item has, from some of
its windows, a stretch of plain words and so their ASCII letters in the same order (``Keys``).

The map tasks pass on only windows whose hash is in a bounded bitmap of the benchmark's;
the join that follows is exact.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refillscope.llm.setjoin import runs_of
from refillscope.llm.shared import in_bitmap, materialise, membership_bitmap, partitions
from refillscope.llm.shingles import mix, word_hashes

DEFAULT_WINDOW = 8
# Share of an item's windows that a document must hold.
DEFAULT_COVERAGE = 0.8
# Least number of words of a window that are not placeholders.
PLAIN_WORDS = 4

# Words that count as units of measure or currency.
UNIT_WORDS = frozenset(
    "mm cm m km inch inches ft feet yard yards mile miles mg g kg ton tons lb lbs oz ml l litre litres liter liters gallon "
    "gallons ms s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years % percent "
    "$ € £ dollar dollars euro euros cent cents usd eur gbp °c °f celsius fahrenheit kmh mph w kw kwh v hz khz mhz ghz kb mb gb tb".split()
)
# Readings of a text.
TEMPLATE, CASELESS, LITERAL, RENAMED = range(4)
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"

_TOKEN = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*|[.!?]+|\n|[+-]?\d+(?:[.,:/]\d+)*|[%$€£]|°[cfCF]\b")
# Stretches that a task remembers, and documents that are read together.
_REMEMBERED = 150_000
_STEP = 200
_SIGNS = frozenset("+-*/=<>^×÷−")
_DIGIT = re.compile(r"[+-]?\d")


def _scan(text: str | None) -> tuple[list[str], list[str], list[bool], list[str]]:
    """Template words, slot values, whether a word begins a sentence with a capital letter, and the words as they are."""
    words, values, capital, literal, begins = [], [], [], [], True
    end, number = 0, False
    for found in _TOKEN.finditer(text or ""):
        token = found.group()
        lower = token.lower()
        if token[0] in ".!?\n":
            begins = True
            end = found.end()
            continue
        capital.append(begins and token[0].isupper())
        is_number = bool(_DIGIT.match(token))
        if is_number:
            words.append(NUMBER)
            values.append(lower)
        elif lower in UNIT_WORDS:
            words.append(UNIT)
            values.append(lower)
        elif token[0].isupper() and not begins:
            words.append(NAME)
            values.append(lower)
        else:
            words.append(lower)
            values.append("")
        sign = "".join(c for c in text[end : found.start()] if c in _SIGNS) if number or is_number and literal else ""
        literal.append(sign + lower)
        end, number = found.end(), is_number
        begins = False
    return words, values, capital, literal


def template(text: str | None) -> tuple[list[str], list[str]]:
    """Template words of a text and, at the same places, the slot values (empty for a plain word)."""
    return _scan(text)[:2]


def readings(text: str | None) -> dict[int, tuple[list[str], list[str], list[int]]]:
    """Words, slot values and places in the template of each reading of a text.

    ``TEMPLATE`` is ``template``. ``CASELESS`` has names as plain words, so that letter case does not matter.
    ``LITERAL`` has all words as they are, signs between numbers included, and no slots.
    ``RENAMED`` takes every capitalised word for a name, at the beginning of a sentence too, and a run of them for one.
    """
    words, values, capital, literal = _scan(text)
    places = list(range(len(words)))
    plain = [v if w == NAME else w for w, v in zip(words, values, strict=True)]
    slots = ["" if w == NAME else v for w, v in zip(words, values, strict=True)]
    found = {TEMPLATE: (words, values, places), CASELESS: (plain, slots, places)}
    found[LITERAL] = (literal, [""] * len(words), places)
    renamed, own, at = [], [], []
    for k, (word, value, first) in enumerate(zip(words, values, capital, strict=True)):
        name = word == NAME or first and value == ""
        if name and not first and renamed and renamed[-1] == NAME:
            own[-1] += " " + value
            continue
        renamed.append(NAME if name else word)
        own.append((value or word) if name else value)
        at.append(k)
    found[RENAMED] = (renamed, own, at)
    return found


def _hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))


def _rolled(hashes: np.ndarray, width: int, reading: int) -> np.ndarray:
    """Hash of each window of ``width`` word hashes."""
    rolled = np.zeros(len(hashes) - width + 1, dtype=np.uint64)
    for k in range(width):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - width + 1 + k]
    return mix(rolled + np.uint64(width + (reading << 32))).view(np.int64)


def window_hashes(words: list[str], width: int, reading: int = TEMPLATE) -> np.ndarray:
    """Hash of each window of ``width`` template words; of all words if there are fewer."""
    if not words:
        return np.zeros(0, dtype=np.int64)
    return _rolled(np.array([_hash(w) for w in words], dtype=np.uint64), min(width, len(words)), reading)


def _plain_enough(values: list[str], width: int) -> np.ndarray:
    plain = np.concatenate([[0], np.cumsum([v == "" for v in values])])
    width = min(width, len(values))
    return (plain[width:] - plain[: len(plain) - width]) >= min(PLAIN_WORDS, width)


def consistent(item_values: list[str], doc_values: list[str]) -> bool:
    """Whether values at the same places are mapped one to one."""
    there, back = {}, {}
    return all(
        there.setdefault(a, b) == b and back.setdefault(b, a) == a
        for a, b in zip(item_values, doc_values, strict=True)
        if a or b
    )


#: What separates runs of ASCII letters (words are in lower case).
_NO_LETTER = np.ones(256, dtype=bool)
_NO_LETTER[ord("a") : ord("z") + 1] = False
# Letter runs of a key at most. Kinds of windows without a key: any text, or any but an ASCII one, may hold them.
_KEY_RUNS = 6
# The upper bits of a key begin there, and their bitmap has so many bits a key.
_UPPER, _SPARSE = 32, 4096
_ANY_TEXT, _NOT_ASCII = -1, 0
# The characters beyond ASCII that have an ASCII letter in lower case.
_LOWER_TO_ASCII = re.compile("[\u0130\u212a]")


def _grams(hashes: np.ndarray, count: int) -> np.ndarray:
    return _rolled(hashes, count, -1 - count & 0xFF)


def key_of(words: list[str], values: list[str], reading: int) -> tuple[int, int]:
    """Number of letter runs of the window's key, and its hash.

    The key is the stretch of adjacent plain words with the most runs of ASCII letters, cut
    at ``_KEY_RUNS``. A text that holds the window has these runs in a row: words that are
    equal in lower case have the same, and nothing but words has any letters.
    """
    if reading == LITERAL:
        return _ANY_TEXT, 0
    stretches, open_ = [], False
    for word, value in zip(words, values, strict=True):
        if value == "":
            if not open_:
                stretches.append([])
            stretches[-1].append(word)
        open_ = value == ""
    hashes, _ = word_hashes(["\n".join(s) for s in stretches], _NO_LETTER)
    counts = [len(word_hashes(["\n".join(s)], _NO_LETTER)[0]) for s in stretches]
    if not sum(counts):
        return _NOT_ASCII, 0
    best = int(np.argmax(counts))
    start, size = sum(counts[:best]), min(_KEY_RUNS, counts[best])
    return size, int(_grams(hashes[start : start + size], size)[0])


class Keys:
    """The keys of all windows: which texts can hold any of them.

    ``bitmap`` has the low bits of the keys, ``sparse`` the upper ones with so many bits a key
    that of a text's hundreds of stretches hardly any is let through by chance.
    """

    def __init__(self, sizes: list[int], bitmap: Broadcast, sparse: Broadcast):
        self.sizes, self.bitmap, self.sparse = sorted(s for s in sizes if s > 0), bitmap, sparse
        self.any_text, self.not_ascii = _ANY_TEXT in sizes, _NOT_ASCII in sizes

    def candidates(self, texts: list[str | None]) -> list[int]:
        if self.any_text:
            return [k for k, t in enumerate(texts) if t]
        hashes, counts = word_hashes(texts, _NO_LETTER)
        owner, found = np.repeat(np.arange(len(texts)), counts), np.zeros(len(texts), bool)
        for size in self.sizes:
            if len(hashes) >= size:
                first, grams = owner[: len(hashes) - size + 1], _grams(hashes, size)
                likely = np.flatnonzero((first == owner[size - 1 :]) & in_bitmap(self.bitmap.value, grams))
                likely = likely[in_bitmap(self.sparse.value, grams[likely] >> _UPPER)]
                found[first[likely]] = True
        for k in np.flatnonzero(~found).tolist():
            if texts[k] and not texts[k].isascii():
                found[k] = self.not_ascii or bool(_LOWER_TO_ASCII.search(texts[k]))
        return np.flatnonzero(found).tolist()


def chosen_keys(keys: list[tuple[int, int]], coverage: float) -> list[tuple[int | None, int | None]]:
    """The keys that are enough to find an item's texts; the others become null.

    A text may lack a share of ``1 - coverage`` of the windows. So it holds one of any more of
    them: those with the longest keys are taken.
    """
    enough = min(len(keys), int((1 - coverage) * len(keys) + 1e-9) + 1)
    best = set(sorted(range(len(keys)), key=lambda k: -keys[k][0])[:enough])
    return [key if k in best else (None, None) for k, key in enumerate(keys)]


def _item_windows(width: int, coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if item is None:
                    continue
                any_window = False
                for reading, (words, values, _) in readings(text).items():
                    if not words:
                        continue
                    if reading == LITERAL and any_window:
                        continue  # for items without other windows
                    hashes, size = window_hashes(words, width, reading), min(width, len(words))
                    enough = _plain_enough(values, width)
                    if reading == RENAMED and (len(words) < width or 2 * sum(enough) < len(enough)):
                        continue  # too little is left to tell it from other texts
                    any_window |= bool(enough.any())
                    good = np.flatnonzero(enough).tolist()
                    keys = chosen_keys([key_of(words[k : k + size], values[k : k + size], reading) for k in good], coverage)
                    rows += [(int(hashes[k]), item, k, len(good), values[k : k + size], reading, *key) for k, key in zip(good, keys, strict=True)]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 8
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.int32(), pa.int32(), pa.int64())
            names = ["hash", "item_id", "place", "windows", "item_values", "reading", "key_runs", "key"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


class _Tokens(dict):
    """Numbers of the tokens of each stretch between blanks; by number, the token, its kind, capital letter and word hash."""

    WORD, NUMBER, UNIT, BREAK = range(4)

    def __init__(self):
        super().__init__()
        self._number: dict[str, int] = {}
        self.names: list[str] = []
        self.kind, self.upper, self.hash = array("b"), array("b"), array("Q")

    def __missing__(self, stretch: str) -> tuple[int, ...]:
        if stretch.isalpha():
            numbers = (self._of(stretch),)
        else:
            numbers = tuple([self._of(token) for token in _TOKEN.findall(stretch)])
        self[stretch] = numbers
        return numbers

    def _of(self, token: str) -> int:
        at = self._number.get(token)
        if at is not None:
            return at
        at = self._number[token] = len(self.names)
        self.names.append(token)
        lower = token.lower()
        if token[0] in ".!?\n":
            kind, value = self.BREAK, 0
        elif _DIGIT.match(token):
            kind, value = self.NUMBER, _hash(NUMBER)
        elif lower in UNIT_WORDS:
            kind, value = self.UNIT, _hash(UNIT)
        else:
            kind, value = self.WORD, _hash(lower)
        self.kind.append(kind)
        self.upper.append(token[0].isupper())
        self.hash.append(value)
        return at


class _Batch:
    """The readings of several texts, one text after the other: word hashes, and the text of each word."""

    def __init__(self, texts: list[str | None], tokens: _Tokens):
        # No token holds a blank, and a line end is one of its own.
        found = [list(chain.from_iterable(map(tokens.__getitem__, t.replace("\n", " \n ").split(" ")))) if t else [] for t in texts]
        ids = np.fromiter(chain.from_iterable(found), np.int64)
        self.ids, self.names = ids, tokens.names
        kinds, uppers, values = np.array(tokens.kind), np.array(tokens.upper).astype(bool), np.array(tokens.hash, dtype=np.uint64)
        text = np.repeat(np.arange(len(texts)), [len(f) for f in found])
        kind = kinds[ids]
        begins = np.ones(len(ids), bool)
        begins[1:] = (text[1:] != text[:-1]) | (kind[:-1] == tokens.BREAK)
        #: The token of each template word.
        self.token = np.flatnonzero(kind != tokens.BREAK)
        kind, upper, begins, text = kind[self.token], uppers[ids[self.token]], begins[self.token], text[self.token]
        hashes = values[ids[self.token]]
        name = (kind == tokens.WORD) & upper & ~begins
        self.slot = {CASELESS: kind != tokens.WORD}
        self.slot[TEMPLATE] = self.slot[CASELESS] | name
        named = np.uint64(_hash(NAME))
        renamed = name | (kind == tokens.WORD) & upper
        goes_on = np.zeros(len(kind), bool)
        goes_on[1:] = renamed[1:] & ~(begins & upper)[1:] & renamed[:-1] & (text[1:] == text[:-1])
        kept = np.flatnonzero(~goes_on)
        whole = np.arange(len(kind))
        self.slot[RENAMED] = self.slot[CASELESS] | renamed
        #: Of each reading: the hash, the text and the template word of each word.
        self.words = {
            TEMPLATE: (np.where(name, named, hashes), text, whole),
            CASELESS: (hashes, text, whole),
            RENAMED: (np.where(renamed, named, hashes)[kept], text[kept], kept),
        }
        self.first = np.searchsorted(text, np.arange(len(texts)))

    def hits(self, reading: int, size: int, bitmap: np.ndarray) -> Iterator[tuple[int, int, int, list[str], list[int]]]:
        """Windows in the bitmap: hash, text, first word, slot values, and places in the template."""
        hashes, text, place = self.words[reading]
        if len(hashes) < size:
            return
        windows = _rolled(hashes, size, reading)
        inside = text[: len(windows)] == text[size - 1 :]
        ends = np.append(place[1:], len(self.token))
        for at in np.flatnonzero(inside & in_bitmap(bitmap, windows)).tolist():
            own = int(text[at])
            values = [
                " ".join(self.names[self.ids[self.token[k]]].lower() for k in range(place[w], ends[w] if reading == RENAMED else place[w] + 1))
                if self.slot[reading][place[w]]
                else ""
                for w in range(at, at + size)
            ]
            start = int(np.searchsorted(text, own))
            yield int(windows[at]), own, at - start, values, (place[at : at + size] - self.first[own]).tolist()


def _literal_hits(texts: list[str | None], size: int, bitmap: np.ndarray) -> Iterator[tuple[int, int, int, list[str], list[int]]]:
    for own, text in enumerate(texts):
        words, values, places = readings(text)[LITERAL]
        if size <= len(words):
            hashes = window_hashes(words, size, LITERAL)
            for at in np.flatnonzero(in_bitmap(bitmap, hashes)).tolist():
                yield int(hashes[at]), own, at, values[at : at + size], places[at : at + size]


def _doc_windows(sizes: list[tuple[int, int]], bitmap: Broadcast, keys: Keys):
    """Windows of documents that are in the bitmap, of each ``(reading, size)`` that the items have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _Tokens()  # lives as long as the task
        for whole in batches:
            for at in range(0, whole.num_rows, _STEP):
                batch = whole.slice(at, _STEP)
                batch = batch.take(pa.array(keys.candidates(batch.column("text").to_pylist()), pa.int64()))
                texts, ids = batch.column("text").to_pylist(), batch.column("doc_id")
                if len(tokens) > _REMEMBERED:
                    tokens = _Tokens()
                read, rows, digests = _Batch(texts, tokens), [], {}
                for reading, size in sizes:
                    found = _literal_hits(texts, size, bitmap.value) if reading == LITERAL else read.hits(reading, size, bitmap.value)
                    for key, own, first, values, spots in found:
                        if own not in digests:
                            digests[own] = hashlib.md5(texts[own].encode("utf-8", "surrogatepass")).hexdigest()
                        rows.append((key, ids[own].as_py(), digests[own], first, values, reading, spots))
                columns = list(zip(*rows, strict=True)) if rows else [()] * 7
                types = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.list_(pa.string()), pa.int32(), pa.list_(pa.int32()))
                names = ["hash", "doc_id", "digest", "at", "doc_values", "reading", "spots"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


def _align(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """For each text and item the reading and alignment with the largest share of windows whose slots agree."""
    for (digest, item), pieces in runs_of(batches, ("digest", "item_id")):
        alignments: dict[tuple[int, int], dict[int, tuple]] = {}
        windows, spots = {}, {}
        ids = set()
        for piece in pieces:
            for row in piece.to_pylist():
                reading = row["reading"]
                ids.add(row["doc_id"])
                windows[reading] = row["windows"]
                spots.setdefault(reading, {}).update(enumerate(row["spots"], row["at"]))
                alignments.setdefault((reading, row["at"] - row["place"]), {})[row["place"]] = (row["item_values"], row["doc_values"])
        best = None
        judged = []
        for (reading, shift), found in sorted(alignments.items()):
            # Place in the document and slot values by place in the item: overlapping windows repeat them.
            at = {}
            for place, (a, b) in found.items():
                at |= {place + k: (place + k + shift, x, y) for k, (x, y) in enumerate(zip(a, b, strict=True))}
            entry = _judged(reading, shift, len(found), windows[reading], at, spots[reading])
            best = entry if best is None or entry > best else best
            judged.append((entry, reading, shift, len(found), at))
        judged.sort(key=lambda x: x[0], reverse=True)
        for reading in windows:
            # Words put in or left out shift what follows: alignments that go on from each other add up.
            total, parts, at, base = 0, 0, {}, None
            for entry, own, shift, n, more in judged:
                if own != reading or not entry[0] or base is not None and abs(shift - base) > width or at.keys() & more.keys():
                    continue
                joint = dict(sorted((at | more).items()))
                order = [x[0] for x in joint.values()]
                if all(x < y for x, y in zip(order, order[1:])) and consistent([x[1] for x in joint.values()], [x[2] for x in joint.values()]):
                    total, parts, at, base = total + n, parts + 1, joint, shift if base is None else base
            if parts > 1:
                best = max(best, _judged(reading, base, total, windows[reading], at, spots[reading]))
        agrees, share, _, same, _, n, start, stop = best
        row = {"item_id": item, "windows": n, "coverage": share, "slots_agree": agrees, "verbatim": same, "start_word": start, "stop_word": stop}
        yield pa.RecordBatch.from_pylist([{"doc_id": i, "digest": digest, **row} for i in ids], schema=pa.schema(_FOUND))


def _judged(reading: int, shift: int, found: int, windows: int, at: dict[int, tuple], spots: dict[int, int]) -> tuple:
    ours, theirs = [x[1] for x in at.values()], [x[2] for x in at.values()]
    places = [spots[x[0]] for x in at.values()]
    return consistent(ours, theirs), found / windows, -reading, ours == theirs, -shift, found, min(places), max(places) + 1


_FOUND = [
    ("doc_id", pa.int64()), ("digest", pa.string()), ("item_id", pa.int64()), ("windows", pa.int32()), ("coverage", pa.float64()),
    ("slots_agree", pa.bool_()), ("verbatim", pa.bool_()), ("start_word", pa.int32()), ("stop_word", pa.int32()),
]
_FOUND_SCHEMA = "doc_id long, digest string, item_id long, windows int, coverage double, slots_agree boolean, verbatim boolean, start_word int, stop_word int"


def _matches(docs: DataFrame, benchmark: DataFrame, width: int, coverage: float) -> DataFrame:
    """Texts that hold an item, by their MD5 digest, with the ids of their documents (null ids too)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = items.mapInArrow(_item_windows(width, coverage), "hash long, item_id long, place int, windows int, item_values array<string>, reading int, key_runs int, key long")
    items = materialise(items, "item-windows")
    upper = items.select(F.shiftright("key", _UPPER).alias("key"))
    runs = [r[0] for r in items.where("key_runs is not null").select("key_runs").distinct().collect()]
    keys = Keys(runs, membership_bitmap(items, "key"), membership_bitmap(upper, "key", _SPARSE))
    items = items.drop("key_runs", "key")
    # The full width and those of short items: no more than the window is wide, in each reading.
    sizes = sorted(tuple(r) for r in items.select("reading", F.size("item_values").alias("n")).distinct().collect())
    bitmap = membership_bitmap(items, "hash")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "hash long, doc_id long, digest string, at int, doc_values array<string>, reading int, spots array<int>"
    found = texts.mapInArrow(_doc_windows(sizes, bitmap, keys), schema)
    matches = found.join(items, ["hash", "reading"]).where(F.size("doc_values") == F.size("item_values"))
    matches = matches.repartition(partitions(spark), "digest", "item_id").sortWithinPartitions("digest", "item_id")
    pairs = matches.mapInArrow(lambda batches: _align(batches, width), _FOUND_SCHEMA)
    return pairs.where(F.col("slots_agree") & (F.col("coverage") >= coverage))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, width: int = DEFAULT_WINDOW, coverage: float = DEFAULT_COVERAGE
) -> DataFrame:
    """Pairs of a document and a benchmark item it holds.

    ``doc_id, item_id, windows, coverage, slots_agree, verbatim, start_word, stop_word``: the
    windows of the best alignment, their share of the item's, whether all slot values are
    those of the item, and where in the document's template the match lies. A pair is
    returned when the slots agree and the coverage is reached. An item of fewer words than a
    window is one window of its own length, and one of fewer than ``PLAIN_WORDS`` words has
    to match as a whole. Windows with fewer plain words than ``PLAIN_WORDS`` do not count.
    Reads ``doc_id, text`` and ``item_id, text`` alone; null or empty texts and null ids
    match nothing. Each text is judged on its own: repeated rows count once, and of several
    texts under one ``doc_id`` the best match is told. Empty inputs give an empty result.
    """
    found = _matches(docs, benchmark, width, coverage).where("doc_id is not null")
    rest = ("windows", "slots_agree", "verbatim", "start_word", "stop_word")
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", "digest", *rest)).alias("best"))
    return best.select("doc_id", "item_id", "best.windows", "best.coverage", *[f"best.{c}" for c in rest[1:]])


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, width: int = DEFAULT_WINDOW, coverage: float = DEFAULT_COVERAGE
) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item; all columns stay as they are.

    Rows go by their text, so those without an id go too, and a row stays if only another
    text under its ``doc_id`` holds an item.
    """
    gone = _matches(docs, benchmark, width, coverage).select(F.col("digest").alias("_leak")).distinct()
    gone = materialise(gone, "contaminated")
    return docs.join(gone, F.md5(docs["text"].cast("binary")) == gone["_leak"], "left_anti")
