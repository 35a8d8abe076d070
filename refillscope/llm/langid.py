"""Operator 2: language identification by known words, backing off to character n-grams.

A word that the model knows is scored by its log frequency in each language. Another word
is scored by the character n-grams of the word between boundary marks: the longest size of
which the model knows any, then shorter ones. Scores are added over the words of the whole
text; the language with the highest sum is predicted.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refillscope.llm import tokens
from refillscope.llm.shared import materialise, slices

UNKNOWN = "und"
# The sample a model is fitted on: about so many rows of each language, chosen by a hash of their id.
SAMPLE_ROWS = 4_000
# The most languages, and the most words and n-grams of each size and language, that a model keeps.
MAX_LANGUAGES = 256
MAX_WORDS = 20_000
MAX_GRAMS = 5_000
GRAM_SIZES = (4, 3, 2, 1)
# Added to each count, and the weight of an n-gram score against a word's.
SMOOTHING = 0.5
BACKOFF = 0.4

_WORD = re.compile(r"[^\W\d_]+")
_REMEMBERED = 400_000


class Table(Mapping):
    """Maps a feature to its log frequencies by language, which are rows of one array: small in every worker."""

    def __init__(self, place: dict[str, int], scores: np.ndarray):
        self.place, self.scores = place, scores

    def __getitem__(self, feature: str) -> np.ndarray:
        return self.scores[self.place[feature]]

    def __iter__(self) -> Iterator[str]:
        return iter(self.place)

    def __len__(self) -> int:
        return len(self.place)


class Model(NamedTuple):
    """``tables[0]``: words, then n-grams by falling size; each maps a feature to log frequencies by language."""

    languages: list[str]
    tables: list[Mapping[str, np.ndarray]]


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _grams(word: str, size: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts of the sample rows, a row for each language and word of a task."""
    counts: dict[str, Counter] = {}
    for batch in slices(batches):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            counts.setdefault(lang, Counter()).update(words_of(text))
    rows = [(lang, word, n) for lang, own in counts.items() for word, n in own.items()]
    for at in range(0, len(rows), 20_000):
        columns = list(zip(*rows[at : at + 20_000], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2], pa.int64())], names=["lang", "word", "n"])


def sample_rows(docs: DataFrame, learn: Column, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``lang, text`` of a sample with about ``rows`` rows of each of the ``MAX_LANGUAGES`` commonest labels."""
    labelled = docs.where(learn).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    labelled = labelled.where("lang is not null and text is not null and doc_id is not null")
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(MAX_LANGUAGES)
    # At most MAX_LANGUAGES rows.
    share = F.broadcast(sizes.select("lang", F.least(F.lit(1.0), rows / F.col("n")).alias("share")))
    spot = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) / float(1 << 20)
    return labelled.join(share, "lang").where(spot < F.col("share")).select("lang", "text")


def fit(sample: DataFrame) -> Model:
    """A model of the words of ``lang, text`` rows; at most ``MAX_WORDS`` words and ``MAX_GRAMS`` n-grams a language and size."""
    words = sample.mapInArrow(_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = materialise(words, "language-words")
    sets = [words.select("lang", F.lit(0).alias("level"), F.col("word").alias("feature"), "n")]
    marked = F.concat(F.lit("<"), F.col("word"), F.lit(">"))
    for level, size in enumerate(GRAM_SIZES, 1):
        spots = F.sequence(F.lit(1), F.length(marked) - (size - 1))
        gram = F.explode(F.transform(spots, lambda i, size=size: F.substring(marked, i, F.lit(size))))
        own = words.where(F.length("word") + 2 >= size).select("lang", F.lit(level).alias("level"), gram.alias("feature"), "n")
        sets.append(own.groupBy("lang", "level", "feature").agg(F.sum("n").alias("n")))
    every = sets[0]
    for own in sets[1:]:
        every = every.unionByName(own)
    by_count = Window.partitionBy("lang", "level").orderBy(F.col("n").desc(), "feature")
    most = F.when(F.col("level") == 0, MAX_WORDS).otherwise(MAX_GRAMS)
    kept = every.withColumn("place", F.row_number().over(by_count)).where(F.col("place") <= most).drop("place")
    rows = kept.collect()  # bounded by the limits above

    languages = sorted({r["lang"] for r in rows})
    position = {x: i for i, x in enumerate(languages)}
    places: list[dict[str, int]] = [{} for _ in range(1 + len(GRAM_SIZES))]
    for r in rows:
        places[r["level"]].setdefault(r["feature"], len(places[r["level"]]))
    counts = [np.zeros((len(place), len(languages)), dtype=np.float32) for place in places]
    for r in rows:
        counts[r["level"]][places[r["level"]][r["feature"]], position[r["lang"]]] = r["n"]
    tables = []
    for place, own in zip(places, counts, strict=True):
        totals = own.sum(axis=0, dtype=np.float64) + SMOOTHING * len(place)
        tables.append(Table(place, np.log((own + SMOOTHING) / totals).astype(np.float32)))
    return Model(languages, tables)


# Least score that identifies a language, as a multiple of a guess.
LEAST_MARGIN = 1.1


def word_scores(model: Model, word: str) -> np.ndarray | None:
    """Log scores of a word by language; null where not even a single character is known."""
    known = model.tables[0].get(word)
    if known is not None:
        return known
    for table, size in zip(model.tables[1:], GRAM_SIZES, strict=True):
        place = table.place if isinstance(table, Table) else table
        found = [place[g] for g in _grams(word, size) if g in place and g not in "<>"]
        if found:
            return BACKOFF * np.mean(table.scores[found] if isinstance(table, Table) else found, axis=0)
    return None


class _Scorer(dict):
    """Row of each word in a growing matrix of scores; -1 for a word without any."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.matrix = np.zeros((1024, max(1, len(model.languages))), dtype=np.float32)
        self.used = 1  # row 0: no evidence

    def __missing__(self, word: str) -> int:
        scores = word_scores(self.model, word)
        if scores is None:
            return 0
        if self.used == len(self.matrix):
            self.matrix = np.vstack([self.matrix, np.zeros_like(self.matrix)])
        self.matrix[self.used] = scores
        self[word] = self.used
        self.used += 1
        return self.used - 1

    def predict(self, text: str | None) -> tuple[str, float, int]:
        """Language, its share, and the number of words with any evidence."""
        if self.used > _REMEMBERED:
            self.clear()
            self.used = 1
        words = words_of(text)
        if not words or not self.model.languages:
            return UNKNOWN, 0.0, 0
        rows = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        seen = np.count_nonzero(rows)
        sums = self.matrix[rows].sum(axis=0, dtype=np.float64)
        best = int(sums.argmax())
        mean = sums / max(1, seen)
        share = math.exp(mean[best] - mean.max()) / float(np.exp(mean - mean.max()).sum())
        return self.model.languages[best], share, int(seen)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` of each row: the whole text decides, nothing else is looked at.

    ``score`` is the predicted language's share when the mean log score of a word is turned
    into shares: 1 over the number of languages where a text has letters but no character of
    the model. ``und`` with score 0 for null text, a text without letters, or an empty model.
    Ties go to the first language in alphabetical order.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        scorer = _Scorer(sent.value)
        for batch in slices(batches):
            found = [scorer.predict(t) for t in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """A quarter of the documents, by the CRC-32 of their id as text; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def language_report(docs: DataFrame, sample: int = SAMPLE_ROWS) -> DataFrame:
    """Fit on the documents not held out and predict all: ``doc_id, held_out, lang_pred, score``.

    Reads ``doc_id``, ``text`` and, to learn only, ``lang``. Rows with a null ``doc_id``,
    ``text`` or ``lang`` are not learned from. Repeated rows are predicted each. An empty
    input gives an empty result; without any labelled row everything is ``und``.
    """
    model = fit(sample_rows(docs, ~held_out(F.col("doc_id")), sample))
    found = predict(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def _known(sent: Broadcast, margin: float):
    """Leave out rows whose language cannot be told. Workers that tokenized before hold much memory, which goes first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        languages, scorer = len(sent.value.languages), _Scorer(sent.value)
        for batch in slices(batches):
            good = []
            for text in batch.column("text").to_pylist():
                language, share, seen = scorer.predict(text)
                good.append(language != UNKNOWN and seen > 0 and (languages == 1 or share * languages > margin))
            yield batch.filter(pa.array(good, pa.bool_()))

    return run


def identified(docs: DataFrame, model: Model, margin: float = LEAST_MARGIN) -> DataFrame:
    """``docs`` without the rows whose language cannot be told.

    The language of each whole text is predicted. A row goes if the prediction is ``und``
    (null text, no letters), if no word has any evidence, or if the score is not above
    ``margin`` times that of a mere guess (1 over the number of languages). With a single
    language nothing can be compared, and the score decides nothing.
    """
    return docs.mapInArrow(_known(docs.sparkSession.sparkContext.broadcast(model), margin), docs.schema)
