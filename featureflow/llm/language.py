"""Language of texts by words first, with backoff to shorter and shorter character n-grams.

A word that any language's model knows scores the log of its share among that language's words, with a
penalty where a language doesn't know it. A word that no model knows is scored by its longest
character n-grams, and by shorter ones as long as no model knows any of them. A text's score for a
language is the mean over its words.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.llm.common import add_columns, bounded, stored

#: Words are runs of letters, marks of the edge included when n-grams are taken.
WORDS = re.compile(r"[^\W\d_]+").findall
EDGE = " "
UNDETERMINED = "und"
#: Bytes of text that are worked on at once.
BLOCK = 1 << 20

OUTPUT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


@dataclass(frozen=True)
class Settings:
    #: The most frequent words, and n-grams of each order, that a language's model holds: its size.
    words: int = 20_000
    grams: int = 5_000
    longest: int = 5
    #: Log10 score of a word or n-gram that a language's model doesn't hold.
    penalty: float = -7.0
    #: How far the mean log10 score per word is stretched before scores of languages are compared.
    sharpness: float = 3.0
    #: Distinct words counted in a task before they are handed on.
    buffer: int = 200_000


@dataclass(frozen=True)
class Model:
    settings: Settings
    languages: list[str]
    #: Order 0: words; order n: n-grams. Each maps to log10 shares by language.
    scores: list[dict[str, np.ndarray]]


@dataclass(frozen=True)
class Tables:
    """A model as the workers get it: one matrix, and its row for each entry, in place of an array for each entry."""

    settings: Settings
    languages: list[str]
    rows: list[dict[str, int]]
    #: The last row is that of words without a known n-gram.
    matrix: np.ndarray


def tables_of(model: Model) -> Tables:
    begins = np.cumsum([0, *map(len, model.scores)]).tolist()
    rows = [{g: begin + i for i, g in enumerate(table)} for begin, table in zip(begins, model.scores)]
    matrix = np.full((begins[-1] + 1, len(model.languages)), model.settings.penalty)
    for begin, table in zip(begins, model.scores):
        if table:
            matrix[begin : begin + len(table)] = np.array(list(table.values()))
    return Tables(model.settings, model.languages, rows, matrix)


def words_of(text: str | None) -> list[str]:
    return WORDS(text.lower()) if text else []


def word_counts(docs: DataFrame, settings: Settings) -> DataFrame:
    """(lang, word, n) over all given texts."""

    def run(batches):
        counts: dict[str, Counter] = {}
        size = 0
        for batch in batches:
            for part in bounded(batch, 1, BLOCK):
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    own = counts.setdefault(lang, Counter())
                    before = len(own)
                    own.update(words_of(text))
                    size += len(own) - before
                    if size > settings.buffer:
                        yield from handed_on(counts)
                        counts, size = {}, 0
        yield from handed_on(counts)

    def handed_on(counts):
        for lang, own in counts.items():
            arrays = [pa.array([lang] * len(own)), pa.array(list(own)), pa.array(list(own.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "word", "n"])

    found = docs.select("lang", "text").mapInArrow(run, "lang string, word string, n long")
    return found.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, train: Column | None = None, settings: Settings = Settings()) -> Model:
    """Learn from every text of ``docs`` with a non-null ``lang`` for which ``train`` holds.

    All words of these texts are counted; the model keeps the most frequent of each language and order,
    ties in code point order, so its size depends on the number of languages alone.
    """
    docs = docs.select("text", "lang", (F.lit(True) if train is None else train).alias("_train"))
    counts = stored(word_counts(docs.where("_train AND lang IS NOT NULL AND text IS NOT NULL"), settings), "word-counts")
    grams = counts.select(
        "lang", "n", F.concat(F.lit(EDGE), "word", F.lit(EDGE)).alias("w"), F.explode(F.sequence(F.lit(1), F.lit(settings.longest))).alias("k")
    ).where("length(w) >= k")
    places = F.sequence(F.lit(1), F.length("w") - F.col("k") + 1)
    grams = grams.select("lang", "n", "k", F.explode(F.transform(places, lambda i: F.substring("w", i, F.col("k")))).alias("gram"))
    grams = grams.where(F.col("gram") != EDGE).groupBy("lang", "k", "gram").agg(F.sum("n").alias("n"))
    entries = counts.select("lang", F.lit(0).alias("k"), F.col("word").alias("gram"), "n").unionByName(grams)
    entries = stored(entries, "gram-counts")
    totals = {(r["lang"], r["k"]): r["total"] for r in entries.groupBy("lang", "k").agg(F.sum("n").alias("total")).collect()}
    place = F.row_number().over(Window.partitionBy("lang", "k").orderBy(F.col("n").desc(), "gram"))
    most = F.when(F.col("k") == 0, settings.words).otherwise(settings.grams)
    kept = entries.withColumn("_place", place).where(F.col("_place") <= max(settings.words, settings.grams)).where(F.col("_place") <= most)
    languages = sorted({lang for lang, _ in totals})
    index = {lang: i for i, lang in enumerate(languages)}
    scores: list[dict[str, np.ndarray]] = [{} for _ in range(settings.longest + 1)]
    for r in kept.select("lang", "k", "gram", "n").toLocalIterator():
        row = scores[r["k"]].setdefault(r["gram"], np.full(len(languages), settings.penalty, np.float32))
        row[index[r["lang"]]] = max(settings.penalty, np.log10(r["n"] / totals[r["lang"], r["k"]]))
    return Model(settings, languages, scores)


class Scorer:
    """Scores of runs between white space, remembered for those met last.

    A run's score is the sum over its words; with the model's tables in one matrix, the sums of many new
    runs are taken at once. All scorers of a worker share the tables.
    """

    def __init__(self, model: Model | Tables, remembered: int = 300_000):
        self.model = model if isinstance(model, Tables) else tables_of(model)
        self.remembered = remembered
        self.row_of_entry, self.matrix = self.model.rows, self.model.matrix
        self.chunk_of: dict[str, int] = {}
        self.sums = np.zeros((0, len(model.languages)))
        self.words = np.zeros(0)

    def entries(self, word: str) -> list[int]:
        """Rows of the matrix whose mean is the word's score."""
        known = self.row_of_entry[0].get(word)
        if known is not None:
            return [known]
        edged = f"{EDGE}{word}{EDGE}"
        for n in range(min(self.model.settings.longest, len(edged)), 0, -1):
            rows = self.row_of_entry[n]
            found = [rows[g] for i in range(len(edged) - n + 1) if (g := edged[i : i + n]) in rows]
            if found:
                return found
        return [len(self.matrix) - 1]

    def learn(self, chunks: list[str]) -> None:
        """Have the sums of these runs ready."""
        of, rows, shares = [], [], []
        words = np.zeros(len(chunks))
        for i, chunk in enumerate(chunks):
            own = [chunk] if chunk.isalpha() else words_of(chunk)
            words[i] = len(own)
            for word in own:
                found = self.entries(word)
                rows += found
                of += [i] * len(found)
                shares += [1 / len(found)] * len(found)
        picked = self.matrix[np.array(rows, np.int64)] * np.array(shares)[:, None]
        sums = np.stack([np.bincount(np.array(of, np.int64), picked[:, j], len(chunks)) for j in range(picked.shape[1])], axis=1)
        self.chunk_of.update(zip(chunks, range(len(self.words), len(self.words) + len(chunks))))
        self.sums, self.words = np.concatenate([self.sums, sums]), np.concatenate([self.words, words])

    def texts(self, texts: list) -> tuple[list, list]:
        """Language and score of each text; texts are taken together up to a third of what is remembered."""
        names, scores = [], []
        held: list[list[str]] = []
        size = 0
        for i, text in enumerate(texts):
            held.append((text or "").lower().split())
            size += len(held[-1])
            if size * 3 > self.remembered or i == len(texts) - 1:
                for name, score in self.judge(held):
                    names.append(name)
                    scores.append(score)
                held, size = [], 0
        return names, scores

    def judge(self, held: list[list[str]]) -> list[tuple[str, float]]:
        nothing = (UNDETERMINED, 0.0)
        languages, sharpness = self.model.languages, self.model.settings.sharpness
        if not languages:
            return [nothing] * len(held)
        distinct = set().union(*held)
        if new := distinct.difference(self.chunk_of):
            if len(self.chunk_of) + len(new) > self.remembered:
                self.chunk_of, self.sums, self.words = {}, self.sums[:0], self.words[:0]
                new = distinct
            self.learn(list(new))
        out = []
        for chunks in held:
            places = np.fromiter(map(self.chunk_of.__getitem__, chunks), np.int64, len(chunks))
            n = self.words[places].sum()
            if n == 0:
                out.append(nothing)
                continue
            mean = self.sums[places].sum(axis=0) / n
            best = int(np.argmax(mean))  # the first of equals, in the order of the languages' names
            out.append((languages[best], float(1 / np.power(10.0, sharpness * (mean - mean[best])).sum())))
        return out


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` of each whole text.

    A null text, one without a letter, and any text if the model knows no language give `und` and 0.
    The score is the best language's share when the mean scores are turned into probabilities.
    Columns already named like the new ones are replaced.
    """
    # Bounded by the settings and the number of languages.
    shared = docs.sparkSession.sparkContext.broadcast(tables_of(model))

    return add_columns(docs, text, OUTPUT, lambda: Scorer(shared.value).texts, BLOCK)
