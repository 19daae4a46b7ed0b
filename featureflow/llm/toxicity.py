"""Toxicity of texts: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

An n-gram counts once per text. Its feature value is the logarithm of its smoothed share among the
toxic texts over its share among the others. A logistic regression over these values decides how far
each ratio is to be trusted. The classifier learns from a sample of the labelled texts whose size is a
parameter, drawn by the hash of the id; it scores every text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.llm.common import add_columns, bounded, stored

#: Text handled at once, in bytes; its n-grams take some two hundred times as much for a moment.
BLOCK = 128 << 10


@dataclass(frozen=True)
class Settings:
    orders: tuple[int, ...] = (3, 4, 5)
    #: n-grams share 2**bits counters.
    bits: int = 18
    smoothing: float = 1.0
    #: An n-gram takes part if at least so many texts of the sample hold it ...
    least_texts: int = 3
    #: ... and its log-count ratio is so many standard errors away from zero.
    least_errors: float = 4.0
    #: Labelled documents of each class, at most, that the log-count ratios are taken from, and of these
    #: the ones that the regression is fitted on; and rows that count for one id.
    rows_per_class: int = 10_000
    regression_per_class: int = 1_500
    rows_per_id: int = 4
    penalty: float = 0.05
    rounds: int = 300


@dataclass(frozen=True)
class Model:
    settings: Settings
    #: Regression weight times log-count ratio, by counter; zero for those that take no part.
    weights: np.ndarray
    bias: float


def grams(texts: list, settings: Settings, taking: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row and counter of the n-grams of the texts; a null is an empty text.

    ``taking`` tells for each counter whether its n-grams are wanted.
    """
    padded = [f" {t.lower()} " if t else "" for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(p) for p in padded])
    rows, counters, h = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], codes
    for n in range(2, max(settings.orders) + 1):
        if len(h) < 2:
            break
        h = h[:-1] * np.uint32(0x9E3779B1)
        h += codes[n - 1 :]
        if n in settings.orders:
            counter = h ^ (h >> np.uint32(15))
            counter *= np.uint32(0x85EBCA6B)
            counter += np.uint32(n)
            counter >>= np.uint32(32 - settings.bits)
            at = np.arange(len(counter)) if taking is None else np.flatnonzero(taking[counter])
            row = np.searchsorted(ends, at, side="right")
            within = at + n <= ends[row]
            rows.append(row[within])
            counters.append(counter[at[within]].astype(np.int64))
    return np.concatenate(rows), np.concatenate(counters)


def once_per_text(rows: np.ndarray, counters: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique(rows << bits | counters)
    return (pairs >> bits).astype(np.int32), (pairs & ((1 << bits) - 1)).astype(np.int32)


def sampled_texts(docs: DataFrame, labels: DataFrame, label: str, settings: Settings) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, text, y) of up to ``rows_per_class`` labelled texts of each class, picked by the hash of the id.

    Several labels of one document count as its highest. Also the number of labelled documents by class.
    """
    marks = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id")
        .agg((F.max(label) > 0).cast("int").alias("y"))
    )
    ids = stored(docs.select("doc_id").distinct().join(marks, "doc_id"), "labelled-ids")
    sizes = {r["y"]: r["n"] for r in ids.groupBy("y").agg(F.count("*").alias("n")).collect()}
    picked = [ids.where(F.col("y") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.rows_per_class) for k in (0, 1)]
    # At most 2 * rows_per_class rows, so the broadcast is bounded.
    order = Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = stored(picked[0].union(picked[1]), "sampled-ids").withColumn("fitted", F.row_number().over(order) <= settings.regression_per_class)
    texts = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y", "fitted")
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text"))
    texts = texts.withColumn("_place", place).where(F.col("_place") <= settings.rows_per_id).drop("_place")
    texts = stored(texts.repartition(32, "doc_id"), "sampled-texts")
    return texts, np.array([sizes.get(0, 0), sizes.get(1, 0)], float)


def class_counts(texts: DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """How many texts of each class hold an n-gram of each counter, and how many texts there are."""
    size = 1 << settings.bits

    def run(batches):
        seen = np.zeros((2, size + 1), np.int64)
        for batch in batches:
            for part in bounded(batch, 0, BLOCK):
                y = part.column(1).to_numpy(zero_copy_only=False)
                rows, counters = once_per_text(*grams(part.column(0).to_pylist(), settings), settings.bits)
                for k in (0, 1):
                    seen[k, :size] += np.bincount(counters[y[rows] == k], minlength=size)
                    seen[k, size] += np.count_nonzero(y == k)
        used = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used), *map(pa.array, seen[:, used])], names=["counter", "others", "toxic"])

    # One row for each counter, so the answer's size is fixed.
    counted = texts.select("text", "y").mapInArrow(run, "counter long, others long, toxic long")
    counted = counted.groupBy("counter").agg(F.sum("others").alias("others"), F.sum("toxic").alias("toxic"))
    got = counted.toArrow()
    counts = np.zeros((2, size + 1))
    counts[:, got["counter"].to_numpy()] = [got["others"].to_numpy(), got["toxic"].to_numpy()]
    return counts[:, :size], counts[:, size]


def log_ratios(counts: np.ndarray, texts: np.ndarray, settings: Settings) -> np.ndarray:
    """Log of the share of toxic texts over the share of others; zero where it says too little."""
    a = settings.smoothing
    shares = (counts + a) / (texts + 2 * a)[:, None]
    ratio = np.log(shares[1] / shares[0])
    error = np.sqrt((1 / (counts + a)).sum(axis=0))
    return np.where((counts.sum(axis=0) >= settings.least_texts) & (np.abs(ratio) >= settings.least_errors * error), ratio, 0.0)


def features(texts: DataFrame, ratios: np.ndarray, settings: Settings) -> pa.Table:
    """(y, packed counters) of the regression's texts, as far as the counters' ratios are not zero."""
    taking = ratios != 0

    def make():
        def found(values: list) -> list:
            row, counter = once_per_text(*grams(values, settings, taking), settings.bits)
            return [[c.tobytes() for c in np.split(counter, np.searchsorted(row, np.arange(1, len(values))))]]

        return found

    fields = T.StructType([T.StructField("_counters", T.BinaryType())])
    return add_columns(texts.where("fitted"), "text", fields, make, BLOCK).select("y", "_counters").toArrow()


def regression(sample: pa.Table, ratios: np.ndarray, texts: np.ndarray, settings: Settings) -> tuple[np.ndarray, float]:
    """Logistic regression over the log-count ratios by accelerated gradient steps; classes weigh alike.

    The bias is shifted afterwards to the classes' shares among all labelled documents that teach.
    """
    y = sample["y"].to_numpy().astype(float)
    counters = [np.frombuffer(b.as_buffer(), np.int32) for b in sample["_counters"]]
    row = np.repeat(np.arange(len(y), dtype=np.int32), [len(c) for c in counters])
    flat = np.concatenate(counters)
    used, column = np.unique(flat, return_inverse=True)
    value = ratios[used][column]
    balance = np.where(y == 1, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, len(y) - y.sum()))
    # The step follows the largest row norm, which bounds the curvature of the balanced loss.
    norms = np.bincount(row, value**2, minlength=len(y)) + 1
    step = 4.0 / (norms @ balance + settings.penalty)
    w = np.zeros(len(used))
    b, before = 0.0, (w, 0.0)
    for k in range(settings.rounds):
        ahead = k / (k + 3)
        vw, vb = w + ahead * (w - before[0]), b + ahead * (b - before[1])
        z = np.bincount(row, vw[column] * value, minlength=len(y)) + vb
        residual = balance * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        gradient = np.bincount(column, residual[row] * value, minlength=len(used)) + settings.penalty * vw / len(y)
        before, w, b = (w, b), vw - step * gradient, vb - step * residual.sum()
    weights = np.zeros(len(ratios), np.float32)
    weights[used] = w * ratios[used]
    return weights, b + float(np.log(texts[1] / texts[0]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", train: Column | None = None, settings: Settings = Settings()) -> Model:
    """Learn from texts of ``docs`` whose ids ``labels`` marks and for which ``train`` holds; see ``Settings``.

    Null ids, texts' ids without a label and null labels teach nothing; a null text is an empty one.
    Without labels of both classes every text scores the share of toxic labels, or 0 without labels.
    """
    docs = docs.select("doc_id", "text", (F.lit(True) if train is None else train).alias("_train"))
    texts, sizes = sampled_texts(docs.where("_train AND doc_id IS NOT NULL").drop("_train"), labels, label, settings)
    counts, totals = class_counts(texts, settings)
    nothing = np.zeros(1 << settings.bits, np.float32)
    if totals.min() == 0:
        return Model(settings, nothing, 40.0 if totals[1] else -40.0)
    ratios = log_ratios(counts, totals, settings)
    if not ratios.any():
        return Model(settings, nothing, float(np.log(sizes[1] / sizes[0])))
    # The sample may hold the classes in other shares than the labelled documents.
    return Model(settings, *regression(features(texts, ratios, settings), ratios, sizes, settings))


def score(docs: DataFrame, model: Model, text: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is toxic, from its whole text alone.

    A null or empty text gets the share of toxic texts, as the model knows nothing else about it. A
    column already named like the new one is replaced.
    """
    # 4 bytes for each of 2**bits counters.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        settings, weights, bias = shared.value.settings, shared.value.weights, shared.value.bias
        taking = weights != 0

        def scores(values: list) -> list:
            row, counter = once_per_text(*grams(values, settings, taking), settings.bits)
            z = bias + np.bincount(row, weights[counter], minlength=len(values))
            return [1 / (1 + np.exp(-np.clip(z, -40, 40)))]

        return scores

    return add_columns(docs, text, T.StructType([T.StructField(column, T.DoubleType())]), make, BLOCK)
