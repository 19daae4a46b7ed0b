"""Quality of texts by a regularised quadratic discriminant over document statistics.

A text's statistics (shares of letters, capitals, digits and signs, word lengths, repeated words and lines,
sizes) are transformed to be roughly normal, standardised, and bounded. Each class has a mean and a
covariance that is shrunk towards the common covariance and towards a multiple of the identity. A text's
score follows from the difference of its log densities under the two classes; each density is a Mahalanobis
distance, measured with the class's Cholesky factor, which is made once when the model is fitted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.llm.common import bounded, byte_words, fresh, segment_hashes, stored, text_bytes

#: Text handled at once, in bytes.
BLOCK = 2 << 20

#: Kinds of bytes by value.
_BYTES = np.arange(256)
SPACE = np.isin(_BYTES, [*range(9, 14), 28, 29, 30, 31, 32])
UPPER = (_BYTES >= ord("A")) & (_BYTES <= ord("Z"))
SMALL = (_BYTES >= ord("a")) & (_BYTES <= ord("z"))
DIGIT = (_BYTES >= ord("0")) & (_BYTES <= ord("9"))
BEYOND = _BYTES >= 0xC0  # the first byte of a character beyond ASCII
CLAUSE = np.isin(_BYTES, [ord(c) for c in ".,;:!?'\"()-"])
SIGN = (_BYTES > 32) & (_BYTES < 127) & ~(UPPER | SMALL | DIGIT | CLAUSE)
CONTINUED = (_BYTES >= 0x80) & (_BYTES < 0xC0)
NOT_NEWLINE = _BYTES != 10

STATISTICS = (
    "words", "word_length", "word_spread", "longest_word", "lines", "line_words",
    "upper", "digits", "beyond_ascii", "clause_signs", "other_signs", "spaces",
    "words_without_letter", "words_with_sign_inside", "capital_words", "repeated_words", "top_word", "repeated_lines", "repeated_pairs",
)


@dataclass(frozen=True)
class Settings:
    #: Standard deviations from the common mean at which a statistic is cut off.
    bound: float = 4.0
    #: Share of the common covariance, and least share of the identity, in each class's covariance.
    pooled: float = 0.1
    least_ridge: float = 0.02


@dataclass(frozen=True)
class Model:
    """What scoring needs: standardisation, and mean, inverse Cholesky factor and constant of each class."""

    settings: Settings
    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    #: Inverses of the lower Cholesky factors of the class covariances.
    whitening: np.ndarray
    constants: np.ndarray
    #: Score is the logistic function of slope * difference + shift.
    slope: float
    shift: float


# --- statistics ------------------------------------------------------------------------------------


def by_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of consecutive pieces."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return np.diff(sums[offsets])


def logit(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Log odds of a share of counts, finite for none and all."""
    return np.log((part + 0.5) / (np.maximum(whole - part, 0) + 0.5))


def repeats(rows: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: how many items equal an earlier one of the row, and how often the most frequent occurs."""
    order = np.lexsort((hashes, rows))
    r, h = rows[order], hashes[order]
    begins = np.concatenate([[True], (r[1:] != r[:-1]) | (h[1:] != h[:-1])]) if len(r) else np.zeros(0, bool)
    starts = np.flatnonzero(begins)
    sizes = np.diff(np.append(starts, len(r)))
    distinct = np.bincount(r[starts], minlength=n)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, r[starts], sizes)
    return np.bincount(rows, minlength=n) - distinct, most


def statistics(texts: pa.Array) -> np.ndarray:
    """Text by statistic. A null is an empty text; both have all counts zero."""
    data, offsets = text_bytes(texts)
    n = len(offsets) - 1
    kinds = {name: by_row(table[data], offsets) for name, table in (("upper", UPPER), ("small", SMALL), ("digit", DIGIT), ("beyond", BEYOND), ("clause", CLAUSE), ("sign", SIGN), ("space", SPACE), ("continued", CONTINUED))}
    chars = np.diff(offsets) - kinds["continued"]

    starts, ends, rows = byte_words(data, offsets, ~SPACE)
    at = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))])
    words = np.diff(at)
    letters = np.concatenate([[0], np.cumsum((UPPER | SMALL | BEYOND)[data])])
    signs = np.concatenate([[0], np.cumsum((SIGN | CLAUSE)[data])])
    uppers = np.concatenate([[0], np.cumsum(UPPER[data])])
    head = np.concatenate([[0], np.cumsum(~CONTINUED[data])])
    length = head[ends] - head[starts]
    word_letters = letters[ends] - letters[starts]
    # The last byte of a word may be a sign without anything being odd about it.
    inside = signs[np.maximum(ends - 1, starts)] - signs[starts]
    capital = (word_letters > 1) & (uppers[ends] - uppers[starts] == word_letters)
    hashes = segment_hashes(data, starts, ends)
    repeated, most = repeats(rows, hashes, n)
    pair_rows = rows[1:][rows[1:] == rows[:-1]]
    pairs = (hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])[rows[1:] == rows[:-1]]
    repeated_pairs, _ = repeats(pair_rows, pairs, n)
    line_starts, line_ends, line_rows = byte_words(data, offsets, NOT_NEWLINE)
    lines = np.bincount(line_rows, minlength=n)
    repeated_lines, _ = repeats(line_rows, segment_hashes(data, line_starts, line_ends), n)

    safe = np.maximum(words, 1)
    mean = by_row(length, at) / safe
    spread = np.sqrt(np.maximum(by_row(length * length, at) / safe - mean * mean, 0))
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, rows, length)
    known = kinds["upper"] + kinds["small"]
    columns = (
        np.log1p(words), np.log1p(mean), np.log1p(spread), np.log1p(longest), np.log1p(lines), np.log1p(words / np.maximum(lines, 1)),
        logit(kinds["upper"], known), logit(kinds["digit"], chars), logit(kinds["beyond"], chars), logit(kinds["clause"], chars),
        logit(kinds["sign"], chars), logit(kinds["space"], chars),
        logit(by_row(word_letters == 0, at), words), logit(by_row(inside > 0, at), words), logit(by_row(capital, at), words),
        logit(repeated, words), logit(most, words), logit(repeated_lines, lines), logit(repeated_pairs, np.maximum(words - 1, 0)),
    )
    return np.stack(columns, axis=1).astype(np.float64)


def appended(df: DataFrame, source: str, field: T.StructField, make) -> DataFrame:
    """``df`` with one more column, computed batch by batch from the Arrow array of one column.

    A column that bears the new name is replaced. ``make`` runs once a task.
    """
    hidden = fresh(df, "_source")
    kept = [c for c in df.columns if c.lower() != field.name.lower()]
    rows = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{source}`").alias(hidden))
    schema = T.StructType([*rows.schema.fields[: len(kept)], field])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for part in bounded(batch, len(kept), BLOCK):
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], compute(part.column(len(kept)))], names=schema.names)

    return rows.mapInArrow(run, schema)


def with_statistics(docs: DataFrame, text: str = "text", column: str = "statistics") -> DataFrame:
    """``docs`` with the array of a text's ``STATISTICS``, from the whole text and nothing else.

    A null is an empty text. Very long texts are handled whole, in memory that is a multiple of their size.
    """

    def make():
        def compute(texts: pa.Array) -> pa.Array:
            values = statistics(texts).astype(np.float32)
            offsets = np.arange(len(values) + 1, dtype=np.int32) * len(STATISTICS)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))

        return compute

    return appended(docs, text, T.StructField(column, T.ArrayType(T.FloatType())), make)


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS)).astype(np.float64)


# --- the discriminant ------------------------------------------------------------------------------


def moments(rows: DataFrame, standard) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (y, statistics): rows, sums and sums of products by class, after ``standard`` maps the statistics.

    Each task sends one row a class and entry, and these are added up on Spark; the answer's size is fixed.
    """
    size = len(STATISTICS) + 1

    def run(batches):
        sums = np.zeros((2, size, size))
        for batch in batches:
            if batch.num_rows:
                y, values = batch.column(0).to_numpy(zero_copy_only=False), standard(matrix(batch.column(1)))
                values = np.concatenate([np.ones((len(values), 1)), values], axis=1)
                for k in (0, 1):
                    sums[k] += values[y == k].T @ values[y == k]
        if sums.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size)), pa.array(sums.ravel())], names=["place", "value"])

    got = rows.select("y", "statistics").mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    sums = np.zeros(2 * size * size)
    sums[got["place"].to_numpy()] = got["value"].to_numpy()
    sums = sums.reshape(2, size, size)
    return sums[:, 0, 0], sums[:, 0, 1:], sums[:, 1:, 1:]


def shrunk(own: np.ndarray, common: np.ndarray, n: float, settings: Settings) -> np.ndarray:
    """A covariance of ``n`` rows drawn towards the common one and then towards a multiple of the identity.

    The identity's share is the oracle-approximating one for normal data, which falls with n; it has a floor,
    as statistics that hardly vary within a class would else have a width of nearly zero.
    """
    s = (1 - settings.pooled) * own + settings.pooled * common
    p, trace, square = len(s), np.trace(s), np.sum(s * s)
    spread = (n + 1 - 2 / p) * (square - trace**2 / p)
    ridge = 1.0 if spread <= 0 else min(1.0, ((1 - 2 / p) * square + trace**2) / spread)
    ridge = max(ridge, settings.least_ridge)
    return (1 - ridge) * s + (ridge * trace / p + 1e-9) * np.eye(p)


def standardised(values: np.ndarray, model: Model) -> np.ndarray:
    return np.clip((values - model.centre) / model.scale, -model.settings.bound, model.settings.bound)


def difference(values: np.ndarray, model: Model) -> np.ndarray:
    """Log density under class 1 less that under class 0, for standardised rows."""
    logs = [model.constants[k] - 0.5 * np.sum(((values - model.means[k]) @ model.whitening[k].T) ** 2, axis=1) for k in (0, 1)]
    return logs[1] - logs[0]


#: Log density differences are counted in steps of a tenth between these bounds when the score is calibrated.
CALIBRATED = 200.0


def calibrated(counts: np.ndarray, values: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through counts of both classes at the given differences.

    The slope is held near a weak prior of one, so that classes without overlap don't send it off.
    """
    slope, shift = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(slope * values + shift, -40, 40)))
        n = counts.sum(axis=0)
        residual, weight = counts[1] - n * p, n * p * (1 - p) + 1e-12
        gradient = np.array([residual @ values - (slope - 1), residual.sum() - 0.01 * shift])
        hessian = np.array([[weight @ values**2 + 1, weight @ values], [weight @ values, weight.sum() + 0.01]])
        step = np.linalg.solve(hessian, gradient)
        step /= max(1.0, np.abs(step[0]) / 0.25, np.abs(step[1]) / 2)
        slope, shift = max(1e-3, slope + step[0]), shift + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(slope), float(shift)


def constant(settings: Settings, shift: float) -> Model:
    """A model that gives every text the same score."""
    p = len(STATISTICS)
    return Model(settings, np.zeros(p), np.ones(p), np.zeros((2, p)), np.stack([np.eye(p)] * 2), np.zeros(2), 0.0, shift)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", train: Column | None = None, settings: Settings = Settings()) -> Model:
    """Learn from the rows of ``docs`` (doc_id, statistics) whose ids ``labels`` marks and for which ``train`` holds.

    All of them teach; no sample is taken. Null ids and null labels teach nothing, several labels of one id
    count as its highest, and each row of a repeated id counts. Without labels of both classes every text
    scores their smoothed share (one half without any).
    """
    marks = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col("doc_id").alias("id"))
        .agg((F.max(label) > 0).cast("int").alias("y"))
    )
    taught = docs.where(F.lit(True) if train is None else train).select(F.col("doc_id").alias("id"), "statistics")
    rows = stored(taught.join(marks, "id").select("y", "statistics"), "labelled-statistics")
    n, sums, products = moments(rows, lambda values: values)
    if n.min() == 0:
        return constant(settings, float(np.log((n[1] + 1) / (n[0] + 1))))
    centre = sums.sum(axis=0) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(products.sum(axis=0)) / n.sum() - centre**2, 0))
    p = len(STATISTICS)
    model = Model(settings, centre, np.where(scale > 1e-6, scale, 1.0), np.zeros((2, p)), np.zeros((2, p, p)), np.zeros(2), 1.0, 0.0)
    n, sums, products = moments(rows, lambda values: standardised(values, model))
    means = sums / n[:, None]
    own = products / n[:, None, None] - means[:, :, None] * means[:, None, :]
    common = np.tensordot(n / n.sum(), own, axes=1)
    factors = [np.linalg.cholesky(shrunk(own[k], common, n[k], settings)) for k in (0, 1)]
    whitening = np.stack([np.linalg.inv(f) for f in factors])
    constants = np.array([np.log(n[k] / n.sum()) - np.log(np.diag(factors[k])).sum() for k in (0, 1)])
    model = Model(settings, model.centre, model.scale, means, whitening, constants, 1.0, 0.0)

    def places(batches):
        for batch in batches:
            if batch.num_rows:
                d = np.clip(difference(standardised(matrix(batch.column(1)), model), model), -CALIBRATED, CALIBRATED)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.rint(d * 10).astype(np.int64))], names=["y", "place"])

    # At most two rows for each of the places between the bounds.
    got = rows.select("y", "statistics").mapInArrow(places, "y int, place long").groupBy("y", "place").agg(F.count("*").alias("n")).toArrow()
    values = np.arange(-10 * CALIBRATED, 10 * CALIBRATED + 1) / 10
    counts = np.zeros((2, len(values)))
    counts[got["y"].to_numpy(), got["place"].to_numpy() + int(10 * CALIBRATED)] = got["n"].to_numpy()
    slope, shift = calibrated(counts, values)
    return Model(settings, model.centre, model.scale, means, whitening, constants, slope, shift)


def score(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is of class 1, from its statistics (see ``with_statistics``).

    An empty text has statistics like any other and is scored by them.
    """
    # A few matrices of fixed size.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        own = shared.value

        def compute(column: pa.Array) -> pa.Array:
            d = difference(standardised(matrix(column), own), own)
            return pa.array(1 / (1 + np.exp(-np.clip(own.slope * d + own.shift, -40, 40))))

        return compute

    return appended(docs, "statistics", T.StructField(column, T.DoubleType()), make)
