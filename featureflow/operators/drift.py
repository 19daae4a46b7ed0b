"""Synthetic drift, and chunked univariate drift detection (Kolmogorov-Smirnov, Jensen-Shannon)."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featureflow.functions.keyed import standard_normal
from featureflow.functions.scalar import clip
from featureflow.operators.clean import nulls_for_nans
from featureflow.operators.order import ONE_TASK, non_null, place_rows, range_splits, running_total, value_ranges
from featureflow.operators.profile import equal_width_bin, mean_and_std
from featureflow.schemas import numeric_columns
from featureflow.session import shared_folder

# A numeric column with at most this many values, making up at most this share of the
# rows, is compared value by value; others by histogram.
MAX_DISCRETE_VALUES = 50
MAX_DISCRETE_SHARE = 0.1
# Default alert limits.
JS_UPPER = 0.1
KS_DEVIATIONS = 3.0

#: Values of a feature, at most, that are broadcast because a hot key of the join would be theirs.
HEAVY_VALUES = 10_000

# Chunks up to this size are ranked in one task each; larger ones are split by value range.
MAX_ROWS_PER_TASK = ONE_TASK


def shift_points(
    df: DataFrame,
    column: str = "points",
    loc: float = -10.0,
    scale: float = 3.0,
    clip_values: bool = True,
    row_id: str = "row_id",
    seed: int = 7,
) -> DataFrame:
    """Add normal noise N(loc, scale) to a column, limited to [0, 100] on request; null stays null.

    The noise is a function of (seed, row id), so it does not depend on the partitioning and a
    recomputed task repeats it.
    """
    drifted = F.col(column) + F.lit(float(loc)) + F.lit(float(scale)) * standard_normal(seed, F.col(row_id))
    return df.withColumn(column, clip(drifted, 0.0, 100.0) if clip_values else drifted)


def drift_effect(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Mean and sample standard deviation of the column before and after."""
    return mean_and_std(before, column, "before").unionByName(mean_and_std(after, column, "after"))


def with_record_id(df: DataFrame, index: str, name: str = "record_id") -> DataFrame:
    """The row index as a column under the name the drift step uses for its order."""
    return df.withColumnRenamed(index, name)


@dataclass(frozen=True)
class Histogram:
    """Equal-width bins over the range of a reference column."""

    low: float
    high: float
    bins: int


def doane_bins(rows: int, low: float, high: float, std: float, skewness: float) -> int:
    """Number of equal-width bins by Doane's rule."""
    if rows <= 2 or not std or high <= low:
        return 1
    spread = math.sqrt(6.0 * (rows - 2) / ((rows + 1.0) * (rows + 3)))
    width = (high - low) / (1.0 + math.log2(rows) + math.log2(1.0 + abs(skewness) / spread))
    return int(math.ceil((high - low) / width))


# Periods and features travel as small numbers; the report names them.
PERIODS = ("reference", "analysis")
REFERENCE = 0


def period_facts(both: DataFrame, record_id: str, features: Sequence[str], numeric: Sequence[str]) -> dict[str, dict]:
    """Per period: record range, rows, approximate distinct counts, and moments of the numeric features.

    One pass over both tables, two rows of result.
    """
    measures = [F.min(record_id).alias("low"), F.max(record_id).alias("high"), F.count("*").alias("rows")]
    for c in features:
        measures += [F.count(c).alias(f"{c}|n"), F.approx_count_distinct(c).alias(f"{c}|distinct")]
    for c in numeric:
        measures += [
            F.min(c).alias(f"{c}|low"),
            F.max(c).alias(f"{c}|high"),
            F.stddev_pop(c).alias(f"{c}|std"),
            F.skewness(c).alias(f"{c}|skew"),
        ]
    none = {"low": None, "high": None, "rows": 0, **{f"{c}|{k}": 0 for c in features for k in ("n", "distinct")}}
    found = {r["period"]: r.asDict() for r in both.groupBy("period").agg(*measures).collect()}
    return {name: found.get(number, none) for number, name in enumerate(PERIODS)}


def reference_histograms(df: DataFrame, numeric: Sequence[str], facts: Mapping) -> dict[str, Histogram]:
    """Bins of the numeric features that are treated as continuous; the others are left out."""
    # An estimate of twice the limit cannot come from a column within it; closer ones are counted.
    unclear = [c for c in numeric if facts[f"{c}|n"] and facts[f"{c}|distinct"] <= 2 * MAX_DISCRETE_VALUES]
    exact = {}
    if unclear:
        exact = df.agg(*[F.countDistinct(F.col(c).cast("double")).alias(c) for c in unclear]).first().asDict()
    histograms = {}
    for c in numeric:
        n = facts[f"{c}|n"]
        distinct = exact.get(c, facts[f"{c}|distinct"])
        if not n or (distinct <= MAX_DISCRETE_VALUES and distinct / n <= MAX_DISCRETE_SHARE):
            continue
        low, high = facts[f"{c}|low"], facts[f"{c}|high"]
        bins = doane_bins(n, low, high, facts[f"{c}|std"], facts[f"{c}|skew"] or 0.0)
        histograms[c] = Histogram(low, high, bins) if high > low else Histogram(low - 0.5, high + 0.5, 1)
    return histograms


CHUNK = ["feature", "chunk"]


def feature_cells(df: DataFrame, features: Sequence[str], numeric: Sequence[str], histograms: Mapping, *keep: str) -> DataFrame:
    """One row per value: (feature, value, bin) and the kept columns; nulls are left out.

    ``feature`` is the position in ``features``. ``bin`` is the histogram bin, or the value itself for features
    that are compared value by value. Text features have no order, so their ``value`` is a constant.
    """

    def cell(i: int, c: str) -> Column:
        label = F.col(c).cast("string")
        h = histograms.get(c)
        if h is not None:
            number = equal_width_bin(F.col(c), h.low, h.high, h.bins).cast("string")
            label = F.when(F.col(c).between(h.low, h.high), number).when(F.col(c).isNotNull(), "outside")
        return F.struct(F.lit(i).alias("feature"), (F.col(c) if c in numeric else F.lit(0.0)).alias("value"), label.alias("bin"))

    cells = df.select(*keep, F.explode(F.array(*[cell(i, c) for i, c in enumerate(features)])).alias("cell"))
    return non_null(cells.select(*keep, "cell.*"), ["value", "bin"])


def ranged_values(df: DataFrame, splits: Mapping[int, list[float]]) -> DataFrame:
    """``df`` (feature, value, ...) with the number of the value's range by its feature's bounds; 0 for text."""
    if not splits:
        return df.withColumn("range", F.lit(0))
    inputs = {f"_value_{i}": F.when(F.col("feature") == i, F.col("value")) for i in splits}
    numbered = value_ranges(df.withColumns(inputs), list(inputs), splits=list(splits.values()))
    own = [F.when(F.col("feature") == i, F.col(f"_range__value_{i}")) for i in splits]
    return numbered.withColumn("range", F.coalesce(*own, F.lit(0))).drop(*inputs, *[f"_range_{c}" for c in inputs])


@dataclass
class ReferenceProfile:
    """What a reference table leaves behind for comparing later batches: no batch reads its rows again.

    ``counts`` holds (feature, value, bin, n) for its distinct values, ``chunks`` (feature, chunk, ks, js) of its
    own chunks, ``limits`` (feature, ks_lower, ks_upper).
    """

    features: list[str]
    numeric: list[str]
    chunk_size: int
    facts: dict
    histograms: dict[str, Histogram]
    splits: dict[int, list[float]]
    counts: DataFrame
    chunks: DataFrame | None = None
    limits: DataFrame | None = None

    def save(self, path: str) -> None:
        about = {k: getattr(self, k) for k in ("features", "numeric", "chunk_size", "facts")}
        about["histograms"] = {c: [h.low, h.high, h.bins] for c, h in self.histograms.items()}
        about["splits"] = {i: s[1:-1] for i, s in self.splits.items()}
        spark = self.counts.sparkSession
        spark.createDataFrame([(json.dumps(about, default=str),)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
        for name in ("counts", "chunks", "limits"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> ReferenceProfile:
        about = json.loads(spark.read.text(f"{path}/about").first()[0])
        about["histograms"] = {c: Histogram(*h) for c, h in about["histograms"].items()}
        about["splits"] = {int(i): [-math.inf, *s, math.inf] for i, s in about["splits"].items()}
        return cls(**about, **{name: spark.read.parquet(f"{path}/{name}") for name in ("counts", "chunks", "limits")})


def distribution_at(profile: ReferenceProfile, values: DataFrame, splits: Mapping[int, list[float]]) -> DataFrame:
    """(feature, value, bin, before, at, share, n, m) for every value of the reference or among the given ones.

    ``before`` and ``at`` are the reference distribution just below and at the value, ``share`` is that of the
    bin, ``n`` and ``m`` the rows with the value in the reference and in ``values`` (feature, value, bin, m). Only
    distinct values are ordered, range by range.
    """
    none = F.lit(0).cast("long")
    both = profile.counts.select("feature", "value", "bin", "n", none.alias("m")).unionByName(values.select("feature", "value", "bin", none.alias("n"), "m"))
    keys = ["feature", "value", "bin"]
    whole = non_null(both, keys).groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    totals = profile.counts.groupBy("feature").agg(F.sum("n").alias("total"))
    bins = profile.counts.groupBy("feature", "bin").agg(F.sum("n").alias("bin_n"))
    order = [i for i, c in enumerate(profile.features) if c in profile.numeric]
    parts = []
    if order:
        ordered = ranged_values(whole.where(F.col("feature").isin(*order)), splits)
        parts.append(running_total(ordered, "value", F.col("n"), ["feature"], range_column="range", name="lower"))
    if len(order) < len(profile.features):
        parts.append(whole.where(~F.col("feature").isin(*order)).withColumn("lower", F.lit(0).cast("long")))
    # One total per monitored feature. A feature that the reference shows nothing of has none.
    placed = reduce(DataFrame.unionByName, parts).join(F.broadcast(totals), "feature", "left").join(bins, ["feature", "bin"], "left")
    return placed.select(
        *keys,
        (F.col("lower") / F.col("total")).alias("before"),
        ((F.col("lower") + F.col("n")) / F.col("total")).alias("at"),
        F.when(F.col("total") > 0, F.coalesce("bin_n", F.lit(0)) / F.col("total")).alias("share"),
        "n",
        "m",
    )


def compare_chunks(cells: DataFrame, distribution: DataFrame, chunk_size: int, rows: int, splits: Mapping[int, list[float]]) -> DataFrame:
    """(feature, chunk, ks, js): each chunk of ``cells`` (chunk, feature, value, bin) against the reference.

    The Kolmogorov-Smirnov distance peaks at a value of the chunk, at it or just below it. For the
    Jensen-Shannon distance, bins a chunk does not hold add half of their reference share, and values the
    reference never showed count as one extra bin. So only the chunk's own values are looked at, never a
    chunk x reference product. ``rows`` is the number of rows behind the distribution.
    """
    keys = ["feature", "value", "bin"]
    counts = cells.groupBy(*CHUNK, "value", "bin").agg(F.count("*").alias("n"))
    # A value that many chunks hold would be a hot key of the join. Values with at least this share of all
    # rows are HEAVY_VALUES per feature at most, and are broadcast; no other value is frequent.
    facts = ["before", "at", "share"]
    heavy_here = F.col("n") + F.col("m") >= F.lit(rows / HEAVY_VALUES)
    heavy = distribution.where(heavy_here).select(*keys, *facts, F.lit(True).alias("heavy"))
    first = counts.join(F.broadcast(heavy), keys, "left")
    light = distribution.where(~heavy_here).select(*keys, *facts)
    compared = first.where("heavy").drop("heavy").unionByName(first.where("heavy IS NULL").drop("heavy", *facts).join(light, keys))
    if chunk_size <= MAX_ROWS_PER_TASK:  # the setting says that a task can hold a chunk
        whole = Window.partitionBy(*CHUNK)
        lower = whole.orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
        compared = compared.select(
            "*",
            F.sum("n").over(whole).alias("total"),
            F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("lower"),
            F.sum("n").over(Window.partitionBy(*CHUNK, "bin")).alias("bin_n"),
        )
    else:
        compared = running_total(ranged_values(compared, splits), "value", F.col("n"), CHUNK, range_column="range", name="lower")
        compared = compared.join(counts.groupBy(*CHUNK).agg(F.sum("n").alias("total")), CHUNK)
        compared = compared.join(counts.groupBy(*CHUNK, "bin").agg(F.sum("n").alias("bin_n")), [*CHUNK, "bin"])
    gap = F.greatest(
        F.abs(F.col("lower") / F.col("total") - F.col("before")),
        F.abs((F.col("lower") + F.col("n")) / F.col("total") - F.col("at")),
    )
    p, q = F.col("share"), F.col("bin_n") / F.col("total")
    part = F.when(p > 0, q * F.log2(2 * q / (p + q)) + p * F.log2(2 * p / (p + q)) - p).otherwise(q)
    # A bin's part is spread over its values in proportion to their rows.
    divergence = (F.sum(part * F.col("n") / F.col("bin_n")) + 1.0) / 2
    return compared.groupBy(*CHUNK).agg(F.max(gap).alias("ks"), F.sqrt(F.greatest(divergence, F.lit(0.0))).alias("js"))


def typed_features(df: DataFrame, features: Sequence[str], numeric: Sequence[str], record_id: str) -> DataFrame:
    typed = [F.col(c).cast("double" if c in numeric else "string").alias(c) for c in features]
    return nulls_for_nans(df.select(record_id, *typed))


def in_chunks(df: DataFrame, record_id: str, facts: Mapping, chunk_size: int) -> DataFrame:
    placed = place_rows(df, record_id, facts["low"], facts["high"], facts["rows"])
    return placed.withColumn("chunk", F.expr(f"position div {int(chunk_size)}"))


def numeric_splits(df: DataFrame, features: Sequence[str], numeric: Sequence[str], rows: int) -> dict[int, list[float]]:
    """Bounds of the value ranges of each numeric feature, by its position."""
    return dict(zip([features.index(c) for c in numeric], range_splits(df, numeric, rows))) if numeric and rows else {}


def profile_reference(
    reference: DataFrame, features: Sequence[str], chunk_size: int = 100, record_id: str = "record_id", ks_deviations: float = KS_DEVIATIONS
) -> ReferenceProfile:
    """Profile of a reference table, with the statistics of its own chunks and the limits that follow from them."""
    shared_folder(reference.sparkSession)
    features = list(features)
    numeric = [c for c in features if c in numeric_columns(reference.schema)]
    df = typed_features(reference, features, numeric, record_id)
    facts = period_facts(df.withColumn("period", F.lit(REFERENCE)), record_id, features, numeric)["reference"]
    histograms = reference_histograms(df, numeric, facts)
    splits = numeric_splits(df, features, numeric, facts["rows"])
    counts = feature_cells(df, features, numeric, histograms).groupBy("feature", "value", "bin").agg(F.count("*").alias("n")).checkpoint()
    profile = ReferenceProfile(features, numeric, chunk_size, facts, histograms, splits, counts)
    # A row per chunk and feature, kept in the shared folder.
    profile.chunks = _chunks_of(df, profile, record_id, facts, splits).checkpoint()
    ks = F.when(F.col("feature").isin(*[features.index(c) for c in numeric]), F.col("ks")) if numeric else F.lit(None).cast("double")
    limits = profile.chunks.groupBy("feature").agg(F.avg(ks).alias("_mean"), F.stddev_pop(ks).alias("_std"))
    margin = ks_deviations * F.col("_std")
    profile.limits = limits.select(
        "feature",
        # A statistic cannot go below zero, so a limit there is no limit.
        F.when(F.col("_mean") - margin > 0, F.col("_mean") - margin).alias("ks_lower"),
        (F.col("_mean") + margin).alias("ks_upper"),
    )
    return profile


def _chunks_of(df: DataFrame, profile: ReferenceProfile, record_id: str, facts: Mapping, splits: Mapping[int, list[float]], own: bool = True) -> DataFrame:
    """Statistics of the chunks of a batch with typed features; ``own`` if it is the reference itself."""
    cells = lambda rows, *keep: feature_cells(rows, profile.features, profile.numeric, profile.histograms, *keep)
    values = cells(df).groupBy("feature", "value", "bin").agg(F.count("*").alias("m"))
    distribution = distribution_at(profile, values.limit(0) if own else values, splits)
    chunked = cells(in_chunks(df, record_id, facts, profile.chunk_size), "chunk")
    rows = facts["rows"] if own else facts["rows"] + profile.facts["rows"]
    return compare_chunks(chunked, distribution, profile.chunk_size, rows, splits)


def compare_batch(profile: ReferenceProfile, batch: DataFrame, record_id: str = "record_id", js_upper: float = JS_UPPER) -> DataFrame:
    """Drift of each feature per chunk of a later batch, from the stored profile alone; as ``detect_univariate_drift``."""
    df = typed_features(batch, profile.features, profile.numeric, record_id)
    measures = F.min(record_id).alias("low"), F.max(record_id).alias("high"), F.count("*").alias("rows")
    facts = df.agg(*measures).first().asDict()
    # The batch may lie where the reference is thin, so its own bounds are added.
    splits = {i: sorted({*s, *profile.splits.get(i, s)}) for i, s in numeric_splits(df, profile.features, profile.numeric, facts["rows"]).items()}
    found = _chunks_of(df, profile, record_id, facts, splits or profile.splits, own=False).checkpoint()
    return _reported(found, profile, "analysis", facts, js_upper)


def reference_report(profile: ReferenceProfile, js_upper: float = JS_UPPER) -> DataFrame:
    """The reference's own chunks against it, in the same form."""
    return _reported(profile.chunks, profile, "reference", profile.facts, js_upper)


def _reported(found: DataFrame, profile: ReferenceProfile, period: str, facts: Mapping, js_upper: float) -> DataFrame:
    ordered = F.col("feature").isin(*[profile.features.index(c) for c in profile.numeric]) if profile.numeric else F.lit(False)
    # One row of limits per monitored feature.
    found = found.withColumn("ks", F.when(ordered, F.col("ks"))).join(F.broadcast(profile.limits), "feature", "left")
    alert = (F.col("ks") > F.col("ks_upper")) | F.coalesce(F.col("ks") < F.col("ks_lower"), F.lit(False))
    report = found.withColumns(
        {
            "period": F.lit(period),
            "feature": F.get(F.array(*[F.lit(c) for c in profile.features]), F.col("feature")),
            "ks_alert": F.when(F.col("ks").isNotNull(), alert),
            "js_upper": F.lit(float(js_upper)),
            "js_alert": F.col("js") > js_upper,
        }
    )
    return with_positions(report, profile.chunk_size, profile.facts, facts)


def detect_univariate_drift(
    reference: DataFrame,
    analysis: DataFrame,
    features: Sequence[str],
    chunk_size: int = 100,
    record_id: str = "record_id",
    js_upper: float = JS_UPPER,
    ks_deviations: float = KS_DEVIATIONS,
) -> DataFrame:
    """Drift of each feature per chunk of consecutive records, for both periods.

    Record ids of the analysis follow those of the reference. Numeric features get the
    Kolmogorov-Smirnov statistic with limits mean +/- deviations * std over the reference chunks; all
    features get the Jensen-Shannon distance with a constant limit. One row per (feature, period, chunk).
    """
    profile = profile_reference(reference, features, chunk_size, record_id, ks_deviations)
    return reference_report(profile, js_upper).unionByName(compare_batch(profile, analysis, record_id, js_upper))


def with_positions(df: DataFrame, chunk_size: int, reference: Mapping, analysis: Mapping) -> DataFrame:
    """First and last position and rows of each chunk; analysis positions continue after the reference."""
    in_reference = F.col("period") == "reference"
    shift = F.when(in_reference, 0).otherwise((reference["high"] or 0) + 1)
    rows = F.when(in_reference, reference["rows"]).otherwise(analysis["rows"])
    first = F.col("chunk") * chunk_size
    after = F.least(first + chunk_size, rows)
    return df.withColumns(
        {
            "start": (first + shift).cast("long"),
            "end": (after - 1 + shift).cast("long"),
            "n_rows": (after - first).cast("long"),
        }
    )
