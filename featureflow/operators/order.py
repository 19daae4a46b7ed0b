"""Global order without a single-task sort: row numbers, running totals and exact cuts."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.session import shared_folder

# Histogram bins per round: every map task may send one row per bin, so not too many of them.
BINS = 1 << 14
# Rows a boundary search may bring to the driver.
SMALL = 20_000
# Rows that one task is given to sort, and distinct values that one task may rank.
ROWS_PER_RANGE = ONE_TASK = 1_000_000
SAMPLES_PER_RANGE = 1000


def range_count(df: DataFrame, rows: int = 0) -> int:
    """How many value ranges to cut a column into: by the number of rows, at least the shuffle parallelism."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_RANGE))


def range_splits(df: DataFrame, columns: Sequence[str], rows: int | None = None, ranges: int | None = None) -> list[list[float]]:
    """Bounds that cut each numeric column into ranges of about equal row counts; their number unless given by the rows.

    Large tables are sampled for it, as a range partitioner does: the bounds decide only how even the
    ranges are, every row is still placed by its own value.
    """
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    rows = df.count() if rows is None else rows
    ranges = ranges or range_count(df, rows)
    if rows > SAMPLES_PER_RANGE * ranges:
        doubles = doubles.sample(SAMPLES_PER_RANGE * ranges / rows, seed=42)
    probabilities = [i / ranges for i in range(1, ranges)]
    quantiles = doubles.approxQuantile(list(columns), probabilities, 0.25 / ranges)
    return [[-np.inf, *(sorted({float(x) for x in q}) or [0.0]), np.inf] for q in quantiles]


def value_ranges(
    df: DataFrame, columns: Sequence[str], prefix: str = "_range_", splits: list[list[float]] | None = None
) -> DataFrame:
    """Add one range number per numeric column, in value order.

    The bounds are literals, so the numbering is a pure function of the value: a recomputed task after a
    lost executor gets the same ranges.
    """
    inputs = [f"{prefix}{c}_in" for c in columns]
    outputs = [f"{prefix}{c}_out" for c in columns]
    bucketizer = Bucketizer(
        splitsArray=splits or range_splits(df, columns),
        inputCols=inputs,
        outputCols=outputs,
        handleInvalid="keep",
    )
    numbered = bucketizer.transform(df.withColumns({i: F.col(c).cast("double") for i, c in zip(inputs, columns)}))
    return numbered.withColumns(
        {prefix + c: F.col(o).cast("int") for c, o in zip(columns, outputs)}
    ).drop(*inputs, *outputs)


def non_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a value in every column, as separate conditions.

    Unlike ``dropna``, the optimizer then knows each column to be non-null and adds no filters of its
    own above joins, so that several uses of one shuffle stay identical and it runs only once.
    """
    return df.where(reduce(operator.and_, [F.col(c).isNotNull() for c in columns]))


def running_total(
    df: DataFrame,
    value: str,
    measure: Column,
    within: Sequence[str] = (),
    range_column: str | None = None,
    name: str = "before",
) -> DataFrame:
    """Add ``name``: the total of ``measure`` over rows with a lower value in the same group.

    Each value range is summed on its own and shifted by the total of the ranges before it. Only
    the per-range totals (groups x ranges rows) meet in one place. ``value`` must be unique within
    a group, so aggregate first; a hot value is then a single row.
    """
    ranged = df
    if range_column is None:
        range_column = f"_range_{value}"
        ranged = value_ranges(df, [value])
    keys = [*within, range_column]
    ranged = non_null(ranged.withColumn("_measure", measure), [*keys, value])
    totals = ranged.groupBy(*keys).agg(F.sum("_measure").alias("_total"))
    earlier = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    earlier = earlier.orderBy(range_column).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    inside = (
        Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    )
    local = ranged.withColumn("_local", F.coalesce(F.sum("_measure").over(inside), F.lit(0)))
    return (
        local.join(offsets, keys)
        .withColumn(name, F.col("_local") + F.col("_offset"))
        .drop("_local", "_offset", "_measure", range_column)
    )


def number_rows(df: DataFrame, key: str, name: str = "position", tie: str | None = None) -> DataFrame:
    """Add a dense 0-based number in the order of a numeric or timestamp key; equal keys by ``tie``.

    Integer keys without gaps or repeats are already row numbers and only get shifted. Otherwise a
    window runs per value range, and each range is about an equal share of the rows, so the work is
    spread whatever the key's distribution is.
    """
    span = df.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count("*").alias("n")).first()
    return place_rows(df, key, span["low"], span["high"], span["n"], name, tie)


def is_dense(df: DataFrame, key: str, low: int, high: int, n: int) -> bool:
    """Whether an integer key takes each value from ``low`` to ``high`` once.

    With as many rows as values, the sums of the values' hashes agree with those of the whole range if
    there are no repeats, and otherwise only by a chance of about one in 2**64.
    """
    if high - low + 1 != n:
        return False
    hashes = F.sum(F.xxhash64(F.col("k").cast("long")).cast("decimal(38,0)")).alias("s")
    own = df.select(F.col(key).alias("k")).agg(hashes).first()["s"]
    return own == df.sparkSession.range(low, high + 1).withColumnRenamed("id", "k").agg(hashes).first()["s"]


def place_rows(df: DataFrame, key: str, low, high, n: int, name: str = "position", tie: str | None = None) -> DataFrame:
    """``number_rows`` when the key's range and the number of rows are known."""
    if isinstance(df.schema[key].dataType, T.IntegralType) and (not n or is_dense(df, key, low, high, n)):
        return df.withColumn(name, F.col(key).cast("long") - F.lit(low or 0))
    order = df.withColumn("_order", F.col(key).cast("double"))
    splits = range_splits(order, ["_order"], n)
    ranged = value_ranges(order, ["_order"], "_r", splits)
    ranged = _split_hot_keys(ranged, key, tie, n).drop("_order")
    places = ["_r_order", "_r_tie"]
    counts = ranged.groupBy(*places).agg(F.count("*").alias("_n"))
    # One row per range.
    earlier = Window.partitionBy(F.lit(0)).orderBy(*places).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*places, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*places).orderBy(key, *([tie] if tie else []))
    # One row per range: Spark broadcasts them by itself.
    return (
        ranged.withColumn("_local", F.row_number().over(inside) - 1)
        .join(offsets, places)
        .withColumn(name, (F.col("_local") + F.col("_offset")).cast("long"))
        .drop(*places, "_local", "_offset")
    )


def _split_hot_keys(ranged: DataFrame, key: str, tie: str | None, n: int) -> DataFrame:
    """Add ``_r_tie``, the second part of a range's number: a range that one key fills is cut by the tie.

    Equal keys can't be told apart by bounds of the key. A range with more than its share of rows that holds
    one key alone, or a hot key and few others, is therefore divided into what lies below the key, ranges of
    the tie among the rows of the key, and what lies above it. Without a numeric tie rows of one key have no
    order to cut by.
    """
    whole = ranged.withColumn("_r_tie", F.lit(0))
    if tie is None or not isinstance(ranged.schema[tie].dataType, (T.NumericType, T.TimestampType)):
        return whole
    share = max(1, -(-n // range_count(ranged, n)))
    # Few ranges and keys can have so many rows: what is fetched is at most the number of ranges.
    sizes = ranged.groupBy("_r_order").agg(F.count("*").alias("n")).where(F.col("n") > 2 * share)
    crowded = [r["_r_order"] for r in sizes.collect()]
    if not crowded:
        return whole
    keys = ranged.where(F.col("_r_order").isin(crowded) & F.col(key).isNotNull()).groupBy("_r_order", F.col(key).alias("k"))
    hot = keys.agg(F.count("*").alias("n")).where(F.col("n") > share).orderBy("k").collect()
    rows = ranged.withColumns({"_tie": F.col(tie).cast("double"), "_r_tie": F.lit(0)})
    start = 1
    for r in hot:
        here, own = F.col("_r_order") == r["_r_order"], F.col(key) == F.lit(r["k"])
        [bounds] = range_splits(rows.where(own).select("_tie"), ["_tie"], r["n"], max(2, -(-r["n"] // share)))
        rows = value_ranges(rows, ["_tie"], "_at", [bounds])
        # Null ties come first, as in the order of the rows.
        inside = F.when(F.col("_tie").isNull(), 0).otherwise(F.col("_at_tie")) + start
        number = F.when(here & own, inside).when(here & (F.col(key) > F.lit(r["k"])), start + len(bounds)).otherwise(F.col("_r_tie"))
        rows = rows.withColumn("_r_tie", number).drop("_at_tie")
        start += len(bounds) + 1
    return rows.drop("_tie")


def number_values(values: DataFrame, column: str, name: str = "code") -> DataFrame:
    """Add a dense 0-based number in sort order of a distinct column of any orderable type.

    Strings have no quantiles, so the values are range-partitioned by Spark, numbered inside each
    partition, and written to the shared checkpoint folder: partition numbers must not change
    between the pass that counts them and the pass that uses them.
    """
    shared_folder(values.sparkSession)
    ranges = range_count(values)
    ordered = values.repartitionByRange(ranges, column).sortWithinPartitions(column)
    placed = ordered.withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    placed = placed.select(
        *values.columns,
        F.shiftright("_id", 33).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_local"),
    )
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    # One row per partition.
    return (
        placed.join(offsets, "_part")
        .withColumn(name, (F.col("_local") + F.col("_offset")).cast("long"))
        .drop("_part", "_local", "_offset")
    )


@dataclass(frozen=True)
class Cut:
    """The boundary row of an ordering: ``taken`` rows are at or before it."""

    key: int | None
    row_id: object
    taken: int
    total: int

    def predicate(self, key: Column, row_id: Column) -> Column:
        """True for the rows up to the boundary; its negation is exactly the rest."""
        if self.taken >= self.total:
            return F.lit(True)
        if self.taken <= 0 or self.key is None:
            return F.lit(False)
        return (key < self.key) | ((key == self.key) & (row_id <= F.lit(self.row_id)))


def exact_cut(
    df: DataFrame,
    key: Column,
    row_id: str,
    take,
    low: int | None = None,
    high: int | None = None,
) -> Cut:
    """Boundary of the first ``take(total)`` rows ordered by (key, row_id), without sorting the table.

    A histogram of at most 16 384 bins over the key finds the bin with the boundary, which is then
    split again until it is small; every step is one scan with map-side counting. Splitting by the
    resulting literal predicate needs no shuffle at all. A row id that repeats at the boundary, where it
    would make the cut inexact, is an error.
    """
    keyed = df.select(key.alias("k"), F.col(row_id).alias("r"))
    if low is None or high is None:
        span = keyed.agg(F.min("k"), F.max("k")).first()
        if span[0] is None:
            return Cut(None, None, 0, 0)
        low, high = span[0], span[1] + 1
    if high - low >= 1 << 63:  # differences of keys must fit 64 bits: bins over halved keys
        low -= low % 2
    total = None
    before = 0
    while True:
        width = -(-(high - low) // BINS)
        inside = keyed if total is None else keyed.where((F.col("k") >= low) & (F.col("k") <= high - 1))
        if high - low >= 1 << 63:
            width += width % 2
            ends_of = inside.select(F.shiftright("k", 1).alias("k"), F.lit(low // 2).alias("low"), F.lit(width // 2).alias("width"))
        else:
            ends_of = inside.select("k", F.lit(low).alias("low"), F.lit(width).alias("width"))
        bin_number = F.expr("(k - low) div width")
        rows = ends_of.groupBy(bin_number.cast("int").alias("b")).agg(F.count("*").alias("n")).collect()
        bins = np.zeros(BINS + 1, dtype=np.int64)
        for r in rows:
            if r["b"] is None:
                raise ValueError(f"{row_id} has null values")
            bins[r["b"]] = r["n"]
        ends = before + np.cumsum(bins)
        if total is None:
            total = int(ends[-1])
            wanted = min(max(int(take(total)), 0), total)
            if wanted in (0, total):
                return Cut(None, None, wanted, total)
        at = int(np.searchsorted(ends, wanted))
        before = int(ends[at] - bins[at])
        low, high = low + at * width, min(high, low + (at + 1) * width)
        if bins[at] <= SMALL:
            break
        if high - low == 1:
            raise ValueError(f"more than {SMALL} rows share one key: {row_id} must be unique")
    # The bin holds SMALL rows at most.
    rows = sorted(tuple(r) for r in keyed.where((F.col("k") >= low) & (F.col("k") <= high - 1)).collect())
    edge_key, edge_row = rows[wanted - before - 1]
    if rows.count((edge_key, edge_row)) > 1:
        raise ValueError(f"{row_id} {edge_row} occurs more than once: {row_id} must be unique")
    return Cut(edge_key, edge_row, wanted, total)
