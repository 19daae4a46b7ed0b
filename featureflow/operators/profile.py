"""Profiling: counts, missing values, describe, correlations, histograms, labelings, errors."""

from __future__ import annotations

import itertools
import math
import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.functions.scalar import nan_to_null, round_2dp
from featureflow.operators.clean import missing, nulls_for_nans
from featureflow.operators.order import ONE_TASK, non_null, running_total, value_ranges
from featureflow.schemas import numeric_columns
from featureflow.session import scratch_path


# Quantile sketches are off by at most one in this many rows. Every map task sends a sketch, so they are
# kept small and repeated inside the bracket instead.
SKETCH = 2_000


def value_counts(df: DataFrame, column: str, ascending: bool = False) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).count()
    return counts.orderBy(F.asc("count") if ascending else F.desc("count"), F.col(column))


#: Values that the sketch behind ``top_values`` keeps track of, from try to try.
TRACKED = (10_000, 300_000)
#: A sketch that tracks m values misjudges a count by at most this share of the rows, over m.
SKETCH_ERROR = 2.625


def top_values(df: DataFrame, column: str, k: int = 10, tracked: Sequence[int] = TRACKED) -> DataFrame:
    """The k most frequent values; equal counts in value order.

    A sketch finds the values that may be among them, and only these are counted: a few rows are shuffled
    however many distinct values there are. The sketch reports every value whose count is above twice its
    error, so the answer is complete if the k-th count is, or if the values found are all rows. Else a
    larger sketch is tried, and in the end all values are counted.
    """
    present = df.where(F.col(column).isNotNull()).select(column)
    if not isinstance(df.schema[column].dataType, (T.StringType, T.IntegralType, T.DateType, T.BooleanType)):
        return value_counts(df, column).limit(k)
    for size in tracked:
        sketch = F.expr(f"approx_top_k(`{column}`, {size}, {size})")
        found = present.agg(sketch.alias("top"), F.count("*").alias("n"))
        total = found.first()["n"]
        # At most ``size`` values.
        candidates = found.select(F.explode("top.item").alias(column))
        counted = present.join(F.broadcast(candidates), column, "left_semi").groupBy(column).count()
        best = counted.orderBy(F.desc("count"), F.col(column)).limit(k)
        about = counted.agg(F.sum("count").alias("rows")).first()["rows"] or 0
        counts = [r["count"] for r in best.collect()]
        if about == total or (len(counts) == k and counts[-1] > 2 * SKETCH_ERROR / size * total):
            return best
    return value_counts(df, column).limit(k)


def value_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, in value order."""
    return df.where(F.col(column).isNotNull()).groupBy(column).count().orderBy(column)


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """(column, n_unique) with nulls left out; ``approximate`` trades exactness for one pass."""
    names = list(columns or df.columns)
    df = nulls_for_nans(df)
    if approximate:
        row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in names])
        return _unpivot_row(row, names, "n_unique")
    # One typed distinct count per column: each reads and shuffles its own column only.
    counts = [df.agg(F.countDistinct(c).alias("n_unique")).select(F.lit(c).alias("column"), "n_unique") for c in names]
    return reduce(DataFrame.unionAll, counts)


def _unpivot_row(row: DataFrame, names: Sequence[str], value: str) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias(value)) for c in names])
    return row.select(F.explode(cells).alias("cell")).select("cell.column", f"cell.{value}")


def table_info(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null); NaN counts as null."""
    names = df.columns
    present = df.agg(*[F.count_if(~missing(df, c)).alias(c) for c in names])
    counted = _unpivot_row(present, names, "non_null")
    return counted.withColumn("dtype", _dtype(df)).select("column", "dtype", "non_null")


def _dtype(df: DataFrame) -> Column:
    branches = None
    for name, dtype in df.dtypes:
        branches = (F.when if branches is None else branches.when)(F.col("column") == name, dtype)
    return branches


def missing_table(df: DataFrame) -> DataFrame:
    """(column, missing_count, missing_percentage) of the columns with nulls, worst first."""
    names = df.columns
    nulls = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(missing(df, c)).alias(c) for c in names]
    )
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing_count")) for c in names]
    )
    long = nulls.select("_rows", F.explode(cells).alias("cell")).select("_rows", "cell.*")
    percentage = round_2dp(F.col("missing_count") / F.col("_rows") * 100)
    return (
        long.where(F.col("missing_count") > 0)
        .select("column", "missing_count", percentage.alias("missing_percentage"))
        .orderBy(F.desc("missing_count"), "column")
    )


def column_profile(df: DataFrame) -> DataFrame:
    """(column, dtype, nulls, nulls_pct, n_unique), most nulls first."""
    names = df.columns
    nulls = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(missing(df, c)).alias(c) for c in names]
    )
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in names])
    long = nulls.select("_rows", F.explode(cells).alias("cell")).select("_rows", "cell.*")
    return (
        long.join(distinct_counts(df), "column")
        .select(
            "column",
            _dtype(df).alias("dtype"),
            "nulls",
            round_2dp(F.col("nulls") / F.col("_rows") * 100).alias("nulls_pct"),
            "n_unique",
        )
        .orderBy(F.desc("nulls"), "column")
    )


def numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles, with null for NaN."""
    return df.select(
        *[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in columns]
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
) -> dict[str, list[float | None]]:
    """Exact linearly interpolated quantiles of numeric columns, null and NaN left out.

    Quantile sketches bracket the wanted ranks until few distinct values are left in each bracket; only
    those are grouped and ranked.
    """
    clean = numbers(df, columns).persist()
    try:
        return _interpolated(clean, columns, probabilities)
    finally:
        clean.unpersist()


def _interpolated(clean: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> dict:
    sizes = clean.agg(*[F.count(c).alias(c) for c in columns]).first()
    wanted = {}
    for c in columns:
        for p in probabilities:
            position = (sizes[c] - 1) * p
            ranks = {math.floor(position), math.ceil(position)} if sizes[c] else set()
            wanted.update({(c, rank): None for rank in ranks})
    found = _order_statistics(clean, {c: sizes[c] for c in columns}, list(wanted))
    result = {}
    for c in columns:
        result[c] = []
        for p in probabilities:
            position = (sizes[c] - 1) * p
            if not sizes[c]:
                result[c].append(None)
                continue
            a, b = found[(c, math.floor(position))], found[(c, math.ceil(position))]
            result[c].append(a + (b - a) * (position - math.floor(position)))
    return result


def _order_statistics(clean: DataFrame, sizes: Mapping[str, int], wanted: Sequence[tuple[str, int]]) -> dict:
    """Value at each wanted (column, 0-based rank).

    Every round is two scans, whatever the number of ranks: one for the sketches, one to measure the new
    brackets. A round shrinks a bracket some 500-fold: one serves half a billion rows, three any table.
    Neighbouring ranks share their bracket.
    """
    # bracket (column, low, high) -> rows below it, rows and distinct values inside it
    whole = {c: (c, -math.inf, math.inf) for c in sizes}
    known = {whole[c]: (0, n, n) for c, n in sizes.items()}
    bracket = {(c, rank): whole[c] for c, rank in wanted}
    stuck: set = set()

    def inside(b):
        return F.col(b[0]).between(b[1], b[2])

    while True:
        wide = {t: b for t, b in bracket.items() if known[b][2] > ONE_TASK and b not in stuck}
        if not wide:
            break
        ends: dict = {}
        for t, b in wide.items():
            share = (t[1] - known[b][0]) / known[b][1]
            ends.setdefault(b, {})[t] = (max(share - 2 / SKETCH, 0.0), min(share + 2 / SKETCH, 1.0))
        points = {b: sorted({p for pair in of.values() for p in pair}) for b, of in ends.items()}
        sketches = [
            F.percentile_approx(F.when(inside(b), F.col(b[0])), p, SKETCH).alias(f"s{i}")
            for i, (b, p) in enumerate(points.items())
        ]
        sketched = clean.agg(*sketches).first()
        for i, (b, p) in enumerate(points.items()):
            at = dict(zip(p, sketched[f"s{i}"]))
            for t, (a, z) in ends[b].items():
                narrowed = (b[0], at[a], at[z])
                if narrowed == b:
                    stuck.add(b)
                bracket[t] = narrowed
        new = [b for b in dict.fromkeys(bracket.values()) if b not in known]
        measures = []
        for i, b in enumerate(new):
            measures += [
                F.count_if(F.col(b[0]) < b[1]).alias(f"below{i}"),
                F.count_if(inside(b)).alias(f"rows{i}"),
                F.approx_count_distinct(F.when(inside(b), F.col(b[0]))).alias(f"values{i}"),
            ]
        if new:
            measured = clean.agg(*measures).first()
            known.update({b: tuple(measured[f"{k}{i}"] for k in ("below", "rows", "values")) for i, b in enumerate(new)})

    brackets = list(dict.fromkeys(bracket.values()))
    cells = [
        F.when(inside(b), F.struct(F.lit(i).alias("bracket"), F.col(b[0]).alias("value")))
        for i, b in enumerate(brackets)
    ]
    counts = (
        clean.select(F.explode(F.array_compact(F.array(*cells))).alias("cell"))
        .groupBy("cell.bracket", "cell.value")
        .agg(F.count("*").alias("n"))
    )
    if stuck:  # hot values at both ends kept a bracket from shrinking
        ranked = running_total(counts, "value", F.col("n"), within=["bracket"])
    else:
        earlier = Window.partitionBy("bracket").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
        ranked = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    place = {t: (brackets.index(b), t[1] - known[b][0]) for t, b in bracket.items()}
    hits = [
        (F.col("bracket") == i) & (F.col("before") <= rank) & (F.col("before") + F.col("n") > rank)
        for i, rank in set(place.values())
    ]
    # One value per wanted rank.
    rows = ranked.where(reduce(operator.or_, hits)).collect()
    return {
        t: next(r["value"] for r in rows if r["bracket"] == i and r["before"] <= rank < r["before"] + r["n"])
        for t, (i, rank) in place.items()
    }


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std (sample), min, 25%, 50%, 75% and max, one row per statistic."""
    names = list(columns or numeric_columns(df.schema))
    moments = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    quartiles = (0.25, 0.5, 0.75)
    measures = [f(F.col(c)).cast("double").alias(f"{c}|{s}") for c in names for s, f in moments.items()]
    row = numbers(df, names).agg(*measures).first().asDict()
    quantiles = exact_quantiles(df, names, quartiles)
    for c in names:
        for label, q in zip(("25%", "50%", "75%"), quantiles[c] or (None,) * 3):
            row[f"{c}|{label}"] = q
    order = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")
    lines = [(s, *[row[f"{c}|{s}"] for c in names]) for s in order]
    schema = "summary string, " + ", ".join(f"`{c}` double" for c in names)
    return df.sparkSession.createDataFrame(lines, schema)


def grouped_mean(df: DataFrame, key: str, column: str, name: str = "mean") -> DataFrame:
    """Mean per group, lowest first; a boolean column gives its success rate."""
    kind = dict(df.dtypes)[column]
    value = F.col(column).cast("int") if kind == "boolean" else nan_to_null(F.col(column).cast("double"))
    means = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(value.cast("double")).alias(name))
    return means.orderBy(name, key)


def group_mean_on_rows(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    """Add each row's group mean, NaN left out; rows with a null key get null.

    Aggregate and join back instead of a window: the aggregation combines map-side, so a key
    with a third of all rows does not end up in one task, and the small side can be broadcast. Rows
    without a key stay out of the join.
    """
    keyed = df.where(F.col(key).isNotNull())
    means = keyed.groupBy(key).agg(F.avg(nan_to_null(F.col(column).cast("double"))).alias(name))
    without = df.where(F.col(key).isNull()).withColumn(name, F.lit(None).cast("double"))
    return keyed.join(means, key).unionByName(without)


def overall_counts_of(df: DataFrame, column: str, selection: Column, k: int = 20) -> DataFrame:
    """The k values most frequent among the selected rows, with their count over all rows."""
    top = top_values(df.where(selection), column, k).select(column)
    totals = df.where(F.col(column).isNotNull()).groupBy(column).count()
    return totals.join(top, column, "left_semi").orderBy(F.desc("count"), column)


def rows_with_top_values(df: DataFrame, column: str, k: int = 15) -> DataFrame:
    """Rows whose value is among the k most frequent."""
    return df.join(F.broadcast(top_values(df, column, k).select(column)), column, "left_semi")


def first_rows(df: DataFrame, n: int = 10, row_id: str = "row_id") -> DataFrame:
    return df.orderBy(row_id).limit(n)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def pearson_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_a, column_b, correlation) for every ordered pair, each on rows with both values."""
    names = list(columns or numeric_columns(df.schema))
    pairs = list(itertools.combinations_with_replacement(names, 2))
    row = numbers(df, names).agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    return _matrix(row, pairs)


def _matrix(row: DataFrame, pairs) -> DataFrame:
    cells = []
    for a, b in pairs:
        for x, y in {(a, b), (b, a)}:
            cells.append(
                F.struct(
                    F.lit(x).alias("column_a"),
                    F.lit(y).alias("column_b"),
                    F.col(f"`{a}|{b}`").alias("correlation"),
                )
            )
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def spearman_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rank correlation of every ordered pair, ranked on the rows where both values are present.

    A column is ranked once, over its counted distinct values, for all pairs whose two columns are missing
    in the same rows; their correlations are then one aggregation over the rows' ranks. Only a pair of columns
    with different gaps is ranked by itself.
    """
    names = list(columns or numeric_columns(df.schema))
    data = numbers(df, names)
    pairs = list(itertools.combinations(names, 2))
    diagonal = df.sparkSession.createDataFrame([(c, c, 1.0) for c in names], "column_a string, column_b string, correlation double")
    if not pairs:
        return diagonal
    gaps = data.agg(*[F.count_if(F.col(a).isNull() != F.col(b).isNull()).alias(f"{a}|{b}") for a, b in pairs]).first()
    alike = [p for p in pairs if not gaps["|".join(p)]]
    parts = [diagonal]
    if alike:
        parts.append(_matrix(_rank_correlations(data, alike), alike))
    if len(alike) < len(pairs):
        parts.append(_paired_rank_correlations(data, names, [p for p in pairs if p not in alike]))
    return reduce(DataFrame.unionByName, parts)


def _rank_correlations(data: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """One row with the rank correlation of each pair; the columns of a pair have the same gaps."""
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    ranged = value_ranges(data.select(*names), names)
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), F.col(f"_range_{c}").alias("range")) for c in names]
    # Values are counted before they leave their task; from here on a hot value is one row.
    counts = ranged.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").where(F.col("value").isNotNull())
    counts = non_null(counts, ["column", "value", "range"]).groupBy("column", "value", "range").agg(F.count("*").alias("n"))
    ranked = running_total(counts, "value", F.col("n"), within=["column"], range_column="range")
    ranked = ranked.select("column", "value", (F.col("before") + (F.col("n") + 1) / 2).alias("rank"))
    path = scratch_path(data.sparkSession, "ranks")
    ranked.write.partitionBy("column").parquet(path)
    ranked = data.sparkSession.read.schema(ranked.schema).parquet(path)
    rows = data.select(*names)
    for c in names:
        own = ranked.where(F.col("column") == c).select(F.col("value").alias("_value"), F.col("rank").alias(f"_rank_{c}"))
        # No hint: Spark broadcasts few distinct values and splits a hot one's rows otherwise.
        rows = rows.join(own, F.col(c) == F.col("_value"), "left").drop("_value")
    return rows.agg(*[F.corr(f"_rank_{a}", f"_rank_{b}").alias(f"{a}|{b}") for a, b in pairs])


def _paired_rank_correlations(data: DataFrame, names: Sequence[str], pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(column_a, column_b, correlation) of pairs with different gaps, both ways round.

    Rows are first reduced to counted (x, y) pairs; average ranks come from running totals over
    distinct values, so ties and hot values cost one row each.
    """
    ranged = value_ranges(data, names)
    cells = [
        F.struct(
            F.lit(f"{a}|{b}").alias("pair"),
            F.col(a).alias("x"),
            F.col(f"_range_{a}").alias("x_range"),
            F.col(b).alias("y"),
            F.col(f"_range_{b}").alias("y_range"),
        )
        for a, b in pairs
    ]
    keys = ["pair", "x", "x_range", "y", "y_range"]
    counts = ranged.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
    # All keys are non-null from here on, so that every later use shares one computed shuffle.
    counts = non_null(counts, keys).groupBy(*keys).agg(F.count("*").alias("n"))

    def ranks(which: str) -> DataFrame:
        values = counts.groupBy("pair", which, f"{which}_range").agg(F.sum("n").alias("n"))
        ranked = running_total(values, which, F.col("n"), within=["pair"], range_column=f"{which}_range")
        return ranked.select("pair", which, (F.col("before") + (F.col("n") + 1) / 2).alias(f"rank_{which}"))

    pairs_ranked = counts.select("pair", "x", "y", "n")
    ranked = pairs_ranked.join(ranks("x"), ["pair", "x"]).join(ranks("y"), ["pair", "y"])
    x, y, n = F.col("rank_x"), F.col("rank_y"), F.col("n")
    sums = ranked.groupBy("pair").agg(
        F.sum(n).alias("n"),
        F.sum(n * x).alias("sx"),
        F.sum(n * y).alias("sy"),
        F.sum(n * x * x).alias("sxx"),
        F.sum(n * y * y).alias("syy"),
        F.sum(n * x * y).alias("sxy"),
    )
    cov = F.col("sxy") - F.col("sx") * F.col("sy") / F.col("n")
    var_x = F.col("sxx") - F.col("sx") * F.col("sx") / F.col("n")
    var_y = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n")
    rho = F.when((var_x > 0) & (var_y > 0), cov / F.sqrt(var_x * var_y))
    a, b = F.substring_index("pair", "|", 1), F.substring_index("pair", "|", -1)
    both = F.array(
        F.struct(a.alias("column_a"), b.alias("column_b"), rho.alias("correlation")),
        F.struct(b.alias("column_a"), a.alias("column_b"), rho.alias("correlation")),
    )
    return sums.select(F.explode(both).alias("cell")).select("cell.*")


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """(bin, low, high, count): equal-width bins over the range, the last one closed; empty bins too."""
    value = F.col(column).cast("double")
    present = df.where(value.isNotNull() & ~F.isnan(value)).select(value.alias("v"))
    span = present.agg(F.min("v"), F.max("v")).first()
    if span[0] is None:
        return df.sparkSession.createDataFrame([], "bin int, low double, high double, count long")
    low, high = span if span[0] < span[1] else (span[0] - 0.5, span[1] + 0.5)
    counts = present.groupBy(equal_width_bin(F.col("v"), low, high, bins).alias("bin")).count()
    step = (high - low) / bins
    grid = df.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"),
        (F.lit(low) + F.col("id") * step).alias("low"),
        F.when(F.col("id") == bins - 1, F.lit(high)).otherwise(F.lit(low) + (F.col("id") + 1) * step).alias("high"),
    )
    return grid.join(F.broadcast(counts), "bin", "left").fillna(0, ["count"]).orderBy("bin")


def equal_width_bin(value: Column, low: float, high: float, bins: int) -> Column:
    """Bin number in [0, bins - 1], corrected where division put a value on the wrong side of an edge."""
    step = (high - low) / bins
    guess = F.least(F.floor((value - low) / (high - low) * bins).cast("int"), F.lit(bins - 1))
    down = value < F.lit(low) + guess * step
    up = (value >= F.lit(low) + (guess + 1) * step) & (guess != bins - 1)
    return F.when(down, guess - 1).when(up, guess + 1).otherwise(guess)


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence | None = None) -> DataFrame:
    """Frequencies of the combinations of two columns, nulls left out.

    (rows, columns, count) in long form, whatever the number of values; with ``values`` one column for
    each of them, zero where a combination does not occur.
    """
    both = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    if values is None:
        return both.groupBy(rows, columns).count()
    return both.groupBy(rows).pivot(columns, list(values)).count().na.fill(0)


def mean_matrix(df: DataFrame, rows: str, columns: str, value: str, values: Sequence | None = None) -> DataFrame:
    """Means of the combinations of two columns: (rows, columns, mean), or one column for each of ``values``."""
    kind = dict(df.dtypes)[value]
    number = F.col(value).cast("int") if kind == "boolean" else nan_to_null(F.col(value).cast("double"))
    mean = F.avg(number.cast("double"))
    both = df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
    if values is None:
        return both.groupBy(rows, columns).agg(mean.alias("mean"))
    return both.groupBy(rows).pivot(columns, list(values)).agg(mean)


def label_share(df: DataFrame, label: str, value: str = "other") -> DataFrame:
    """Percentage of rows with the label value (nulls count as rows)."""
    hits = F.count_if(F.col(label) == value)
    return df.agg(hits.alias("n_label"), F.count("*").alias("n_rows")).withColumn(
        "share_pct", F.col("n_label") / F.col("n_rows") * 100
    )


def label_reduction(df: DataFrame, before: str, after: str, value: str = "other") -> DataFrame:
    """How much rarer a label is in the second labeling, in percent; 0 when it never occurred."""
    counted = df.agg(
        F.count_if(F.col(before) == value).alias("n_before"),
        F.count_if(F.col(after) == value).alias("n_after"),
    )
    drop = (F.col("n_before") - F.col("n_after")) / F.nullif(F.col("n_before"), F.lit(0)) * 100
    return counted.withColumn("reduction_pct", F.coalesce(drop, F.lit(0.0)))


def compare_labelings(df: DataFrame, methods: Mapping[str, str], labels: Sequence[str]) -> DataFrame:
    """Label counts of several labelings side by side over a fixed label list, 0 when absent."""
    cells = F.array(
        *[F.struct(F.lit(m).alias("method"), F.col(c).alias("label")) for m, c in methods.items()]
    )
    long = df.select(F.explode(cells).alias("cell")).select("cell.*").where(F.col("label").isin(*labels))
    wide = long.groupBy("label").pivot("method", list(methods)).count()
    every = df.sparkSession.createDataFrame([(x,) for x in labels], "label string")
    return every.join(wide, "label", "left").na.fill(0)


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(mse, rmse, mae, r2) in two plain aggregations."""
    y = F.col(actual).cast("double")
    miss = y - F.col(predicted).cast("double")
    sums = df.agg(
        F.avg(miss * miss).alias("mse"),
        F.avg(F.abs(miss)).alias("mae"),
        F.var_pop(y).alias("_spread"),
    )
    r2 = F.lit(1.0) - F.col("mse") / F.nullif(F.col("_spread"), F.lit(0.0))
    return sums.select("mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2"))


def mean_and_std(df: DataFrame, column: str, label: str) -> DataFrame:
    """One labelled row with the mean and the sample standard deviation."""
    value = nan_to_null(F.col(column).cast("double"))
    return df.agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")).select(
        F.lit(label).alias("stage"), "mean", "std"
    )


def best_of(scores: DataFrame, name: str, score: str) -> DataFrame:
    """The candidate with the highest score."""
    return scores.agg(F.max_by(name, score).alias(name), F.max(score).alias(score))
