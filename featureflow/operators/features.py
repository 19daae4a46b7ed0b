"""Feature vectors from numbers and categories, fitted on the training rows and kept as tables.

A category column becomes a smoothed target mean or a one-hot vector; which one is said by the caller, never
by the number of categories. The categories live in a table that is joined, whatever their number. No
training row sees its own target: its mean is taken either from the other folds' rows ("mean") or from the
rows before it in a random order ("ordered"). Rows to be scored get the mean of all training rows.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from featureflow.functions.keyed import hash_key
from featureflow.operators.clean import nan_to_null
from featureflow.operators.order import number_values, range_count
from featureflow.session import scratch_path

#: Folds of the means of training rows, and the seed that deals rows to them.
MEAN_FOLDS, FOLD_SEED = 5, 17
#: Seed of the order in which rows see each other's targets.
ORDER_SEED = 23
#: Rows with the overall mean that each category's mean counts besides its own.
SMOOTHING = 1.0


def mean_fold(row_id: str) -> Column:
    """Fold of a row, 0 to ``MEAN_FOLDS`` - 1, by the hash of its id."""
    return (hash_key(FOLD_SEED, F.col(row_id)) % MEAN_FOLDS).cast("int")


@dataclass
class Features:
    """Fitted on a training table; ``transform`` adds the vector ``features``."""

    numeric: Mapping[str, float]
    encodings: Mapping[str, str]
    target_mean: float
    #: (column, value, code, n, total, fold_n, fold_total); a null value is a category of its own.
    categories: DataFrame | None
    #: Categories per one-hot column.
    sizes: Mapping[str, int]
    row_id: str = "row_id"
    target: str = ""

    def slots(self) -> list[str]:
        """Source column of each slot of the vector."""
        out = [c for c in self.numeric for _ in (0, 1)]
        for column, kind in self.encodings.items():
            out += [column] * (max(self.sizes[column] - 1, 0) if kind == "one_hot" else 1)
        return out

    def level(self, out_of_fold: bool) -> Column:
        """Smoothed target mean of the joined category; for training rows without those of their fold."""
        n, total = F.coalesce("_n", F.lit(0)), F.coalesce("_total", F.lit(0.0))
        if out_of_fold:
            at = mean_fold(self.row_id) + 1
            n = n - F.coalesce(F.element_at("_fold_n", at), F.lit(0))
            total = total - F.coalesce(F.element_at("_fold_total", at), F.lit(0.0))
        return (total + SMOOTHING * F.lit(self.target_mean)) / (n + SMOOTHING)

    def encoded(self, df: DataFrame, out_of_fold: bool = False) -> DataFrame:
        """``df`` with ``_<column>`` for every feature: a number, or a one-hot vector."""
        ordered = [c for c, kind in self.encodings.items() if kind == "ordered"] if out_of_fold else []
        if ordered:
            df = ordered_means(df, self.target, ordered, self.target_mean, self.row_id)
        for column, kind in self.encodings.items():
            if column in ordered:
                continue
            own = self.categories.where(F.col("column") == column)
            own = own.select(F.col("value").alias("_value"), *[F.col(c).alias(f"_{c}") for c in ("code", "n", "total", "fold_n", "fold_total")])
            # No hint: Spark broadcasts a small dictionary and splits a hot value's rows otherwise.
            df = df.join(own, F.col(column).cast("string").eqNullSafe(F.col("_value")), "left")
            if kind in ("mean", "ordered"):
                df = df.withColumn(f"_{column}", self.level(out_of_fold))
            else:
                # The first category and unseen ones share the code that the encoder leaves out.
                first = self.sizes[column] - 1
                code = F.when(F.col("_code") > 0, F.col("_code") - 1).otherwise(first)
                df = df.withColumn(f"_{column}_code", code.cast("double"))
            df = df.drop("_value", "_code", "_n", "_total", "_fold_n", "_fold_total")
        hot = [c for c, kind in self.encodings.items() if kind == "one_hot" and self.sizes[c] > 1]
        if hot:
            encoder = OneHotEncoder(inputCols=[f"_{c}_code" for c in hot], outputCols=[f"_{c}" for c in hot])
            # Fitted on the largest codes alone, as the encoder only learns how long its vectors are.
            longest = [tuple(float(self.sizes[c] - 1) for c in hot)]
            df = encoder.fit(df.sparkSession.createDataFrame(longest, [f"_{c}_code" for c in hot])).transform(df)
        numbers = {}
        for column, fill in self.numeric.items():
            value = nan_to_null(F.col(column).cast("double"))
            numbers[f"_{column}"] = F.coalesce(value, F.lit(fill))
            numbers[f"_{column}_missing"] = value.isNull().cast("double")
        return df.withColumns(numbers) if numbers else df

    def transform(self, df: DataFrame, out_of_fold: bool = False) -> DataFrame:
        inputs = [x for c in self.numeric for x in (f"_{c}", f"_{c}_missing")]
        inputs += [f"_{c}" for c, kind in self.encodings.items() if kind != "one_hot" or self.sizes[c] > 1]
        encoded = VectorAssembler(inputCols=inputs, outputCol="features").transform(self.encoded(df, out_of_fold))
        return encoded.select(*df.columns, "features")

    def save(self, path: str, spark: SparkSession) -> None:
        about = {k: getattr(self, k) for k in ("numeric", "encodings", "target_mean", "sizes", "row_id", "target")}
        spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
        if self.categories is not None:
            self.categories.write.mode("overwrite").parquet(f"{path}/categories")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> Features:
        about = json.loads(spark.read.text(f"{path}/about").first()[0])
        categories = spark.read.parquet(f"{path}/categories") if about["encodings"] else None
        return cls(categories=categories, **about)


def ordered_means(df: DataFrame, target: str, columns: Sequence[str], mean: float, row_id: str = "row_id") -> DataFrame:
    """``df`` with ``_<column>``: the smoothed target mean of the rows of the same category before each row.

    The order is that of a keyed hash of the row id, equal hashes by the id. Hashes are uniform, so equal
    ranges of them hold about equally many rows, and so does each category's share of a range: within a
    range a category's rows are totalled in order, on top of what it has in the ranges before. A category
    with a third of all rows is thereby as many tasks as there are ranges. Rows without a target count for
    nothing, but have a mean of their own; null is a category.
    """
    spark = df.sparkSession
    y = nan_to_null(F.col(target).cast("double"))
    ranges = range_count(df, df.count())
    order = hash_key(ORDER_SEED, F.col(row_id))
    # The hash has 60 bits; its upper 30 place it.
    placed = df.withColumn("_order", order).withColumn("_range", F.shiftright(F.shiftright("_order", 30) * ranges, 30).cast("int"))
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    # Copies of a row, one per category column, are totalled before they leave their task.
    totals = placed.select(F.explode(cells).alias("cell"), "_range", y.alias("y")).groupBy("cell.column", "cell.value", "_range")
    totals = totals.agg(F.count("y").alias("n"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("total"))
    # A category has at most one row a range here.
    earlier = Window.partitionBy("column", "value").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        "column",
        F.col("value").alias("_value"),
        F.col("_range").alias("_own_range"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_n"),
        F.coalesce(F.sum("total").over(earlier), F.lit(0.0)).alias("_total"),
    )
    path = scratch_path(spark, "totals-before")
    before.write.parquet(path)
    before = spark.read.schema(before.schema).parquet(path)
    out = placed.withColumn("_y", y)
    for c in columns:
        value = F.col(c).cast("string")
        so_far = Window.partitionBy("_range", value).orderBy("_order", row_id).rowsBetween(Window.unboundedPreceding, -1)
        own = before.where(F.col("column") == c).drop("column")
        out = out.withColumn("_own_n", F.count("_y").over(so_far)).withColumn("_own_total", F.coalesce(F.sum("_y").over(so_far), F.lit(0.0)))
        # Spark broadcasts a small table of totals; else the range is part of the key, so no key is hot.
        out = out.join(own, (F.col("_range") == F.col("_own_range")) & value.eqNullSafe(F.col("_value")), "left")
        n, total = F.col("_own_n") + F.col("_n"), F.col("_own_total") + F.col("_total")
        out = out.withColumn(f"_{c}", (total + SMOOTHING * F.lit(mean)) / (n + SMOOTHING)).drop("_own_n", "_own_total", "_n", "_total", "_value", "_own_range")
    return out.drop("_order", "_range", "_y")


def fit_features(
    train: DataFrame, target: str, numeric: Sequence[str], encodings: Mapping[str, str], row_id: str = "row_id"
) -> Features:
    """Category statistics, target mean and fill values of the training rows.

    ``encodings`` says "mean", "ordered" or "one_hot" for each category column. Null counts as a category. A missing
    number is replaced by the column's mean and marked in a slot of its own.
    """
    if unknown := {k for k in encodings.values()} - {"mean", "ordered", "one_hot"}:
        raise ValueError(f"unknown encodings {sorted(unknown)}")
    y = nan_to_null(F.col(target).cast("double"))
    means = {c: F.avg(nan_to_null(F.col(c).cast("double"))).alias(c) for c in numeric}
    row = train.agg(F.avg(y).alias("_target"), *means.values()).first()
    fills = {c: float(row[c]) if row[c] is not None else 0.0 for c in numeric}
    mean = float(row["_target"]) if row["_target"] is not None else 0.0
    if not encodings:
        return Features(fills, {}, mean, None, {}, row_id, target)
    spark = train.sparkSession
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in encodings])
    # Copies of a row, one per category column, are counted before they leave their task.
    rows = train.select(F.explode(cells).alias("cell"), y.alias("y"), mean_fold(row_id).alias("fold"))
    in_fold = [F.col("fold") == k for k in range(MEAN_FOLDS)]
    counted = rows.groupBy("cell.column", "cell.value").agg(
        F.count("y").alias("n"),
        F.coalesce(F.sum("y"), F.lit(0.0)).alias("total"),
        F.array(*[F.count(F.when(f, F.col("y"))) for f in in_fold]).alias("fold_n"),
        F.array(*[F.coalesce(F.sum(F.when(f, F.col("y"))), F.lit(0.0)) for f in in_fold]).alias("fold_total"),
    )
    path = scratch_path(spark, "categories")
    counted.write.parquet(f"{path}/counted")
    counted = spark.read.parquet(f"{path}/counted")
    sizes = {r["column"]: r["n"] for r in counted.groupBy("column").agg(F.count("*").alias("n")).collect()}
    # Codes in sort order, null last, over all one-hot columns at once; each column's begin at 0.
    hot = [c for c, kind in encodings.items() if kind == "one_hot"]
    placed = counted.where(F.col("column").isin(hot)).select("column", F.struct("column", F.col("value").isNull().alias("none"), "value").alias("place"))
    begins, begin = {}, 0
    for c in sorted(hot):
        begins[c], begin = begin, begin + sizes.get(c, 0)
    if hot:
        offset = F.coalesce(*[F.when(F.col("column") == c, b) for c, b in begins.items()])
        coded = number_values(placed, "place", "code").select("column", F.col("place.value").alias("value"), (F.col("code") - offset).alias("code"))
        coded = coded.withColumnsRenamed({"column": "_c", "value": "_v"})
        same = (F.col("column") == F.col("_c")) & F.col("value").eqNullSafe(F.col("_v"))
        counted = counted.join(coded, same, "left").drop("_c", "_v")
    else:
        counted = counted.withColumn("code", F.lit(None).cast("long"))
    counted.write.parquet(f"{path}/categories")
    return Features(fills, dict(encodings), mean, spark.read.parquet(f"{path}/categories"), {c: sizes.get(c, 0) for c in encodings}, row_id, target)


def fit_one_hot(df: DataFrame, columns: Sequence[str], row_id: str = "row_id", numeric: Sequence[str] = ()) -> Features:
    """One-hot vectors of the columns, for any number of categories: the first in sort order and unseen ones are zeros."""
    return fit_features(df.withColumn("_none", F.lit(0.0)), "_none", numeric, {c: "one_hot" for c in columns}, row_id)
