"""Feature tables: typed, keyed, versioned Parquet tables with their statistics beside them."""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.functions.scalar import feature_names
from featureflow.operators.order import number_rows, range_count
from featureflow.operators.profile import equal_width_bin, pearson_matrix
from featureflow.operators.quality import feature_group_suite, run_suite, typed_groups
from featureflow.schemas import numeric_columns
from featureflow.session import scratch_path

log = logging.getLogger(__name__)

HISTOGRAM_BINS = 20


def feature_types(df: DataFrame, row_id: str = "row_id", event_time: str = "datetime") -> DataFrame:
    """Integers to int, floats to float, everything else (booleans too) to string.

    ``try_cast`` is not enough for integers: a value that does not fit must fail, not become null.
    """

    def typed(f: T.StructField):
        col = F.col(f"`{f.name}`")
        if f.name == event_time:
            return col.cast("timestamp").alias(f.name)
        if f.name == row_id or isinstance(f.dataType, T.IntegralType):
            if f.name == row_id:  # more rows than a 32-bit id can number keep the wide type
                return col.cast("long").alias(f.name)
            return _to_int(col, f.name).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            return col.cast("float").alias(f.name)
        return col.cast("string").alias(f.name)

    return df.select(*[typed(f) for f in df.schema.fields])


def _to_int(col, name: str):
    fits = col.isNull() | col.between(-(2**31), 2**31 - 1)
    message = F.raise_error(F.lit(f"{name} does not fit a 32-bit integer")).cast("int")
    return F.when(fits, col.cast("int")).otherwise(message)


def prepare_feature_table(
    df: DataFrame, order_by: str, row_id: str = "row_id", event_time: str = "datetime"
) -> DataFrame:
    """Dense row id from 0 in the given order, event time, allowed names and types."""
    # Rows of one event time, say, are told apart by their id.
    tie = row_id if order_by != row_id and row_id in df.columns else None
    numbered = number_rows(df, order_by, "_position", tie)
    if order_by == row_id or tie:
        numbered = numbered.drop(row_id)
    numbered = numbered.withColumnRenamed("_position", row_id)
    if event_time not in numbered.columns:
        numbered = numbered.withColumn(event_time, F.current_timestamp())
    return feature_types(numbered.withColumnsRenamed(feature_names(numbered.columns)), row_id, event_time)


def feature_statistics(df: DataFrame, skip: Sequence[str] = ("row_id",)) -> tuple[DataFrame, DataFrame]:
    """(histograms, correlations) of the numeric features: all histograms in one pass after the ranges."""
    names = [c for c in numeric_columns(df.schema) if c not in skip]
    spark = df.sparkSession
    empty = spark.createDataFrame([], "feature string, bin int, count long")
    if not names:
        return empty, spark.createDataFrame([], "column_a string, column_b string, correlation double")
    spans = df.agg(
        *[f(F.col(c).cast("double")).alias(f"{c}|{s}") for c in names for s, f in (("a", F.min), ("b", F.max))]
    ).first().asDict()
    cells = []
    for c in names:
        low, high = spans[f"{c}|a"], spans[f"{c}|b"]
        if low is None:
            continue
        low, high = (low, high) if low < high else (low - 0.5, high + 0.5)
        number = equal_width_bin(F.col(c).cast("double"), low, high, HISTOGRAM_BINS)
        cells.append(F.struct(F.lit(c).alias("feature"), number.alias("bin")))
    counted = empty
    if cells:
        counted = (
            df.select(F.explode(F.array(*cells)).alias("cell"))
            .where("cell.bin is not null")
            .groupBy("cell.feature", "cell.bin")
            .count()
        )
    return counted, pearson_matrix(df, names)


def bucketed_name(path: str) -> str:
    """Catalog name of the bucketed table at a path."""
    return f"bucketed_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Replace a table whose files are dealt out and sorted by the key, and read it back.

    Tables with the same key and number of buckets join by it without any exchange. Each bucket is one file,
    written by one task, so that its order needs no sort later either.
    """
    spark, table = df.sparkSession, bucketed_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # the files stay and are overwritten below
    dealt = df.repartition(buckets, key).sortWithinPartitions(key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)
    layout = spark.createDataFrame([(key, buckets, df.schema.json())], "key string, buckets int, columns string")
    layout.coalesce(1).write.mode("overwrite").json(f"{path}_layout")
    return spark.table(table)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``write_bucketed``, also in a session whose catalog doesn't know it yet."""
    table = bucketed_name(path)
    if not spark.catalog.tableExists(table):
        layout = spark.read.json(f"{path}_layout").first()
        schema = T.StructType.fromJson(json.loads(layout["columns"]))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        key, n = layout["key"], layout["buckets"]
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {n} BUCKETS LOCATION '{path}'"
        )
    return spark.table(table)


def write_feature_table(
    df: DataFrame,
    root: str,
    name: str,
    version: int = 1,
    order_by: str = "row_id",
    descriptions: Mapping[str, str] | None = None,
    statistics: bool = True,
    buckets: int | None = None,
) -> DataFrame | None:
    """Replace a feature table and read it back; None when writing failed, which is only logged.

    Descriptions become column comments; histograms and correlations are stored beside the rows. With
    ``buckets`` the rows are dealt out and sorted by their id, see ``write_bucketed``.
    """
    path = f"{root}/{name}_v{version}"
    spark = df.sparkSession
    try:
        ready = prepare_feature_table(df, order_by)
        comments = feature_names(list(descriptions or {}))
        texts = {comments[k]: v for k, v in (descriptions or {}).items()}
        ready = ready.select(
            *[F.col(c).alias(c, metadata={"comment": texts[c]}) if c in texts else F.col(c) for c in ready.columns]
        )
        if buckets:
            stored = write_bucketed(ready, f"{path}/data", "row_id", buckets)
        else:
            ready.write.mode("overwrite").parquet(f"{path}/data")
            stored = spark.read.schema(ready.schema).parquet(f"{path}/data")
        if statistics:
            histograms, correlations = feature_statistics(stored)
            histograms.coalesce(1).write.mode("overwrite").parquet(f"{path}/histograms")
            correlations.coalesce(1).write.mode("overwrite").parquet(f"{path}/correlations")
        return stored
    except Exception as problem:  # noqa: BLE001 - a failed feature table never stops ingestion
        log.error("feature table %s was not written: %s", name, problem)
        return None


def read_feature_table(spark: SparkSession, root: str, name: str, version: int = 1) -> DataFrame:
    path = f"{root}/{name}_v{version}/data"
    return spark.table(bucketed_name(path)) if spark.catalog.tableExists(bucketed_name(path)) else spark.read.parquet(path)


def vertical_groups(df: DataFrame, target: str, row_id: str = "row_id", event_time: str = "datetime") -> dict[str, DataFrame]:
    """Numeric, categorical and target groups, each with the row id and event time."""
    groups = typed_groups(df, target)
    names = {**groups, "target_features": groups["target"]}
    del names["target"]
    return {g: df.select(row_id, event_time, *cols) for g, cols in names.items()}


def write_feature_groups(
    df: DataFrame, target: str, root: str, version: int = 1, enabled: bool = True, row_id: str = "row_id"
) -> dict[str, DataFrame | None]:
    """The three groups as feature tables; each one may fail without harming the others.

    All have as many buckets by row id, so ``joined_groups`` puts them together again without an exchange.
    """
    if not enabled:
        return {}
    kinds = {
        "numerical_features": "Numerical feature",
        "categorical_features": "Categorical feature",
        "target_features": "Target variable",
    }
    # Numbered once; each group then finds dense row ids and only projects.
    path = scratch_path(df.sparkSession, "numbered")
    numbered = number_rows(df, row_id, "_position").drop(row_id).withColumnRenamed("_position", row_id)
    numbered.write.parquet(path)
    df = df.sparkSession.read.parquet(path)
    buckets = range_count(df, df.count())
    written = {}
    for name, group in vertical_groups(df, target, row_id).items():
        texts = {c: f"{kinds[name]}: {c}" for c in group.columns if c not in (row_id, "datetime")}
        written[name] = write_feature_table(group, root, name, version, row_id, texts, buckets=buckets)
    return written


def joined_groups(groups: Mapping[str, DataFrame], row_id: str = "row_id") -> DataFrame:
    """The rows of bucketed groups side by side; a column that several have comes from the first.

    The merge join is asked for because both sides lie ready for it: neither is sent anywhere.
    """
    whole = None
    for group in groups.values():
        if whole is None:
            whole = group
        else:
            known = [c for c in group.columns if c != row_id and c in whole.columns]
            whole = whole.join(group.drop(*known).hint("merge"), row_id)
    return whole


def group_checks(df: DataFrame, target: str) -> DataFrame:
    """Type checks of the three groups as one result table."""
    groups = typed_groups(df, target)
    checks = [c for g, cols in groups.items() for c in feature_group_suite(g, cols)]
    return run_suite(df, checks)
