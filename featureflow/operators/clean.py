"""Column pruning, filters, null handling and de-duplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.functions.scalar import nan_to_null
from featureflow.functions.text import normalize_text
from featureflow.schemas import numeric_columns, string_columns


def strict_drop(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns that must exist (Spark's own ``drop`` ignores unknown names)."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*columns)


def drop_present(df: DataFrame, columns: Sequence[str] | None) -> tuple[DataFrame, list[str]]:
    """Drop those of the listed columns that exist; also returns the names that did not."""
    wanted = list(columns or [])
    missing = [c for c in wanted if c not in df.columns]
    return df.drop(*[c for c in wanted if c in df.columns]), missing


def drop_unnamed(df: DataFrame) -> DataFrame:
    return df.drop(*columns_like(df, "unnamed"))


def drop_index_columns(df: DataFrame) -> DataFrame:
    return df.drop("df_index", "index")


def columns_like(df: DataFrame, part: str) -> list[str]:
    """Columns whose name contains ``part``, whatever the case."""
    return [c for c in df.columns if part.lower() in c.lower()]


def first_of_each_name(df: DataFrame) -> DataFrame:
    """Keep the first column of every repeated name."""
    by_position = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    first = {}
    for i, name in enumerate(df.columns):
        first.setdefault(name, f"_{i}")
    return by_position.select(*[F.col(pos).alias(name) for name, pos in first.items()])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def with_event_time(df: DataFrame, moment: str = "2025-01-01", name: str = "datetime") -> DataFrame:
    """The constant event time every ingested row carries."""
    return df.withColumn(name, F.lit(moment).cast("timestamp"))


def features_and_target(
    df: DataFrame, target: str, row_id: str = "row_id"
) -> tuple[DataFrame, DataFrame]:
    """X (everything but the target) and y (row id and target), tied together by the row id."""
    if target not in df.columns:
        raise KeyError(f"target column {target} not found")
    return df.drop(target), df.select(row_id, target)


def check_same_features(left: DataFrame, right: DataFrame, target: str) -> None:
    """The target must not be among the features, and both sides must have the same columns."""
    for side in (left, right):
        if target in side.columns:
            raise ValueError(f"target column {target} found in the features")
    if sorted(left.columns) != sorted(right.columns):
        raise ValueError("feature columns of the two parts differ")


def nulls_for_nans(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every float column."""
    floats = (T.DoubleType, T.FloatType)
    swaps = {f.name: nan_to_null(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, floats)}
    return df.withColumns(swaps) if swaps else df


def keep_positive(df: DataFrame, column: str = "price") -> DataFrame:
    """Rows with a value above zero; null and NaN go."""
    return df.where((F.col(column) > 0) & ~F.isnan(F.col(column).cast("double")))


def drop_zero(df: DataFrame, column: str = "price") -> DataFrame:
    """Rows whose value is not exactly zero; null stays."""
    return df.where(F.col(column).isNull() | (F.col(column) != 0))


def drop_empty_rows(df: DataFrame, ignore: Sequence[str] = ("row_id",)) -> DataFrame:
    """Drop rows that are null in every column (the row id does not count)."""
    return df.dropna(how="all", subset=[c for c in df.columns if c not in ignore])


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def fill_unknown(df: DataFrame, token: str = "unknown") -> DataFrame:
    """Null to a token in every categorical column."""
    return df.fillna(token, subset=string_columns(df.schema))


def typed_fill(df: DataFrame, keep: Sequence[str] = ("row_id", "datetime")) -> DataFrame:
    """Integers: null to 0 as int; floats: null to 0.0 as float; the rest: null to '' as string.

    Values beyond the narrower integer range become an error instead of wrapping around.
    """

    def narrowed(field: T.StructField):
        col = F.col(field.name)
        if field.name in keep:
            return col
        if isinstance(field.dataType, T.IntegralType):
            wide = F.coalesce(col.cast("long"), F.lit(0))
            in_range = wide.between(-(2**31), 2**31 - 1)
            checked = F.when(in_range, wide).otherwise(
                F.raise_error(F.lit(f"{field.name} does not fit a 32-bit integer")).cast("long")
            )
            return checked.cast("int").alias(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            return F.coalesce(nan_to_null(col.cast("double")), F.lit(0.0)).cast("float").alias(field.name)
        return F.coalesce(col.cast("string"), F.lit("")).alias(field.name)

    return df.select(*[narrowed(f) for f in df.schema.fields])


def column_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mode): most frequent non-null value, ties to the lowest.

    Values are counted by a grouped aggregation over (column, value) pairs, so no task ever holds
    the distinct values of a whole column.
    """
    pairs = df.select(
        F.explode(F.array(*[_pair(c) for c in columns])).alias("p")
    ).select("p.column", "p.value").where(F.col("value").isNotNull())
    counts = pairs.groupBy("column", "value").agg(F.count("*").alias("n"))
    # The smallest (-count, value) is the most frequent value, lowest first among equals.
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value").alias("value")))
    return counts.groupBy("column").agg(best.alias("best")).select("column", F.col("best.value").alias("mode"))


def _pair(column: str):
    return F.struct(F.lit(column).alias("column"), F.col(column).cast("string").alias("value"))


def impute_mode(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Fill nulls of categorical columns with the column's mode (one row per column is collected)."""
    names = list(columns or string_columns(df.schema))
    modes = {r["column"]: r["mode"] for r in column_modes(df, names).collect()}
    return df.fillna(modes) if modes else df


def missing(df: DataFrame, column: str) -> Column:
    """Whether a column has no value: null, or NaN in a float column."""
    col = F.col(f"`{column}`")
    floats = isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType))
    return col.isNull() | F.isnan(col) if floats else col.isNull()


def null_count_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the missing values of each column, NaN included, in one pass."""
    return df.agg(*[F.count_if(missing(df, c)).alias(c) for c in columns or df.columns])


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, int]:
    """``null_count_table`` as a dict."""
    return null_count_table(df, columns).first().asDict()


def select_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns chosen by feature selection, in that order; one that is missing is an error."""
    if absent := [c for c in columns if c not in df.columns]:
        raise KeyError(f"selected columns are missing: {absent}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def assert_no_nulls(df: DataFrame) -> DataFrame:
    found = {c: n for c, n in null_counts(df).items() if n}
    if found:
        raise ValueError(f"null values before splitting: {found}")
    return df


def distinct_rows(df: DataFrame, row_id: str | None = "row_id") -> DataFrame:
    """Distinct rows over all columns but the row id; the lowest row id of each group stays.

    A plain hash aggregation: copies collapse before the shuffle, so a group of copies that holds a
    large share of the table costs one row per task.
    """
    if row_id is None or row_id not in df.columns:
        return df.dropDuplicates()
    keys = [c for c in df.columns if c != row_id]
    return df.groupBy(*keys).agg(F.min(row_id).alias(row_id)).select(*df.columns)


def normalize_columns(df: DataFrame, columns: Sequence[str] = ("variety",), null_token: str = "nan") -> DataFrame:
    """Normalise the text columns that exist."""
    present = {c: normalize_text(F.col(c), null_token) for c in columns if c in df.columns}
    return df.withColumns(present) if present else df


def numeric_and_categorical(df: DataFrame) -> tuple[list[str], list[str]]:
    """Feature columns by kind; booleans are numeric, the index and event time are neither."""
    skip = ("index", "datetime", "row_id")
    numeric = [c for c in numeric_columns(df.schema, booleans=True) if c not in skip]
    return numeric, [c for c in string_columns(df.schema) if c not in skip]
