"""Explicit schemas of the review tables, one per layer."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the raw review file.
RAW_REVIEWS = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("country", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("designation", T.StringType()),
        T.StructField("points", T.LongType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("province", T.StringType()),
        T.StructField("region_1", T.StringType()),
        T.StructField("region_2", T.StringType()),
        T.StructField("taster_name", T.StringType()),
        T.StructField("taster_twitter_handle", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("variety", T.StringType()),
        T.StructField("winery", T.StringType()),
    ]
)

# Columns the ingestion step removes, and columns it must deliver.
INGEST_DROPPED = (
    "region_2",
    "designation",
    "description",
    "title",
    "winery",
    "taster_twitter_handle",
)
INGESTED_COLUMNS = (
    "country",
    "points",
    "price",
    "province",
    "region_1",
    "taster_name",
    "variety",
    "datetime",
)

# Fixed value: engineered columns that are left out of the model table by default.
DEFAULT_FEATURES_TO_DROP = (
    "country_standardized",
    "province",
    "continent",
    "wine_type_main",
    "is_blend",
    "variety",
)


def string_columns(schema: T.StructType) -> list[str]:
    """Categorical columns."""
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_columns(schema: T.StructType, booleans: bool = False) -> list[str]:
    """Numeric columns; ``booleans=True`` follows the ingestion step, which counts them as numeric."""
    kinds = (T.NumericType, T.BooleanType) if booleans else (T.NumericType,)
    return [f.name for f in schema.fields if isinstance(f.dataType, kinds)]
