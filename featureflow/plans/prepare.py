"""From raw reviews to the feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.functions.rules import main_type, subtype
from featureflow.functions.scalar import COUNTRY_SPELLINGS, bucket_points, continent_of, replace_values
from featureflow.functions.text import is_blend
from featureflow.operators import clean
from featureflow.operators.quality import require_any_column
from featureflow.schemas import DEFAULT_FEATURES_TO_DROP, INGEST_DROPPED


def ingest(
    raw: DataFrame,
    target: str = "price",
    dropped: Sequence[str] = INGEST_DROPPED,
    row_id: str | None = "row_id",
    blank_nulls: bool = False,
) -> DataFrame:
    """Prune, de-duplicate, filter and date-stamp the raw table.

    With ``blank_nulls`` missing values are filled by type and numbers narrowed; without it they stay
    null and wide, which is what the next step sees either way.
    """
    df = clean.strict_drop(require_any_column(raw), dropped)
    if target == "price":
        # Filtering and de-duplicating commute; on the untouched column the filter reaches the scan.
        df = clean.keep_positive(df, "price")
    df = clean.distinct_rows(clean.nulls_for_nans(df), row_id)
    df = clean.drop_empty_rows(df)
    df = clean.drop_index_columns(clean.drop_unnamed(df))
    df = clean.with_event_time(df)
    return clean.typed_fill(df) if blank_nulls else df


def preprocess(df: DataFrame, null_token: str = "nan", text_columns: Sequence[str] = ("variety",)) -> DataFrame:
    """Drop zero prices, normalise text, fill missing categories.

    The training side turns a null text into ``'nan'`` before filling, the scoring side into
    ``'unknown'``; ``null_token`` says which.
    """
    df = clean.drop_zero(clean.drop_index_columns(df))
    return clean.fill_unknown(clean.normalize_columns(df, text_columns, null_token))


def engineer_features(df: DataFrame) -> DataFrame:
    """Add bucket, blend flag, main type, subtype, standard country name and continent."""
    missing = [c for c in ("points", "variety", "country") if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    variety = F.coalesce(F.col("variety").cast("string"), F.lit("nan"))
    df = clean.drop_index_columns(df).withColumn("variety", variety)
    country = replace_values(F.col("country"), COUNTRY_SPELLINGS)
    return df.select(
        "*",
        bucket_points(F.col("points")).alias("points_category"),
        is_blend(F.col("variety")).alias("is_blend"),
        main_type(F.col("variety")).alias("wine_type_main"),
        subtype(F.col("variety")).alias("wine_subtype"),
        country.alias("country_standardized"),
        continent_of(country).alias("continent"),
    )


def model_table(df: DataFrame, dropped: Sequence[str] | None = DEFAULT_FEATURES_TO_DROP) -> DataFrame:
    """The engineered table without the features that are left out; unknown names are ignored."""
    return clean.drop_present(df, dropped)[0]
