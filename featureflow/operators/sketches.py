"""Profiles that can be merged: counts and sketches per batch, stored, so that a profile of appended data needs no old rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.operators.clean import missing

#: Size of the distinct-count sketches as a power of two: a standard error of 1.04 / sqrt(2**12), 1.6 %.
DISTINCT_BITS = 12
#: Size of the quantile sketches: ranks are off by at most 1.7 % of the rows in 99 of 100 cases.
QUANTILE_SIZE = 200

STATE = "column string, dtype string, n long, nulls long, low double, high double, distinct_sketch binary, quantile_sketch binary"


def profile_state(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: exact counts and range, and sketches of distinct values and quantiles; one scan for all.

    NaN counts as null. Columns without order on numbers have neither range nor quantiles.
    """
    names = list(columns or df.columns)
    kinds = dict(df.dtypes)
    parts: list[Column] = []
    for name in names:
        col = F.col(f"`{name}`")
        held = F.when(~missing(df, name), col)
        number = isinstance(df.schema[name].dataType, T.NumericType)
        value = held.cast("double") if number else F.lit(None).cast("double")
        # -0.0 and 0.0 are one value.
        hashed = F.xxhash64(held + 0 if number else held)
        parts.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(kinds[name]).alias("dtype"),
                F.count("*").alias("n"),
                F.count_if(missing(df, name)).alias("nulls"),
                F.min(value).alias("low"),
                F.max(value).alias("high"),
                F.hll_sketch_agg(F.when(held.isNotNull(), hashed), DISTINCT_BITS).alias("distinct_sketch"),
                F.kll_sketch_agg_double(value, QUANTILE_SIZE).alias("quantile_sketch") if number else F.lit(None).cast("binary").alias("quantile_sketch"),
            )
        )
    wide = df.agg(*[p.alias(f"_{i}") for i, p in enumerate(parts)])
    return wide.select(F.explode(F.array(*[F.col(f"_{i}") for i in range(len(parts))])).alias("s")).select("s.*")


def merge_states(states: DataFrame) -> DataFrame:
    """States of several batches as the state of all their rows."""
    return states.groupBy("column", "dtype").agg(
        F.sum("n").alias("n"),
        F.sum("nulls").alias("nulls"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def profile_of(states: DataFrame, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column, dtype, n, nulls, nulls_pct, low, high, n_unique, quantiles) of merged states, the last two estimated."""
    at = F.array(*[F.lit(float(p)) for p in probabilities])
    known = F.col("low").isNotNull()
    return merge_states(states).select(
        "column",
        "dtype",
        "n",
        "nulls",
        F.round(F.col("nulls") / F.nullif(F.col("n"), F.lit(0)) * 100, 2).alias("nulls_pct"),
        "low",
        "high",
        F.hll_sketch_estimate("distinct_sketch").alias("n_unique"),
        F.when(known, F.kll_sketch_get_quantile_double("quantile_sketch", at)).alias("quantiles"),
    )


def append_state(df: DataFrame, path: str, batch: str | None = None, columns: Sequence[str] | None = None) -> None:
    """Store the state of one batch; a batch stored again replaces its earlier state."""
    batch = batch or uuid.uuid4().hex
    profile_state(df, columns).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def stored_profile(spark: SparkSession, path: str, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Profile of all batches stored below the path."""
    return profile_of(spark.read.schema(STATE).parquet(f"{path}/batch=*"), probabilities)
