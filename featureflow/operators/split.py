"""Exact-size, reproducible splits and samples keyed by row id."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.functions.keyed import KEY_BITS, hash_key
from featureflow.operators.clean import assert_no_nulls, check_same_features, features_and_target
from featureflow.operators.order import Cut, exact_cut


def cut_by_hash(df: DataFrame, row_id: str, seed: int, take) -> tuple[Column, Cut]:
    """Predicate that holds for the first ``take(n)`` rows in keyed-hash order.

    It compares with a literal boundary, so filtering by it needs no shuffle, and it picks the same ids
    in any other table that carries them.
    """
    key = hash_key(seed, F.col(row_id))
    cut = exact_cut(df, key, row_id, take, 0, 1 << KEY_BITS)
    return cut.predicate(key, F.col(row_id)), cut


def take_by_hash(df: DataFrame, row_id: str, seed: int, take) -> tuple[DataFrame, DataFrame]:
    """(first ``take(n)`` rows in keyed-hash order, the rest): disjoint and complete by construction."""
    chosen, _ = cut_by_hash(df, row_id, seed, take)
    return df.where(chosen), df.where(~chosen)


def split_random(
    df: DataFrame, row_id: str = "row_id", fraction: float = 0.8, seed: int = 200
) -> tuple[DataFrame, DataFrame]:
    """(train, batch) with round(fraction * n) training rows, halves rounded to even."""
    return take_by_hash(df, row_id, seed, lambda n: round(fraction * n))


def rest_of(df: DataFrame, part: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Rows of ``df`` whose id is not in ``part``, for parts that were not cut by a predicate."""
    return df.join(part.select(row_id), row_id, "left_anti")


def sample_rows(df: DataFrame, n: int = 30000, row_id: str = "row_id", seed: int = 42) -> DataFrame:
    """n rows without replacement, or the whole table when it has no more."""
    return take_by_hash(df, row_id, seed, lambda total: n)[0]


def train_test_parts(
    df: DataFrame, row_id: str = "row_id", test_fraction: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with ceil(test_fraction * n) test rows."""
    test, train = take_by_hash(df, row_id, seed, lambda n: math.ceil(test_fraction * n))
    return train, test


def split_and_validate(
    df: DataFrame,
    target: str,
    row_id: str = "row_id",
    test_fraction: float = 0.2,
    seed: int = 42,
) -> dict[str, DataFrame]:
    """X/y for train and test after the null, label-leak, schema and size checks.

    y keeps the row id, so features and target stay joinable. The same ids fall into the same part for
    every table split with this seed (the plain and the one-hot table).
    """
    assert_no_nulls(df)
    is_test, cut = cut_by_hash(df, row_id, seed, lambda n: math.ceil(test_fraction * n))
    x_train, y_train = features_and_target(df.where(~is_test), target, row_id)
    x_test, y_test = features_and_target(df.where(is_test), target, row_id)
    check_same_features(x_train, x_test, target)
    expected = int(cut.total * test_fraction)
    if abs(cut.taken - expected) > 0.05 * cut.total:
        raise ValueError(f"test part has {cut.taken} rows, expected about {expected}")
    return {"X_train": x_train, "X_test": x_test, "y_train": y_train, "y_test": y_test}


def contiguous_folds(df: DataFrame, row_id: str = "row_id", name: str = "fold") -> DataFrame:
    """Two unshuffled folds: the first ceil(n / 2) rows by row id, then the others."""
    order = F.col(row_id).cast("long")
    cut = exact_cut(df, order, row_id, lambda n: math.ceil(n / 2))
    return df.withColumn(name, F.when(cut.predicate(order, F.col(row_id)), 0).otherwise(1))
