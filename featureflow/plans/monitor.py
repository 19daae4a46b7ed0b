"""From a raw table to a drifted sample and its drift report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from featureflow.operators.drift import detect_univariate_drift, shift_points
from featureflow.operators.split import sample_rows


def drifted_sample(
    raw: DataFrame,
    column: str = "points",
    n: int = 30000,
    loc: float = -10.0,
    scale: float = 3.0,
    clip_values: bool = True,
    row_id: str = "row_id",
    seed: int = 42,
) -> DataFrame:
    """n sampled rows with noise added to one column."""
    sampled = sample_rows(raw, n, row_id, seed)
    return shift_points(sampled, column, loc, scale, clip_values, row_id, seed)


def drift_report(
    raw: DataFrame,
    features: Sequence[str] = ("points",),
    n: int = 30000,
    chunk_size: int = 100,
    row_id: str = "row_id",
) -> DataFrame:
    """Raw rows as reference, a drifted sample of them as analysis."""
    analysis = drifted_sample(raw, features[0], n, row_id=row_id)
    return detect_univariate_drift(raw, analysis, features, chunk_size, row_id)
