"""One-hot encoding with categories fitted once, and integer category codes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.functions.scalar import flag_to_int
from featureflow.operators.order import number_values
from featureflow.schemas import string_columns

@dataclass(frozen=True)
class Categories:
    """Sorted categories per column, as fitted on the training table."""

    values: Mapping[str, tuple[str | None, ...]]

    def output_names(self) -> list[str]:
        return [f"{c}_{v}" for c, found in self.values.items() for v in found[1:]]


def fit_categories(df: DataFrame, columns: Sequence[str] | None = None) -> Categories:
    """Distinct values per categorical column, in one grouped pass.

    Wide encoding makes one column per category, so the categories become part of the schema; where they
    are too many for that, ``features.fit_one_hot`` keeps them in a table.
    """
    names = [c for c in (columns or string_columns(df.schema))]
    if not names:
        return Categories({})
    pairs = df.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in names]
            )
        ).alias("p")
    )
    distinct = pairs.select("p.c", "p.v").distinct()
    found: dict[str, list] = {c: [] for c in names}
    for r in distinct.collect():
        found[r["c"]].append(r["v"])
    # Null sorts last and counts as a category of its own.
    order = {c: tuple(sorted(v, key=lambda x: (x is None, x or ""))) for c, v in found.items()}
    return Categories(order)


def one_hot_wide(df: DataFrame, categories: Categories, blend: str = "is_blend") -> DataFrame:
    """One 0/1 column ``<column>_<category>`` per category but the first.

    Unseen values get zeros everywhere. The blend flag becomes ``<blend>_True`` (0 when absent).
    """
    encoded = []
    for column, values in categories.values.items():
        for value in values[1:]:
            hit = F.col(column).eqNullSafe(F.lit(value))
            encoded.append(F.coalesce(hit.cast("double"), F.lit(0.0)).alias(f"{column}_{value}"))
    kept = [F.col(c) for c in df.columns if c not in categories.values and c != blend]
    flag = flag_to_int(F.col(blend)) if blend in df.columns else F.lit(0)
    return df.select(*kept, flag.alias(f"{blend}_True"), *encoded)


def category_codes(
    df: DataFrame,
    column: str,
    name: str | None = None,
    unknown: str = "unknown",
    unknown_code: int = 1000,
) -> DataFrame:
    """Integer codes of the sorted distinct values; the unknown token gets its own code."""
    name = name or f"{column}_codes"
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    codes = number_values(values, column, name)
    # The dictionary is joined without a hint: Spark broadcasts it while it is small. Nulls stay out of it.
    without = df.where(F.col(column).isNull()).withColumn(name, F.lit(None).cast("long"))
    coded = df.where(F.col(column).isNotNull()).join(codes, column).unionByName(without)
    fixed = F.when(F.col(column) == unknown, F.lit(unknown_code)).otherwise(
        F.coalesce(F.col(name), F.lit(-1))
    )
    return coded.withColumn(name, fixed.cast("long"))
