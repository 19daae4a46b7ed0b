"""Bias-corrected Cramér's V between categorical columns."""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.functions.scalar import round_2dp
from featureflow.operators.order import non_null
from featureflow.session import scratch_path


#: Combinations of categories are only taken apart into pairs if they are at most this share of the rows.
COLLAPSED = 0.25


def pair_counts(labels: DataFrame, pairs: Sequence[tuple[str, str]], collapsed: float = COLLAPSED) -> DataFrame:
    """(pair, a, b, o): rows of each pair of categories, nulls left out.

    Rows are counted by their combination of categories first. If these are few, they are taken apart into
    pairs; if a column has so many categories that rows hardly collapse, two columns are counted at a time.
    Which way is taken follows from the counts themselves.
    """
    names = labels.columns
    path = scratch_path(labels.sparkSession, "combinations")
    labels.groupBy(*names).agg(F.count("*").alias("n")).write.parquet(path)
    counted = labels.sparkSession.read.parquet(path)
    sizes = counted.agg(F.count("*").alias("combinations"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    if sizes["combinations"] <= collapsed * sizes["rows"]:
        structs = [F.struct(F.lit(i).alias("pair"), F.col(a).alias("a"), F.col(b).alias("b")) for i, (a, b) in enumerate(pairs)]
        # Both labels are non-null from here on, so that every later use shares one computed shuffle.
        apart = counted.select("n", F.explode(F.array(*structs)).alias("cell")).select("n", "cell.*")
        return non_null(apart, ["pair", "a", "b"]).groupBy("pair", "a", "b").agg(F.sum("n").alias("o"))
    parts = []
    for i, (a, b) in enumerate(pairs):
        two = non_null(counted.select("n", F.col(a).alias("a"), F.col(b).alias("b")), ["a", "b"])
        parts.append(two.groupBy("a", "b").agg(F.sum("n").alias("o")).select(F.lit(i).alias("pair"), "a", "b", "o"))
    path = scratch_path(labels.sparkSession, "pairs")
    reduce(DataFrame.unionByName, parts).write.parquet(path)
    return labels.sparkSession.read.parquet(path)


def cramers_v_matrix(df: DataFrame, columns: Sequence[str] | None = None, collapsed: float = COLLAPSED) -> DataFrame:
    """(column_a, column_b, cramers_v) for every ordered pair, rounded to two decimals.

    The chi-square sum uses observed cells only, because empty cells add exactly what the marginals
    already say; 2 x 2 tables get the continuity correction.
    """
    kinds = (T.StringType, T.BooleanType)
    names = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)])
    pairs = list(itertools.combinations(names, 2))
    diagonal = df.sparkSession.createDataFrame(
        [(c, c, 1.0) for c in names], "column_a string, column_b string, cramers_v double"
    )
    if not pairs:
        return diagonal
    labels = df.select(*[F.col(c).cast("string").alias(c) for c in names])
    cells = pair_counts(labels, pairs, collapsed)
    rows = cells.groupBy("pair", "a").agg(F.sum("o").alias("row_total"))
    cols = cells.groupBy("pair", "b").agg(F.sum("o").alias("col_total"))
    row_side = rows.groupBy("pair").agg(
        F.count("*").alias("r"), F.sum("row_total").alias("n"), F.sum(1 / F.col("row_total")).alias("inv_r")
    )
    col_side = cols.groupBy("pair").agg(F.count("*").alias("k"), F.sum(1 / F.col("col_total")).alias("inv_k"))
    observed = (
        cells.join(rows, ["pair", "a"])
        .join(cols, ["pair", "b"])
        .groupBy("pair")
        .agg(
            F.sum(F.col("o") * F.col("o") / (F.col("row_total") * F.col("col_total"))).alias("s"),
            F.max(F.struct("o", "row_total", "col_total")).alias("one"),
        )
    )
    n, r, k = F.col("n"), F.col("r"), F.col("k")
    gap = F.abs(F.col("one.o") - F.col("one.row_total") * F.col("one.col_total") / n)
    shrunk = F.greatest(gap - 0.5, F.lit(0.0))
    corrected = shrunk * shrunk * n * F.col("inv_r") * F.col("inv_k")
    chi2 = F.when((r == 2) & (k == 2), corrected).otherwise(n * (F.col("s") - 1))
    spare = n - 1
    phi2 = F.greatest(F.lit(0.0), chi2 / n - (k - 1) * (r - 1) / F.nullif(spare, F.lit(0)))
    r_side = r - (r - 1) * (r - 1) / F.nullif(spare, F.lit(0))
    k_side = k - (k - 1) * (k - 1) / F.nullif(spare, F.lit(0))
    bound = F.least(k_side - 1, r_side - 1)
    v = F.when(bound > 0, F.sqrt(phi2 / bound)).otherwise(F.lit(0.0))
    half = (
        observed.join(row_side, "pair")
        .join(col_side, "pair")
        .select("pair", round_2dp(F.coalesce(v, F.lit(0.0))).alias("cramers_v"))
    )
    named = df.sparkSession.createDataFrame(
        [(i, x, y) for i, (a, b) in enumerate(pairs) for x, y in ((a, b), (b, a))],
        "pair int, column_a string, column_b string",
    )
    # One row per ordered pair of columns.
    off_diagonal = F.broadcast(named).join(half, "pair", "left").select(
        "column_a", "column_b", F.coalesce("cramers_v", F.lit(0.0)).alias("cramers_v")
    )
    return off_diagonal.unionByName(diagonal)
