"""Data-quality suites: declarative checks, evaluated in one pass, reported as a table."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from featureflow.functions.scalar import nan_to_null
from featureflow.operators.profile import grouped_mean, mean_matrix, value_counts
from featureflow.schemas import INGESTED_COLUMNS, numeric_columns, string_columns

# Check type names and the wording used in reports.
COLUMN_COUNT = "expect_table_column_count_to_equal"
VALUE_RANGE = "expect_column_values_to_be_between"
COLUMN_TYPE = "expect_column_values_to_be_of_type"
COLUMN_TYPE_LIST = "expect_column_values_to_be_in_type_list"
NOT_NULL = "expect_column_values_to_not_be_null"
NO_DUPLICATES = "expect_table_row_count_to_equal_other_table"
DESCRIPTIONS = {
    COLUMN_COUNT: "Number of features in dataset",
    VALUE_RANGE: "Value range check",
    COLUMN_TYPE: "Data type check",
    NO_DUPLICATES: "No duplicate records check",
}
# Names of array-library types and the column types that correspond to them.
TYPE_NAMES = {
    "int64": ("bigint",),
    "int32": ("int",),
    "float64": ("double",),
    "float32": ("float",),
    "object": ("string",),
    "str": ("string",),
    "bool": ("boolean",),
}


@dataclass(frozen=True)
class Check:
    """One expectation; which fields matter depends on ``kind``."""

    kind: str
    column: str | None = None
    expected: int | None = None
    types: tuple[str, ...] = ()
    minimum: float | None = None
    maximum: float | None = None
    strict_min: bool = False


def column_count(expected: int) -> Check:
    return Check(COLUMN_COUNT, expected=expected)


def value_range(
    column: str, minimum: float | None, maximum: float | None = None, strict_min: bool = False
) -> Check:
    return Check(VALUE_RANGE, column, minimum=minimum, maximum=maximum, strict_min=strict_min)


def column_type(column: str, expected: str) -> Check:
    return Check(COLUMN_TYPE, column, types=(expected,))


def column_type_in(column: str, expected: Sequence[str]) -> Check:
    return Check(COLUMN_TYPE_LIST, column, types=tuple(expected))


def not_null(column: str) -> Check:
    return Check(NOT_NULL, column)


def no_duplicates() -> Check:
    return Check(NO_DUPLICATES)


def review_suite() -> list[Check]:
    """The checks every ingested review table has to pass."""
    return [
        column_count(8),
        column_type("points", "int64"),
        column_type("price", "float64"),
        *[column_type(c, "object") for c in ("country", "province", "region_1", "variety")],
        value_range("points", 0, 100),
        value_range("price", 0, strict_min=True),
        no_duplicates(),
    ]


def feature_group_suite(group: str, columns: Sequence[str] = ()) -> list[Check]:
    """Type checks of one feature group, for the columns it really has."""
    wanted = {
        "numerical_features": [column_type_in("points", ["int64"])],
        "categorical_features": [
            column_type(c, "str") for c in ("country", "province", "region_1", "taster_name", "variety")
        ],
        "target": [column_type_in("price", ["float64"])],
    }
    return [check for check in wanted.get(group, []) if check.column in columns]


def split_suite(df: DataFrame) -> list[Check]:
    return [not_null(c) for c in sorted(df.columns)]


def distinct_row_count(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[int, int]:
    """``distinct_row_table`` as (rows, distinct rows)."""
    return tuple(distinct_row_table(df, columns).first())


def distinct_row_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row (n_rows, n_distinct), exact, without shuffling whole rows that have no copies.

    Rows are grouped by a 64-bit hash first. Only rows whose hash occurs twice can be copies;
    just those are compared in full, so hash collisions cannot spoil the count.
    """
    names = list(columns or df.columns)
    hashed = df.select(*names, F.xxhash64(*names).alias("_hash"))
    per_hash = hashed.groupBy("_hash").agg(F.count("*").alias("n"))
    repeated = per_hash.where(F.col("n") > 1).select("_hash")
    suspects = hashed.join(repeated, "_hash", "left_semi").groupBy(*names).agg(F.count("*").alias("n"))
    counts = per_hash.select(F.col("n").alias("rows"), F.lit(0).cast("long").alias("extra"))
    counts = counts.unionAll(suspects.select(F.lit(0).cast("long"), F.col("n") - 1))
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum("extra"), F.lit(0)).alias("extra"))
    return total.select("n_rows", (F.col("n_rows") - F.col("extra")).alias("n_distinct"))


def _spark_types(names: Sequence[str]) -> set[str]:
    return {t for name in names for t in TYPE_NAMES.get(name, (name,))}


def suite_measures(df: DataFrame, checks: Sequence[Check]) -> list[Column]:
    """The aggregates that the value checks need."""
    schema_types = dict(df.dtypes)
    measures: list[Column] = [F.count("*").alias("rows")]
    for i, check in enumerate(checks):
        if check.column is None or check.column not in schema_types:
            continue
        col = F.col(check.column)
        if schema_types[check.column] in ("double", "float"):
            col = nan_to_null(col)
        if check.kind == VALUE_RANGE:
            bad = F.lit(False)
            if check.minimum is not None:
                bad = bad | ((col <= check.minimum) if check.strict_min else (col < check.minimum))
            if check.maximum is not None:
                bad = bad | (col > check.maximum)
            measures += [F.count_if(bad).alias(f"bad_{i}"), F.count(col).alias(f"seen_{i}")]
        elif check.kind == NOT_NULL:
            measures += [F.count_if(col.isNull()).alias(f"bad_{i}"), F.count("*").alias(f"seen_{i}")]
    return measures


def run_suite(df: DataFrame, checks: Sequence[Check], duplicates: tuple[int, int] | None = None) -> DataFrame:
    """One result row per check.

    All value checks share a single aggregation over the table, schema checks cost nothing, and
    the duplicate check (if asked for) is one hash count, unless the caller hands over (rows, distinct
    rows). A failing check does not stop the others.
    """
    if duplicates is None and any(c.kind == NO_DUPLICATES for c in checks):
        duplicates = distinct_row_count(df)
    return suite_results(df.agg(*suite_measures(df, checks)), df, checks, duplicates)


def suite_results(measured: DataFrame, df: DataFrame, checks: Sequence[Check], duplicates: tuple[int, int] | None) -> DataFrame:
    """The result rows from one row of ``suite_measures``."""
    schema_types = dict(df.dtypes)
    results = [_result(check, i, df, schema_types, duplicates) for i, check in enumerate(checks)]
    numbered = measured.select(F.posexplode(F.array(*results)).alias("_n", "r"))
    return numbered.orderBy("_n").select("r.*")


def _result(check: Check, i: int, df: DataFrame, schema_types: Mapping[str, str], duplicates) -> Column:
    text = lambda value: F.lit(None if value is None else str(value)).cast("string")
    elements = unexpected = F.lit(None).cast("long")
    percent = F.lit(None).cast("double")
    observed = text(None)
    if check.kind == COLUMN_COUNT:
        success = F.lit(len(df.columns) == check.expected)
        observed = text(len(df.columns))
    elif check.kind == NO_DUPLICATES:
        success = F.lit(duplicates[0] == duplicates[1])
        observed = text(duplicates[0])
    elif check.column not in schema_types:
        success = F.lit(False)
    elif check.kind in (COLUMN_TYPE, COLUMN_TYPE_LIST):
        actual = schema_types[check.column]
        success = F.lit(actual in _spark_types(check.types))
        observed = text(actual)
    else:
        elements, unexpected = F.col("rows"), F.col(f"bad_{i}")
        percent = F.coalesce(unexpected / F.nullif(F.col(f"seen_{i}"), F.lit(0)) * 100, F.lit(0.0))
        success = unexpected == 0
    number = lambda value: F.lit(value).cast("double")
    return F.struct(
        success.alias("Success"),
        text(check.kind).alias("Expectation Type"),
        text(check.column).alias("Column"),
        F.struct(text(None).alias("a"), text(None).alias("b")).alias("Column Pair"),
        number(check.maximum).alias("Max Value"),
        number(check.minimum).alias("Min Value"),
        elements.alias("Element Count"),
        unexpected.alias("Unexpected Count"),
        percent.alias("Unexpected Percent"),
        F.lit(None).cast("array<string>").alias("Value Set"),
        F.array().cast("array<string>").alias("Unexpected Value"),
        observed.alias("Observed Value"),
        text(describe_check(check)).alias("Test Description"),
    )


def describe_check(check: Check) -> str:
    """Wording of a check: what it is, the column, and for a range its bounds."""
    wording = DESCRIPTIONS.get(check.kind, check.kind)
    if check.column:
        wording += f" ({check.column})"
    if check.kind == VALUE_RANGE:
        low = "any" if check.minimum is None else check.minimum
        high = "any" if check.maximum is None else check.maximum
        wording += f" [{low} to {high}]"
    return wording


def add_descriptions(results: DataFrame) -> DataFrame:
    """Derive the wording from the other columns, for result tables that come without it."""
    kind = F.col("Expectation Type")
    wording = None
    for name, words in DESCRIPTIONS.items():
        wording = (F.when if wording is None else wording.when)(kind == name, words)
    wording = wording.otherwise(kind)
    column = F.col("Column")
    named = F.when(F.coalesce(column, F.lit("")) != "", F.concat(F.lit(" ("), column, F.lit(")"))).otherwise("")

    def bound(name: str) -> Column:
        value = F.col(name)
        whole = value.cast("long")
        plain = F.when(whole.cast("double") == value, whole.cast("string")).otherwise(value.cast("string"))
        return F.coalesce(plain, F.lit("any"))

    span = F.concat(F.lit(" ["), bound("Min Value"), F.lit(" to "), bound("Max Value"), F.lit("]"))
    span = F.when(kind == VALUE_RANGE, span).otherwise("")
    return results.withColumn("Test Description", F.concat(wording, named, span))


class GateError(AssertionError):
    """A hard requirement on the data does not hold."""


def not_positive(column: str) -> Column:
    """How many rows lack a value above zero."""
    value = F.col(column)
    return F.count_if(~F.coalesce((value > 0) & ~F.isnan(value.cast("double")), F.lit(False)))


def require_columns(columns: Sequence[str], required: Sequence[str]) -> None:
    missing = [c for c in required if c not in columns]
    if missing:
        raise GateError(f"expected columns not found: {missing}")
    if len(columns) != len(required):
        raise GateError(f"{len(columns)} columns instead of {len(required)}")


def require_counts(duplicates: tuple[int, int], positive: str, bad: int) -> None:
    if duplicates[0] != duplicates[1]:
        raise GateError(f"{duplicates[0] - duplicates[1]} duplicate rows")
    if bad:
        raise GateError(f"{bad} values of {positive} are not greater than 0")


def assert_gates(
    df: DataFrame, required: Sequence[str] = INGESTED_COLUMNS, positive: str = "price", row_id: str = "row_id"
) -> DataFrame:
    """Required columns, their number, no copies, every value of ``positive`` above zero; else raise."""
    checked = df.drop(row_id)
    require_columns(checked.columns, required)
    require_counts(distinct_row_count(checked), positive, checked.agg(not_positive(positive)).first()[0])
    return df


def write_checked(
    df: DataFrame,
    path: str,
    checks: Sequence[Check],
    required: Sequence[str] = INGESTED_COLUMNS,
    positive: str = "price",
    row_id: str = "row_id",
) -> tuple[DataFrame, DataFrame]:
    """Write a table that passes the gates, and judge it: (stored table, result rows of the suite).

    What gates and checks need is observed while the rows are written, so the table is computed once. The
    rows go to a folder beside the path; copies are counted there, once for gates and suite. The folder
    takes the path's place only if the gates hold; otherwise it is deleted and the path stays as it was.
    """
    checked = df.drop(row_id)
    require_columns(checked.columns, required)
    seen = Observation(f"checks-{uuid.uuid4().hex}")
    observed = df.observe(seen, *suite_measures(checked, checks), not_positive(positive).alias("_not_positive"))
    spark = df.sparkSession
    aside = f"{path}.{uuid.uuid4().hex}"
    observed.write.parquet(aside)
    counts = seen.get
    written = spark.read.schema(df.schema).parquet(aside)
    duplicates = distinct_row_count(written.drop(row_id))
    folder = spark._jvm.org.apache.hadoop.fs.Path
    files = folder(aside).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        require_counts(duplicates, positive, counts["_not_positive"])
    except GateError:
        files.delete(folder(aside), True)
        raise
    files.delete(folder(path), True)
    if not files.rename(folder(aside), folder(path)):
        raise OSError(f"{aside} could not take the place of {path}")
    row = spark.createDataFrame([tuple(counts.values())], ", ".join(f"`{c}` long" for c in counts))
    return spark.read.schema(df.schema).parquet(path), suite_results(row, checked, checks, duplicates)


#: Columns of a stored suite.
SUITE = "position int, kind string, column string, expected int, types array<string>, minimum string, maximum string, strict_min boolean"


def save_suite(checks: Sequence[Check], path: str, spark: SparkSession) -> None:
    """Keep a suite as data; ``load_suite`` gives the same checks in the same order."""
    rows = [(i, c.kind, c.column, c.expected, list(c.types), json.dumps(c.minimum), json.dumps(c.maximum), c.strict_min) for i, c in enumerate(checks)]
    spark.createDataFrame(rows, SUITE).coalesce(1).write.mode("overwrite").json(path)


def load_suite(path: str, spark: SparkSession) -> list[Check]:
    rows = spark.read.schema(SUITE).json(path).orderBy("position").collect()  # one row a check
    return [
        Check(r["kind"], r["column"], r["expected"], tuple(r["types"] or ()), json.loads(r["minimum"]), json.loads(r["maximum"]), r["strict_min"])
        for r in rows
    ]


def require_any_column(df: DataFrame) -> DataFrame:
    if not df.columns:
        raise GateError("wrong data collected")
    return df


def success_rates(results: DataFrame) -> DataFrame:
    """Share of passed checks per description, lowest first."""
    return grouped_mean(results, "Test Description", "Success", "success_rate")


def pass_fail_counts(results: DataFrame) -> DataFrame:
    return value_counts(results, "Success")


def checks_by_column(results: DataFrame) -> DataFrame:
    """Column x description matrix of success rates."""
    kinds = [r[0] for r in results.select("Test Description").distinct().orderBy("Test Description").collect()]
    return mean_matrix(results, "Column", "Test Description", "Success", [k for k in kinds if k is not None])


def suite_summary(results: DataFrame) -> DataFrame:
    passed = F.count_if(F.col("Success"))
    return results.agg(
        passed.alias("passed"),
        (F.count("*") - passed).alias("failed"),
        (passed / F.count("*") * 100).alias("success_pct"),
    )


def typed_groups(df: DataFrame, target: str, skip: Sequence[str] = ("index", "datetime", "row_id")) -> dict[str, list[str]]:
    """Columns of the numeric, categorical and target feature groups."""
    numeric = [c for c in numeric_columns(df.schema, booleans=True) if c not in skip]
    categorical = [c for c in string_columns(df.schema) if c not in (*skip, target)]
    return {"numerical_features": numeric, "categorical_features": categorical, "target": [target]}
