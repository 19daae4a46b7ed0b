"""Readers, writers and a registry of named tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.operators.clean import nulls_for_nans
from featureflow.schemas import RAW_REVIEWS

CSV_FORMAT = {"header": True, "quote": '"', "escape": '"'}


def read_indexed_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType = RAW_REVIEWS, multi_line: bool = False
) -> DataFrame:
    """CSV whose unnamed first column is the row index; it arrives under the schema's first name.

    The schema is given, so there is no inference pass. Files are split among tasks; fields with quoted
    line breaks need ``multi_line``, which makes each file one task: hand over many files then. NaN in a
    number becomes null.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return nulls_for_nans(spark.read.csv(paths, schema=schema, multiLine=multi_line, enforceSchema=True, **CSV_FORMAT))


def write_csv(df: DataFrame, path: str, index: str | None = None) -> None:
    """CSV export; ``index`` names the column that becomes the unnamed first one."""
    if index is not None:
        df = df.select(F.col(index).alias("_c0"), *[c for c in df.columns if c != index])
    exact = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").csv(path, **CSV_FORMAT, **exact)


def write_json(values: Mapping, path: str, spark: SparkSession) -> None:
    """One JSON record, for metrics."""
    kinds = {str: "string", bool: "boolean", int: "long", float: "double"}
    schema = ", ".join(f"`{k}` {kinds[type(v)]}" for k, v in values.items())
    spark.createDataFrame([tuple(values.values())], schema).coalesce(1).write.mode("overwrite").json(path)


def read_json(path: str, spark: SparkSession, schema: str | None = None) -> dict:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path).first().asDict()


#: Folders and the tables they hold, unless the caller names others.
LAYERS = {
    "raw": ("reviews",),
    "prepared": ("ingested", "train", "batch"),
    "features": ("train_features", "batch_features"),
    "split": ("X_train", "X_val", "y_train", "y_val"),
    "output": ("scored", "described", "drift"),
    "reports": ("checks", "metrics"),
}


@dataclass
class Tables:
    """Named Parquet tables below one root, one folder per layer; no type is lost between steps."""

    spark: SparkSession
    root: str
    layers: Mapping[str, Sequence[str]] = field(default_factory=lambda: LAYERS)

    def path(self, name: str) -> str:
        for layer, names in self.layers.items():
            if name in names:
                return f"{self.root}/{layer}/{name}"
        raise KeyError(f"unknown table {name}")

    def names(self) -> list[str]:
        return [n for names in self.layers.values() for n in names]

    def load(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return nulls_for_nans(reader.parquet(self.path(name)))

    def save(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write a table and read it back, so that later steps start from the stored rows."""
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(name))
        return self.load(name, df.schema)
