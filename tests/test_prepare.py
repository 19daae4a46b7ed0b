import datetime
import math

import pytest
from pyspark.sql import functions as F

from featureflow.operators import clean
from featureflow.plans.prepare import engineer_features, ingest, model_table, preprocess
from featureflow.schemas import INGESTED_COLUMNS, RAW_REVIEWS


def raw(spark, rows):
    defaults = {f.name: None for f in RAW_REVIEWS.fields}
    return spark.createDataFrame([tuple({**defaults, **r}.values()) for r in rows], RAW_REVIEWS)


def test_ingest(spark):
    base = {"country": "US", "points": 90, "price": 20.0, "variety": "Merlot"}
    df = raw(
        spark,
        [
            {"row_id": 0, **base, "title": "a"},
            {"row_id": 1, **base, "title": "b"},
            {"row_id": 2, **base, "price": 0.0},
            {"row_id": 3, **base, "price": None},
            {"row_id": 4, **base, "price": math.nan},
            {"row_id": 5, "price": 1.0},
        ],
    )
    out = ingest(df)
    assert sorted(out.columns) == sorted((*INGESTED_COLUMNS, "row_id"))
    rows = {r["row_id"]: r for r in out.collect()}
    assert sorted(rows) == [0, 5]
    assert rows[0]["datetime"] == datetime.datetime(2025, 1, 1)
    filled = {r["row_id"]: r for r in ingest(df, blank_nulls=True).collect()}
    assert (filled[5]["points"], filled[5]["variety"]) == (0, "")
    with pytest.raises(KeyError):
        ingest(df.drop("title"))


def test_preprocess(spark):
    df = spark.createDataFrame(
        [
            ("Pinot Noir", 25, "USA", "California"),
            ("Chardonnay", 30, "France", "Burgundy"),
            ("Red Blend", 0, "Italy", "Tuscany"),
            (None, 40, None, None),
        ],
        "variety string, price long, country string, province string",
    )
    rows = preprocess(df).orderBy("price").collect()
    assert [r["variety"] for r in rows] == ["pinotnoir", "chardonnay", "nan"]
    assert (rows[2]["country"], rows[2]["province"]) == ("unknown", "unknown")
    assert preprocess(df, "unknown").orderBy("price").collect()[2]["variety"] == "unknown"


def test_engineered_columns(spark):
    df = spark.createDataFrame(
        [("US", 95, 30.0, "CA", "Napa", "T", "pinotnoir", 0), (None, 82, 10.0, "x", "y", "z", "", 1)],
        "country string, points long, price double, province string, region_1 string, taster_name string, variety string, index long",
    ).withColumn("datetime", F.lit("2025-01-01").cast("timestamp"))
    out = engineer_features(df)
    assert "index" not in out.columns
    first, second = out.orderBy(F.desc("points")).collect()
    assert (first["points_category"], first["wine_type_main"], first["continent"]) == ("High", "red", "North America")
    assert (second["continent"], second["points_category"], second["wine_type_main"]) == ("Other", "Low", "other")
    assert second["is_blend"] is False and second["country_standardized"] is None
    table = model_table(out)
    assert sorted(table.columns) == sorted(
        ["country", "points", "price", "region_1", "taster_name", "datetime", "points_category", "wine_subtype"]
    )
    assert model_table(out, None).columns == out.columns
    with pytest.raises(KeyError):
        engineer_features(df.drop("variety"))


def test_zero_filter_keeps_null(spark):
    df = spark.createDataFrame([(0.0,), (None,), (3.0,)], "price double")
    assert df.count() - clean.drop_zero(df).count() == 1
    assert clean.keep_positive(df).count() == 1


def test_typed_fill_rejects_overflow(spark):
    df = spark.createDataFrame([(2**40,)], "n long")
    with pytest.raises(Exception, match="32-bit"):
        clean.typed_fill(df).collect()


def test_mode_ties_go_to_lowest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert clean.impute_mode(df).where("c = 'a'").count() == 3


def test_no_nulls_gate(spark):
    with pytest.raises(ValueError):
        clean.assert_no_nulls(spark.createDataFrame([(None,)], "a int"))
