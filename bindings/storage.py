"""Readers, writers, named tables and feature tables: written from the test tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings.checks import ORDER_RESULTS_SQL, flat, order_results
from bindings.cleaning import INGEST_SQL
from bindings.common import reviews, rounded, table
from bindings.profiling import CLOSED_FORM_SQL, closed_form
from featureflow.operators.profile import regression_metrics
from featureflow.plans.prepare import ingest
from featureflow.session import scratch_path
from featureflow.sources import feature_tables, tables

QUERIES = {}


def query(name: str, sql: str | None):
    def register(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return register


@query("src1_indexed_csv", "SELECT doc_id AS row_id, text, lang, source, n_chars FROM documents")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = scratch_path(spark, "documents_csv")
    tables.write_csv(docs, path, index="doc_id")
    schema = T.StructType(
        [
            T.StructField("row_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )
    # The texts hold line breaks.
    return tables.read_indexed_csv(spark, path, schema, multi_line=True)


@query("snk1_csv_without_index", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def _(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    path = scratch_path(spark, "part_csv")
    tables.write_csv(parts, path)
    return spark.read.csv(path, schema=parts.schema, **tables.CSV_FORMAT)


@query("src2_stored_intermediate", INGEST_SQL)
def _(spark, sf):
    store = tables.Tables(spark, scratch_path(spark, "tables"))
    return store.save("ingested", ingest(reviews(spark, sf)))


@query("src3_load_by_name", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def _(spark, sf):
    store = tables.Tables(spark, scratch_path(spark, "tables"), {"prepared": ["orders"]})
    store.save("orders", table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"))
    return store.load("orders")


@query(
    "snk2_partitioned_parquet",
    "SELECT event_id, user_id, value, event_type FROM events WHERE event_type = 'click'",
)
def _(spark, sf):
    store = tables.Tables(spark, scratch_path(spark, "tables"), {"output": ["events"]})
    events = table(spark, sf, "events").select("event_id", "user_id", "value", "event_type")
    return store.save("events", events, partition_by=["event_type"]).where("event_type = 'click'")


@query(
    "snk3_metrics_json",
    f"SELECT 'closed form' AS regressor, round(sqrt(avg(power(y - y_pred, 2))), 4) AS val_score FROM ({CLOSED_FORM_SQL})",
)
def _(spark, sf):
    rmse = regression_metrics(closed_form(spark, sf), "y", "y_pred").first()["rmse"]
    path = scratch_path(spark, "metrics")
    tables.write_json({"regressor": "closed form", "val_score": rmse}, path, spark)
    back = spark.read.schema("regressor string, val_score double").json(path)
    return rounded(back, "val_score", digits=4)


# Row ids with gaps: every second one is left out by arithmetic.
FEATURE_SOURCE_SQL = "SELECT o_orderkey * 3 + o_orderkey % 2 AS row_id, o_totalprice, o_custkey, o_orderstatus, o_orderpriority FROM orders"


def feature_source(spark, sf):
    return (
        table(spark, sf, "orders")
        .select(
            (F.col("o_orderkey") * 3 + F.col("o_orderkey") % 2).alias("row_id"),
            F.col("o_totalprice").alias("Price (total)"),
            "o_custkey",
            "o_orderstatus",
            "o_orderpriority",
            F.lit("2025-01-01").cast("timestamp").alias("datetime"),
        )
    )


@query(
    "snk5_feature_table",
    f"""SELECT row_number() OVER (ORDER BY row_id) - 1 AS row_id, round(o_totalprice::float::double, 2) AS price__total_,
    o_custkey::integer AS o_custkey, o_orderstatus, o_orderpriority, TIMESTAMP '2025-01-01 00:00:00' AS datetime FROM ({FEATURE_SOURCE_SQL})""",
)
def _(spark, sf):
    root = scratch_path(spark, "features")
    texts = {"o_custkey": "Numerical feature: o_custkey"}
    stored = feature_tables.write_feature_table(feature_source(spark, sf), root, "orders", 1, "row_id", texts)
    return stored.withColumn("price__total_", F.round(F.col("price__total_").cast("double"), 2))


@query(
    "snk6_feature_groups",
    f"""WITH s AS (SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS n FROM ({FEATURE_SOURCE_SQL}))
    SELECT n AS row_id, o_custkey::integer AS o_custkey, o_orderstatus, o_orderpriority, round(o_totalprice::float::double, 2) AS price FROM s""",
)
def _(spark, sf):
    df = feature_source(spark, sf).withColumnRenamed("Price (total)", "price")
    written = feature_tables.write_feature_groups(df, "price", scratch_path(spark, "groups"))
    joined = feature_tables.joined_groups(written).select("row_id", "o_custkey", "o_orderstatus", "o_orderpriority", "price")
    return joined.withColumn("price", F.round(F.col("price").cast("double"), 2))


@query(
    "snk7_feature_statistics",
    f"""WITH s AS (SELECT o_custkey::double AS v FROM ({FEATURE_SOURCE_SQL})), r AS (SELECT min(v) AS lo, max(v) AS hi FROM s)
    SELECT 'o_custkey' AS feature, least(floor((v - lo) / (hi - lo) * 20), 19)::integer AS bin, count(*) AS count FROM s, r GROUP BY 2""",
)
def _(spark, sf):
    root = scratch_path(spark, "features")
    df = feature_source(spark, sf).select("row_id", "datetime", "o_custkey")
    feature_tables.write_feature_table(df, root, "customers")
    return spark.read.parquet(f"{root}/customers_v1/histograms")


@query(
    "snk7_feature_correlations",
    f"""SELECT a.c AS column_a, b.c AS column_b, round(CASE WHEN a.c = b.c THEN 1 ELSE (SELECT corr(o_custkey::double, o_totalprice::float::double)
    FROM ({FEATURE_SOURCE_SQL})) END, 6)::double AS correlation FROM (VALUES ('o_custkey'), ('price__total_')) a(c), (VALUES ('o_custkey'), ('price__total_')) b(c)""",
)
def _(spark, sf):
    root = scratch_path(spark, "features")
    feature_tables.write_feature_table(feature_source(spark, sf), root, "orders")
    return rounded(spark.read.parquet(f"{root}/orders_v1/correlations"), "correlation")


@query("snk8_results_csv", f"SELECT success, description FROM ({ORDER_RESULTS_SQL})")
def _(spark, sf):
    results = flat(order_results(spark, sf)).select("success", "description")
    path = scratch_path(spark, "results_csv")
    tables.write_csv(results, path)
    return spark.read.csv(path, schema=results.schema, **tables.CSV_FORMAT)
