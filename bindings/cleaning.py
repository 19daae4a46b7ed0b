"""Column pruning, filters, null handling, de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.common import GAPPY_EVENTS_SQL, REVIEWS_SQL, gappy_events, reviews, rounded, sql_any, table
from featureflow.operators import clean, profile
from featureflow.plans.prepare import ingest

QUERIES = {}


def query(name: str, sql: str | None):
    def register(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return register


@query("prj1_strict_drop", "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem")
def _(spark, sf):
    return clean.strict_drop(
        table(spark, sf, "lineitem"),
        ["l_partkey", "l_suppkey", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    )


@query("prj2_drop_unnamed", "SELECT p_partkey, p_brand FROM part")
def _(spark, sf):
    raw = table(spark, sf, "part").select(
        "p_partkey", "p_brand", F.col("p_size").alias("Unnamed: 0"), F.col("p_type").alias("is_unnamed_too")
    )
    return clean.drop_unnamed(raw)


@query("prj3_drop_index_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, sf):
    raw = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.col("o_custkey").alias("index"), F.col("o_orderkey").alias("df_index")
    )
    return clean.drop_index_columns(raw)


@query("prj4_drop_columns_without_index", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, sf):
    raw = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", "o_orderstatus", F.col("o_custkey").alias("index")
    )
    return clean.strict_drop(clean.drop_index_columns(raw), ["o_orderstatus"])


@query("prj5_lenient_drop", "SELECT c_custkey, c_acctbal FROM customer")
def _(spark, sf):
    kept, missing = clean.drop_present(
        table(spark, sf, "customer"), ["c_name", "c_nationkey", "c_mktsegment", "continent"]
    )
    assert missing == ["continent"]
    return kept


@query("prj6_first_of_each_name", "SELECT s_suppkey, s_acctbal AS bal FROM supplier")
def _(spark, sf):
    twice = table(spark, sf, "supplier").select(
        "s_suppkey", F.col("s_acctbal").alias("bal"), F.col("s_nationkey").alias("bal")
    )
    return clean.first_of_each_name(twice)


@query(
    "prj7_columns_by_kind",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax "
    "FROM lineitem",
)
def _(spark, sf):
    df = table(spark, sf, "lineitem")
    return df.select(*clean.numeric_and_categorical(df)[0])


@query(
    "prj8_features_and_target",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice AS y FROM orders",
)
def _(spark, sf):
    df = table(spark, sf, "orders").drop("o_orderdate")
    x, y = clean.features_and_target(df, "o_totalprice", "o_orderkey")
    return x.join(y.withColumnRenamed("o_totalprice", "y"), "o_orderkey")


@query("prj9_best_columns", "SELECT p_size, p_retailprice FROM part")
def _(spark, sf):
    return clean.select_features(table(spark, sf, "part"), ["p_size", "p_retailprice"])


@query("prj10_rename", "SELECT n_nationkey AS row_id, n_name AS country FROM nation")
def _(spark, sf):
    df = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return clean.rename(df, {"n_nationkey": "row_id", "n_name": "country", "absent": "x"})


@query("prj11_columns_like", "SELECT l_extendedprice, l_shipdate FROM lineitem")
def _(spark, sf):
    df = table(spark, sf, "lineitem")
    return df.select(*clean.columns_like(df, "EXTENDED"), *clean.columns_like(df, "shipd"))


@query("prj12_event_time", "SELECT o_orderkey, TIMESTAMP '2025-01-01 00:00:00' AS datetime FROM orders")
def _(spark, sf):
    return clean.with_event_time(table(spark, sf, "orders").select("o_orderkey"))


@query(
    "flt1_keep_positive",
    f"SELECT row_id, price FROM ({REVIEWS_SQL}) WHERE price > 0",
)
def _(spark, sf):
    return clean.keep_positive(reviews(spark, sf).select("row_id", "price"))


@query(
    "flt2_drop_zero_keep_null",
    f"SELECT row_id, price FROM ({REVIEWS_SQL}) WHERE price IS DISTINCT FROM 0",
)
def _(spark, sf):
    return clean.drop_zero(reviews(spark, sf).select("row_id", "price"))


@query(
    "flt3_drop_empty_rows",
    f"SELECT * FROM ({GAPPY_EVENTS_SQL}) "
    "WHERE NOT (event_type IS NULL AND value IS NULL AND user_id IS NULL)",
)
def _(spark, sf):
    return clean.drop_empty_rows(gappy_events(spark, sf), ["event_id"])


@query(
    "flt4_drop_missing",
    f"SELECT * FROM ({GAPPY_EVENTS_SQL}) WHERE event_type IS NOT NULL AND value IS NOT NULL",
)
def _(spark, sf):
    return clean.drop_missing(gappy_events(spark, sf), ["event_type", "value"])


@query(
    "flt5_fill_unknown",
    f"SELECT event_id, coalesce(event_type, 'unknown') AS event_type, value, user_id FROM ({GAPPY_EVENTS_SQL})",
)
def _(spark, sf):
    return clean.fill_unknown(gappy_events(spark, sf))


@query(
    "flt6_typed_fill",
    "SELECT event_id::integer AS event_id, coalesce(event_type, '') AS event_type, "
    "round(coalesce(value, 0.0)::float::double, 4) AS value, coalesce(user_id, 0)::integer AS user_id "
    f"FROM ({GAPPY_EVENTS_SQL})",
)
def _(spark, sf):
    filled = clean.typed_fill(gappy_events(spark, sf))
    return filled.withColumn("value", F.round(F.col("value").cast("double"), 4))


@query(
    "flt7_impute_mode",
    f"""WITH g AS ({GAPPY_EVENTS_SQL}),
    m AS (SELECT event_type AS top FROM g WHERE event_type IS NOT NULL
          GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)
    SELECT event_id, coalesce(event_type, (SELECT top FROM m)) AS event_type, value, user_id FROM g""",
)
def _(spark, sf):
    return clean.impute_mode(gappy_events(spark, sf))


@query(
    "flt8_null_counts",
    f"""WITH g AS ({GAPPY_EVENTS_SQL})
    SELECT count(*) - count(event_id) AS event_id, count(*) - count(event_type) AS event_type,
           count(*) - count(value) AS value, count(*) - count(user_id) AS user_id FROM g""",
)
def _(spark, sf):
    return clean.null_count_table(gappy_events(spark, sf))


# Both kinds of missing values in one column, alike on both sides.
NAN_EVENTS_SQL = """SELECT event_id, event_type, CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 'NaN'::double ELSE value END AS value,
    CASE WHEN event_id % 13 = 0 THEN 'NaN'::double ELSE user_id::double END AS user_id FROM events"""
PLAIN_EVENTS_SQL = """(SELECT event_id, event_type, CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 THEN value END AS value,
    CASE WHEN event_id % 13 <> 0 THEN user_id::double END AS user_id FROM events)"""


def nan_events(spark, sf):
    return spark.sql(NAN_EVENTS_SQL.replace("FROM events", "FROM {e}"), e=table(spark, sf, "events"))


@query(
    "flt8_null_counts_with_nan",
    f"SELECT 0::bigint AS event_id, 0::bigint AS event_type, count(*) - count(value) AS value, count(*) - count(user_id) AS user_id FROM {PLAIN_EVENTS_SQL}",
)
def _(spark, sf):
    return clean.null_count_table(nan_events(spark, sf))


@query(
    "agg3_agg21_counts_with_nan",
    f"""SELECT 'value' AS "column", count(value) AS non_null, count(DISTINCT value) AS n_unique FROM {PLAIN_EVENTS_SQL}
    UNION ALL SELECT 'user_id', count(user_id), count(DISTINCT user_id) FROM {PLAIN_EVENTS_SQL}""",
)
def _(spark, sf):
    events = nan_events(spark, sf).select("value", "user_id")
    return profile.table_info(events).drop("dtype").join(profile.distinct_counts(events), "column")


@query(
    "agg5_profile_with_nan",
    f"""SELECT 'value' AS "column", count(*) - count(value) AS nulls, count(DISTINCT value) AS n_unique FROM {PLAIN_EVENTS_SQL}
    UNION ALL SELECT 'user_id', count(*) - count(user_id), count(DISTINCT user_id) FROM {PLAIN_EVENTS_SQL}""",
)
def _(spark, sf):
    return profile.column_profile(nan_events(spark, sf).select("value", "user_id")).select("column", "nulls", "n_unique")


@query("agg7_means_with_nan", f"SELECT event_type, round(avg(value), 6) AS mean FROM {PLAIN_EVENTS_SQL} GROUP BY 1")
def _(spark, sf):
    return rounded(profile.grouped_mean(nan_events(spark, sf), "event_type", "value"), "mean")


@query(
    "agg8_correlations_with_nan",
    f"""WITH e AS (SELECT value AS x, user_id AS y FROM {PLAIN_EVENTS_SQL} WHERE value IS NOT NULL AND user_id IS NOT NULL),
    r AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
                 rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM e)
    SELECT round((SELECT corr(x, y) FROM e), 6) AS pearson, round((SELECT corr(rx, ry) FROM r), 6) AS spearman""",
)
def _(spark, sf):
    events = nan_events(spark, sf).select("value", "user_id")
    one = lambda m, name: m.where("column_a = 'value' AND column_b = 'user_id'").select("column_a", F.col("correlation").alias(name))
    both = one(profile.pearson_matrix(events), "pearson").join(one(profile.spearman_matrix(events), "spearman"), "column_a")
    return rounded(both.drop("column_a"), "pearson", "spearman")


@query("flt8_assert_no_nulls", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, sf):
    return clean.assert_no_nulls(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"))


@query(
    "flt9_membership",
    """SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN
    (SELECT o_orderpriority FROM orders GROUP BY 1 ORDER BY count(*) DESC, o_orderpriority LIMIT 2)""",
)
def _(spark, sf):
    from featureflow.operators.profile import rows_with_top_values

    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return rows_with_top_values(df, "o_orderpriority", 2)


@query("flt10_substring", f"SELECT doc_id FROM documents WHERE {sql_any('lower(text)', ['noir', 'blanc', 'port'])}")
def _(spark, sf):
    from featureflow.functions.text import contains_any

    df = table(spark, sf, "documents")
    return df.where(contains_any(F.lower("text"), ["noir", "blanc", "port"])).select("doc_id")


@query("agg1_distinct_rows", "SELECT lang, text, n_chars, min(doc_id) AS row_id FROM documents GROUP BY ALL")
def _(spark, sf):
    df = table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"), "lang", "text", "n_chars")
    return clean.distinct_rows(df)


@query(
    "agg1_distinct_low_cardinality",
    "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem",
)
def _(spark, sf):
    return clean.distinct_rows(
        table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber"), None
    )


INGEST_SQL = f"""
SELECT min(row_id) AS row_id, country, points, price, province, region_1, taster_name, variety,
       TIMESTAMP '2025-01-01 00:00:00' AS datetime
FROM ({REVIEWS_SQL}) WHERE price > 0
GROUP BY country, points, price, province, region_1, taster_name, variety
"""


@query("ingest_reviews", INGEST_SQL)
def _(spark, sf):
    return ingest(reviews(spark, sf))


@query(
    "ingest_reviews_filled",
    f"""SELECT row_id, coalesce(country, '') AS country, points::integer AS points,
    round(price::float::double, 3) AS price, province, coalesce(region_1, '') AS region_1,
    coalesce(taster_name, '') AS taster_name, coalesce(variety, '') AS variety, datetime
    FROM ({INGEST_SQL})""",
)
def _(spark, sf):
    filled = ingest(reviews(spark, sf), blank_nulls=True)
    return rounded(filled.withColumn("price", F.col("price").cast("double")), "price", digits=3)
