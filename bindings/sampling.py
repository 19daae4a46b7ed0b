"""Splits, samples, folds, encodings, row numbers."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from bindings.common import sql_hash, table
from featureflow.operators import encode, split
from featureflow.operators.drift import with_record_id
from featureflow.operators.features import fit_one_hot
from featureflow.operators.order import number_rows, number_values, running_total

QUERIES = {}


def query(name: str, sql: str | None):
    def register(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return register


RANKED_200 = f"""SELECT o_orderkey, o_totalprice, count(*) OVER () AS n,
row_number() OVER (ORDER BY {sql_hash(200, 'o_orderkey')}, o_orderkey) AS rn FROM orders"""


@query("spl1_train_part", f"SELECT o_orderkey, o_totalprice FROM ({RANKED_200}) WHERE rn <= round_even(0.8 * n, 0)")
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return split.split_random(df, "o_orderkey")[0]


@query("jn1_batch_part", f"SELECT o_orderkey, o_totalprice FROM ({RANKED_200}) WHERE rn > round_even(0.8 * n, 0)")
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return split.split_random(df, "o_orderkey")[1]


@query("jn1_rest_by_anti_join", "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'")
def _(spark, sf):
    df = table(spark, sf, "orders")
    return split.rest_of(df.select("o_orderkey"), df.where("o_orderstatus = 'F'"), "o_orderkey")


RANKED_42 = f"""SELECT l.*, count(*) OVER () AS n, row_number() OVER (ORDER BY {sql_hash(42, 'event_id')}, event_id) AS rn
FROM (SELECT event_id, user_id, event_type, value FROM events) l"""


@query(
    "spl2_split_and_validate",
    f"""SELECT event_id, user_id, event_type, value, CASE WHEN rn <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS part
    FROM ({RANKED_42})""",
)
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    parts = split.split_and_validate(df, "value", "event_id")
    joined = [
        parts[f"X_{p}"].join(parts[f"y_{p}"], "event_id").withColumn("part", F.lit(p)) for p in ("train", "test")
    ]
    return joined[0].unionByName(joined[1])


@query("spl2_same_rows_encoded", f"SELECT event_id FROM ({RANKED_42}) WHERE rn <= ceil(0.2 * n)")
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "event_type", "value")
    encoded = encode.one_hot_wide(df, encode.fit_categories(df))
    return split.train_test_parts(encoded, "event_id")[1].select("event_id")


@query("spl3_sample_rows", f"SELECT event_id, value FROM ({RANKED_42}) WHERE rn <= 3000")
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value")
    return split.sample_rows(df, 3000, "event_id")


@query("spl3_sample_of_small_table", "SELECT s_suppkey FROM supplier")
def _(spark, sf):
    return split.sample_rows(table(spark, sf, "supplier").select("s_suppkey"), 30000, "s_suppkey")


@query(
    "spl4_contiguous_folds",
    """SELECT row_id, (CASE WHEN row_number() OVER (ORDER BY row_id) <= ceil(count(*) OVER () / 2) THEN 0 ELSE 1 END)::integer AS fold
    FROM (SELECT o_orderkey * 3 + o_orderkey % 2 AS row_id FROM orders)""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select((F.col("o_orderkey") * 3 + F.col("o_orderkey") % 2).alias("row_id"))
    return split.contiguous_folds(df, "row_id")


# Ids over the whole 64-bit range, from the first 16 hex digits of a hash.
WIDE_ID_SQL = "(('0x' || substr(md5(o_orderkey::varchar), 1, 15))::bigint - 576460752303423488) * 16"


@query(
    "spl4_folds_of_hash_ids",
    f"""SELECT o_orderkey, (CASE WHEN row_number() OVER (ORDER BY id) <= ceil(count(*) OVER () / 2) THEN 0 ELSE 1 END)::integer AS fold
    FROM (SELECT o_orderkey, {WIDE_ID_SQL} AS id FROM orders)""",
)
def _(spark, sf):
    digits = F.conv(F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 15), 16, 10).cast("long")
    df = table(spark, sf, "orders").select("o_orderkey", ((digits - 576460752303423488) * 16).alias("id"))
    return split.contiguous_folds(df, "id").drop("id")


STATUSES = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def hot_sql(column: str, values: list[str], source: str = "") -> str:
    return ", ".join(
        f"CASE WHEN {column} = '{v}' THEN 1.0::double ELSE 0.0::double END AS \"{column}_{v}\"" for v in values[1:]
    )


@query(
    "enc1_one_hot_wide",
    f"""SELECT o_orderkey, o_totalprice, (CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE 0 END)::integer AS "is_blend_True",
    {hot_sql('o_orderstatus', STATUSES)}, {hot_sql('o_orderpriority', PRIORITIES)} FROM orders""",
)
def _(spark, sf):
    blend = F.when(F.col("o_custkey") % 3 == 0, True).when(F.col("o_custkey") % 3 == 1, False)
    df = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", blend.alias("is_blend"), "o_orderstatus", "o_orderpriority"
    )
    return encode.one_hot_wide(df, encode.fit_categories(df))


@query(
    "enc1_one_hot_vector",
    f"""SELECT o_orderkey, {hot_sql('o_orderstatus', STATUSES)}, {hot_sql('o_orderpriority', PRIORITIES)} FROM orders""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    model = fit_one_hot(df, ["o_orderstatus", "o_orderpriority"], "o_orderkey")
    slots = [f"o_orderstatus_{v}" for v in STATUSES[1:]] + [f"o_orderpriority_{v}" for v in PRIORITIES[1:]]
    array = vector_to_array(F.col("features"))
    return model.transform(df).select("o_orderkey", *[array[i].alias(name) for i, name in enumerate(slots)])


@query(
    "enc2_fitted_categories_on_new_rows",
    f"""SELECT o_orderkey, 0::integer AS "is_blend_True", {hot_sql('o_orderpriority', PRIORITIES[1:])} FROM orders""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    fitted = encode.fit_categories(df.where("o_orderpriority <> '1-URGENT'"))
    return encode.one_hot_wide(df, fitted)


@query(
    "enc2_refitted_on_batch",
    f"""SELECT o_orderkey, 0::integer AS "is_blend_True", {hot_sql('o_orderpriority', PRIORITIES[2:])} FROM orders
    WHERE o_orderpriority > '2-HIGH'""",
)
def _(spark, sf):
    batch = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority").where("o_orderpriority > '2-HIGH'")
    return encode.one_hot_wide(batch, encode.fit_categories(batch))


@query("prj13_record_id", "SELECT event_id AS record_id, value FROM events")
def _(spark, sf):
    return with_record_id(table(spark, sf, "events").select("event_id", "value"), "event_id")


@query(
    "prj13_row_numbers",
    """SELECT id, row_number() OVER (ORDER BY id) - 1 AS position FROM (SELECT event_id * 3 + event_id % 2 AS id FROM events)""",
)
def _(spark, sf):
    df = table(spark, sf, "events").select((F.col("event_id") * 3 + F.col("event_id") % 2).alias("id"))
    return number_rows(df, "id")


@query(
    "numbered_values",
    "SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS code FROM (SELECT DISTINCT c_name FROM customer)",
)
def _(spark, sf):
    return number_values(table(spark, sf, "customer").select("c_name").distinct(), "c_name")


@query(
    "running_totals",
    """SELECT l_returnflag, l_extendedprice, n, (sum(n) OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - n)::bigint AS before
    FROM (SELECT l_returnflag, l_extendedprice, count(*) AS n FROM lineitem GROUP BY 1, 2)""",
)
def _(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_returnflag", "l_extendedprice").agg(F.count("*").alias("n"))
    return running_total(counts, "l_extendedprice", F.col("n"), ["l_returnflag"])
