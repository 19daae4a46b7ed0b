"""Counts, missing values, describe, correlations, association, histograms, labelings, errors, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.common import GAPPY_EVENTS_SQL, gappy_events, quoted, rounded, columns_of, sql_case, sql_squash, table
from featureflow.functions import rules
from featureflow.functions.scalar import bucket_points
from featureflow.operators import profile, sketches
from featureflow.operators.association import cramers_v_matrix
from featureflow.operators.clean import drop_missing
from featureflow.session import scratch_path

QUERIES = {}


def query(name: str, sql: str | None):
    def register(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return register


@query(
    "agg2_value_counts",
    f"SELECT event_type, count(*) AS count FROM ({GAPPY_EVENTS_SQL}) WHERE event_type IS NOT NULL GROUP BY 1",
)
def _(spark, sf):
    return profile.value_counts(gappy_events(spark, sf), "event_type")


@query(
    "agg3_distinct_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique FROM lineitem"
        for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    ),
)
def _(spark, sf):
    names = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"]
    return profile.distinct_counts(table(spark, sf, "lineitem"), names)


NULLS_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, count(*) AS n, count(DISTINCT {c}) AS n_unique, "
    f"count({c}) AS non_null, '{t}' AS dtype FROM g"
    for c, t in (("event_id", "bigint"), ("event_type", "string"), ("value", "double"), ("user_id", "bigint"))
)


@query(
    "agg4_missing_table",
    f"WITH g AS ({GAPPY_EVENTS_SQL}), s AS ({NULLS_SQL}) SELECT \"column\", nulls AS missing_count, "
    "round_even(nulls / n * 100 * 100, 0) / 100 AS missing_percentage FROM s WHERE nulls > 0",
)
def _(spark, sf):
    return profile.missing_table(gappy_events(spark, sf))


@query(
    "agg5_column_profile",
    f"WITH g AS ({GAPPY_EVENTS_SQL}), s AS ({NULLS_SQL}) SELECT \"column\", dtype, nulls, "
    "round_even(nulls / n * 100 * 100, 0) / 100 AS nulls_pct, n_unique FROM s",
)
def _(spark, sf):
    return profile.column_profile(gappy_events(spark, sf))


@query(
    "agg21_table_info",
    f'WITH g AS ({GAPPY_EVENTS_SQL}), s AS ({NULLS_SQL}) SELECT "column", dtype, non_null FROM s',
)
def _(spark, sf):
    return profile.table_info(gappy_events(spark, sf))


def describe_sql(source: str, columns: list[str]) -> str:
    measures = (
        ("count", "count({c})::double"),
        ("mean", "avg({c})::double"),
        ("std", "stddev_samp({c})"),
        ("min", "min({c})::double"),
        ("25%", "quantile_cont({c}::double, 0.25)"),
        ("50%", "quantile_cont({c}::double, 0.5)"),
        ("75%", "quantile_cont({c}::double, 0.75)"),
        ("max", "max({c})::double"),
    )
    return " UNION ALL ".join(
        f"SELECT '{name}' AS summary, "
        + ", ".join(f"round({m.format(c=c)}, 4) + 0.0::double AS {c}" for c in columns)
        + f" FROM ({source})"
        for name, m in measures
    )


@query("agg6_describe", describe_sql("SELECT * FROM lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_partkey"]))
def _(spark, sf):
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_partkey"]
    return rounded(profile.describe(columns_of(spark, sf, "lineitem", *names), names), *names, digits=4)


@query("agg6_describe_with_nulls", describe_sql(GAPPY_EVENTS_SQL, ["value", "user_id"]))
def _(spark, sf):
    return rounded(profile.describe(gappy_events(spark, sf), ["value", "user_id"]), "value", "user_id", digits=4)


@query(
    "agg7_grouped_mean",
    "SELECT l_returnflag, avg(l_quantity) AS mean FROM lineitem GROUP BY 1",
)
def _(spark, sf):
    return profile.grouped_mean(table(spark, sf, "lineitem"), "l_returnflag", "l_quantity")


def pairs_sql(names: list[str], source: str, value: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round({value.format(a=a, b=b)}, 6) AS correlation FROM {source}"
        for a in names
        for b in names
    )


@query(
    "agg8_pearson",
    pairs_sql(["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "lineitem", "corr({a}, {b})"),
)
def _(spark, sf):
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(profile.pearson_matrix(table(spark, sf, "lineitem"), names), "correlation")


@query(
    "agg8_pearson_with_nulls",
    f"WITH g AS (SELECT *, event_id % 97 AS k FROM ({GAPPY_EVENTS_SQL})) " + pairs_sql(["value", "user_id", "k"], "g", "corr({a}, {b})"),
)
def _(spark, sf):
    df = gappy_events(spark, sf).withColumn("k", F.col("event_id") % 97)
    return rounded(profile.pearson_matrix(df, ["value", "user_id", "k"]), "correlation")


def spearman_sql(names: list[str], source: str) -> str:
    parts = []
    for a in names:
        for b in names:
            if a == b:
                parts.append(f"SELECT '{a}' AS column_a, '{a}' AS column_b, 1.0::double AS correlation")
                continue
            ranks = (
                f"SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0::double AS x, "
                f"rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0::double AS y "
                f"FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
            )
            parts.append(
                f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr(x, y), 6) AS correlation FROM ({ranks})"
            )
    return " UNION ALL ".join(parts)


@query("agg8_spearman", spearman_sql(["l_quantity", "l_extendedprice", "l_discount"], "lineitem"))
def _(spark, sf):
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    return rounded(profile.spearman_matrix(columns_of(spark, sf, "lineitem", *names), names), "correlation")


@query(
    "agg8_spearman_with_nulls",
    f"WITH g AS (SELECT *, event_id % 97 AS k FROM ({GAPPY_EVENTS_SQL})) " + spearman_sql(["value", "user_id", "k"], "g"),
)
def _(spark, sf):
    df = gappy_events(spark, sf).withColumn("k", F.col("event_id") % 97)
    return rounded(profile.spearman_matrix(df, ["value", "user_id", "k"]), "correlation")


def cramers_sql(names: list[str], source: str) -> str:
    parts = []
    for a in names:
        for b in names:
            if a == b:
                parts.append(f"SELECT '{a}' AS column_a, '{a}' AS column_b, 1.0::double AS cramers_v")
                continue
            parts.append(
                f"""SELECT '{a}' AS column_a, '{b}' AS column_b, round_even(100 * coalesce(CASE
                WHEN least(k - (k-1)*(k-1)/(n-1) - 1, r - (r-1)*(r-1)/(n-1) - 1) <= 0 THEN 0.0
                ELSE sqrt(greatest(0.0, chi2/n - (k-1)*(r-1)/(n-1))
                     / least(k - (k-1)*(k-1)/(n-1) - 1, r - (r-1)*(r-1)/(n-1) - 1)) END, 0.0), 0) / 100 AS cramers_v
                FROM (SELECT n, r, k, sum(power(greatest(abs(o - e) - CASE WHEN r = 2 AND k = 2 THEN 0.5 ELSE 0 END, 0), 2) / e) AS chi2
                  FROM (SELECT coalesce(c.o, 0) AS o, rt.t * ct.t / n.n AS e, n.n::double AS n, n.r::double AS r, n.k::double AS k
                    FROM (SELECT {a} AS a, count(*)::double AS t FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1) rt
                    CROSS JOIN (SELECT {b} AS b, count(*)::double AS t FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1) ct
                    CROSS JOIN (SELECT count(*) AS n, count(DISTINCT {a}) AS r, count(DISTINCT {b}) AS k FROM {source}
                                WHERE {a} IS NOT NULL AND {b} IS NOT NULL) n
                    LEFT JOIN (SELECT {a} AS a, {b} AS b, count(*)::double AS o FROM {source}
                               WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2) c ON c.a = rt.a AND c.b = ct.b)
                  GROUP BY n, r, k)"""
            )
    return " UNION ALL ".join(parts)


CATEGORICAL_LINES_SQL = """SELECT l_returnflag, l_linestatus, l_quantity > 25 AS large,
CASE WHEN l_quantity > 40 THEN 'many' WHEN l_extendedprice > 50000 THEN 'dear' ELSE l_returnflag END AS kind,
CASE WHEN l_linenumber = 1 THEN NULL WHEN l_linestatus = 'O' AND l_tax < 0.04 THEN 'x' ELSE 'y' END AS gappy FROM lineitem"""


@query(
    "agg9_cramers_v",
    f"WITH c AS ({CATEGORICAL_LINES_SQL}) "
    + cramers_sql(["l_returnflag", "l_linestatus", "large", "kind", "gappy"], "c"),
)
def _(spark, sf):
    return cramers_v_matrix(
        spark.sql(CATEGORICAL_LINES_SQL.replace("FROM lineitem", "FROM {l}"), l=table(spark, sf, "lineitem"))
    )


@query(
    "agg10_histogram",
    """WITH s AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
    b AS (SELECT least(floor((l_quantity - lo) / (hi - lo) * 20), 19)::integer AS bin, count(*) AS n FROM lineitem, s GROUP BY 1)
    SELECT i::integer AS bin, round(lo + i * (hi - lo) / 20, 6) AS low, round(lo + (i + 1) * (hi - lo) / 20, 6) AS high,
           coalesce(n, 0) AS count FROM range(20) t(i) CROSS JOIN s LEFT JOIN b ON b.bin = i""",
)
def _(spark, sf):
    return rounded(profile.histogram(table(spark, sf, "lineitem"), "l_quantity", 20), "low", "high")


@query(
    "agg11_crosstab",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O,
    count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1""",
)
def _(spark, sf):
    return profile.crosstab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query(
    "agg12_mean_matrix",
    """SELECT l_returnflag, avg(l_quantity) FILTER (l_linestatus = 'F') AS F, avg(l_quantity) FILTER (l_linestatus = 'O') AS O
    FROM lineitem GROUP BY 1""",
)
def _(spark, sf):
    return profile.mean_matrix(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", "l_quantity", ["F", "O"])


@query("agg11_crosstab_long", "SELECT o_custkey, o_orderpriority, count(*) AS count FROM orders GROUP BY 1, 2")
def _(spark, sf):
    return profile.crosstab(table(spark, sf, "orders"), "o_custkey", "o_orderpriority")


@query(
    "agg12_mean_matrix_long",
    "SELECT l_partkey, l_returnflag, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY 1, 2",
)
def _(spark, sf):
    return rounded(profile.mean_matrix(table(spark, sf, "lineitem"), "l_partkey", "l_returnflag", "l_quantity"), "mean")


BOTH_LABELS_SQL = (
    f"SELECT p_name, {sql_case(sql_squash('p_name'), rules.MAIN_TYPE_RULES)} AS first_labels, "
    f"{sql_case(sql_squash('p_name'), rules.WIDER_SQUASHED_RULES)} AS second_labels FROM part"
)


def both_labels(spark, sf):
    from featureflow.functions.text import classify, squash

    name = F.col("p_name")
    return table(spark, sf, "part").select(
        "p_name",
        classify(squash(name), rules.MAIN_TYPE_RULES).alias("first_labels"),
        rules.alternative_type(name).alias("second_labels"),
    )


@query(
    "agg13_label_share",
    f"SELECT count(*) FILTER (second_labels = 'other') AS n_label, count(*) AS n_rows, "
    f"round(count(*) FILTER (second_labels = 'other') / count(*) * 100, 6) AS share_pct FROM ({BOTH_LABELS_SQL})",
)
def _(spark, sf):
    return rounded(profile.label_share(both_labels(spark, sf), "second_labels"), "share_pct")


@query(
    "agg13_label_reduction",
    f"""SELECT b AS n_before, a AS n_after, round(coalesce((b - a) / nullif(b, 0) * 100, 0), 6)::double AS reduction_pct
    FROM (SELECT count(*) FILTER (first_labels = 'other') AS b, count(*) FILTER (second_labels = 'other') AS a FROM ({BOTH_LABELS_SQL}))""",
)
def _(spark, sf):
    return rounded(profile.label_reduction(both_labels(spark, sf), "first_labels", "second_labels"), "reduction_pct")


@query(
    "agg14_mean_and_std",
    """SELECT 'before' AS stage, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std FROM orders
    UNION ALL SELECT 'after', round(avg(least(o_totalprice, 200000)), 4), round(stddev_samp(least(o_totalprice, 200000)), 4) FROM orders""",
)
def _(spark, sf):
    df = table(spark, sf, "orders")
    capped = df.withColumn("o_totalprice", F.least("o_totalprice", F.lit(200000.0)))
    both = profile.mean_and_std(df, "o_totalprice", "before").unionByName(
        profile.mean_and_std(capped, "o_totalprice", "after")
    )
    return rounded(both, "mean", "std", digits=4)


@query("agg15_shape", "SELECT count(*) AS n_rows, 11::integer AS n_columns FROM lineitem")
def _(spark, sf):
    return profile.shape(table(spark, sf, "lineitem"))


CLOSED_FORM_SQL = "SELECT l_extendedprice AS y, 900.0 + l_quantity * 1500 AS y_pred FROM lineitem"


def closed_form(spark, sf):
    predicted = F.lit(900.0) + F.col("l_quantity") * 1500
    return table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("y"), predicted.alias("y_pred"))


@query(
    "agg17_regression_metrics",
    f"""SELECT round(avg(power(y - y_pred, 2)), 2) AS mse, round(sqrt(avg(power(y - y_pred, 2))), 4) AS rmse,
    round(avg(abs(y - y_pred)), 4) AS mae, round(1 - avg(power(y - y_pred, 2)) / var_pop(y), 6) AS r2 FROM ({CLOSED_FORM_SQL})""",
)
def _(spark, sf):
    metrics = profile.regression_metrics(closed_form(spark, sf), "y", "y_pred")
    return rounded(rounded(rounded(metrics, "mse", digits=2), "rmse", "mae", digits=4), "r2")


LABELS = ["red", "white", "rosé", "sparkling", "fortified", "other"]


@query(
    "agg18_compare_labelings",
    "SELECT l AS label, "
    + ", ".join(
        f"(SELECT count(*) FROM b WHERE {c} = l) AS {n}" for n, c in (("first", "first_labels"), ("second", "second_labels"))
    )
    + f" FROM (SELECT unnest([{', '.join(quoted(x) for x in LABELS)}]) AS l)",
)
def _(spark, sf):
    methods = {"first": "first_labels", "second": "second_labels"}
    return profile.compare_labelings(both_labels(spark, sf), methods, LABELS)


QUERIES["agg18_compare_labelings"] = (
    QUERIES["agg18_compare_labelings"][0],
    f"WITH b AS ({BOTH_LABELS_SQL}) " + QUERIES["agg18_compare_labelings"][1],
)


@query("agg19_sorted_distinct", "SELECT DISTINCT c_mktsegment FROM customer WHERE c_acctbal < 0")
def _(spark, sf):
    return profile.sorted_distinct(table(spark, sf, "customer").where("c_acctbal < 0"), "c_mktsegment")


@query("agg20_value_distribution", "SELECT p_size, count(*) AS count FROM part GROUP BY 1")
def _(spark, sf):
    return profile.value_distribution(table(spark, sf, "part"), "p_size")


@query(
    "srt1_top_words",
    """SELECT word, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
    GROUP BY 1 ORDER BY count(*) DESC, word LIMIT 20""",
)
def _(spark, sf):
    # Very many distinct values of which few are frequent.
    words = table(spark, sf, "documents").select(F.explode(F.split("text", " ")).alias("word"))
    return profile.top_values(words, "word", 20)


@query(
    "agg5_stored_states",
    """SELECT 'o_totalprice' AS "column", count(*) AS n, count(*) FILTER (o_custkey % 10 = 0) AS nulls, min(p) AS low, max(p) AS high, true AS near_unique, true AS near_median
    FROM (SELECT *, CASE WHEN o_custkey % 10 <> 0 THEN o_totalprice END AS p FROM orders)
    UNION ALL SELECT 'o_orderpriority', count(*), 0, NULL, NULL, true, NULL FROM orders""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority", F.when(F.col("o_custkey") % 10 != 0, F.col("o_totalprice")).alias("o_totalprice"))
    path = scratch_path(spark, "states")
    names = ["o_totalprice", "o_orderpriority"]
    # Batches arrive by status; no later one reads the rows of an earlier one.
    for status in ("F", "O", "P"):
        sketches.append_state(orders.where(F.col("o_orderstatus") == status), path, status, names)
    exact = profile.distinct_counts(orders, names).withColumnRenamed("n_unique", "exact")
    below, above = orders.agg(F.expr("percentile(o_totalprice, array(0.48, 0.52))")).first()[0]
    found = sketches.stored_profile(spark, path, [0.5]).join(exact, "column")
    near_unique = F.abs(F.col("n_unique") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.08 * F.col("exact"))
    return found.select("column", "n", "nulls", "low", "high", near_unique.alias("near_unique"), F.col("quantiles")[0].between(below, above).alias("near_median"))


@query(
    "srt1_top_values",
    "SELECT p_brand, count(*) AS count FROM part GROUP BY 1 ORDER BY count(*) DESC, p_brand LIMIT 10",
)
def _(spark, sf):
    return profile.top_values(table(spark, sf, "part"), "p_brand", 10)


@query("srt2_sorted_counts", f"SELECT event_type, count(*) AS count FROM ({GAPPY_EVENTS_SQL}) WHERE event_type IS NOT NULL AND value IS NOT NULL GROUP BY 1")
def _(spark, sf):
    df = drop_missing(gappy_events(spark, sf), ["event_type", "value"])
    return profile.value_counts(df, "event_type", ascending=True)


@query("srt3_first_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000")
def _(spark, sf):
    return profile.first_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 1000, "o_orderkey")


@query(
    "srt5_best_candidate",
    """SELECT l_returnflag AS model, score FROM (SELECT l_returnflag, round(-sqrt(avg(power(l_quantity - 25, 2))), 6) AS score
    FROM lineitem GROUP BY 1) ORDER BY score DESC LIMIT 1""",
)
def _(spark, sf):
    error = F.sqrt(F.avg(F.pow(F.col("l_quantity") - 25, F.lit(2))))
    scores = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("model")).agg((-error).alias("score"))
    return rounded(profile.best_of(scores, "model", "score"), "score")


@query(
    "bucket_counts",
    "SELECT CASE WHEN p_size < 85 - 60 THEN 'Low' WHEN p_size < 90 - 60 THEN 'Medium' ELSE 'High' END AS bucket, count(*) AS count "
    "FROM part GROUP BY 1",
)
def _(spark, sf):
    df = table(spark, sf, "part").select(bucket_points(F.col("p_size") + 60).alias("bucket"))
    return profile.value_counts(df, "bucket")
