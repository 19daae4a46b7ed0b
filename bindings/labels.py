"""Text normalisation, keyword rules, buckets, replacements and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.cleaning import INGEST_SQL
from bindings.common import (
    quoted,
    reviews,
    sql_any,
    sql_case,
    sql_normalize,
    sql_squash,
    columns_of,
    table,
)
from featureflow.functions import rules, scalar
from featureflow.functions.text import Rule, classify, is_blend, normalize_text, squash
from featureflow.operators import clean
from featureflow.operators.encode import category_codes
from featureflow.operators.profile import group_mean_on_rows, overall_counts_of
from featureflow.plans.prepare import engineer_features, ingest, model_table, preprocess

QUERIES = {}


def query(name: str, sql: str | None):
    def register(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return register


def sql_main(col: str) -> str:
    return sql_case(sql_squash(col), rules.MAIN_TYPE_RULES)


def sql_subtype(col: str) -> str:
    return sql_case(sql_squash(col), rules.SUBTYPE_RULES, sql_main(col))


# Names with the main type and the subtype that they have to get, written down independently of the rules.
LABEL_EXAMPLES = (
    ("Champagne", "sparkling", "sparkling"), ("Prosecco", "sparkling", "sparkling rosé"), ("Rosé", "rosé", "rosé"),
    ("Tokay", "fortified", "fortified"), ("Sherry", "fortified", "fortified"), ("Pinot Noir", "red", "light-bodied red"),
    ("Merlot", "red", "medium-bodied red"), ("Cabernet Sauvignon", "red", "full-bodied red"),
    ("Sauvignon Blanc", "white", "light-bodied white"), ("Riesling", "white", "light-bodied white"),
    ("Chardonnay", "white", "full-bodied white"), ("Unknown Variety", "other", "other"),
)


@query(
    "scl4_scl5_fixed_examples",
    "SELECT p_partkey, main, sub FROM part JOIN (VALUES "
    + ", ".join(f"({k}, '{main}', '{sub}')" for k, (_, main, sub) in enumerate(LABEL_EXAMPLES))
    + f") AS e(k, main, sub) ON p_partkey % {len(LABEL_EXAMPLES)} = k",
)
def _(spark, sf):
    names = spark.createDataFrame([(k, e[0]) for k, e in enumerate(LABEL_EXAMPLES)], "k int, name string")
    parts = table(spark, sf, "part").select("p_partkey", (F.col("p_partkey") % len(LABEL_EXAMPLES)).alias("k"))
    named = parts.join(names, "k")
    return named.select("p_partkey", rules.main_type(F.col("name")).alias("main"), rules.subtype(F.col("name")).alias("sub"))


# Rules made of words that occur in the test texts, so that every branch is taken.
TEXT_RULES = (
    Rule("maritime", ("chou", "eaux")),
    Rule("northern", ("thth", "ering"), also=("nd",)),
    Rule("short", ("ou",)),
    Rule("plain", ("an", "en")),
)
PART_RULES = (
    Rule("hot", ("hot", "red")),
    Rule("cold", ("cold", "blue")),
    Rule("small ring", ("small",), also=("ring",)),
    Rule("round", ("ring", "gear", "bolt")),
    Rule("large", ("large",)),
)


@query(
    "label_counts_by_language",
    f"""WITH t AS (SELECT lang, {sql_normalize('text')} AS v FROM documents),
    c AS (SELECT lang, {sql_case('v', TEXT_RULES)} AS label, {sql_subtype('v')} AS subtype FROM t)
    SELECT lang, label, subtype, count(*) AS n FROM c GROUP BY ALL""",
)
def label_counts_by_language(spark, sf):
    text = normalize_text(F.col("text"))
    docs = columns_of(spark, sf, "documents", "doc_id", "text", "lang", "source").select("lang", text.alias("v"))
    labelled = docs.select(
        "lang", classify(F.col("v"), TEXT_RULES).alias("label"), rules.subtype(F.col("v")).alias("subtype")
    )
    return labelled.groupBy("lang", "label", "subtype").agg(F.count("*").alias("n"))


@query("scl1_normalize_text", f"SELECT doc_id, {sql_normalize('text')} AS normalized FROM documents")
def _(spark, sf):
    return columns_of(spark, sf, "documents", "doc_id", "text", "lang", "source").select("doc_id", normalize_text(F.col("text")).alias("normalized"))


@query(
    "scl1_null_tokens",
    "WITH n AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN NULL ELSE url END AS url FROM pages) "
    f"SELECT page_id, {sql_normalize('url')} AS train, {sql_normalize('url', 'unknown')} AS batch FROM n",
)
def _(spark, sf):
    url = F.when(F.col("page_id") % 3 != 0, F.col("url"))
    return table(spark, sf, "pages").select(
        "page_id",
        normalize_text(url).alias("train"),
        normalize_text(url, "unknown").alias("batch"),
    )


BUCKETS_SQL = (
    "CASE WHEN {0} < 85 THEN 'Low' WHEN {0} < 90 THEN 'Medium' ELSE 'High' END"
)


@query(
    "scl2_bucket_points",
    "SELECT l_orderkey, l_linenumber, l_quantity, "
    + BUCKETS_SQL.format("(CASE WHEN l_quantity = 50 THEN NULL ELSE 60 + l_quantity END)")
    + " AS bucket FROM lineitem",
)
def _(spark, sf):
    points = F.when(F.col("l_quantity") != 50, 60 + F.col("l_quantity"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", scalar.bucket_points(points).alias("bucket")
    )


@query("scl3_is_blend", "SELECT page_id, contains(lower(coalesce(html, 'nan')), 'blend') AS is_blend FROM pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", is_blend(F.col("html")).alias("is_blend"))


@query("scl4_main_type", f"SELECT doc_id, {sql_main('text')} AS main_type FROM documents")
def _(spark, sf):
    return columns_of(spark, sf, "documents", "doc_id", "text", "lang", "source").select("doc_id", rules.main_type(F.col("text")).alias("main_type"))


@query("scl4_main_type_parts", f"SELECT p_partkey, {sql_main('p_name')} AS main_type FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", rules.main_type(F.col("p_name")).alias("main_type"))


@query(
    "scl4_own_rules",
    f"SELECT p_partkey, {sql_case(sql_squash('p_name'), PART_RULES)} AS label FROM part",
)
def _(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", classify(squash(F.col("p_name")), PART_RULES).alias("label")
    )


@query("scl5_subtype", f"SELECT doc_id, {sql_subtype('text')} AS subtype FROM documents")
def _(spark, sf):
    return columns_of(spark, sf, "documents", "doc_id", "text", "lang", "source").select("doc_id", rules.subtype(F.col("text")).alias("subtype"))


@query(
    "scl6_replace_values",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' "
    "ELSE o_orderstatus END AS status FROM orders",
)
def _(spark, sf):
    swapped = scalar.replace_values(F.col("o_orderstatus"), {"F": "finished", "O": "open"})
    return table(spark, sf, "orders").select("o_orderkey", swapped.alias("status"))


@query(
    "scl7_clip",
    "SELECT c_custkey, CASE WHEN b IS NULL THEN NULL ELSE least(greatest(b, 0.0), 100.0) END AS clipped "
    "FROM (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal / 10 - 100 END AS b FROM customer)",
)
def _(spark, sf):
    balance = F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal") / 10 - 100)
    return table(spark, sf, "customer").select("c_custkey", scalar.clip(balance, 0.0, 100.0).alias("clipped"))


@query("scl8_feature_names", "SELECT s_suppkey AS f_1st_key, s_acctbal AS acct_bal____, s_name AS f___name FROM supplier")
def _(spark, sf):
    df = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("1st key"), F.col("s_acctbal").alias("Acct Bal ($)"), F.col("s_name").alias("__name")
    )
    return df.withColumnsRenamed(scalar.feature_names(df.columns))


@query(
    "scl9_feature_types",
    "SELECT o_orderkey AS row_id, o_custkey::integer AS o_custkey, "
    "round(o_totalprice::float::double, 2) AS o_totalprice, CASE WHEN o_totalprice > 100000 THEN 'true' ELSE 'false' END AS big "
    "FROM orders",
)
def _(spark, sf):
    from featureflow.sources.feature_tables import feature_types

    df = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"), "o_custkey", "o_totalprice", (F.col("o_totalprice") > 100000).alias("big")
    )
    typed = feature_types(df)
    return typed.withColumn("o_totalprice", F.round(F.col("o_totalprice").cast("double"), 2))


@query(
    "scl10_flag_to_int",
    "SELECT event_id, (CASE WHEN event_type = 'error' THEN 0 WHEN value > 10 THEN 1 ELSE 0 END)::integer AS flag FROM events",
)
def _(spark, sf):
    flag = F.when(F.col("event_type") != "error", F.col("value") > 10)
    return table(spark, sf, "events").select("event_id", scalar.flag_to_int(flag).alias("flag"))


@query(
    "scl11_category_codes",
    """WITH d AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS code
                 FROM (SELECT DISTINCT source FROM documents))
    SELECT doc_id, source, CASE WHEN source = 'src9' THEN 1000 ELSE code END AS source_codes
    FROM documents JOIN d USING (source)""",
)
def _(spark, sf):
    df = columns_of(spark, sf, "documents", "doc_id", "text", "lang", "source").select("doc_id", "source")
    return category_codes(df, "source", unknown="src9")


def sql_suggestion(col: str, part: str) -> str:
    text = f"lower({col})"
    lines = []
    for hint in rules.SUGGESTION_HINTS:
        found = f"list_filter([{', '.join(quoted(t) for t in hint.terms)}], lambda term: contains({text}, term))[1]"
        reason = f"{quoted(hint.reason + ': ')} || {found}" if hint.name_term else quoted(hint.reason)
        value = {"label": quoted(hint.label), "confidence": f"{hint.confidence}::double", "reason": reason}[part]
        lines.append(f"WHEN {sql_any(text, hint.terms)} THEN {value}")
    default = {"label": "'other'", "confidence": "0.2::double", "reason": "'No identifiable pattern'"}[part]
    missing = {"label": "'other'", "confidence": "0.0::double", "reason": "'Not a string'"}[part]
    return f"CASE WHEN {col} IS NULL THEN {missing} {' '.join(lines)} ELSE {default} END"


@query(
    "scl12_suggest_type",
    "SELECT doc_id, "
    + ", ".join(f"{sql_suggestion('t', p)} AS {p}" for p in ("label", "confidence", "reason"))
    + " FROM (SELECT doc_id, CASE WHEN source = 'src5' THEN NULL ELSE text END AS t FROM documents)",
)
def _(spark, sf):
    text = F.when(F.col("source") != "src5", F.col("text"))
    return (
        columns_of(spark, sf, "documents", "doc_id", "text", "lang", "source")
        .select("doc_id", rules.suggest_type(text).alias("s"))
        .select("doc_id", "s.label", "s.confidence", "s.reason")
    )


@query(
    "scl13_alternative_labelings",
    f"""SELECT doc_id, {sql_case('lower(text)', rules.EXACT_FIRST_RULES)} AS exact_first,
    {sql_case('lower(text)', rules.EXACT_CHECKED_RULES)} AS checked,
    {sql_case(sql_squash('text'), rules.WIDER_SQUASHED_RULES)} AS squashed FROM documents""",
)
def _(spark, sf):
    text = F.col("text")
    return columns_of(spark, sf, "documents", "doc_id", "text", "lang", "source").select(
        "doc_id",
        rules.alternative_type(text, "exact").alias("exact_first"),
        rules.alternative_type(text, "checked").alias("checked"),
        rules.alternative_type(text, "squashed").alias("squashed"),
    )


@query(
    "scl15_term_flags",
    f"SELECT doc_id, {sql_any('lower(text)', rules.WIDER_RED)} AS in_red, "
    f"{sql_any('lower(text)', rules.WIDER_WHITE)} AS in_white FROM documents",
)
def _(spark, sf):
    red, white = rules.term_flags(F.col("text"))
    return columns_of(spark, sf, "documents", "doc_id", "text", "lang", "source").select("doc_id", red.alias("in_red"), white.alias("in_white"))


# A country for each nation key of the test tables, and what its continent has to be.
NATION_COUNTRIES = (
    ("Italy", "Europe"), ("US", "North America"), ("England", "Europe"), ("Chile", "South America"),
    ("South Africa", "Africa"), ("Japan", "Asia"), ("New Zealand", "Oceania"), ("Ivory Coast", "Africa"),
    ("Brunei", "Asia"), ("Kosovo", "Europe"), ("Puerto Rico", "North America"), ("Atlantis", "Other"),
    ("Greenland", "North America"), ("Guinea-Bissau", "Africa"), ("Hong Kong", "Asia"), ("Samoa", "Oceania"),
    ("Georgia", "Asia"), ("Peru", "South America"), ("Czechia", "Europe"), ("Bermuda", "North America"),
    ("Palestine", "Asia"), ("Saint Lucia", "North America"), ("Turkey", "Asia"), ("", "Other"), (None, "Other"),
)


@query(
    "jn2_continent_lookup",
    "SELECT c_custkey, coalesce(continent, 'Other') AS continent FROM customer LEFT JOIN (VALUES "
    + ", ".join(f"({key}, '{continent}')" for key, (_, continent) in enumerate(NATION_COUNTRIES))
    + ") AS d(k, continent) ON c_nationkey = k",
)
def _(spark, sf):
    countries = spark.createDataFrame([(k, c) for k, (c, _) in enumerate(NATION_COUNTRIES)], "k int, country string")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    # The dimension has one row per nation; Spark broadcasts it by itself.
    joined = customers.join(countries, F.col("c_nationkey") == F.col("k"), "left")
    standard = scalar.replace_values(F.col("country"), scalar.COUNTRY_SPELLINGS)
    return joined.select("c_custkey", scalar.continent_of(standard).alias("continent"))


@query(
    "jn3_group_mean_on_rows",
    """WITH l AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE l_suppkey END AS l_suppkey, l_quantity FROM lineitem),
    m AS (SELECT l_suppkey, avg(l_quantity) AS a FROM l WHERE l_suppkey IS NOT NULL GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, a AS supplier_mean FROM l LEFT JOIN m USING (l_suppkey)""",
)
def _(spark, sf):
    supplier = F.when(F.col("l_suppkey") % 10 != 0, F.col("l_suppkey"))
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", supplier.alias("l_suppkey"), "l_quantity")
    return group_mean_on_rows(df, "l_suppkey", "l_quantity", "supplier_mean")


@query(
    "jn4_overall_counts_of_other",
    f"""WITH p AS (SELECT p_name, {sql_main('p_name')} AS label FROM part),
    top AS (SELECT p_name FROM p WHERE label = 'other' GROUP BY 1 ORDER BY count(*) DESC, p_name LIMIT 20)
    SELECT p_name, count(*) AS count FROM p WHERE p_name IN (SELECT p_name FROM top) GROUP BY 1""",
)
def _(spark, sf):
    df = table(spark, sf, "part").select("p_name", rules.main_type(F.col("p_name")).alias("label"))
    return overall_counts_of(df, "p_name", F.col("label") == "other", 20)


PREPROCESS_SQL = """
SELECT row_id, coalesce(country, 'unknown') AS country, points, price, province,
       coalesce(region_1, 'unknown') AS region_1, coalesce(taster_name, 'unknown') AS taster_name,
       {normalized} AS variety, datetime
FROM ({ingested})
"""
PREPROCESS_TRAIN_SQL = PREPROCESS_SQL.format(normalized=sql_normalize("variety"), ingested=INGEST_SQL)
PREPROCESS_BATCH_SQL = PREPROCESS_SQL.format(normalized=sql_normalize("variety", "unknown"), ingested=INGEST_SQL)


@query("preprocess_train", PREPROCESS_TRAIN_SQL)
def _(spark, sf):
    return preprocess(ingest(reviews(spark, sf)))


@query("preprocess_batch", PREPROCESS_BATCH_SQL)
def _(spark, sf):
    return preprocess(ingest(reviews(spark, sf)), "unknown")


ENGINEER_SQL = f"""
SELECT *, {BUCKETS_SQL.format('points')} AS points_category, contains(variety, 'blend') AS is_blend,
       {sql_main('variety')} AS wine_type_main, {sql_subtype('variety')} AS wine_subtype,
       CASE country WHEN 'US' THEN 'United States' WHEN 'England' THEN 'United Kingdom' ELSE country END AS country_standardized,
       CASE WHEN country = 'US' THEN 'North America' WHEN country IN ('England', 'France', 'Germany') THEN 'Europe'
            ELSE 'Other' END AS continent
FROM ({PREPROCESS_TRAIN_SQL})
"""


@query("engineer_features", ENGINEER_SQL)
def _(spark, sf):
    return engineer_features(preprocess(ingest(reviews(spark, sf))))


MODEL_TABLE_SQL = f"""
SELECT row_id, country, points, price, region_1, taster_name, datetime, points_category, wine_subtype
FROM ({ENGINEER_SQL})
"""


@query("model_table", MODEL_TABLE_SQL)
def model_table_query(spark, sf):
    return model_table(engineer_features(preprocess(ingest(reviews(spark, sf)))))


@query(
    "clean_text_columns",
    f"SELECT doc_id, {sql_normalize('text')} AS text, {sql_normalize('source')} AS source FROM documents",
)
def _(spark, sf):
    df = columns_of(spark, sf, "documents", "doc_id", "text", "lang", "source").select("doc_id", "text", "source")
    return clean.normalize_columns(df, ["text", "source", "not_there"])
