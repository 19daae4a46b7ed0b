"""Shared inputs and SQL helpers of the queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.functions.text import ASCII_PUNCTUATION, UNICODE_WHITESPACE, Rule


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns_of(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, name).select(*columns)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_any(col: str, terms: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains({col}, {quoted(t)})" for t in terms) + ")"


def sql_case(col: str, rules: Sequence[Rule], default: str = "'other'") -> str:
    lines = []
    for r in rules:
        hit = f"{col} IN ({', '.join(quoted(t) for t in r.terms)})" if r.exact else sql_any(col, r.terms)
        if r.also:
            hit += " AND " + sql_any(col, r.also)
        lines.append(f"WHEN {hit} THEN {quoted(r.label)}")
    return f"CASE {' '.join(lines)} ELSE {default} END"


def sql_squash(col: str) -> str:
    return f"replace(lower({col}), ' ', '')"


def sql_normalize(col: str, null_token: str = "nan") -> str:
    removed = quoted(ASCII_PUNCTUATION + UNICODE_WHITESPACE)
    return f"translate(lower(coalesce({col}, {quoted(null_token)})), {removed}, '')"


def sql_hash(seed: int, key: str) -> str:
    """The order of the keyed hash: first 15 hex digits of md5('seed:key')."""
    return f"substr(md5('{seed}:' || cast({key} AS varchar)), 1, 15)"


def sql_hash_number(seed: int, key: str) -> str:
    """The keyed hash as a number."""
    return f"('0x' || {sql_hash(seed, key)})::bigint"


def sql_uniform(seed: int, key: str, part: int = 0) -> str:
    digits = f"substr(md5('{seed}:' || cast({key} AS varchar)), {1 + 8 * part}, 8)"
    return f"((('0x' || {digits})::bigint + 0.5) / 4294967296.0)"


def sql_normal(seed: int, key: str) -> str:
    return (
        f"(sqrt(-2.0 * ln({sql_uniform(seed, key, 0)})) * cos(2.0 * pi() * {sql_uniform(seed, key, 1)}))"
    )


# A raw review table made of the documents: every column the ingestion step expects, with missing
# countries, tasters and prices and some zero prices.
REVIEWS_SQL = """
SELECT doc_id AS row_id,
       CASE WHEN source = 'src19' THEN NULL
            WHEN lang = 'en' AND source IN ('src0', 'src1', 'src2') THEN 'England'
            WHEN lang = 'en' THEN 'US' WHEN lang = 'fr' THEN 'France'
            WHEN lang = 'de' THEN 'Germany' ELSE 'Atlantis' END AS country,
       text AS description,
       lang AS designation,
       80 + n_chars % 21 AS points,
       CASE WHEN n_chars % 11 = 0 THEN NULL WHEN n_chars % 13 = 0 THEN 0.0
            ELSE CAST(n_chars AS double) / 8 END AS price,
       source AS province,
       CASE WHEN n_chars % 5 = 0 THEN NULL ELSE lang || source END AS region_1,
       lang AS region_2,
       CASE WHEN source = 'src3' THEN NULL ELSE source END AS taster_name,
       source AS taster_twitter_handle,
       lang AS title,
       CASE WHEN source = 'src7' THEN NULL ELSE text END AS variety,
       source AS winery
FROM documents
"""


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = REVIEWS_SQL.replace("FROM documents", "FROM {docs}").replace("0.0", "CAST(0 AS double)")
    return spark.sql(sql, docs=table(spark, sf_dir, "documents"))


# Events with missing values, derived alike on both sides.
GAPPY_EVENTS_SQL = """
SELECT event_id,
       CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE user_id END AS user_id
FROM events
"""


def gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(GAPPY_EVENTS_SQL.replace("FROM events", "FROM {ev}"), ev=table(spark, sf_dir, "events"))


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})
