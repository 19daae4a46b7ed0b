"""Quality suites, their reports, synthetic drift and drift detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.common import GAPPY_EVENTS_SQL, REVIEWS_SQL, gappy_events, reviews, sql_hash, sql_normal, table
from bindings.cleaning import INGEST_SQL
from featureflow.operators import drift, quality
from featureflow.operators.clean import null_count_table
from featureflow.plans.monitor import drift_report, drifted_sample
from featureflow.plans.prepare import ingest
from featureflow.session import scratch_path

QUERIES = {}


def query(name: str, sql: str | None):
    def register(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return register


ORDER_CHECKS = [
    quality.column_count(6),
    quality.column_type("o_orderkey", "int64"),
    quality.column_type("o_totalprice", "object"),
    quality.value_range("o_totalprice", 0, 400000),
    quality.value_range("o_custkey", 0, strict_min=True),
    quality.not_null("o_orderstatus"),
    quality.no_duplicates(),
]


def order_results(spark, sf):
    return quality.run_suite(table(spark, sf, "orders"), ORDER_CHECKS)


ORDER_RESULTS_SQL = """
WITH m AS (SELECT count(*) AS n, count(*) FILTER (o_totalprice < 0 OR o_totalprice > 400000) AS high,
  count(*) FILTER (o_custkey <= 0) AS low, count(*) - count(o_orderstatus) AS gaps,
  (SELECT count(*) FROM (SELECT DISTINCT * FROM orders)) AS uniq FROM orders)
SELECT * FROM (
SELECT true AS success, 'expect_table_column_count_to_equal' AS kind, NULL AS "column", NULL::double AS low, NULL::double AS high,
  NULL::bigint AS elements, NULL::bigint AS unexpected, NULL::double AS pct, '6' AS observed, 'Number of features in dataset' AS description FROM m
UNION ALL SELECT true, 'expect_column_values_to_be_of_type', 'o_orderkey', NULL, NULL, NULL, NULL, NULL, 'bigint', 'Data type check (o_orderkey)' FROM m
UNION ALL SELECT false, 'expect_column_values_to_be_of_type', 'o_totalprice', NULL, NULL, NULL, NULL, NULL, 'double', 'Data type check (o_totalprice)' FROM m
UNION ALL SELECT high = 0, 'expect_column_values_to_be_between', 'o_totalprice', 0, 400000, n, high, round(high / n * 100, 6), NULL, 'Value range check (o_totalprice) [0 to 400000]' FROM m
UNION ALL SELECT low = 0, 'expect_column_values_to_be_between', 'o_custkey', 0, NULL, n, low, round(low / n * 100, 6), NULL, 'Value range check (o_custkey) [0 to any]' FROM m
UNION ALL SELECT gaps = 0, 'expect_column_values_to_not_be_null', 'o_orderstatus', NULL, NULL, n, gaps, round(gaps / n * 100, 6), NULL, 'expect_column_values_to_not_be_null (o_orderstatus)' FROM m
UNION ALL SELECT uniq = n, 'expect_table_row_count_to_equal_other_table', NULL, NULL, NULL, NULL, NULL, NULL, n::varchar, 'No duplicate records check' FROM m)
"""


def flat(results):
    return results.select(
        F.col("Success").alias("success"),
        F.col("Expectation Type").alias("kind"),
        F.col("Column").alias("column"),
        F.col("Min Value").alias("low"),
        F.col("Max Value").alias("high"),
        F.col("Element Count").alias("elements"),
        F.col("Unexpected Count").alias("unexpected"),
        F.round("Unexpected Percent", 6).alias("pct"),
        F.col("Observed Value").alias("observed"),
        F.col("Test Description").alias("description"),
    )


@query("dq5_run_suite", ORDER_RESULTS_SQL)
def _(spark, sf):
    return flat(order_results(spark, sf))


def one_check(name: str, df_name: str, check, sql: str):
    @query(name, sql)
    def _(spark, sf):
        return flat(quality.run_suite(table(spark, sf, df_name), [check])).select("success", "description")


one_check(
    "dq1_column_count",
    "part",
    quality.column_count(8),
    "SELECT count(*) = 8 AS success, 'Number of features in dataset' AS description FROM (DESCRIBE part)",
)
one_check(
    "dq3_column_type",
    "part",
    quality.column_type("p_retailprice", "float64"),
    "SELECT bool_and(column_type = 'DOUBLE') AS success, 'Data type check (p_retailprice)' AS description "
    "FROM (DESCRIBE part) WHERE column_name = 'p_retailprice'",
)


@query(
    "dq2_value_range",
    f"""SELECT count(*) FILTER (value < 1 OR value > 20) = 0 AS success, count(*) AS elements,
    count(*) FILTER (value < 1 OR value > 20) AS unexpected,
    round(count(*) FILTER (value < 1 OR value > 20) / count(value) * 100, 6) AS pct FROM ({GAPPY_EVENTS_SQL})""",
)
def _(spark, sf):
    results = quality.run_suite(gappy_events(spark, sf), [quality.value_range("value", 1, 20)])
    return flat(results).select("success", "elements", "unexpected", "pct")


@query(
    "dq4_duplicates",
    """SELECT count(*) AS n_rows, (SELECT count(*) FROM (SELECT DISTINCT lang, text, n_chars FROM documents)) AS n_distinct FROM documents""",
)
def _(spark, sf):
    return quality.distinct_row_table(table(spark, sf, "documents"), ["lang", "text", "n_chars"])


@query(
    "dq6_review_suite",
    f"""WITH i AS ({INGEST_SQL}), m AS (SELECT count(*) FILTER (points < 0 OR points > 100) AS pts, count(*) FILTER (price <= 0) AS prc,
      count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT country, points, price, province, region_1, taster_name, variety, datetime FROM i)) AS d FROM i)
    SELECT unnest([true, true, true, true, true, true, true, pts = 0, prc = 0, n = d]) AS success,
    unnest(['Number of features in dataset', 'Data type check (points)', 'Data type check (price)', 'Data type check (country)',
      'Data type check (province)', 'Data type check (region_1)', 'Data type check (variety)', 'Value range check (points) [0 to 100]',
      'Value range check (price) [0 to any]', 'No duplicate records check']) AS description FROM m""",
)
def _(spark, sf):
    ingested = ingest(reviews(spark, sf))
    checked = quality.assert_gates(ingested).drop("row_id")
    return flat(quality.run_suite(checked, quality.review_suite())).select("success", "description")


@query(
    "dq6_checked_write",
    f"""WITH i AS ({INGEST_SQL}), m AS (SELECT count(*) FILTER (points < 0 OR points > 100) AS pts, count(*) FILTER (price <= 0) AS prc,
      count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT country, points, price, province, region_1, taster_name, variety, datetime FROM i)) AS d FROM i)
    SELECT unnest([true, true, true, true, true, true, true, pts = 0, prc = 0, n = d]) AS success,
    unnest(['Number of features in dataset', 'Data type check (points)', 'Data type check (price)', 'Data type check (country)',
      'Data type check (province)', 'Data type check (region_1)', 'Data type check (variety)', 'Value range check (points) [0 to 100]',
      'Value range check (price) [0 to any]', 'No duplicate records check']) AS description FROM m""",
)
def _(spark, sf):
    _, results = quality.write_checked(ingest(reviews(spark, sf)), scratch_path(spark, "ingested"), quality.review_suite())
    return flat(results).select("success", "description")


@query(
    "dq5_stored_suite",
    f"""WITH i AS ({INGEST_SQL}), m AS (SELECT count(*) FILTER (points < 0 OR points > 100) AS pts, count(*) FILTER (price <= 0) AS prc,
      count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT country, points, price, province, region_1, taster_name, variety, datetime FROM i)) AS d FROM i)
    SELECT unnest([true, true, true, true, true, true, true, pts = 0, prc = 0, n = d]) AS success,
    unnest(['Number of features in dataset', 'Data type check (points)', 'Data type check (price)', 'Data type check (country)',
      'Data type check (province)', 'Data type check (region_1)', 'Data type check (variety)', 'Value range check (points) [0 to 100]',
      'Value range check (price) [0 to any]', 'No duplicate records check']) AS description FROM m""",
)
def _(spark, sf):
    path = scratch_path(spark, "suite")
    quality.save_suite(quality.review_suite(), path, spark)
    return flat(quality.run_suite(ingest(reviews(spark, sf)).drop("row_id"), quality.load_suite(path, spark))).select("success", "description")


@query(
    "dq7_feature_group_checks",
    """SELECT true AS success, * FROM (VALUES ('points'), ('country'), ('province'), ('region_1'), ('taster_name'), ('variety'), ('price')) t("column")
    WHERE (SELECT count(*) FROM documents) > 0""",
)
def _(spark, sf):
    from featureflow.sources.feature_tables import group_checks

    return flat(group_checks(ingest(reviews(spark, sf)), "price")).select("success", "column")


@query(
    "dq8_not_null_checks",
    " UNION ALL ".join(
        f"SELECT count(*) = count({c}) AS success, '{c}' AS \"column\", count(*) - count({c}) AS unexpected FROM ({GAPPY_EVENTS_SQL})"
        for c in ("event_id", "event_type", "user_id", "value")
    ),
)
def _(spark, sf):
    df = gappy_events(spark, sf)
    return flat(quality.run_suite(df, quality.split_suite(df))).select("success", "column", "unexpected")


@query(
    "dq9_required_columns",
    "SELECT count(*) AS n FROM orders",
)
def _(spark, sf):
    return quality.require_any_column(table(spark, sf, "orders")).agg(F.count("*").alias("n"))


@query(
    "dq10_success_rates",
    f"SELECT description AS \"Test Description\", avg(success::int) AS success_rate FROM ({ORDER_RESULTS_SQL}) GROUP BY 1",
)
def _(spark, sf):
    return quality.success_rates(order_results(spark, sf))


@query("dq10_pass_fail_counts", f"SELECT success AS \"Success\", count(*) AS count FROM ({ORDER_RESULTS_SQL}) GROUP BY 1")
def _(spark, sf):
    return quality.pass_fail_counts(order_results(spark, sf))


@query(
    "agg16_suite_summary",
    f"""SELECT count(*) FILTER (success) AS passed, count(*) FILTER (NOT success) AS failed,
    round(count(*) FILTER (success) / count(*) * 100, 6) AS success_pct FROM ({ORDER_RESULTS_SQL})""",
)
def _(spark, sf):
    return quality.suite_summary(order_results(spark, sf)).withColumn("success_pct", F.round("success_pct", 6))


@query(
    "dq10_checks_by_column",
    f"""SELECT "column", max(success::int) FILTER (description LIKE 'Data type check%')::double AS typed,
    max(success::int) FILTER (description LIKE 'Value range check%')::double AS ranged
    FROM ({ORDER_RESULTS_SQL}) WHERE "column" IS NOT NULL GROUP BY 1""",
)
def _(spark, sf):
    matrix = quality.checks_by_column(order_results(spark, sf))
    rest = [c for c in matrix.columns if c != "Column"]

    def best(prefix):
        return F.greatest(*[F.col(f"`{c}`") for c in rest if c.startswith(prefix)])

    return matrix.select(
        F.col("Column").alias("column"), best("Data type").alias("typed"), best("Value range").alias("ranged")
    )


@query(
    "scl14_add_descriptions",
    f"SELECT kind, \"column\", description FROM ({ORDER_RESULTS_SQL})",
)
def _(spark, sf):
    bare = order_results(spark, sf).drop("Test Description")
    return flat(quality.add_descriptions(bare)).select("kind", "column", "description")


@query(
    "set1_appended_results",
    f"SELECT success, description FROM ({ORDER_RESULTS_SQL}) UNION ALL "
    "SELECT (SELECT count(*) FROM (DESCRIBE part)) = 6, 'Number of features in dataset'",
)
def _(spark, sf):
    more = quality.run_suite(table(spark, sf, "part"), [quality.column_count(6)])
    return flat(order_results(spark, sf).unionByName(more)).select("success", "description")


SHIFTED = f"least(greatest(l + -10.0 + 3.0 * {sql_normal(7, 'k')}, 0.0), 100.0)"


@query(
    "syn1_shift_points",
    f"""SELECT o_orderkey, CASE WHEN l IS NULL THEN NULL ELSE round({SHIFTED}, 6) END AS points
    FROM (SELECT o_orderkey, o_orderkey AS k, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey % 101 END AS l FROM orders)""",
)
def _(spark, sf):
    points = F.when(F.col("o_orderkey") % 50 != 0, F.col("o_custkey") % 101)
    df = table(spark, sf, "orders").select("o_orderkey", points.alias("points"))
    drifted = drift.shift_points(df, row_id="o_orderkey")
    return drifted.withColumn("points", F.round("points", 6))


@query(
    "syn2_drifted_sample",
    f"""SELECT event_id, round(least(greatest(value + -10.0 + 3.0 * {sql_normal(42, 'event_id')}, 0.0), 100.0), 6) AS value
    FROM (SELECT event_id, value, row_number() OVER (ORDER BY {sql_hash(42, 'event_id')}, event_id) AS rn FROM events) WHERE rn <= 4000""",
)
def _(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value")
    sample = drifted_sample(df, "value", 4000, row_id="event_id")
    return sample.withColumn("value", F.round("value", 6))


@query(
    "agg14_drift_effect",
    """SELECT 'before' AS stage, round(avg(o_custkey), 6) AS mean, round(stddev_samp(o_custkey), 6) AS std FROM orders
    UNION ALL SELECT 'after', round(avg(least(o_custkey, 100)), 6), round(stddev_samp(least(o_custkey, 100)), 6) FROM orders""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey")
    after = df.withColumn("o_custkey", F.least("o_custkey", F.lit(100)))
    effect = drift.drift_effect(df, after, "o_custkey")
    return effect.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


# Monitored columns: a discrete number, a continuous number, and a category.
DRIFT_REFERENCE_SQL = """SELECT o_orderkey AS record_id, month(o_orderdate)::double AS points, o_totalprice AS price, o_orderstatus AS status FROM orders"""
DRIFT_ANALYSIS_SQL = """SELECT o_orderkey AS record_id, month(o_orderdate) + CASE WHEN o_custkey % 4 = 0 THEN 1 ELSE 0 END::double AS points,
CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice * 1.25 - 5000 END AS price,
CASE WHEN o_custkey % 5 = 0 THEN 'N' ELSE o_orderstatus END AS status FROM orders"""


def drift_sql(reference: str, analysis: str, discrete: list[str], continuous: list[str], text: list[str], chunk: int) -> str:
    """Brute force: both statistics straight from their definitions, with histogram bins by Doane's rule."""
    numeric = discrete + continuous

    def long(period: str) -> str:
        return " UNION ALL ".join(
            [
                f"SELECT '{period}' AS period, '{c}' AS feature, (rn - 1) // {chunk} AS chunk, {c}::double AS v, "
                f"{c}::double::varchar AS s FROM {period} WHERE {c} IS NOT NULL"
                for c in numeric
            ]
            + [
                f"SELECT '{period}', '{c}', (rn - 1) // {chunk}, NULL, {c} FROM {period} WHERE {c} IS NOT NULL"
                for c in text
            ]
        )

    cont = ", ".join(f"'{c}'" for c in continuous)
    return f"""
WITH reference AS (SELECT *, row_number() OVER (ORDER BY record_id) AS rn FROM ({reference})),
analysis AS (SELECT *, row_number() OVER (ORDER BY record_id) AS rn FROM ({analysis})),
longs AS ({long('reference')} UNION ALL {long('analysis')}),
sizes AS (SELECT period, feature, chunk, count(*)::double AS total FROM longs GROUP BY 1, 2, 3),
nref AS (SELECT feature, count(*)::double AS n FROM longs WHERE period = 'reference' GROUP BY 1),
-- distribution functions at every value
vals AS (SELECT feature, v, count(*) FILTER (period = 'reference') AS c FROM longs WHERE v IS NOT NULL GROUP BY 1, 2),
refc AS (SELECT feature, v, (sum(c) OVER w - c) / n AS before, sum(c) OVER w / n AS at FROM vals JOIN nref USING (feature)
         WINDOW w AS (PARTITION BY feature ORDER BY v)),
own AS (SELECT period, feature, chunk, v, count(*) AS c FROM longs WHERE v IS NOT NULL GROUP BY 1, 2, 3, 4),
ownc AS (SELECT period, feature, chunk, v, (sum(c) OVER w - c) / total AS before, sum(c) OVER w / total AS at FROM own JOIN sizes USING (period, feature, chunk)
         WINDOW w AS (PARTITION BY period, feature, chunk ORDER BY v)),
ks AS (SELECT o.period, o.feature, o.chunk, max(greatest(abs(o.before - r.before), abs(o.at - r.at))) AS ks
       FROM ownc o JOIN refc r ON o.feature = r.feature AND o.v = r.v GROUP BY 1, 2, 3),
lim AS (SELECT feature, avg(ks) - 3 * stddev_pop(ks) AS lo, avg(ks) + 3 * stddev_pop(ks) AS hi FROM ks WHERE period = 'reference' GROUP BY 1),
-- histogram bins
mom AS (SELECT feature, count(*)::double AS n, min(v) AS lo, max(v) AS hi, avg(v) AS mu, stddev_pop(v) AS sd FROM longs
        WHERE period = 'reference' AND feature IN ({cont}) GROUP BY 1),
skw AS (SELECT feature, any_value(n) AS n, any_value(lo) AS lo, any_value(hi) AS hi, avg(power((v - mu) / sd, 3)) AS g
        FROM longs JOIN mom USING (feature) WHERE period = 'reference' GROUP BY 1),
doane AS (SELECT feature, lo, hi, ceil((hi - lo) / ((hi - lo) / (1 + log2(n) + log2(1 + abs(g) / sqrt(6.0 * (n - 2) / ((n + 1) * (n + 3))))))) AS bins FROM skw),
binned AS (SELECT l.period, l.feature, l.chunk, CASE WHEN d.feature IS NULL THEN l.s WHEN l.v < d.lo OR l.v > d.hi THEN 'outside'
           ELSE least(floor((l.v - d.lo) / (d.hi - d.lo) * d.bins), d.bins - 1)::varchar END AS bin FROM longs l LEFT JOIN doane d USING (feature)),
p AS (SELECT feature, bin, count(*) / any_value(n) AS p FROM binned JOIN nref USING (feature) WHERE period = 'reference' GROUP BY 1, 2),
q AS (SELECT period, feature, chunk, CASE WHEN p.bin IS NULL THEN 'new' ELSE binned.bin END AS bin, count(*) / any_value(total) AS q
      FROM binned JOIN sizes USING (period, feature, chunk) LEFT JOIN p USING (feature, bin) GROUP BY 1, 2, 3, 4),
grid AS (SELECT s.period, s.feature, s.chunk, b.bin, coalesce(p.p, 0) AS p, coalesce(q.q, 0) AS q
         FROM sizes s JOIN (SELECT feature, bin FROM p UNION ALL SELECT feature, 'new' FROM nref) b USING (feature)
         LEFT JOIN p ON p.feature = s.feature AND p.bin = b.bin
         LEFT JOIN q ON q.period = s.period AND q.feature = s.feature AND q.chunk = s.chunk AND q.bin = b.bin),
js AS (SELECT period, feature, chunk, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
        + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS js FROM grid GROUP BY 1, 2, 3),
pos AS (SELECT 'reference' AS period, (rn - 1) // {chunk} AS chunk, min(rn - 1) AS start, max(rn - 1) AS "end", count(*) AS n_rows FROM reference GROUP BY 2
        UNION ALL SELECT 'analysis', (rn - 1) // {chunk}, min(rn - 1) + (SELECT max(record_id) + 1 FROM reference),
        max(rn - 1) + (SELECT max(record_id) + 1 FROM reference), count(*) FROM analysis GROUP BY 2)
SELECT js.period, js.feature, js.chunk, start, "end", n_rows, round(ks, 6) AS ks,
       round(CASE WHEN lo > 0 THEN lo END, 6) AS ks_lower, round(hi, 6) AS ks_upper,
       CASE WHEN ks IS NOT NULL THEN ks > hi OR (lo > 0 AND ks < lo) END AS ks_alert, round(js, 6) AS js, 0.1::double AS js_upper, js > 0.1 AS js_alert
FROM js LEFT JOIN ks USING (period, feature, chunk) LEFT JOIN lim USING (feature) JOIN pos USING (period, chunk)
"""


def rounded_report(report):
    return report.withColumns({c: F.round(c, 6) for c in ("ks", "ks_lower", "ks_upper", "js")})


def drift_inputs(spark, sf):
    orders = table(spark, sf, "orders")
    month = F.month("o_orderdate").cast("double")
    reference = orders.select(
        F.col("o_orderkey").alias("record_id"),
        month.alias("points"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("status"),
    )
    analysis = orders.select(
        F.col("o_orderkey").alias("record_id"),
        (month + F.when(F.col("o_custkey") % 4 == 0, 1.0).otherwise(0.0)).alias("points"),
        F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice") * 1.25 - 5000).alias("price"),
        F.when(F.col("o_custkey") % 5 == 0, "N").otherwise(F.col("o_orderstatus")).alias("status"),
    )
    return reference, analysis


@query("dr1_univariate_drift", drift_sql(DRIFT_REFERENCE_SQL, DRIFT_ANALYSIS_SQL, ["points"], ["price"], ["status"], 100))
def dr1_univariate_drift(spark, sf):
    reference, analysis = drift_inputs(spark, sf)
    return rounded_report(drift.detect_univariate_drift(reference, analysis, ["points", "price", "status"], 100))


@query("dr1_large_chunks", drift_sql(DRIFT_REFERENCE_SQL, DRIFT_ANALYSIS_SQL, ["points"], ["price"], ["status"], 4000))
def _(spark, sf):
    reference, analysis = drift_inputs(spark, sf)
    return rounded_report(drift.detect_univariate_drift(reference, analysis, ["points", "price", "status"], 4000))


@query(
    "dr2_stored_reference",
    f"SELECT * FROM ({drift_sql(DRIFT_REFERENCE_SQL, DRIFT_ANALYSIS_SQL, ['points'], ['price'], ['status'], 100)}) WHERE period = 'analysis'",
)
def _(spark, sf):
    # The batch meets the profile alone; the reference is read once, to make it.
    reference, analysis = drift_inputs(spark, sf)
    path = scratch_path(spark, "reference-profile")
    drift.profile_reference(reference, ["points", "price", "status"], 100).save(path)
    return rounded_report(drift.compare_batch(drift.ReferenceProfile.load(path, spark), analysis))


@query(
    "dr1_drift_report",
    drift_sql(
        "SELECT event_id AS record_id, value AS points FROM events",
        f"""SELECT event_id AS record_id, least(greatest(value + -10.0 + 3.0 * {sql_normal(42, 'event_id')}, 0.0), 100.0) AS points
        FROM (SELECT event_id, value, row_number() OVER (ORDER BY {sql_hash(42, 'event_id')}, event_id) AS rn FROM events) WHERE rn <= 3000""",
        [],
        ["points"],
        [],
        100,
    ),
)
def _(spark, sf):
    raw = table(spark, sf, "events").select(F.col("event_id").alias("row_id"), F.col("value").alias("points"))
    return rounded_report(drift_report(raw, n=3000))


@query(
    "dq_raw_review_nulls",
    f"SELECT count(*) - count(country) AS country, count(*) - count(price) AS price, count(*) - count(variety) AS variety FROM ({REVIEWS_SQL})",
)
def _(spark, sf):
    return null_count_table(reviews(spark, sf), ["country", "price", "variety"])
