"""Model selection, training, scoring and feature selection (iterative, so without reference SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.functions import unwrap_udt

from bindings.common import reviews, sql_hash, sql_hash_number, table
from featureflow.operators import model, select
from featureflow.operators.features import FOLD_SEED, MEAN_FOLDS, ORDER_SEED, fit_features, fit_one_hot
from featureflow.operators.split import split_random, train_test_parts
from featureflow.plans.prepare import engineer_features, ingest, model_table, preprocess
from featureflow.plans.train import select_and_train
from featureflow.session import scratch_path
from featureflow.sources.registry import Registry
from featureflow.sources.tables import Tables

QUERIES = {}

# A handful of shallow trees for the queries about storing, scoring and describing with a model. Those that
# compare, search, choose or select run the operators' own settings and grid.
LIGHT = {"maxIter": 5, "maxDepth": 4}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return register


def line_features(spark, sf):
    """Line items with an order-independent row id; the target is the price."""
    lines = table(spark, sf, "lineitem")
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate").alias("row_id"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_discount").alias("discount"),
            F.col("l_tax").alias("tax"),
            F.col("p_size").alias("size"),
            F.col("l_returnflag").alias("returnflag"),
            F.col("p_brand").alias("brand"),
            F.col("p_type").alias("type"),
        )
    )


def order_features(spark, sf):
    """Orders with their customer: mixed kinds of features, dense row id, the total as target."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return (
        table(spark, sf, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("row_id"),
            (F.col("o_totalprice") / 1000 + F.when(F.col("o_orderstatus") == "F", 300).otherwise(0)).alias("price"),
            F.col("c_acctbal").alias("balance"),
            F.month("o_orderdate").alias("month"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("priority"),
            F.col("c_mktsegment").alias("segment"),
        )
    )


def stored(df):
    """The feature table written once to the shared folder: every later pass reads it from there."""
    spark = df.sparkSession
    return Tables(spark, scratch_path(spark, "features"), {"features": ["features"]}).save("features", df)


def parts_of(df):
    return train_test_parts(stored(df), "row_id")


@query(
    "enc3_native_categories",
    f"""WITH o AS (SELECT o_orderkey AS row_id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status,
    CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE 'c' || o_custkey END AS customer, o_totalprice AS price,
    {sql_hash_number(FOLD_SEED, 'o_orderkey')} % {MEAN_FOLDS} AS fold FROM orders),
    m AS (SELECT avg(price) AS m FROM o),
    s AS (SELECT status, sum(price) AS t, count(*) AS n FROM o GROUP BY 1), sf AS (SELECT status, fold, sum(price) AS t, count(*) AS n FROM o GROUP BY 1, 2),
    c AS (SELECT customer, sum(price) AS t, count(*) AS n FROM o GROUP BY 1), cf AS (SELECT customer, fold, sum(price) AS t, count(*) AS n FROM o GROUP BY 1, 2)
    SELECT row_id, round((s.t - sf.t + m) / (s.n - sf.n + 1), 2) AS status, round((c.t - cf.t + m) / (c.n - cf.n + 1), 2) AS customer,
    round((s.t + m) / (s.n + 1), 2) AS whole_status, round((c.t + m) / (c.n + 1), 2) AS whole_customer
    FROM o, m JOIN s ON o.status IS NOT DISTINCT FROM s.status JOIN sf ON o.status IS NOT DISTINCT FROM sf.status AND o.fold = sf.fold
    JOIN c ON o.customer IS NOT DISTINCT FROM c.customer JOIN cf ON o.customer IS NOT DISTINCT FROM cf.customer AND o.fold = cf.fold""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_totalprice").alias("price"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_custkey") % 10 != 0, F.concat(F.lit("c"), F.col("o_custkey"))).alias("customer"),
    )
    fitted = fit_features(df, "price", [], {"status": "mean", "customer": "mean"})
    own = fitted.encoded(df, out_of_fold=True).select("row_id", *[F.round(f"_{c}", 2).alias(c) for c in ("status", "customer")])
    whole = fitted.encoded(df).select("row_id", *[F.round(f"_{c}", 2).alias(f"whole_{c}") for c in ("status", "customer")])
    return own.join(whole, "row_id")


@query(
    "enc3_ordered_means",
    f"""WITH o AS (SELECT o_orderkey AS row_id, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status,
    CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE 'c' || o_custkey END AS customer, o_totalprice AS price,
    {sql_hash_number(ORDER_SEED, 'o_orderkey')} AS h FROM orders),
    m AS (SELECT *, avg(price) OVER () AS m FROM o)
    SELECT row_id, round((coalesce(sum(price) OVER s, 0) + m) / (count(price) OVER s + 1), 2) AS status,
    round((coalesce(sum(price) OVER c, 0) + m) / (count(price) OVER c + 1), 2) AS customer FROM m
    WINDOW s AS (PARTITION BY status ORDER BY h, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    c AS (PARTITION BY customer ORDER BY h, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_totalprice").alias("price"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_custkey") % 10 != 0, F.concat(F.lit("c"), F.col("o_custkey"))).alias("customer"),
    )
    fitted = fit_features(df, "price", [], {"status": "ordered", "customer": "ordered"})
    return fitted.encoded(df, out_of_fold=True).select("row_id", *[F.round(f"_{c}", 2).alias(c) for c in ("status", "customer")])


@query(
    "enc1_one_hot_any_width",
    """WITH o AS (SELECT o_orderkey AS row_id, CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE 'c' || o_custkey END AS customer FROM orders),
    c AS (SELECT customer, row_number() OVER (ORDER BY customer IS NULL, customer) - 2 AS slot FROM (SELECT DISTINCT customer FROM o))
    SELECT row_id, CASE WHEN slot >= 0 THEN slot END::integer AS slot, (SELECT count(*) - 1 FROM c)::integer AS slots
    FROM o JOIN c ON o.customer IS NOT DISTINCT FROM c.customer""",
)
def _(spark, sf):
    df = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"), F.when(F.col("o_custkey") % 10 != 0, F.concat(F.lit("c"), F.col("o_custkey"))).alias("customer")
    )
    vector = fit_one_hot(df, ["customer"]).transform(df).select("row_id", unwrap_udt("features").alias("v"))
    return vector.select("row_id", F.get("v.indices", F.lit(0)).alias("slot"), F.col("v.size").alias("slots"))


@query("ml1_score_candidates")
def _(spark, sf):
    train, validation = parts_of(order_features(spark, sf))
    candidates = [model.Candidate(name, name, model.BASELINE) for name in ("native", "one_hot")]
    return model.score_candidates(train, validation, "price", candidates)[0]


@query("ml2_grid_search")
def _(spark, sf):
    train, _ = parts_of(order_features(spark, sf))
    return model.grid_search(train, "price", model.Candidate("native", "native", model.BASELINE))[1]


@query("ml3_champion_choice")
def _(spark, sf):
    train, validation = parts_of(order_features(spark, sf))
    fitted = model.Candidate("native", "native", model.BASELINE).fit(train, "price")
    rmse = model.error_metrics(fitted, validation, "price")["rmse"]
    cases = [("none", None), ("worse", {"val_rmse": 10000.0}), ("better", {"val_score": 0.1})]
    rows = [(name, rmse, model.replaces_champion(champion, rmse)) for name, champion in cases]
    return spark.createDataFrame(rows, "champion string, challenger_rmse double, replaced boolean")


@query(
    "ml3_champion_from_runs",
    """WITH r AS (SELECT o_orderpriority AS run_id, stddev_pop(o_totalprice) AS rmse FROM orders GROUP BY 1),
    c AS (SELECT arg_min(run_id, rmse) AS champion, min(rmse) AS rmse FROM r)
    SELECT r.run_id AS challenger, c.champion, r.rmse * 0.99 < c.rmse AS replaced FROM r, c""",
)
def _(spark, sf):
    # One stored run per priority: the model that predicts the mean has the spread as its error.
    spread = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.stddev_pop("o_totalprice").alias("rmse"))
    path = scratch_path(spark, "runs")
    for row in spread.collect():  # one row per priority
        model.log_run(spark, path, row["o_orderpriority"], "mean", {}, {"val_rmse": row["rmse"]})
    champion = model.champion_of(spark.read.parquet(path))
    rows = [
        (r["o_orderpriority"], champion["run_id"], model.replaces_champion(champion, r["rmse"] * 0.99)) for r in spread.collect()
    ]
    return spark.createDataFrame(rows, "challenger string, champion string, replaced boolean")


@query(
    "ml3_registry",
    """WITH r AS (SELECT o_orderpriority AS run_id, stddev_pop(o_totalprice) AS rmse FROM orders GROUP BY 1),
    c AS (SELECT *, min(rmse) OVER (ORDER BY run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best, min(rmse) OVER (ORDER BY run_id) AS now FROM r)
    SELECT c.run_id, best IS NULL OR rmse < best AS replaced, (SELECT r.run_id FROM r WHERE r.rmse = c.now) AS champion,
    count(*) FILTER (best IS NULL OR rmse < best) OVER (ORDER BY run_id) AS version FROM c""",
)
def _(spark, sf):
    # A run per priority, whose model is the mean: its error is the spread. The runs come in by name.
    spread = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.stddev_pop("o_totalprice").alias("rmse"), F.avg("o_totalprice").alias("mean"))
    store, rows = Registry(spark, scratch_path(spark, "registry")), []
    for row in spread.orderBy("o_orderpriority").collect():  # one row per priority
        run_id = row["o_orderpriority"]
        store.add_run(run_id, lambda path, row=row: spread.where(F.col("o_orderpriority") == row["o_orderpriority"]).write.parquet(f"{path}/model"), {"val_rmse": row["rmse"]})
        replaced = store.challenge(run_id)
        now = store.champion()
        rows.append((run_id, replaced, now.run_id, now.version))
    return spark.createDataFrame(rows, "run_id string, replaced boolean, champion string, version long")


@query(
    "ml5_training_flow",
    """SELECT 'GBTRegressionModel' AS regressor, true AS known_columns, true AS better_than_mean, 4::bigint AS settings, 2::bigint AS candidates, true AS replaced,
    (SELECT count(*) - ceil(0.2 * count(*)) FROM orders)::bigint AS n_train""",
)
def _(spark, sf):
    # Candidates, grid, champion, feature selection and final fit in their order, on a grid of four settings.
    train, validation = parts_of(order_features(spark, sf))
    small = {"maxIter": (2, 4), "maxDepth": (2, 3)}
    trained = select_and_train(train, validation, grids={"native": small, "one_hot": small}, settings=LIGHT)
    spread = validation.agg(F.stddev_pop("price")).first()[0]
    counts = trained.selection.grid.count(), trained.selection.scores.count(), train.count()
    known = bool(trained.columns) and set(trained.columns) <= {"balance", "month", "status", "priority", "segment"}
    row = (trained.metrics["regressor"], known, trained.metrics["val_score"] < spread, counts[0], counts[1], trained.selection.replaced, counts[2])
    return spark.createDataFrame([row], "regressor string, known_columns boolean, better_than_mean boolean, settings long, candidates long, replaced boolean, n_train long")


@query("ml4_importance_boosted")
def _(spark, sf):
    return select.importance_table(stored(order_features(spark, sf)), "price", "boosted")


@query("ml4_importance_forest")
def _(spark, sf):
    return select.importance_table(stored(order_features(spark, sf)), "price", "tree_based")


@query("ml4_recursive_elimination")
def _(spark, sf):
    kept = select.select_features(stored(order_features(spark, sf)), "price", "rfe")
    return spark.createDataFrame([(c,) for c in kept], "feature string")


@query("srt4_top_features")
def _(spark, sf):
    return select.top_features(select.importance_table(stored(order_features(spark, sf)), "price", "boosted"), 3)


@query("ml5_train_model")
def _(spark, sf):
    train, validation = parts_of(line_features(spark, sf))
    light = model.Candidate("native", "native", LIGHT)
    _, columns, metrics = model.train_model(train, validation, "price", ["quantity", "size", "brand"], light)
    rows = [(metrics["regressor"], ",".join(columns), metrics["train_score"], metrics["val_score"])]
    return spark.createDataFrame(rows, "regressor string, columns string, train_score double, val_score double")


def scored_orders(spark, sf):
    train, batch = split_random(stored(order_features(spark, sf)))
    fitted = model.Candidate("native", "native", LIGHT).fit(train, "price")
    return model.predict_and_describe(batch, fitted, ["balance", "month", "status", "priority", "segment"])


@query(
    "ml6_scored_batch",
    f"""WITH o AS (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY {sql_hash(200, 'o_orderkey')}, o_orderkey) AS rn FROM orders)
    SELECT o_orderkey AS row_id, o_totalprice / 1000 + CASE WHEN o_orderstatus = 'F' THEN 300 ELSE 0 END AS price, c_acctbal AS balance,
    month(o_orderdate)::integer AS month, o_orderstatus AS status, o_orderpriority AS priority, c_mktsegment AS segment, true AS scored
    FROM o JOIN customer ON o_custkey = c_custkey WHERE rn > round_even(0.8 * n, 0)""",
)
def _(spark, sf):
    # The predictions themselves are no matter of SQL; that every row of the batch has one is.
    scored = scored_orders(spark, sf)[0]
    return scored.withColumn("scored", F.col("y_pred").between(-1e9, 1e9)).drop("y_pred")


@query("ml6_described_batch")
def _(spark, sf):
    return scored_orders(spark, sf)[1]


@query("ml7_permutation_importance")
def _(spark, sf):
    df = stored(order_features(spark, sf))
    fitted = model.Candidate("native", "native", model.BASELINE).fit(df, "price")
    return select.permutation_importance(df, fitted, ["balance", "month", "status", "priority", "segment"], "price")


@query("ml8_run_log")
def _(spark, sf):
    train, validation = parts_of(order_features(spark, sf))
    fitted = model.Candidate("one_hot", "one_hot", model.BASELINE).fit(train, "price")
    path = scratch_path(spark, "runs")
    metrics = model.error_metrics(fitted, validation, "price")
    model.log_run(spark, path, "first", "one_hot", model.BASELINE, {k: metrics[k] for k in ("rmse", "r2")})
    return spark.read.parquet(path)


@query(
    "snk4_saved_model",
    "SELECT (count(*) - round_even(0.8 * count(*), 0))::bigint AS n, 0::bigint AS different FROM orders",
)
def _(spark, sf):
    train, batch = split_random(stored(order_features(spark, sf)))
    fitted = model.Candidate("native", "native", LIGHT).fit(train, "price")
    path = scratch_path(spark, "model")
    model.save_model(fitted, ["balance", "month", "status", "priority", "segment"], path, spark)
    loaded, columns = model.load_model(path, spark)
    both = model.predict(batch, fitted, columns).select("row_id", F.col("y_pred").alias("before")).join(
        model.predict(batch, loaded, columns).select("row_id", "y_pred"), "row_id"
    )
    return both.agg(F.count("*").alias("n"), F.count_if(F.col("before") != F.col("y_pred")).alias("different"))


@query("reviews_to_scores")
def _(spark, sf):
    features = stored(model_table(engineer_features(preprocess(ingest(reviews(spark, sf))))))
    train, batch = split_random(features)
    fitted = model.Candidate("native", "native", LIGHT).fit(train, "price")
    return model.predict(batch, fitted, ["country", "points", "region_1", "taster_name", "points_category", "wine_subtype"])


@query("donor_pairs", "SELECT count(*) AS n, sum(o_orderkey)::bigint AS donors, sum(o_orderkey)::bigint AS receivers FROM orders")
def _(spark, sf):
    df = table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_orderkey").alias("given"))
    pairs = select.with_donors(df, ["given"])
    return pairs.agg(
        F.count("*").alias("n"), F.sum("donor.given").alias("donors"), F.sum("row_id").alias("receivers")
    )
