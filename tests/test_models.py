import itertools
import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from featureflow.functions.keyed import hash_key
from featureflow.operators import features, model, select
from featureflow.operators.profile import regression_metrics
from featureflow.plans.train import score_batch, select_and_train

LIGHT = {"maxIter": 5, "maxDepth": 3}


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(42)
    one, two = np.linspace(0, 10, 100), np.linspace(-5, 5, 100) ** 2
    pdf = pd.DataFrame(
        {
            "row_id": np.arange(100),
            "noise_feature_1": rng.random(100),
            "important_feature_1": one,
            "noise_feature_2": rng.normal(size=100),
            "important_feature_2": two,
            "categorical_feature": rng.choice(["A", "B", "C"], 100),
            "target": 3 * one + 2 * two + rng.normal(0, 0.1, 100),
        }
    )
    return spark.createDataFrame(pdf)


@pytest.mark.parametrize("method", ["boosted", "tree_based", "rfe"])
def test_selection_finds_planted_features(planted, method):
    settings = {"maxDepth": 5, "numTrees": 10} if method == "tree_based" else {"maxIter": 10, "maxDepth": 4}
    kept = select.select_features(planted, "target", method, settings)
    assert {"important_feature_1", "important_feature_2"} == set(kept)


@pytest.fixture(scope="module")
def frames(spark):
    rng = np.random.default_rng(1)

    def make(n, start):
        return spark.createDataFrame(
            pd.DataFrame(
                {
                    "row_id": np.arange(start, start + n),
                    "feat1": rng.random(n),
                    "feat2": rng.choice(list("ABCD"), n),
                    "feat3": rng.choice(["red", "white", "rose"], n),
                    "feat4": rng.choice(["US", "France", "Italy", "Spain", "Chile"], n),
                    "feat5": rng.choice(["dry", "sweet", "medium"], n),
                    "price": rng.random(n) * 100,
                }
            )
        )

    return make(100, 0), make(50, 1000)


GRIDS = {"native": {"maxIter": [3], "maxDepth": [2, 3]}, "one_hot": {"maxIter": [3], "maxDepth": [2, 3]}}


def test_champion_rules(frames):
    train, validation = frames
    old = model.Candidate("native", "native", LIGHT).fit(train, "price")
    won = model.select_model(train, validation, "price", {"val_rmse": 10000}, old, grids=GRIDS)
    assert won.replaced and won.model is not old
    assert won.grid.count() == 2
    kept = model.select_model(train, validation, "price", {"val_score": 0.1}, old, grids=GRIDS)
    assert not kept.replaced and kept.model is old
    assert model.replaces_champion(None, 5.0) and not model.replaces_champion({"val_rmse": 5.0}, 5.0)


def test_stages_equal_separate_fits(frames):
    """The grid's errors are those of one fit per setting and fold."""
    train, _ = frames
    grid = {"maxIter": (2, 3, 6), "stepSize": (0.3,), "maxDepth": (2, 3)}
    candidate = model.Candidate("native", "native", {})
    _, table = model.grid_search(train, "price", candidate, grid)
    got = {r["settings"]: r["mse"] for r in table.collect()}
    folded = model.contiguous_folds(train, "row_id")
    folds = [model._prepared_fold(folded, k, "price", candidate, "row_id") for k in (0, 1)]
    for rounds, depth in itertools.product((2, 3, 6), (2, 3)):
        setting = {"maxIter": rounds, "stepSize": 0.3, "maxDepth": depth}
        errors = [
            regression_metrics(model.boosted_trees("price", **setting).fit(prepared).transform(judged), "price", "y_pred").first()["mse"]
            for prepared, judged in folds
        ]
        assert got[json.dumps(setting, sort_keys=True)] == pytest.approx(sum(errors) / 2, rel=1e-9)


def test_refused_settings_cannot_win(frames):
    train, _ = frames
    fitted, table = model.grid_search(train, "price", model.Candidate("native", "native", {"maxIter": 2}), {"maxDepth": (-1, 2)})
    assert [(r["settings"], r["mse"] is None) for r in table.collect()] == [('{"maxDepth": -1}', True), ('{"maxDepth": 2}', False)]
    assert fitted.learner.getMaxDepth() == 2
    fitted, table = model.grid_search(train, "price", model.Candidate("native", "native", {"maxIter": 2}), {"maxDepth": (-1,)})
    assert table.where("mse IS NULL").count() == 1 and fitted.learner.getMaxIter() == 2
    with pytest.raises(Exception, match="nowhere"):
        model.grid_search(train.drop("feat1").withColumn("feat1", F.expr("raise_error('nowhere')").cast("double")), "price", model.Candidate("native", "native", {"maxIter": 2}), {"maxDepth": (2,)})


def test_failing_candidate_loses(frames):
    train, validation = frames
    broken = model.Candidate("broken", "native", {"maxDepth": -1})
    scores, _ = model.score_candidates(train, validation, "price", [broken, model.Candidate("native", "native", LIGHT)])
    by_name = {r["model"]: r["score"] for r in scores.collect()}
    assert by_name["broken"] == -math.inf and by_name["native"] > -math.inf


def test_whole_training_flow(frames):
    train, validation = frames
    trained = select_and_train(train, validation, grids=GRIDS, settings=LIGHT)
    assert trained.metrics["regressor"] == "GBTRegressionModel"
    assert set(trained.columns) <= {"feat1", "feat2", "feat3", "feat4", "feat5"}
    scored, described = score_batch(validation, trained)
    assert scored.count() == 50 and scored.columns == [*validation.columns, "y_pred"]
    assert [r["summary"] for r in described.collect()] == ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]


def test_unseen_categories_score(spark, frames):
    train, _ = frames
    fitted = model.Candidate("one_hot", "one_hot", LIGHT).fit(train, "price")
    new = spark.createDataFrame([(1, 0.5, "Z", "red", "Peru", "dry")], "row_id long, feat1 double, feat2 string, feat3 string, feat4 string, feat5 string")
    assert model.predict(new, fitted, ["feat1", "feat2"]).count() == 1
    with pytest.raises(KeyError):
        model.predict(new, fitted, ["missing"])


def test_many_categories_become_target_means(spark):
    rows = [(i, f"c{i % 200}", float(i % 200)) for i in range(2000)]
    df = spark.createDataFrame(rows, "row_id long, region string, price double")
    fitted = model.Candidate("native", "native", {"maxIter": 10, "maxDepth": 5}).fit(df, "price")
    assert model.error_metrics(fitted, df, "price")["r2"] > 0.9


def test_permutation_importance(planted):
    fitted = model.Candidate("native", "native", {"maxIter": 10, "maxDepth": 4}).fit(planted, "target")
    columns = ["noise_feature_1", "important_feature_1", "noise_feature_2", "important_feature_2", "categorical_feature"]
    rows = select.permutation_importance(planted, fitted, columns, "target").collect()
    assert {r["feature"] for r in rows[:2]} == {"important_feature_1", "important_feature_2"}


def test_donors_are_a_permutation(spark):
    df = spark.range(1000).selectExpr("id * 7 AS row_id", "id * 7 AS v")
    rows = select.with_donors(df, ["v"]).selectExpr("row_id", "donor.v AS given").collect()
    assert sorted(r["given"] for r in rows) == sorted(r["row_id"] for r in rows)
    assert sum(r["given"] == r["row_id"] for r in rows) < 20


def test_means_of_training_rows_leave_out_their_fold(spark):
    """A target of pure noise: settings judged in folds look no better than the target's spread."""
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"row_id": np.arange(1500), "who": [f"c{i}" for i in rng.integers(0, 800, 1500)], "price": rng.normal(size=1500)})
    df = spark.createDataFrame(pdf)
    _, grid = model.grid_search(df, "price", model.Candidate("native", "native", {"maxIter": 5}), {"maxDepth": [3]})
    assert grid.first()["mse"] > 0.95 * pdf["price"].var()


def test_ordered_means_of_a_hot_category(spark):
    """A category with a third of all rows is spread over ranges, and every row sees the rows before it alone."""
    rng = np.random.default_rng(9)
    kinds = [None if k == 1 else f"k{k}" for k in np.where(rng.random(3000) < 0.4, 0, rng.integers(1, 60, 3000))]
    rows = [(i, k, None if i % 50 == 0 else float(v)) for i, (k, v) in enumerate(zip(kinds, rng.integers(0, 100, 3000)))]
    df = spark.createDataFrame(rows, "row_id long, kind string, price double")
    made = features.ordered_means(df, "price", ["kind"], 50.0)
    assert made.columns == [*df.columns, "_kind"]
    got = {r["row_id"]: r["_kind"] for r in made.collect()}
    order = {r["row_id"]: r["h"] for r in df.select("row_id", hash_key(features.ORDER_SEED, F.col("row_id")).alias("h")).collect()}
    sums = {}
    for i, k, v in sorted(rows, key=lambda r: (order[r[0]], r[0])):
        n, total = sums.get(k, (0, 0.0))
        assert got[i] == pytest.approx((total + 50) / (n + 1))
        sums[k] = (n + (v is not None), total + (v or 0))
    windows = [line for line in made._jdf.queryExecution().executedPlan().toString().splitlines() if "Window [" in line]
    assert windows and all("_range" in line for line in windows)
    assert features.ordered_means(df.limit(0), "price", ["kind"], 50.0).count() == 0


def test_one_hot_of_many_categories_with_null(spark):
    rows = [(i, f"c{i:05d}" if i else None) for i in range(2500)]
    df = spark.createDataFrame(rows, "row_id long, region string")
    vectors = features.fit_one_hot(df, ["region"]).transform(df).collect()
    hot = {r["row_id"]: r["features"].indices.tolist() for r in vectors}
    assert all(r["features"].size == 2499 for r in vectors)
    assert hot == {0: [2498], 1: [], **{i: [i - 2] for i in range(2, 2500)}}


def test_missing_numbers_and_saved_model(spark, tmp_path):
    rows = [(i, None if i % 5 == 0 else float(i % 7), None if i % 3 == 0 else "ab"[i % 2], float(i % 7)) for i in range(300)]
    rows.append((300, float("nan"), "a", 1.0))
    df = spark.createDataFrame(rows, "row_id long, size double, kind string, price double")
    for encoding in ("native", "one_hot"):
        fitted = model.Candidate(encoding, encoding, LIGHT).fit(df, "price")
        before = fitted.transform(df).select("row_id", "y_pred").collect()
        model.save_model(fitted, ["size", "kind"], f"{tmp_path}/{encoding}", spark)
        loaded, columns = model.load_model(f"{tmp_path}/{encoding}", spark)
        assert columns == ["size", "kind"]
        assert sorted(loaded.transform(df).select("row_id", "y_pred").collect()) == sorted(before)


def test_champion_is_read_from_the_runs(spark, tmp_path):
    path = f"{tmp_path}/runs"
    model.log_run(spark, path, "b", "native", {}, {"val_rmse": 3.0})
    model.log_run(spark, path, "a", "one_hot", {"maxIter": 5}, {"val_rmse": 2.0, "r2": 0.5})
    runs = spark.read.parquet(path)
    assert model.champion_of(runs) == {"run_id": "a", "model": "one_hot", "val_rmse": 2.0}
    assert model.champion_of(runs.limit(0)) == {}
