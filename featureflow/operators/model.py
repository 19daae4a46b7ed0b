"""Candidate regressors, grid search, champion choice, final training and batch scoring."""

from __future__ import annotations

import itertools
import json
import logging
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from multiprocessing.pool import ThreadPool

from pyspark import SparkContext
from pyspark.errors import IllegalArgumentException
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.operators.boosting import BoostedTrees, stages
from featureflow.operators.features import Features, fit_features
from featureflow.operators.profile import describe, regression_metrics
from featureflow.operators.split import contiguous_folds
from featureflow.schemas import numeric_columns, string_columns
from featureflow.session import shared_folder

log = logging.getLogger(__name__)

#: Bins that the trees cut a number into.
MAX_BINS = 64
NOT_FEATURES = ("row_id", "datetime")
#: Rows of a partition of a fold; small folds are one partition each, as several fits run at a time.
FOLD_ROWS = 50_000

# Settings of a model trained without a champion to copy, and the search grids.
BASELINE = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 6, "seed": 42}
GRIDS = {
    "native": {"maxIter": (100, 200, 300), "stepSize": (0.01, 0.05, 0.1), "maxDepth": (6, 8, 10)},
    "one_hot": {
        "maxIter": (100, 200, 300),
        "stepSize": (0.01, 0.05, 0.1),
        "maxDepth": (3, 6, 9),
        "minInfoGain": (0.0, 0.1, 0.2),
    },
}


def feature_columns(df: DataFrame, target: str, skip: Sequence[str] = NOT_FEATURES) -> tuple[list[str], list[str]]:
    """(numeric, categorical) feature columns; the constant event time is not a feature."""
    left_out = {target, *skip}
    numeric = [c for c in numeric_columns(df.schema, booleans=True) if c not in left_out]
    return numeric, [c for c in string_columns(df.schema) if c not in left_out]


def boosted_trees(target: str, **settings) -> BoostedTrees:
    """Gradient-boosted trees; lineage of long fits by Spark's learner is cut in the shared checkpoint folder."""
    params = {"maxBins": MAX_BINS, "seed": 42, **settings}
    return BoostedTrees(labelCol=target, featuresCol="features", predictionCol="y_pred", **params)


def ordered(df: DataFrame, row_id: str = "row_id", parts: int | None = None) -> DataFrame:
    """Rows dealt out and sorted by their id, so that a fit doesn't depend on how they came."""
    dealt = df.repartition(row_id) if parts is None else df.repartition(parts, row_id)
    return dealt.sortWithinPartitions(row_id)


@dataclass
class Trained:
    """Fitted features and the learner trained on them."""

    features: Features
    learner: GBTRegressionModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.learner.transform(self.features.transform(df))


@dataclass
class Candidate:
    """A named way to build features, and the settings of its learner.

    ``encoding`` holds for all category columns but those that ``encodings`` names: "mean", "ordered" (also
    called "native") or "one_hot".
    """

    name: str
    encoding: str
    settings: Mapping[str, float] = field(default_factory=dict)
    encodings: Mapping[str, str] = field(default_factory=dict)

    def features(self, train: DataFrame, target: str, columns: Sequence[str] | None = None) -> Features:
        numeric, categorical = feature_columns(train, target)
        if columns is not None:
            numeric = [c for c in numeric if c in columns]
            categorical = [c for c in categorical if c in columns]
        usual = "ordered" if self.encoding == "native" else self.encoding
        return fit_features(train, target, numeric, {c: self.encodings.get(c, usual) for c in categorical})

    def fit(self, train: DataFrame, target: str, columns: Sequence[str] | None = None) -> Trained:
        shared_folder(train.sparkSession)
        features = self.features(train, target, columns)
        learner = boosted_trees(target, **self.settings)
        # The learner passes over its input several times before it keeps its own binned copy.
        prepared = ordered(features.transform(train, out_of_fold=True)).select("features", target).persist()
        try:
            return Trained(features, learner.fit(prepared))
        finally:
            prepared.unpersist()


CANDIDATES = (Candidate("native", "native"), Candidate("one_hot", "one_hot"))


def error_metrics(model, data: DataFrame, target: str) -> dict[str, float]:
    return regression_metrics(model.transform(data), target, "y_pred").first().asDict()


def score_candidates(
    train: DataFrame, validation: DataFrame, target: str, candidates: Sequence[Candidate] = CANDIDATES
) -> tuple[DataFrame, dict[str, Trained]]:
    """(model, score, rmse, r2) with score = -RMSE on the validation part, and the fitted models.

    A candidate that cannot be trained scores minus infinity and loses, without ending the run.
    """
    rows, models = [], {}
    for candidate in candidates:
        try:
            model = candidate.fit(train, target)
            metrics = error_metrics(model, validation, target)
            models[candidate.name] = model
            rows.append((candidate.name, -metrics["rmse"], metrics["rmse"], metrics["r2"]))
        except Exception as problem:  # noqa: BLE001 - any failure disqualifies the candidate only
            log.error("candidate %s failed: %s", candidate.name, problem)
            rows.append((candidate.name, -math.inf, None, None))
    schema = "model string, score double, rmse double, r2 double"
    return train.sparkSession.createDataFrame(rows, schema), models


def segments(learner: GBTRegressionModel, stops: Sequence[int]) -> list[GBTRegressionModel]:
    """The trees of a boosted model cut at ascending numbers of rounds, each piece a model by itself.

    Rounds are fitted one after another, so the sum of the first pieces predicts what a fit of so many
    rounds with the same other settings and seed predicts.
    """
    whole, gateway = learner._java_obj, SparkContext._active_spark_context._gateway
    jvm, trees, weights, pieces = gateway.jvm, whole.trees(), whole.treeWeights(), []
    for begin, end in zip([0, *stops], stops):
        some = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, end - begin)
        factors = gateway.new_array(jvm.double, end - begin)
        for k in range(end - begin):
            some[k], factors[k] = trees[begin + k], weights[begin + k]
        piece = GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"{learner.uid}_{end}", some, factors))
        pieces.append(piece.setFeaturesCol(learner.getFeaturesCol()))
    return pieces


def staged_errors(learner: GBTRegressionModel, judged: DataFrame, target: str, rounds: Sequence[int]) -> dict[int, float]:
    """Mean squared error on ``judged`` after each of the given numbers of rounds the model has, all from one scan."""
    last = stages(rounds, learner.getNumTrees)
    stops = sorted(set(last.values()))
    scored, so_far, misses = judged, F.lit(0.0), {}
    for stop, piece in zip(stops, segments(learner, stops)):
        scored = piece.setPredictionCol(f"_piece_{stop}").transform(scored)
        so_far = so_far + F.col(f"_piece_{stop}")
        misses[stop] = F.col(target).cast("double") - so_far
    row = scored.agg(*[F.avg(miss * miss).alias(str(stop)) for stop, miss in misses.items()]).first()
    return {n: float(row[str(stop)]) for n, stop in last.items()}


def grid_search(
    train: DataFrame,
    target: str,
    candidate: Candidate,
    grid: Mapping[str, Sequence] | None = None,
    row_id: str = "row_id",
    parallelism: int = 8,
) -> tuple[Trained, DataFrame]:
    """Best settings by mean squared error over two contiguous folds, refitted on all rows.

    Features are fitted inside each fold, on its training rows only. Settings that differ in the number of
    rounds alone share one fit per fold, of the most rounds, and are judged by its stages. Returns the model
    and one row per setting. A setting that the learner refuses has no error and cannot win; if it refuses
    all, the defaults are fitted instead. Any other failure ends the search.
    """
    spark = train.sparkSession
    shared_folder(spark)
    grid = grid or GRIDS[candidate.name]
    settings = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    folded = contiguous_folds(train, row_id)
    folds = [_prepared_fold(folded, k, target, candidate, row_id) for k in (0, 1)]
    groups: dict[str, list[dict]] = {}
    for s in settings:
        groups.setdefault(json.dumps({k: v for k, v in s.items() if k != "maxIter"}, sort_keys=True), []).append(s)
    # The longest fits first, so that none of them is left over at the end.
    tasks = sorted(itertools.product(groups.values(), folds), key=lambda t: -t[0][0].get("maxDepth", 0))
    try:
        with ThreadPool(parallelism) as pool:
            found = pool.map(lambda t: _group_errors(*t[1], target, candidate, t[0]), tasks, chunksize=1)
    finally:
        for prepared, judged in folds:
            prepared.unpersist()
            judged.unpersist()
    errors: dict[str, list[float]] = {}
    for part in found:
        for key, mse in part.items():
            errors.setdefault(key, []).append(mse)
    rows = []
    for s in settings:
        key = json.dumps(s, sort_keys=True)
        mse = sum(errors[key]) / 2 if len(errors.get(key, ())) == 2 else None
        rows.append((key, mse, None if mse is None else math.sqrt(mse)))
    table = spark.createDataFrame(rows, "settings string, mse double, rmse double")
    judged = [(mse, i) for i, (_, mse, _) in enumerate(rows) if mse is not None]
    best = settings[min(judged)[1]] if judged else {}
    chosen = Candidate(candidate.name, candidate.encoding, {**candidate.settings, **best}, candidate.encodings)
    return chosen.fit(train, target), table


def _prepared_fold(folded: DataFrame, fold: int, target: str, candidate: Candidate, row_id: str) -> tuple[DataFrame, DataFrame]:
    """Cached feature vectors of the rows outside a fold, and of the fold's rows, encoded by the others."""
    others, held = folded.where(F.col("fold") != fold).drop("fold"), folded.where(F.col("fold") == fold).drop("fold")
    features = candidate.features(others, target)
    parts = max(1, math.ceil(others.count() / FOLD_ROWS))
    prepared = ordered(features.transform(others, out_of_fold=True), row_id, parts).select("features", target).persist()
    judged = ordered(features.transform(held), row_id, parts).select("features", target).persist()
    return prepared, judged


def _group_errors(prepared: DataFrame, judged: DataFrame, target: str, candidate: Candidate, group: Sequence[dict]) -> dict[str, float]:
    """Mean squared error of settings that differ in ``maxIter`` alone, by setting; none if the learner refuses them."""
    try:
        default = None if all("maxIter" in s for s in group) else boosted_trees(target, **candidate.settings).getMaxIter()
        rounds = {json.dumps(s, sort_keys=True): s.get("maxIter", default) for s in group}
        most = {**candidate.settings, **group[0], "maxIter": max(rounds.values())}
        learner = boosted_trees(target, cacheNodeIds=True, **most)
        errors = learner.errors_after(prepared, judged, list(rounds.values()))
        if errors is None:
            errors = staged_errors(learner.fit(prepared), judged, target, list(rounds.values()))
    except IllegalArgumentException as refused:
        log.error("settings %s refused: %s", group, refused)
        return {}
    return {key: errors[n] for key, n in rounds.items() if n in errors}


def settings_of(model: Trained) -> dict[str, float]:
    """Learner settings a fitted model was trained with, to train another one like it."""
    names = ("maxIter", "stepSize", "maxDepth", "minInfoGain", "maxBins", "seed")
    return {n: model.learner.getOrDefault(n) for n in names if model.learner.hasParam(n)}


def replaces_champion(champion: Mapping | None, challenger_rmse: float) -> bool:
    """Only a strictly lower error than the champion's ``val_rmse`` (else ``val_score``) wins."""
    champion = champion or {}
    key = "val_rmse" if "val_rmse" in champion else "val_score"
    return champion.get(key, math.inf) > challenger_rmse


@dataclass
class Selection:
    """Outcome of model selection."""

    model: Trained
    candidate: str
    scores: DataFrame
    grid: DataFrame
    metrics: dict[str, float]
    replaced: bool


def select_model(
    train: DataFrame,
    validation: DataFrame,
    target: str,
    champion: Mapping | None = None,
    champion_model: Trained | None = None,
    candidates: Sequence[Candidate] = CANDIDATES,
    grids: Mapping[str, Mapping[str, Sequence]] | None = None,
    row_id: str = "row_id",
) -> Selection:
    """Compare the candidates, tune the better one, and let it challenge the champion."""
    scores, _ = score_candidates(train, validation, target, candidates)
    best = scores.agg(F.max_by("model", "score")).first()[0]
    candidate = next(c for c in candidates if c.name == best)
    model, grid = grid_search(train, target, candidate, (grids or GRIDS).get(best), row_id)
    metrics = error_metrics(model, validation, target)
    wins = replaces_champion(champion, metrics["rmse"]) or champion_model is None
    return Selection(model if wins else champion_model, best, scores, grid, metrics, wins)


def train_model(
    train: DataFrame,
    validation: DataFrame,
    target: str,
    best_columns: Sequence[str] | None = None,
    candidate: Candidate = Candidate("native", "native", BASELINE),
) -> tuple[Trained, list[str], dict]:
    """(model, columns it uses, {regressor, train_score, val_score}) with both scores as RMSE."""
    numeric, categorical = feature_columns(train, target)
    columns = [c for c in train.columns if c in (*numeric, *categorical)]
    if best_columns is not None:
        columns = [c for c in best_columns]
    model = candidate.fit(train, target, columns)
    result = {
        "regressor": type(model.learner).__name__,
        "train_score": error_metrics(model, train, target)["rmse"],
        "val_score": error_metrics(model, validation, target)["rmse"],
    }
    return model, columns, result


def predict(df: DataFrame, model: Trained, columns: Sequence[str]) -> DataFrame:
    """Every input column plus ``y_pred``; only the model's columns have to be there."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns the model needs are missing: {missing}")
    scored = model.transform(df)
    return scored.select(*df.columns, "y_pred")


def predict_and_describe(df: DataFrame, model: Trained, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    scored = predict(df, model, columns)
    numeric = [c for c in numeric_columns(scored.schema) if c != "row_id"]
    return scored, describe(scored, numeric)


def save_model(model: Trained, columns: Sequence[str], path: str, spark: SparkSession) -> None:
    """Model and the columns it uses, side by side."""
    model.learner.write().overwrite().save(f"{path}/learner")
    model.features.save(f"{path}/features", spark)
    rows = [(i, c) for i, c in enumerate(columns)]
    spark.createDataFrame(rows, "position int, column string").coalesce(1).write.mode("overwrite").json(
        f"{path}/columns"
    )


def load_model(path: str, spark: SparkSession) -> tuple[Trained, list[str]]:
    columns = spark.read.schema("position int, column string").json(f"{path}/columns")
    model = Trained(Features.load(f"{path}/features", spark), GBTRegressionModel.load(f"{path}/learner"))
    return model, [r["column"] for r in columns.orderBy("position").collect()]


def log_run(
    spark: SparkSession, path: str, run_id: str, model: str, params: Mapping = (), metrics: Mapping = ()
) -> None:
    """Append (run_id, model, kind, name, value) rows to the run table."""
    rows = [(run_id, model, "param", k, str(v)) for k, v in dict(params).items()]
    rows += [(run_id, model, "metric", k, str(v)) for k, v in dict(metrics).items()]
    schema = "run_id string, model string, kind string, name string, value string"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def champion_of(runs: DataFrame, metric: str = "val_rmse") -> dict:
    """The logged run with the lowest value of the metric, ties to the first run id; empty without runs.

    ``runs`` is the run table; a champion is thereby stored state, not something the caller remembers.
    """
    value = F.col("value").cast("double")
    scored = runs.where((F.col("kind") == "metric") & (F.col("name") == metric) & value.isNotNull())
    best = scored.agg(F.min(F.struct(value.alias("value"), "run_id", "model")).alias("best")).first()["best"]
    return {} if best is None else {"run_id": best["run_id"], "model": best["model"], metric: best["value"]}
