import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from featureflow.operators import drift, order, profile, quality
from featureflow.operators.association import cramers_v_matrix


def frame(n=2000, seed=3):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"a": rng.normal(0, 1, n).round(2), "b": rng.exponential(5, n), "c": rng.integers(0, 20, n).astype(float)})
    pdf.loc[rng.random(n) < 0.1, "a"] = np.nan
    pdf["b"] = pdf["b"] + 2 * pdf["c"]
    return pdf


@pytest.mark.parametrize("n, one_task", [(1, 10), (2, 10), (3, 10), (7, 10), (100, 10**6), (100, 10), (4001, 50), (4001, 10**6)])
def test_describe(spark, monkeypatch, n, one_task):
    monkeypatch.setattr(profile, "ONE_TASK", one_task)
    pdf = frame(n)
    got = profile.describe(spark.createDataFrame(pdf)).toPandas().set_index("summary")
    expected = pdf.describe()
    for c in pdf.columns:
        for s in expected.index:
            a, b = got.loc[s, c], expected.loc[s, c]
            assert (pd.isna(a) and pd.isna(b)) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12), (c, s)


def test_describe_with_a_hot_value(spark, monkeypatch):
    monkeypatch.setattr(profile, "ONE_TASK", 20)
    monkeypatch.setattr(profile, "SKETCH", 40)
    values = [88.0] * 400 + [float(x) for x in range(800)]
    got = profile.describe(spark.createDataFrame([(v,) for v in values], "v double")).toPandas().set_index("summary")
    assert got.loc["50%", "v"] == pd.Series(values).quantile(0.5)
    assert got.loc["25%", "v"] == pd.Series(values).quantile(0.25)


def test_describe_when_hot_values_block_the_bracket(spark, monkeypatch):
    monkeypatch.setattr(profile, "ONE_TASK", 20)
    monkeypatch.setattr(profile, "SKETCH", 4)
    values = [1.0] * 300 + [1.0 + x / 100 for x in range(1, 60)] + [2.0] * 300
    got = profile.describe(spark.createDataFrame([(v,) for v in values], "v double")).toPandas().set_index("summary")
    for label, p in (("25%", 0.25), ("50%", 0.5), ("75%", 0.75)):
        assert got.loc[label, "v"] == pytest.approx(pd.Series(values).quantile(p))


def matrix(df, value):
    return {(r["column_a"], r["column_b"]): r[value] for r in df.collect()}


def test_correlations(spark):
    pdf = frame()
    df = spark.createDataFrame(pdf).withColumn("a", F.when(~F.isnan("a"), F.col("a")))
    for got, method in ((profile.pearson_matrix(df), "pearson"), (profile.spearman_matrix(df), "spearman")):
        expected = pdf.corr(method=method)
        for (a, b), v in matrix(got, "correlation").items():
            assert math.isclose(v, expected.loc[a, b], rel_tol=1e-9, abs_tol=1e-9)


def cramers(x, y):
    table = pd.crosstab(x, y).to_numpy().astype(float)
    n = table.sum()
    expected = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / n
    gap = np.abs(table - expected)
    if table.shape == (2, 2):
        gap = np.maximum(gap - 0.5, 0)
    chi2 = (gap**2 / expected).sum()
    r, k = table.shape
    phi2 = max(0, chi2 / n - (k - 1) * (r - 1) / (n - 1))
    low = min(k - (k - 1) ** 2 / (n - 1), r - (r - 1) ** 2 / (n - 1)) - 1
    return 0.0 if low <= 0 else round(math.sqrt(phi2 / low), 2)


@pytest.mark.parametrize("collapsed", [1.0, 0.0])
def test_cramers_v(spark, collapsed):
    rnd = random.Random(4)
    rows = [(rnd.choice("abc"), rnd.choice(["x", "y", None]), rnd.random() < 0.3, "k") for _ in range(500)]
    rows = [(a, "x" if a == "a" else b, c, k) for a, b, c, k in rows]
    pdf = pd.DataFrame(rows, columns=["p", "q", "r", "s"])
    got = matrix(cramers_v_matrix(spark.createDataFrame(rows, "p string, q string, r boolean, s string"), collapsed=collapsed), "cramers_v")
    for a in pdf.columns:
        for b in pdf.columns:
            keep = pdf[a].notna() & pdf[b].notna()
            expected = 1.0 if a == b else cramers(pdf[a][keep], pdf[b][keep])
            assert got[(a, b)] == pytest.approx(expected, abs=1e-9), (a, b)


def test_histogram_matches_numpy(spark):
    values = np.round(np.random.default_rng(5).normal(50, 7, 3000), 1)
    rows = profile.histogram(spark.createDataFrame([(float(v),) for v in values], "v double"), "v").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=20)
    assert [r["count"] for r in rows] == counts.tolist()
    assert np.allclose([r["low"] for r in rows], edges[:-1])


def js_distance(p, q):
    m = (p + q) / 2
    left = np.sum(p[p > 0] * np.log2(p[p > 0] / m[p > 0]))
    right = np.sum(q[q > 0] * np.log2(q[q > 0] / m[q > 0]))
    return math.sqrt(max((left + right) / 2, 0))


def brute_drift(reference, chunk):
    points = np.sort(np.concatenate([reference, chunk]))
    below = lambda data: np.searchsorted(np.sort(data), points, side="right") / len(data)
    ks = np.max(np.abs(below(reference) - below(chunk)))
    values = np.unique(reference)
    if len(values) > 50 or len(values) / len(reference) > 0.1:
        edges = np.histogram_bin_edges(reference, bins="doane")
        p = np.histogram(reference, edges)[0] / len(reference)
        q = np.histogram(chunk, edges)[0] / len(chunk)
    else:
        p = np.array([(reference == v).mean() for v in values])
        q = np.array([(chunk == v).mean() for v in values])
    return ks, js_distance(np.append(p, 0), np.append(q, max(0, 1 - q.sum())))


@pytest.mark.parametrize("task_limit", [1_000_000, 10])
def test_drift_against_brute_force(spark, monkeypatch, task_limit):
    # The second run splits chunks by value range, cuts values into ranges of ten rows, and broadcasts few values.
    monkeypatch.setattr(drift, "MAX_ROWS_PER_TASK", task_limit)
    monkeypatch.setattr(drift, "HEAVY_VALUES", min(task_limit, 10_000))
    monkeypatch.setattr(order, "ROWS_PER_RANGE", task_limit)
    rng = np.random.default_rng(123)
    ref = pd.DataFrame({"record_id": np.arange(400) * 3, "points": np.clip(rng.normal(88, 3, 400), 80, 100), "price": rng.integers(1, 9, 400).astype(float)})
    ana = pd.DataFrame({"record_id": rng.permutation(250) * 7, "points": np.clip(rng.normal(85, 4, 250), 80, 100), "price": rng.integers(3, 12, 250).astype(float)})
    report = drift.detect_univariate_drift(spark.createDataFrame(ref), spark.createDataFrame(ana), ["points", "price"], 50).collect()
    assert len(report) == 2 * (8 + 5)
    for r in report:
        data = (ref if r["period"] == "reference" else ana).sort_values("record_id")
        chunk = data[r["feature"]].to_numpy()[r["chunk"] * 50 : (r["chunk"] + 1) * 50]
        ks, js = brute_drift(ref[r["feature"]].to_numpy(), chunk)
        assert r["ks"] == pytest.approx(ks, abs=1e-12)
        assert r["js"] == pytest.approx(js, abs=1e-9)
        assert r["js_alert"] == (js > 0.1)
    for feature in ("points", "price"):
        own = [r for r in report if r["feature"] == feature and r["period"] == "reference"]
        upper = np.mean([r["ks"] for r in own]) + 3 * np.std([r["ks"] for r in own])
        for r in report:
            if r["feature"] == feature:
                assert r["ks_upper"] == pytest.approx(upper)
                assert r["ks_alert"] == (r["ks"] > upper or (r["ks_lower"] is not None and r["ks"] < r["ks_lower"]))


def test_batches_against_a_stored_profile(spark, tmp_path):
    """Two batches compared with one stored profile, whose reference rows are gone, give what one run gives."""
    rng = np.random.default_rng(12)

    def frame(n, mean, kinds):
        return pd.DataFrame({"record_id": np.arange(n), "points": rng.normal(mean, 3, n), "stars": rng.integers(1, 5, n).astype(float), "kind": rng.choice(kinds, n)})

    ref, batches = frame(300, 88, list("ab")), [frame(130, 85, list("abc")), frame(90, 120, list("c"))]
    path, features = f"{tmp_path}/reference", ["points", "stars", "kind"]
    drift.profile_reference(spark.createDataFrame(ref), features, 50).save(path)
    profile = drift.ReferenceProfile.load(path, spark)
    key = lambda r: (r["period"], r["feature"], r["chunk"])
    for batch in batches:
        whole = drift.detect_univariate_drift(spark.createDataFrame(ref), spark.createDataFrame(batch), features, 50)
        got = drift.reference_report(profile).unionByName(drift.compare_batch(profile, spark.createDataFrame(batch)))
        assert got.columns == whole.columns
        for a, b in zip(sorted(got.collect(), key=key), sorted(whole.collect(), key=key), strict=True):
            for c in got.columns:
                assert a[c] == (pytest.approx(b[c]) if isinstance(b[c], float) else b[c]), c
    assert drift.compare_batch(profile, spark.createDataFrame(batches[0]).limit(0)).count() == 0


def test_record_id(spark):
    df = spark.createDataFrame([(10, 1.0), (20, 2.0), (30, 3.0)], "index long, v double")
    assert [r["record_id"] for r in drift.with_record_id(df, "index").collect()] == [10, 20, 30]


def test_shift_is_stable_and_clipped(spark):
    df = spark.range(4000).select(F.col("id").alias("row_id"), F.lit(88.0).alias("points"))
    a = drift.shift_points(df.repartition(3)).orderBy("row_id").collect()
    b = drift.shift_points(df.repartition(8)).orderBy("row_id").collect()
    assert a == b
    values = np.array([r["points"] for r in a])
    assert abs(values.mean() - 78) < 0.2 and abs(values.std() - 3) < 0.15
    low = drift.shift_points(df.withColumn("points", F.lit(2.0))).agg(F.min("points")).first()[0]
    assert low == 0.0


def ingested(spark, rows):
    return spark.createDataFrame(
        rows,
        "row_id long, country string, points long, price double, province string, region_1 string, taster_name string, variety string",
    ).withColumn("datetime", F.lit("2025-01-01").cast("timestamp"))


GOOD = [(i, "US", 90 + i, 10.0 + i, "p", "r", "t", "v") for i in range(4)]


def test_review_suite(spark):
    results = quality.run_suite(quality.assert_gates(ingested(spark, GOOD)).drop("row_id"), quality.review_suite())
    rows = results.collect()
    assert all(r["Success"] for r in rows) and len(rows) == 10
    assert [r["Test Description"] for r in rows][7:] == [
        "Value range check (points) [0 to 100]",
        "Value range check (price) [0 to any]",
        "No duplicate records check",
    ]


def test_soft_checks_report_instead_of_stopping(spark):
    bad = ingested(spark, [*GOOD, (9, "US", 190, None, "p", "r", "t", "v")]).drop("row_id")
    rows = {r["Test Description"]: r for r in quality.run_suite(bad, quality.review_suite()).collect()}
    points = rows["Value range check (points) [0 to 100]"]
    assert (points["Success"], points["Element Count"], points["Unexpected Count"]) == (False, 5, 1)
    assert points["Unexpected Percent"] == 20.0
    assert rows["Value range check (price) [0 to any]"]["Success"]


@pytest.mark.parametrize(
    "rows, message",
    [
        ([*GOOD, (9, *GOOD[0][1:])], "duplicate"),
        ([*GOOD, (9, "US", 90, None, "p", "r", "t", "v")], "greater than 0"),
        ([*GOOD, (9, "US", 90, math.nan, "p", "r", "t", "v")], "greater than 0"),
    ],
)
def test_gates(spark, rows, message):
    with pytest.raises(quality.GateError, match=message):
        quality.assert_gates(ingested(spark, rows))


def test_gate_on_columns(spark):
    with pytest.raises(quality.GateError, match="not found"):
        quality.assert_gates(ingested(spark, GOOD).drop("variety"))


def test_distinct_count(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (None, "1"), (1, "1")], "a int, b string")
    assert quality.distinct_row_count(df) == (5, 4)
    assert quality.distinct_row_count(df.limit(0)) == (0, 0)


def test_labels_side_by_side(spark):
    df = spark.createDataFrame([("red", "red"), ("other", "red"), ("other", "white")], "x string, y string")
    got = {r["label"]: (r["one"], r["two"]) for r in profile.compare_labelings(df, {"one": "x", "two": "y"}, ["red", "white", "rosé"]).collect()}
    assert got == {"red": (1, 2), "white": (0, 1), "rosé": (0, 0)}
    reduction = profile.label_reduction(df, "x", "y").first()
    assert (reduction["n_before"], reduction["n_after"], reduction["reduction_pct"]) == (2, 0, 100.0)
    assert profile.label_reduction(df, "y", "y").first()["reduction_pct"] == 0.0
