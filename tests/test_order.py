import random

import pytest
from pyspark.sql import functions as F

from featureflow.operators.order import exact_cut, number_rows, number_values, running_total
from featureflow.operators import order, split
from featureflow.operators.encode import category_codes, fit_categories, one_hot_wide


def test_split_sizes(spark):
    df = spark.createDataFrame([(i, i * 2, i % 3, i % 2, i, 0) for i in range(10)], "Id long, Feature1 long, Feature2 long, Target long, index long, datetime long")
    parts = split.split_and_validate(df, "Target", "Id")
    train = {r["Id"] for r in parts["X_train"].collect()}
    test = {r["Id"] for r in parts["X_test"].collect()}
    assert (len(train), len(test)) == (8, 2)
    assert train.isdisjoint(test) and train | test == set(range(10))
    assert "Target" not in parts["X_train"].columns
    assert parts["y_test"].columns == ["Id", "Target"]


@pytest.mark.parametrize("n", [0, 1, 2, 5, 13, 997])
def test_split_random_is_exact(spark, n):
    df = spark.range(n).withColumnRenamed("id", "row_id")
    train, batch = split.split_random(df)
    assert train.count() == round(0.8 * n)
    assert train.count() + batch.count() == n


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "row_id")
    a = {r[0] for r in split.sample_rows(df.repartition(1), 100).collect()}
    b = {r[0] for r in split.sample_rows(df.repartition(7), 100).collect()}
    assert a == b and len(a) == 100
    assert split.sample_rows(df, 9999).count() == 5000


def test_exact_cut_descends_into_full_bins(spark, monkeypatch):
    monkeypatch.setattr(order, "BINS", 4)
    monkeypatch.setattr(order, "SMALL", 3)
    values = random.Random(1).sample(range(-(10**12), 10**12), 500)
    df = spark.createDataFrame([(v,) for v in values], "k long")
    for take in (1, 37, 250, 499):
        cut = exact_cut(df, F.col("k"), "k", lambda n: take)
        got = sorted(r[0] for r in df.where(cut.predicate(F.col("k"), F.col("k"))).collect())
        assert got == sorted(values)[:take]


def test_exact_cut_wants_unique_ids(spark, monkeypatch):
    monkeypatch.setattr(order, "SMALL", 3)
    df = spark.createDataFrame([(7,)] * 10 + [(1,), (9,)], "k long")
    with pytest.raises(ValueError, match="unique"):
        exact_cut(df, F.col("k"), "k", lambda n: 5)


def test_null_ids_are_refused(spark):
    df = spark.createDataFrame([(1,), (None,)], "row_id long")
    with pytest.raises(ValueError, match="null"):
        split.split_random(df)


def test_folds_are_contiguous(spark):
    df = spark.createDataFrame([(i * 10 - 35,) for i in range(11)], "row_id long")
    folds = [r["fold"] for r in split.contiguous_folds(df).orderBy("row_id").collect()]
    assert folds == [0] * 6 + [1] * 5


def test_exact_cut_refuses_a_repeated_id_at_the_boundary(spark):
    df = spark.createDataFrame([(i // 2,) for i in range(10)], "k long")
    with pytest.raises(ValueError, match="unique"):
        exact_cut(df, F.col("k"), "k", lambda n: 5)


def test_folds_over_the_whole_range_of_ids(spark):
    ids = [-(2**63), -(2**63) + 1, -5, 0, 7, 2**62, 2**63 - 2, 2**63 - 1]
    for some in (ids, ids[:-1], ids[1:], [ids[0], ids[-1]]):
        df = spark.createDataFrame([(i,) for i in some], "row_id long")
        folds = {r["row_id"]: r["fold"] for r in split.contiguous_folds(df).collect()}
        first = sorted(some)[: -(-len(some) // 2)]
        assert folds == {i: int(i not in first) for i in some}


def test_number_rows_with_repeated_keys(spark):
    df = spark.createDataFrame([(0, 2), (0, 1), (2, 3), (5, 9)], "k long, tie long")
    got = {r["tie"]: r["position"] for r in number_rows(df, "k", tie="tie").collect()}
    assert got == {1: 0, 2: 1, 3: 2, 9: 3}
    two = spark.createDataFrame([(0, 2), (0, 1), (2, 3)], "k long, tie long")
    assert sorted(r["position"] for r in number_rows(two, "k").collect()) == [0, 1, 2]


@pytest.mark.parametrize("rows_per_range, samples", [(10, 1000), (10, 20), (10**6, 1000)])
def test_number_rows(spark, monkeypatch, rows_per_range, samples):
    monkeypatch.setattr(order, "ROWS_PER_RANGE", max(rows_per_range, 100))
    monkeypatch.setattr(order, "SAMPLES_PER_RANGE", samples)
    keys = random.Random(2).sample(range(10**9), 3000)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    got = {r["k"]: r["position"] for r in number_rows(df, "k").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}
    dense = spark.range(100, 200)
    assert [r["position"] for r in number_rows(dense, "id").orderBy("id").collect()] == list(range(100))


def test_number_rows_by_time(spark):
    df = spark.range(500).select(F.timestamp_seconds(F.col("id") * 37 % 501 + 1_700_000_000).alias("t"))
    rows = number_rows(df, "t").orderBy("t").collect()
    assert [r["position"] for r in rows] == list(range(500))


def test_number_values(spark):
    words = sorted({f"w{random.Random(i).randint(0, 10**6)}" for i in range(700)})
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(6)
    assert {r["w"]: r["code"] for r in number_values(df, "w").collect()} == {w: i for i, w in enumerate(words)}


def test_running_total_with_a_hot_value(spark):
    # One value holds a third of the rows; after aggregation it is one row.
    values = [5.0] * 300 + [float(random.Random(i).randint(0, 400)) for i in range(600)]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    counts = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    for r in running_total(counts, "v", F.col("n"), ["g"]).collect():
        assert r["before"] == sum(v < r["v"] for v in values)


def test_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("unknown",), ("c",), (None,)], "p string")
    got = {r["p"]: r["p_codes"] for r in category_codes(df, "p").collect()}
    assert got == {"a": 0, "b": 1, "c": 2, "unknown": 1000, None: -1}


def test_one_hot(spark):
    train = spark.createDataFrame([("b", 1, True), ("a", 2, None), ("c", 3, False)], "c string, n int, is_blend boolean")
    fitted = fit_categories(train)
    rows = one_hot_wide(train, fitted).orderBy("n").collect()
    assert rows[0].asDict() == {"n": 1, "is_blend_True": 1, "c_b": 1.0, "c_c": 0.0}
    assert [r["is_blend_True"] for r in rows] == [1, 0, 0]
    unseen = spark.createDataFrame([("z", 9)], "c string, n int")
    assert one_hot_wide(unseen, fitted).first().asDict() == {"n": 9, "is_blend_True": 0, "c_b": 0.0, "c_c": 0.0}
    assert fitted.output_names() == ["c_b", "c_c"]


def test_one_hot_null_is_a_category(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert sorted(r["c_None"] for r in one_hot_wide(df, fit_categories(df)).collect()) == [0.0, 1.0]


@pytest.mark.parametrize("shape", ["constant", "hot", "two hot", "null ties"])
def test_rows_of_a_hot_key_are_spread_over_ranges(spark, monkeypatch, shape):
    """One key for all rows, or for most, is cut by the tie; the numbers are those of one sort."""
    monkeypatch.setattr(order, "ROWS_PER_RANGE", 100)
    pick = random.Random(2)
    keys = {
        "constant": [5] * 2000,
        "hot": [7] * 1500 + [pick.randrange(15) for _ in range(500)],
        "two hot": [7] * 900 + [8] * 900 + [pick.randrange(7, 10) for _ in range(200)],
        "null ties": [5] * 2000,
    }[shape]
    ties = pick.sample(range(10**6), len(keys))
    if shape == "null ties":
        ties[0] = None
    df = spark.createDataFrame(list(zip(keys, ties)), "k long, t long").repartition(5)
    numbered = number_rows(df, "k", "n", "t")
    got = [(r["k"], r["t"]) for r in sorted(numbered.collect(), key=lambda r: r["n"])]
    assert got == sorted(zip(keys, ties), key=lambda x: (x[0], x[1] is not None, x[1] or 0))
    assert sorted(r["n"] for r in numbered.collect()) == list(range(len(keys)))
    ranged = order.value_ranges(df.withColumn("_order", F.col("k").cast("double")), ["_order"], "_r")
    parts = order._split_hot_keys(ranged, "k", "t", len(keys)).groupBy("_r_order", "_r_tie").count().collect()
    assert max(r["count"] for r in parts) <= 450 and len(parts) >= 10
