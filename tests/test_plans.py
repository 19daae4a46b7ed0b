"""Shape of the physical plans: what reaches the scan, and what does not shuffle."""

import pytest
from pyspark.sql import functions as F

from featureflow.functions.text import classify, squash
from featureflow.operators import encode, order, split
from featureflow.operators.profile import pearson_matrix
from featureflow.plans.prepare import engineer_features, ingest, model_table, preprocess
from featureflow.schemas import RAW_REVIEWS
from featureflow.session import scratch_path


@pytest.fixture(scope="module")
def reviews(spark):
    path = scratch_path(spark, "raw")
    rows = []
    for i in range(300):
        row = {f.name: f"{f.name}{i % 7}" for f in RAW_REVIEWS.fields}
        row.update(row_id=i, points=80 + i % 20, price=float(i % 9))
        rows.append(tuple(row.values()))
    spark.createDataFrame(rows, RAW_REVIEWS).write.parquet(path)
    return spark.read.schema(RAW_REVIEWS).parquet(path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ingest_prunes_and_pushes_down(reviews):
    plan = plan_of(ingest(reviews))
    assert "GreaterThan(price,0.0)" in plan
    schema = plan.split("ReadSchema: ")[1]
    assert "description" not in schema and "winery" not in schema


def test_only_wanted_features_are_computed(reviews):
    plan = plan_of(model_table(engineer_features(preprocess(reviews))))
    assert "Other" not in plan and "Exchange" not in plan


def test_splits_do_not_shuffle(reviews):
    for part in split.split_random(reviews):
        assert "Exchange" not in plan_of(part)
    parts = split.split_and_validate(reviews, "price")
    assert "Exchange" not in plan_of(parts["X_train"])
    assert "Exchange" not in plan_of(split.contiguous_folds(reviews))


def test_encoding_does_not_shuffle(reviews):
    small = reviews.select("row_id", "country", "variety")
    assert "Exchange" not in plan_of(encode.one_hot_wide(small, encode.fit_categories(small)))


def test_dense_ids_are_only_shifted(reviews):
    assert "Window" not in plan_of(order.number_rows(reviews, "row_id"))


def test_labels_stay_in_generated_code(reviews):
    from featureflow.functions.rules import SUBTYPE_RULES

    labelled = reviews.select(classify(squash(F.col("variety")), SUBTYPE_RULES).alias("label"))
    labelled.collect()
    assert "Python" not in plan_of(labelled) and "*(1) Project" in plan_of(labelled)


def test_correlations_are_one_aggregation(reviews):
    assert plan_of(pearson_matrix(reviews, ["points", "price"])).count("Exchange") == 1
