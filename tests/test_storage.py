from multiprocessing.pool import ThreadPool

import pytest

from featureflow.schemas import RAW_REVIEWS
from featureflow.session import scratch_path, shared_folder
from featureflow.sources import feature_tables, tables
from featureflow.sources.registry import Champion, Registry


def test_csv_with_quotes_breaks_and_spaces(spark):
    row = {f.name: None for f in RAW_REVIEWS.fields}
    row.update(row_id=3, points=88, price=12.5, description='He said "fine",\nthen  left ', title=" padded ")
    df = spark.createDataFrame([tuple(row.values())], RAW_REVIEWS)
    path = scratch_path(spark, "reviews")
    tables.write_csv(df, path, index="row_id")
    header = spark.read.text(path).first()[0]
    assert header.startswith("_c0,country,description")
    assert tables.read_indexed_csv(spark, path, multi_line=True).collect() == df.collect()


def test_feature_table(spark):
    df = spark.createDataFrame([(50, 1.5, "x", True), (20, 2.5, "y", None)], "row_id long, `The Price` double, kind string, flag boolean")
    root = scratch_path(spark, "features")
    stored = feature_tables.write_feature_table(df, root, "numbers", descriptions={"The Price": "Target variable"})
    rows = stored.orderBy("row_id").collect()
    assert [(r["row_id"], r["the_price"], r["kind"], r["flag"]) for r in rows] == [(0, 2.5, "y", None), (1, 1.5, "x", "true")]
    assert stored.schema["the_price"].metadata == {"comment": "Target variable"}
    assert "datetime" in stored.columns
    again = feature_tables.write_feature_table(df.limit(1), root, "numbers")
    assert again.count() == 1
    assert feature_tables.read_feature_table(spark, root, "numbers").count() == 1


def test_failed_feature_table_is_only_logged(spark):
    df = spark.createDataFrame([(1, 2**40)], "row_id long, big long")
    assert feature_tables.write_feature_table(df, scratch_path(spark, "features"), "broken") is None
    assert feature_tables.write_feature_groups(df, "big", "unused", enabled=False) == {}


def test_registry(spark):
    store = tables.Tables(spark, scratch_path(spark, "tables"))
    store.save("X_train", spark.range(5).toDF("row_id"))
    assert store.load("X_train").count() == 5
    assert "scored" in store.names()
    with pytest.raises(KeyError):
        store.load("nothing")


def test_metrics_json(spark):
    path = scratch_path(spark, "metrics")
    tables.write_json({"regressor": "GBT", "train_score": 1.5, "val_score": 2.5}, path, spark)
    assert tables.read_json(path, spark) == {"regressor": "GBT", "train_score": 1.5, "val_score": 2.5}


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark)
    assert spark.sparkContext.getCheckpointDir() is not None


def test_champion_is_swapped_by_comparison(spark, tmp_path):
    store, other = Registry(spark, str(tmp_path)), Registry(spark, str(tmp_path))
    assert store.champion() == Champion()
    for run_id, error in (("a", 5.0), ("b", 4.0), ("c", 4.0), ("d", 3.0)):
        store.add_run(run_id, lambda path: spark.range(3).write.parquet(f"{path}/model"), {"val_rmse": error})
    with pytest.raises(FileExistsError):
        store.add_run("a", lambda path: None, {"val_rmse": 1.0})
    assert store.metrics_of("a") == {"val_rmse": 5.0} and spark.read.parquet(f"{store.run_path('a')}/model").count() == 3
    assert store.challenge("a") and store.champion().run_id == "a"
    # Two writers saw the same champion: one of them gets the next version.
    seen = other.champion()
    assert store.promote("b", seen) and not other.promote("d", seen)
    assert other.champion() == store.champion() == Champion(2, "b", {"val_rmse": 4.0})
    assert not other.challenge("c") and other.challenge("d") and store.champion().run_id == "d"
    assert not store.challenge("a") and store.champion().version == 3


def test_many_writers_end_with_the_best(spark, tmp_path):
    errors = {f"run{i}": float(abs(7 - i) + 1) for i in range(14)}
    for run_id, error in errors.items():
        Registry(spark, str(tmp_path)).add_run(run_id, lambda path: None, {"val_rmse": error})
    with ThreadPool(7) as pool:
        won = pool.map(lambda r: Registry(spark, str(tmp_path)).challenge(r), errors)
    last = Registry(spark, str(tmp_path)).champion()
    assert last.run_id == "run7" and last.version == sum(won)
