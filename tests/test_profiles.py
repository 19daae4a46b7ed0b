"""Top values by a sketch, mergeable profiles, checked writes, stored suites, bucketed groups."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from featureflow.operators import profile, quality, sketches
from featureflow.sources import feature_tables


def test_top_values_among_many_distinct_ones(spark):
    pick = random.Random(3)
    values = [f"hot{k}" for k in range(12) for _ in range(300 - 10 * k)] + [f"rare{pick.randrange(10**9)}" for _ in range(20_000)]
    values += ["tie a"] * 250 + ["tie b"] * 250
    pick.shuffle(values)
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v string").repartition(4)
    best = sorted(Counter(values).items(), key=lambda x: (-x[1], x[0]))
    for k in (1, 5, 8, 14):
        assert [tuple(r) for r in profile.top_values(df, "v", k).collect()] == best[:k]
    # A sketch too small to prove the answer is not believed.
    assert [tuple(r) for r in profile.top_values(df, "v", 14, tracked=(20, 40)).collect()] == best[:14]
    assert [tuple(r) for r in profile.top_values(df, "v", 14, tracked=()).collect()] == best[:14]
    assert profile.top_values(df.limit(0), "v", 3).count() == 0
    plan = profile.top_values(df, "v", 5)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan  # only candidates are counted


def test_merged_states_are_the_state_of_the_union(spark):
    pick = random.Random(4)
    rows = [(pick.randrange(3000), pick.choice([None, "a", "b"]), pick.choice([float("nan"), None, pick.random()]), i % 3) for i in range(9000)]
    df = spark.createDataFrame(rows, "k long, s string, x double, part int")
    names = ["k", "s", "x"]
    parts = [sketches.profile_state(df.where(F.col("part") == p), names) for p in range(3)]
    merged = {r["column"]: r for r in sketches.profile_of(parts[0].union(parts[1]).union(parts[2])).collect()}
    whole = {r["column"]: r for r in sketches.profile_of(sketches.profile_state(df, names)).collect()}
    for c in names:
        for field in ("dtype", "n", "nulls", "nulls_pct", "low", "high"):
            assert merged[c][field] == whole[c][field]
    distinct = {"k": len({r[0] for r in rows}), "s": 2, "x": len({r[2] for r in rows if r[2] is not None and r[2] == r[2]})}
    for found in (merged, whole):
        for c in names:
            assert abs(found[c]["n_unique"] - distinct[c]) <= max(1, 0.07 * distinct[c])
        ranks = sorted(r[0] for r in rows)
        for p, q in zip((0.25, 0.5, 0.75), found["k"]["quantiles"]):
            assert abs(sum(k <= q for k in ranks) / len(ranks) - p) < 0.035
        assert found["s"]["quantiles"] is None and found["x"]["nulls"] == sum(r[2] is None or r[2] != r[2] for r in rows)


def test_stored_states(spark, tmp_path):
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    sketches.append_state(df.where("id < 40"), str(tmp_path), "one", ["v"])
    sketches.append_state(df.where("id >= 40"), str(tmp_path), "two", ["v"])
    sketches.append_state(df.where("id >= 40"), str(tmp_path), "two", ["v"])  # again
    row = sketches.stored_profile(spark, str(tmp_path)).first()
    assert (row["n"], row["nulls"], row["n_unique"], row["low"], row["high"]) == (100, 0, 7, 0.0, 6.0)
    state = sketches.profile_state(df, ["id", "v"])
    assert state._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 1  # one scan for all columns
    empty = sketches.profile_of(sketches.profile_state(df.limit(0), ["v"])).first()
    assert (empty["n"], empty["nulls"], empty["n_unique"], empty["quantiles"]) == (0, 0, 0, None)


def reviews(spark, price=100.5, twice=False):
    rows = [(i, "US", 90, float(i + 1), "p", "r", "t", "v", None) for i in range(20)]
    rows[3] = (*rows[3][:3], price, *rows[3][4:])
    if twice:
        rows.append((99, *rows[0][1:]))
    return spark.createDataFrame(rows, "row_id long, country string, points long, price double, province string, region_1 string, taster_name string, variety string, datetime timestamp")


def test_checked_write_publishes_only_what_passes(spark, tmp_path):
    path = f"{tmp_path}/table"
    suite = quality.review_suite()
    good = reviews(spark)
    stored, results = quality.write_checked(good, path, suite)
    assert sorted(stored.collect()) == sorted(good.collect())
    expected = quality.run_suite(good.drop("row_id"), suite)
    assert results.collect() == expected.collect()
    for bad, message in ((reviews(spark, price=0.0), "not greater"), (reviews(spark, twice=True), "duplicate"), (good.drop("variety"), "not found"), (good.withColumn("more", F.lit(1)), "instead of")):
        with pytest.raises(quality.GateError, match=message):
            quality.write_checked(bad, path, suite)
        assert spark.read.parquet(path).count() == 20 and os.listdir(tmp_path) == ["table"]
    again, _ = quality.write_checked(reviews(spark, price=7.5), path, suite)
    assert again.where("price = 7.5 AND row_id = 3").count() == 1


def test_lineage_of_a_checked_write_runs_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    df = reviews(spark)
    quality.write_checked(df.mapInArrow(counted, df.schema), f"{tmp_path}/t", quality.review_suite())
    assert runs.value == 20


def test_stored_suite(spark, tmp_path):
    suite = [*quality.review_suite(), quality.not_null("price"), quality.column_type_in("points", ["int64", "int32"])]
    quality.save_suite(suite, str(tmp_path), spark)
    assert quality.load_suite(str(tmp_path), spark) == suite
    quality.save_suite([], str(tmp_path), spark)
    assert quality.load_suite(str(tmp_path), spark) == []


def test_groups_join_without_an_exchange(spark, tmp_path):
    rows = [(7 * i, i % 5, f"c{i % 9}", i / 3) for i in range(500)]
    df = spark.createDataFrame(rows, "row_id long, size int, kind string, price double").withColumn("datetime", F.lit("2025-01-01").cast("timestamp"))
    written = feature_tables.write_feature_groups(df, "price", str(tmp_path))
    joined = feature_tables.joined_groups(written)
    got = sorted((r["row_id"], r["size"], r["kind"], round(r["price"], 3)) for r in joined.collect())
    assert got == [(i, r[1], r[2], round(r[3], 3)) for i, r in enumerate(rows)]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") >= 2 and "Exchange" not in plan
    path = f"{tmp_path}/numerical_features_v1/data"
    spark.sql(f"DROP TABLE {feature_tables.bucketed_name(path)}")  # another session's catalog doesn't know it
    again = feature_tables.read_bucketed(spark, path)
    assert sorted(again.collect(), key=str) == sorted(written["numerical_features"].collect(), key=str)
