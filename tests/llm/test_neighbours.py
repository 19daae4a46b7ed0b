import numpy as np

from featureflow.llm import neighbours
from tests.llm.cases import plain

SCHEMA = "vec_id long, embedding array<double>, vec string, key string, score string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "own", "own", "own") for i, v in rows], SCHEMA).repartition(3)


def brute(rows, asking, k=5):
    some = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)})
    out = []
    for q, x in some:
        if q in asking:
            near = sorted(
                (-np.dot(x, y) / np.sqrt(np.dot(x, x) * np.dot(y, y)), i) for i, y in some if i != q and len(x) == len(y)
            )
            out += [(q, r, i, -s) for r, (s, i) in enumerate(near[:k], 1)]
    return out


def test_recall_and_exact_scores(spark):
    random = np.random.default_rng(1)
    centres = random.standard_normal((20, 16))
    rows = [(i, (centres[i % 20] + 0.3 * random.standard_normal(16)).tolist()) for i in range(2000)]
    asking = {i for i in range(2000) if i % 50 == 0}
    vectors = table(spark, rows)
    settings = neighbours.Settings(vectors=50, queries=3)
    got = neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"), settings=settings).collect()
    true = brute(rows, asking)
    assert len(got) == len(true)
    score = {(q, v): s for q, _, v, s in brute(rows, asking, 2000)}
    assert all(abs(score[r["query_id"], r["vec_id"]] - r["score"]) < 1e-12 for r in got)
    found = {(r["query_id"], r["vec_id"]) for r in got}
    assert np.mean([(q, v) in found for q, _, v, _ in true]) >= 0.9
    few = neighbours.Hashing(settings, 1.0, 1)
    index = neighbours.hashed(neighbours.entries_of(neighbours.vectors_of(vectors), 5), few, False)
    assert index.count() == 2000 * settings.tables


def test_edge_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, -0.0]), (None, [1.0, 1.0])]
    rows += [(5, [nan, 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, None]), (8, []), (100, [-1.0, 0.0]), (100, [-1.0, 0.0]), (150, [1.0, 2.0, 3.0])]
    vectors = table(spark, rows)
    got = neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0")).collect()
    assert plain(got) == plain(brute([(i, v) for i, v in rows if v], {0, 50, 100, 150}))


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(300)] + [(300 + i, [1.0, 2.0 + 0.01 * i]) for i in range(1, 300)]
    vectors = table(spark, rows)
    got = neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0")).where("query_id < 300").collect()
    for r in got:
        others = [i for i in range(7) if i != r["query_id"]]
        assert r["vec_id"] == others[r["rank"] - 1]


def test_extreme_values_and_empty_table(spark):
    rows = [(0, [1e300, 1e300]), (1, [1e-300, 1e-300]), (2, [1e300, -1e300])]
    got = neighbours.nearest(table(spark, rows), table(spark, rows).where("vec_id = 0")).collect()
    assert [(r["vec_id"], round(r["score"], 12)) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1.0), (2, 0.0)]
    assert neighbours.nearest(table(spark, []), table(spark, [])).count() == 0


def test_steps_come_cheapest_first():
    random = np.random.default_rng(4)
    for _ in range(20):
        f = random.uniform(0, 1, 3)
        taken = neighbours.steps(f, 27)
        cost = [sum((1 - f[s % 3]) ** 2 if s >= 3 else f[s] ** 2 for s in t) for t in taken]
        assert len(set(taken)) == 27 and cost == sorted(cost)
