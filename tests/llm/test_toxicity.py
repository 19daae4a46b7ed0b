import math
import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from featureflow.llm import toxicity
from featureflow.llm.common import bounded
from tests.llm.cases import TEXTS, documents

GOOD = "river stone garden morning window letter market song winter bread".split()
BAD = ["vileword", "nastyterm"]


def made(spark, n=400):
    pick = random.Random(3)
    texts, labels = [], []
    for i in range(n):
        words = [pick.choice(GOOD) for _ in range(30)]
        if i % 4 == 0:
            words[pick.randrange(30)] = pick.choice(BAD)
        texts.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy(spark):
    docs, labels = made(spark)
    model = toxicity.fit(docs, labels, train=F.col("doc_id") % 5 != 0)
    rows = toxicity.score(docs, model).collect()
    assert all((r["score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in rows)


def test_edge_rows_and_clashing_columns(spark):
    docs, labels = made(spark)
    labels = labels.union(spark.createDataFrame([(None, 1), (0, None), (4, 0)], labels.schema))
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(documents(spark), model)
    rows = scored.collect()
    assert len(rows) == len(TEXTS) and scored.columns.count("score") == 1
    assert all(0 <= r["score"] <= 1 and r["y"] == "own y" for r in rows)
    empty = {r["score"] for r in rows if not r["text"]}
    assert len(empty) == 1 and empty.pop() < 0.5


def test_without_labels_of_both_classes(spark):
    docs, labels = made(spark, 20)
    for some in (labels.limit(0), labels.where("toxic = 0")):
        rows = toxicity.score(docs, toxicity.fit(docs, some)).collect()
        assert all(r["score"] < 0.5 for r in rows)
    rows = toxicity.score(docs, toxicity.fit(docs, labels.where("toxic = 1"))).collect()
    assert all(r["score"] >= 0.5 for r in rows)
    nothing = documents(spark, [])
    assert toxicity.score(nothing, toxicity.fit(nothing, labels)).count() == 0


def test_score_sees_whole_long_text(spark):
    docs, labels = made(spark)
    model = toxicity.fit(docs, labels)
    long = " ".join(GOOD * 60_000) + " vileword nastyterm"
    assert toxicity.score(spark.createDataFrame([(1, long)], "doc_id long, text string"), model).first()["score"] > 0.5


def test_blocks_give_the_same_scores(spark, monkeypatch):
    docs, labels = made(spark, 80)
    model = toxicity.fit(docs, labels)
    texts = [r["text"] for r in docs.collect()]
    whole = toxicity.grams(texts, model.settings)
    parts = [toxicity.grams([t], model.settings)[1].tolist() for t in texts]
    assert sorted(whole[1].tolist()) == sorted(sum(parts, []))


def plain_counters(text, settings):
    """The counters of a text's n-grams, one n-gram at a time; an n-gram counts once per text."""
    padded = f" {text.lower()} " if text else ""
    found = set()
    for n in settings.orders:
        for at in range(len(padded) - n + 1):
            h = ord(padded[at])
            for c in padded[at + 1 : at + n]:
                h = (h * 0x9E3779B1 + ord(c)) % 2**32
            h ^= h >> 15
            found.add(((h * 0x85EBCA6B + n) % 2**32) >> (32 - settings.bits))
    return found


def plain_scores(taught, texts, settings):
    """Counts in dictionaries and gradient steps over lists: the classifier in its plainest form."""
    sets = [(plain_counters(t, settings), y) for t, y in taught]
    n = [sum(y == k for _, y in sets) for k in (0, 1)]
    a, ratios = settings.smoothing, {}
    for g in set().union(*[s for s, _ in sets]):
        c = [sum(y == k and g in s for s, y in sets) for k in (0, 1)]
        ratio = math.log((c[1] + a) / (n[1] + 2 * a)) - math.log((c[0] + a) / (n[0] + 2 * a))
        if sum(c) >= settings.least_texts and abs(ratio) >= settings.least_errors * math.sqrt(1 / (c[0] + a) + 1 / (c[1] + a)):
            ratios[g] = ratio
    rows = [({g: ratios[g] for g in s if g in ratios}, y) for s, y in sets]
    balance = [0.5 / max(1, n[y]) for _, y in rows]
    step = 4 / (sum(b * (1 + sum(v * v for v in r.values())) for b, (r, _) in zip(balance, rows)) + settings.penalty)
    used = sorted({g for r, _ in rows for g in r})
    w, b, was = dict.fromkeys(used, 0.0), 0.0, (dict.fromkeys(used, 0.0), 0.0)
    for k in range(settings.rounds):
        ahead = k / (k + 3)
        vw = {g: w[g] + ahead * (w[g] - was[0][g]) for g in used}
        vb = b + ahead * (b - was[1])
        slope, shift = dict.fromkeys(used, 0.0), 0.0
        for (r, y), share in zip(rows, balance):
            z = sum(vw[g] * v for g, v in r.items()) + vb
            miss = share * (1 / (1 + math.exp(-max(-40, min(40, z)))) - y)
            shift += miss
            for g, v in r.items():
                slope[g] += miss * v
        was = (w, b)
        w = {g: vw[g] - step * (slope[g] + settings.penalty * vw[g] / len(rows)) for g in used}
        b = vb - step * shift
    b += math.log(n[1] / n[0])
    return [1 / (1 + math.exp(-(b + sum(w[g] * ratios[g] for g in plain_counters(t, settings) if g in w)))) for t in texts]


def test_scores_against_plain_python(spark):
    pick = random.Random(21)
    words = ["calm", "river", "stone", "Meadow", "é漢", "light"]
    rows, labels = [], []
    for i in range(60):
        bad = i % 3 == 0
        rows.append((i, " ".join(pick.choice(words + ["vile", "scum"] * 3 * bad) for _ in range(pick.randrange(3, 9)))))
        labels.append((i, 1, int(bad)))
    settings = toxicity.Settings(rounds=40, least_errors=1.0)
    model = toxicity.fit(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), settings=settings)
    more = rows + [(100, ""), (101, "vile"), (102, "calm RIVER")]
    got = {r["doc_id"]: r["score"] for r in toxicity.score(documents(spark, more), model, column="score").collect()}
    expected = plain_scores([(t, y) for (_, t), (_, _, y) in zip(rows, labels)], [t for _, t in more], settings)
    assert [got[i] for i, _ in more] == pytest.approx(expected, abs=1e-6)


def test_counting_takes_little_memory():
    """Tasks share a machine with other tasks, so what a worker takes for a moment is bounded."""
    pick = random.Random(5)
    texts = [" ".join(f"w{pick.randrange(10**6)}" for _ in range(300)) for _ in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    settings = toxicity.Settings()
    tracemalloc.start()
    for part in bounded(batch, 0, toxicity.BLOCK):
        toxicity.once_per_text(*toxicity.grams(part.column(0).to_pylist(), settings), settings.bits)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 48 << 20
