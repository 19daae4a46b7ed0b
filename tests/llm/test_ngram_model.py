import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from featureflow.llm import ngram_model as lm
from tests.llm.cases import TEXTS, documents


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()) + [None]


def corpus(n=200):
    pick = random.Random(1)
    words = [f"w{i}" for i in range(60)]
    texts = [(i, " ".join(pick.choice(words[: pick.choice([5, 60])]) for _ in range(pick.randrange(60)))) for i in range(n)]
    return texts + [(500, "Rare\x0bWORD é unseen here"), (500, "Rare\x0bWORD é unseen here"), *TEXTS]


@pytest.mark.parametrize("exact", [1 << 19, 8, 0])
def test_base_scores_against_brute_force(spark, exact):
    rows = corpus()
    docs = documents(spark, rows)
    train = ~F.coalesce(F.col("doc_id") % 7 == 3, F.lit(False))
    model, counts = lm.fit(docs, train, lm.Settings(exact=exact, buffer=50))
    seen = collections.Counter(t for i, text in rows if i is None or i % 7 != 3 for t in tokens(text))
    n, v = sum(seen.values()), len(seen)
    assert (model.tokens, model.distinct) == (n, v)
    got = lm.score(docs.select("doc_id", "text", F.col("text").alias("same"), "score"), model, counts).collect()
    assert len(got) == len(rows)
    for r in got:
        ts = tokens(r["same"])
        base = sum(math.log10((seen[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)
        assert r["n_tokens"] == len(ts) and r["n_known"] == sum(seen[t] > 0 for t in ts)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)


def test_levels_read_back_from_the_filter(spark):
    rows = corpus()
    docs = documents(spark, rows)
    model, _ = lm.fit(docs, settings=lm.Settings(exact=0, slice_tokens=500, event_bits=24, probes=8))
    assert len(model.begins) > 5
    counted = collections.Counter(t for _, text in rows for t in tokens(text))
    ordered = [t for t in counted if t is not None]
    h = lm.Tokens(pa.array([t.decode() for t in ordered])).hashes
    h = h[h != lm.END]
    level = lm.levels(model, lm.single_keys(h))
    assert (level >= [1 + int(math.log2(counted[t])) for t in ordered]).all()
    assert np.mean(level == [1 + int(math.log2(counted[t])) for t in ordered]) > 0.98
    unseen = lm.single_keys(np.arange(1, 20_001, dtype=np.uint64) * lm.GOLDEN)
    assert np.mean(lm.levels(model, unseen) > 0) < 0.01


def test_pairs_help_on_text_like_the_training_text(spark):
    phrase = "one two three four five six seven eight"
    docs = spark.createDataFrame([(i, phrase) for i in range(50)] + [(99, " ".join(reversed(phrase.split())))], "doc_id long, text string")
    model, counts = lm.fit(docs, F.col("doc_id") < 40)
    rows = {r["doc_id"]: r for r in lm.score(docs, model, counts).collect()}
    assert rows[45]["score"] > rows[45]["base_score"] + 3
    assert rows[99]["score"] < rows[45]["score"]


def test_shares_after_a_history_add_up_to_one_at_most(spark):
    rows = corpus(120)
    model, _ = lm.fit(documents(spark, rows))
    words = sorted({t for _, text in rows for t in tokens(text) if t is not None})
    texts = pa.array([f"w1 {w.decode()}" for w in words])
    t = lm.Tokens(texts)
    p = 10 ** lm.log_probabilities(model, t, lm.lookup(t.hashes, model.known, model.counts))
    after = p[t.first + 1].sum() + p[lm.Tokens(pa.array(["w1"])).first + 0][0] * 0
    assert 0.5 < after < 1.02


def test_bounded_filter_keeps_the_frequent(spark):
    docs = documents(spark, corpus())
    free, _ = lm.fit(docs, settings=lm.Settings(exact=0))
    tight, _ = lm.fit(docs, settings=lm.Settings(exact=0, max_bits=len(free.bits) * 4))
    assert tight.least_level > 1 and len(tight.bits) <= len(free.bits) // 2 + 16


@pytest.mark.parametrize("exact", [8, 0])
def test_filter_beyond_a_broadcast_scores_the_same(spark, exact):
    docs = documents(spark, corpus()).withColumn("at", F.timestamp_seconds("doc_id")).repartition(3, "text")
    train = ~F.coalesce(F.col("doc_id") % 7 == 3, F.lit(False))
    results = []
    for more in ({}, {"broadcast_bits": 0, "bunch_bytes": 2000}):
        model, counts = lm.fit(docs, train, lm.Settings(exact=exact, slice_tokens=500, **more))
        assert model.least_level == 1 and (model.parts is None) == (not more)
        rows = lm.score(docs.select("doc_id", "text", "at", F.col("text").alias("same")), model, counts).collect()
        results.append(sorted(map(repr, ((r["doc_id"], r["same"], r["at"], r["n_known"], round(r["score"], 9)) for r in rows))))
    assert results[0] == results[1]


def test_all_levels_are_kept_by_default():
    assert lm.Settings().max_bits is None


def test_empty_tables(spark):
    none = documents(spark, [])
    model, counts = lm.fit(none)
    assert (model.tokens, model.distinct) == (0, 0)
    assert lm.score(none, model, counts).count() == 0
    rows = lm.score(documents(spark), model, counts).collect()
    assert len(rows) == len(TEXTS) and all(r["n_known"] == 0 and math.isfinite(r["score"]) for r in rows)
