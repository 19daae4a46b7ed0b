import pickle
import tracemalloc

import numpy as np
from pyspark import SparkContext
from pyspark.sql import functions as F

from featureflow.llm import language
from tests.llm.cases import TEXTS, documents

SAMPLES = {
    "en": "the cat and the dog went to the house where they live with that old man",
    "de": "der hund und die katze gingen zum haus in dem sie mit dem alten mann leben",
    "fr": "le chat et le chien sont allés à la maison où ils vivent avec ce vieil homme",
}


def corpus(spark):
    rows = [(i, text, lang) for i, (lang, text) in enumerate(sorted(SAMPLES.items()) * 3)]
    return spark.createDataFrame([*rows, (90, None, "en"), (91, "xyz", None)], "doc_id long, text string, lang string")


def test_words_then_shorter_grams(spark):
    model = language.fit(corpus(spark))
    assert model.languages == ["de", "en", "fr"]
    scorer = language.Scorer(model)
    names, scores = scorer.texts(["the dog", "DER Hund!", "le chien", "thecatty", None, "", "12 -- 34", "\U0001f600"])
    assert names == ["en", "de", "fr", "en", "und", "und", "und", "und"]
    assert all(0 <= s <= 1 for s in scores) and scores[4:] == [0.0] * 4


def test_mean_over_words_by_hand(spark):
    model = language.fit(corpus(spark), settings=language.Settings(longest=2))
    scorer = language.Scorer(model)
    word = lambda w: model.scores[0][w]
    grams = [g for g in (" z", "zh", "hu", "un", "nd", "d ") if g in model.scores[2]]
    unseen = sum(model.scores[2][g] for g in grams) / len(grams)
    mean = (word("the").astype(float) + word("dog") + unseen) / 3
    name, score = (x[0] for x in scorer.texts(["the dog, zhund"]))
    assert name == model.languages[mean.argmax()]
    expected = 1 / (10 ** (model.settings.sharpness * (mean - mean.max()))).sum() ** -1
    assert abs(score - 1 / expected) < 1e-6


def test_small_memory_changes_nothing(spark):
    model = language.fit(corpus(spark))
    texts = [*SAMPLES.values(), None, " ".join(SAMPLES.values())] * 2
    assert language.Scorer(model).texts(texts) == language.Scorer(model, remembered=6).texts(texts)


def test_edge_rows(spark):
    model = language.fit(corpus(spark), train=F.col("doc_id") != 0)
    found = language.identify(documents(spark), model)
    rows = found.collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert r["lang"] == "own lang" and r["score"] != "own score"


def test_empty_tables(spark):
    none = language.fit(corpus(spark).limit(0))
    assert none.languages == []
    assert {r["lang_pred"] for r in language.identify(corpus(spark), none).collect()} == {"und"}
    assert language.identify(documents(spark, []), language.fit(corpus(spark))).count() == 0


def test_workers_hold_one_matrix(spark, monkeypatch):
    """What a worker unpacks takes little more than its words, not an array for each."""
    sent, real = [], SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: sent.append(value) or real(self, value))
    words = {f"word{i}": np.array([-7.0, -i / 1e5, -1.0], np.float32) for i in range(30_000)}
    model = language.Model(language.Settings(), ["de", "en", "fr"], [words, {}, {}, {}, {}, {}])
    language.identify(documents(spark), model)
    packed = pickle.dumps(sent[0])
    tracemalloc.start()
    held = pickle.loads(packed)
    one = language.Scorer(held)
    before = tracemalloc.get_traced_memory()[0]
    two = language.Scorer(held)
    after = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert before < 300 * len(words) and after - before < 10_000
    assert one.texts(["word5 word6 none"]) == two.texts(["word5 word6 none"]) == language.Scorer(model).texts(["word5 word6 none"])
