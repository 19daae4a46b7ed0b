import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from featureflow.llm import quality
from tests.llm.cases import LONG, TEXTS, documents


def brute(text):
    """The statistics said character by character."""
    text = text or ""
    space = set(" \t\n\v\f\r\x1c\x1d\x1e\x1f")
    words, word = [], ""
    for c in text + " ":
        if c in space:
            words += [word] if word else []
            word = ""
        else:
            word += c
    lines = [x for x in text.split("\n") if x]
    upper, small, digit = (lambda c: "A" <= c <= "Z"), (lambda c: "a" <= c <= "z"), (lambda c: "0" <= c <= "9")
    clause = lambda c: c in ".,;:!?'\"()-"
    sign = lambda c: "!" <= c <= "~" and not (upper(c) or small(c) or digit(c) or clause(c))
    letter = lambda c: upper(c) or small(c) or c > "\x7f"
    logit = lambda part, whole: math.log((part + 0.5) / (max(whole - part, 0) + 0.5))
    count = lambda kind: sum(map(kind, text))
    lengths, n = [len(w) for w in words], len(words)
    mean = sum(lengths) / max(n, 1)
    spread = math.sqrt(max(sum(x * x for x in lengths) / max(n, 1) - mean * mean, 0))
    pairs = list(zip(words, words[1:]))
    # The last byte of a word is left out; a character beyond ASCII is no sign anyway.
    inside = sum(any(sign(c) or clause(c) for c in w[:-1]) for w in words)
    capital = sum(sum(map(letter, w)) > 1 and all(upper(c) for c in w if letter(c)) for w in words)
    return [
        math.log1p(n), math.log1p(mean), math.log1p(spread), math.log1p(max(lengths, default=0)), math.log1p(len(lines)), math.log1p(n / max(len(lines), 1)),
        logit(count(upper), count(upper) + count(small)), logit(count(digit), len(text)), logit(count(lambda c: c > "\x7f"), len(text)),
        logit(count(clause), len(text)), logit(count(sign), len(text)), logit(count(lambda c: c in space), len(text)),
        logit(sum(not any(map(letter, w)) for w in words), n), logit(inside, n), logit(capital, n),
        logit(n - len(set(words)), n), logit(max(Counter(words).values(), default=0), n), logit(len(lines) - len(set(lines)), len(lines)),
        logit(len(pairs) - len(set(pairs)), max(n - 1, 0)),
    ]


def test_statistics_against_characters():
    pick = random.Random(4)
    texts = ["".join(pick.choice("aaBC1é漢 .#\n\t-") for _ in range(pick.randrange(60))) for _ in range(400)]
    texts += [t for _, t in TEXTS] + ["UP UP up\nUP UP up", "\n\n", " "]
    got = quality.statistics(pa.array(texts))
    assert np.allclose(got, [brute(t) for t in texts], atol=1e-5)
    assert np.allclose(quality.statistics(pa.array(texts).slice(5, 9)), got[5:14])
    assert quality.statistics(pa.array([], pa.string())).shape == (0, len(quality.STATISTICS))


def corpus(n=600):
    pick = random.Random(8)
    rows, labels = [], []
    for i in range(n):
        good = pick.random() < 0.7
        words = [pick.choice(["river", "stone", "of", "the", "light", "Under", "moves"]) + str(pick.randrange(50)) * (not good) for _ in range(pick.randrange(5, 80))]
        if not good:
            words = [w + pick.choice(["###", "", "$$$"]) for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, int(good)))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int")


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    docs = quality.with_statistics(documents(spark, rows))
    extra = [(None, 1), (3, None), (10**6, 0), labels[0]]
    return docs, quality.fit(docs, labelled(spark, labels + extra), train=F.col("doc_id") % 4 != 2), rows, dict(labels)


def test_model_against_plain_algebra(spark, fitted):
    docs, model, rows, labels = fitted
    settings = model.settings
    taught = [(brute(t), labels[i]) for i, t in rows if i % 4 != 2]
    x, y = np.array([s for s, _ in taught], np.float32).astype(float), np.array([k for _, k in taught])
    z = np.clip((x - x.mean(0)) / np.where(x.std(0) > 1e-6, x.std(0), 1), -settings.bound, settings.bound)
    common = sum(np.cov(z[y == k].T, bias=True) * np.mean(y == k) for k in (0, 1))
    everything = np.array([brute(t) for _, t in rows], np.float32).astype(float)
    every = np.clip((everything - x.mean(0)) / np.where(x.std(0) > 1e-6, x.std(0), 1), -settings.bound, settings.bound)
    logs = []
    for k in (0, 1):
        s = quality.shrunk(np.cov(z[y == k].T, bias=True), common, np.sum(y == k), settings)
        away = every - z[y == k].mean(0)
        logs.append(np.log(np.mean(y == k)) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", away, np.linalg.inv(s), away))
    expected = 1 / (1 + np.exp(-np.clip(model.slope * (logs[1] - logs[0]) + model.shift, -40, 40)))
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert np.allclose([got[i] for i, _ in rows], expected, atol=1e-4)


def test_held_out_accuracy(spark, fitted):
    docs, model, rows, labels = fitted
    held = quality.score(docs, model).where("doc_id % 4 = 2").collect()
    assert np.mean([(r["score"] >= 0.7) == bool(labels[r["doc_id"]]) for r in held]) > 0.97
    assert held[0]["node"] == "own node"


def test_shrinking():
    common = np.diag([1.0, 2.0, 3.0])
    few, many = (quality.shrunk(np.zeros((3, 3)), common, n, quality.Settings(pooled=0.5)) for n in (2, 10**6))
    assert np.all(np.linalg.eigvalsh(few) > 0) and np.all(np.linalg.eigvalsh(many) > 0)
    # Few rows are drawn further towards equal variances.
    assert np.ptp(np.diag(few)) < np.ptp(np.diag(many))


def test_calibration_keeps_order_and_rates():
    values = np.linspace(-5, 5, 101)
    truth = 1 / (1 + np.exp(-(0.5 * values + 1)))
    slope, shift = quality.calibrated(np.stack([1000 * (1 - truth), 1000 * truth]), values)
    assert abs(slope - 0.5) < 0.01 and abs(shift - 1) < 0.02
    slope, shift = quality.calibrated(np.stack([(values < 0) * 1.0, (values >= 0) * 1.0]), values)
    assert 0 < slope < 20 and np.isfinite(shift)


def test_edge_rows(spark, fitted):
    _, model, _, _ = fitted
    got = quality.score(quality.with_statistics(documents(spark)), model).collect()
    assert len(got) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in got)
    by_text = {}
    for r in got:
        assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]
    assert LONG in by_text
    assert quality.score(quality.with_statistics(documents(spark, [])), model).count() == 0


def test_without_both_classes(spark):
    docs = quality.with_statistics(documents(spark))
    for labels, expected in (([], 0.5), ([(1, 1)], 0.75), ([(1, 0)], 0.25)):
        scores = {round(r["score"], 6) for r in quality.score(docs, quality.fit(docs, labelled(spark, labels))).collect()}
        assert scores == {expected}
    one_each = quality.fit(docs, labelled(spark, [(5, 1), (6, 0)]))
    assert all(0 <= r["score"] <= 1 for r in quality.score(docs, one_each).collect())
