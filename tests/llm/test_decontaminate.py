import hashlib
import random
import re

import pytest

from featureflow.llm import decontaminate
from tests.llm.cases import TEXTS, documents, plain

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for a in range(len(w) - n + 1 if n and item is not None else 0):
            windows.setdefault(tuple(w[a : a + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, met = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                if found := windows.get(tuple(w[a : a + n])):
                    hit.update(range(a, a + n))
                    met |= found
        ids = ",".join(sorted(map(str, met)))
        out.append((doc, len(w), len(hit), len(met), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


def check(spark, docs, items):
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(documents(spark, docs), table).drop("digest", "hits").collect()
    assert plain(got) == plain(brute(docs, items))


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    pick = random.Random(seed)
    signs = ["a", "b", "C", "é", "x1"]
    text = lambda n: " ".join(pick.choice(signs) for _ in range(pick.randrange(n)))
    docs = [(i, text(80)) for i in range(60)]
    items = [(i, pick.choice([text(5), text(14), text(30)])) for i in range(12)]
    items += [(50, " ".join(words(docs[3][1])[2:20])), (50, "a"), (None, "b"), (51, None), (52, "")]
    check(spark, docs, items)


def test_edge_rows(spark):
    items = [(1, "alpha beta gamma delta alpha beta gamma delta alpha beta gamma"), (1, "a few words"), (2, "same id")]
    check(spark, TEXTS, items)
    check(spark, TEXTS, [])
    check(spark, [], items)


def test_clean_keeps_rows_and_columns(spark):
    items = spark.createDataFrame([(1, "a few words in it")], "item_id long, text string")
    docs = documents(spark)
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    assert plain(kept.collect()) == plain(r for r in docs.collect() if "a few words" not in (r["text"] or ""))
