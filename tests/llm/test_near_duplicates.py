import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from featureflow.llm import near_duplicates as near
from tests.llm.cases import TEXTS, documents, plain


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(pick, words, times, fresh):
    words = list(words)
    for _ in range(times):
        i = pick.randrange(len(words))
        words[i : i + pick.randrange(2)] = [f"e{fresh}x{pick.randrange(10**6)}"] * pick.randrange(2)
    return words


def test_banded_distance(spark):
    pick = random.Random(2)
    for _ in range(4000):
        a = [pick.randrange(4) for _ in range(pick.randrange(14))]
        b = list(a) if pick.random() < 0.6 else [pick.randrange(4) for _ in range(pick.randrange(14))]
        for _ in range(pick.randrange(4)):
            if b:
                i = pick.randrange(len(b))
                b[i : i + pick.randrange(2)] = [pick.randrange(4)] * pick.randrange(3)
        most = pick.randrange(9)
        assert near.distance(np.array(a), np.array(b), most) == min(edit_distance(a, b), most + 1)


def corpus():
    pick = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    texts, shared = [], [pick.choice(words) for _ in range(40)]
    for g in range(30):
        base = [pick.choice(words) for _ in range(pick.randrange(60, 300))]
        if g % 3 == 0:
            base[10:10] = shared  # a passage that many texts share
        for c in range(pick.choice([1, 2, 5, 40])):
            texts.append(edited(pick, base, c and len(base) // 50, g))
    texts += [texts[0], texts[0], ["a"], ["a"], ["b", "c"]]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def true_classes(rows, least=0.8):
    words = [t.split() for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(words):
        for j in range(i):
            if a and min(len(a), len(words[j])) >= least * max(len(a), len(words[j])):
                ids = {w: k for k, w in enumerate({*a, *words[j]})}
                x, y = (np.array([ids[w] for w in t]) for t in (a, words[j]))
                if near.similar(x, y, least):
                    parent[max(root(i), root(j))] = min(root(i), root(j))
    return {rows[i][0]: rows[root(i)][0] for i in range(len(rows))}


@pytest.mark.parametrize("early, few", [(6, 32), (1, 2)])
def test_classes_against_brute_force(spark, early, few):
    rows = corpus()
    got = near.classes(documents(spark, rows), near.Settings(early=early, few=few)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == true_classes(rows)


def test_chain_of_links_is_one_class(spark):
    labels = spark.createDataFrame([(i, i) for i in [*range(41), 90, 100, 200, 300]], "node long, label long")
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90)], "a long, b long")
    first = near.components(labels, links)
    assert {r["node"]: r["label"] for r in first.collect()} == {**{i: 0 for i in range(41)}, 90: 90, 100: 90, 200: 200, 300: 300}
    more = near.components(first, spark.createDataFrame([(40, 100), (7, 200)], "a long, b long"))
    assert {r["node"]: r["label"] for r in more.collect()} == {**{i: 0 for i in range(41)}, 90: 0, 100: 0, 200: 0, 300: 300}


def test_edge_rows(spark):
    got = near.classes(documents(spark)).select("doc_id", "class_id").collect()
    same, other = 1, 7
    expected = [(1, same), (1, same), (2, 2), (3, 3), (None, None), (None, None), (4, 4), (5, 5), (6, 6), (7, same), (7, other)]
    assert plain(got) == plain(expected)
    assert near.classes(documents(spark, [])).count() == 0


def test_representatives(spark):
    docs = documents(spark)
    kept = near.representatives(docs)
    assert kept.columns == docs.columns
    expected = [(1, TEXTS[0][1]), (2, None), (3, ""), TEXTS[4], (None, None), TEXTS[6], TEXTS[7], TEXTS[8], TEXTS[10]]
    assert plain(r[:2] for r in kept.collect()) == plain(expected)
    assert near.representatives(documents(spark, [])).count() == 0


def test_last_step_compares_what_shares_rare_kmers(spark):
    """All pairs of nodes that share a k-mer of few texts, and each with the first of a more common one."""
    pick = random.Random(11)
    rows, common = [], [f"common{i}" for i in range(12)]
    for g in range(25):
        base = [f"w{pick.randrange(300)}" for _ in range(pick.randrange(20, 40))]
        for _ in range(4):
            rows.append(common + edited(pick, base, pick.randrange(5), g))
    arrays = {i: np.array([zlib.crc32(w.encode()) for w in t], np.uint32) for i, t in enumerate(rows)}
    words = spark.createDataFrame([(i, a.tobytes()) for i, a in arrays.items()], "node long, words binary")
    labels = spark.createDataFrame([(i, i // 2) for i in arrays], "node long, label long")
    settings = near.Settings(few=20, taken=10**6)
    got = {(r["a"], r["b"]) for r in near.candidates(words, labels, settings).collect()}
    kmers = {i: {tuple(a[k : k + 5].tolist()) for k in range(len(a) - 4)} for i, a in arrays.items()}
    n = Counter(k for ks in kmers.values() for k in ks)
    fits = lambda i, j: i // 2 != j // 2 and min(len(rows[i]), len(rows[j])) >= 0.8 * max(len(rows[i]), len(rows[j])) - 1e-9
    expected = {(i, j) for i in arrays for j in arrays if i < j and fits(i, j) and any(n[k] <= 20 for k in kmers[i] & kmers[j])}
    expected |= {(min(i for i in kmers if k in kmers[i]), j) for j in arrays for k in kmers[j] if n[k] > 20 and fits(min(i for i in kmers if k in kmers[i]), j)}
    assert got == expected and len(got) < len(rows) * (len(rows) - 1) / 4
    fewer = {(r["a"], r["b"]) for r in near.candidates(words, labels, near.Settings(few=20, taken=8)).collect()}
    assert len(fewer & expected) > len(expected) / 3


def passage_texts(n):
    """Texts of 85 words that share 60 of them in a row and nothing else."""
    pick = random.Random(13)
    passage = [f"p{i}" for i in range(60)]
    out = []
    for i in range(n):
        own = [f"x{pick.randrange(10**9)}" for _ in range(20)] + [f"c{pick.randrange(30)}" for _ in range(5)]
        at = pick.randrange(26)
        out.append((i, " ".join(own[:at] + passage + own[at:])))
    return out


def test_common_passage_makes_few_pairs(spark, monkeypatch):
    made, real = [], near.linked

    def counted(pairs, words, settings):
        made.append(pairs.count())
        return real(pairs, words, settings)

    monkeypatch.setattr(near, "linked", counted)
    for n in (150, 300):
        got = near.classes(documents(spark, passage_texts(n))).select("doc_id", "class_id").collect()
        assert all(r["doc_id"] == r["class_id"] for r in got)
    first, second = sum(made[:3]), sum(made[3:])
    assert second < 3 * first and second < 300 * 100


@pytest.mark.parametrize("similarity, least", [(0.8, 0.8), (0.85, 0.9), (0.9, 0.9)])
def test_recall_by_edit_similarity(spark, similarity, least):
    """Texts of 100 words and a copy with single words replaced all over it."""
    pick = random.Random(17)
    rows = []
    for i in range(120):
        base = [f"w{pick.randrange(5000)}" for _ in range(100)]
        copy = list(base)
        for at in pick.sample(range(100), round(100 * (1 - similarity))):
            copy[at] = f"new{pick.randrange(10**9)}"
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(copy))]
    found = near.classes(documents(spark, rows)).where("class_id <> doc_id").count()
    assert found >= least * 120


def test_order_matters(spark):
    pick = random.Random(9)
    words = [f"w{i}" for i in range(200)]
    blocks = [words[i : i + 20] for i in range(0, 200, 20)]
    pick.shuffle(blocks)
    rows = [(1, " ".join(words)), (2, " ".join(sum(blocks, [])))]
    got = {r["doc_id"]: r["class_id"] for r in near.classes(documents(spark, rows)).collect()}
    assert got == {1: 1, 2: 2}


def hidden_pairs(seed):
    """Texts that share a passage of 40 words; but for two in each of three groups their own words make them unlike."""
    pick = random.Random(seed)
    rows, pairs = [], []
    for g in range(3):
        passage = [f"g{g}p{i}" for i in range(40)]
        sizes = [13] * 44 + [5, 5]
        pick.shuffle(sizes)
        ids = []
        for size in sizes:
            own = [f"x{pick.randrange(10**9)}" for _ in range(size)]
            if size == 5:
                ids.append(len(rows))
            rows.append((len(rows), " ".join(own + passage)))
        pairs.append(ids)
    return rows, pairs


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_that_share_a_common_passage_alone(spark, seed):
    """All k-mers they have in common are held by many texts, with another one first."""
    rows, pairs = hidden_pairs(seed)
    expected = {i: i for i, _ in rows} | {b: a for a, b in pairs}
    assert true_classes(rows) == expected
    got = near.classes(documents(spark, rows)).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == expected


@pytest.mark.parametrize("similarity", [0.6, 0.8, 0.9])
def test_exact_candidates_hold_all_similar_pairs(spark, similarity, monkeypatch):
    """Also in short texts of few different words, for words and for pairs of words."""
    pick = random.Random(23)
    arrays, of = {}, {}
    for g in range(40):
        base = [pick.randrange(60) for _ in range(pick.randrange(1, 40))]
        for _ in range(4):
            text = list(base)
            for _ in range(pick.randrange(1 + len(base) // 4)):
                i = pick.randrange(len(text))
                text[i : i + pick.randrange(2)] = [pick.randrange(60)] * pick.randrange(3)
                text = text or [0]
            if tuple(text) not in of:
                of[tuple(text)] = len(arrays)
                arrays[len(arrays)] = np.array(text, np.uint32)
    words = spark.createDataFrame([(i, i // 2, a.tobytes()) for i, a in arrays.items()], "node long, label long, words binary")
    settings = near.Settings(similarity=similarity)
    expected = {(i, j) for i in arrays for j in arrays if i < j and i // 2 != j // 2 and near.similar(arrays[i], arrays[j], similarity)}
    real = near.rarest_kmers
    for k in (1, 2) if similarity >= 0.75 else (1,):  # whichever is chosen, under another's order too
        monkeypatch.setattr(near, "rarest_kmers", lambda some, _, shared, s, k=k: real(some, k, shared, s))
        got = {(r["a"], r["b"]) for r in near.exact_candidates(words, settings).collect()}
        assert expected and expected <= got and len(got) < len(arrays) * (len(arrays) - 1) / 2


def test_repeats_and_large_classes_meet_once_for_each_run(spark, monkeypatch):
    """Texts that repeat two words up to a hundred times after words of their own, 60 of them in one class."""
    pick = random.Random(29)
    arrays = {}
    for i in range(120):
        own = [10 + pick.randrange(10**6) for _ in range(20 + i % 7)] + [pick.randrange(2, 9) for _ in range(20)]
        arrays[i] = np.array(own + [0, 1] * pick.randrange(85, 100), np.uint32)
    words = spark.createDataFrame([(i, min(i, 60) + 1000, a.tobytes()) for i, a in arrays.items()], "node long, label long, words binary")
    held, real = [], near.stored

    def seen(df, name):
        out = real(df, name)
        if {"kmer", "needed"} <= set(out.columns):
            held.append(out)
        return out

    monkeypatch.setattr(near, "stored", seen)
    got = {(r["a"], r["b"]) for r in near.exact_candidates(words, near.Settings()).collect()}
    expected = {(i, j) for i in arrays for j in arrays if i < j and min(i, 60) != min(j, 60) and near.similar(arrays[i], arrays[j], 0.8)}
    assert expected and expected <= got
    often = held[-1].groupBy("kmer").count()
    met = often.agg(F.sum(F.expr("count * (count - 1) / 2"))).first()[0]
    assert met <= 12 * 61 * 60 / 2


def repeating_texts(n):
    """Texts of 780 words, 550 of them two words in turn; every tenth is like the one before."""
    pick = random.Random(31)
    arrays = {}
    for i in range(n):
        own = [2 + pick.randrange(2000) for _ in range(230)]
        if i % 10 == 9:
            own = list(arrays[i - 1][:230])
            for at in pick.sample(range(230), 40):
                own[at] = 3000 + pick.randrange(10**6)
        arrays[i] = np.array(own + [0, 1] * 275, np.uint32)
    return arrays


def test_repeats_that_fill_most_of_a_text_make_few_pairs(spark, monkeypatch):
    """Long runs stand for the short ones of the same words, and signatures tell the rest of the texts apart."""
    arrays = repeating_texts(120)
    words = spark.createDataFrame([(i, i // 2 if i % 20 > 15 else 100 + i, a.tobytes()) for i, a in arrays.items()], "node long, label long, words binary")
    labels = {r["node"]: r["label"] for r in words.collect()}
    held, real, ranked = [], near.stored, near.rarest_kmers

    def seen(df, name):
        out = real(df, name)
        if {"kmer", "needed"} <= set(out.columns):
            held.append(out)
        return out

    monkeypatch.setattr(near, "stored", seen)
    monkeypatch.setattr(near, "rarest_kmers", lambda some, _, shared, s: ranked(some, 2, shared, s))
    got = {(r["a"], r["b"]) for r in near.exact_candidates(words, near.Settings()).collect()}
    pairs = [(i, j) for i in arrays for j in arrays if i < j and labels[i] != labels[j]]
    expected = {(i, j) for i, j in pairs if near.similar(arrays[i], arrays[j], 0.8)}
    assert expected and expected <= got
    assert len(got) < len(expected) + len(pairs) / 4
    met = held[-1].groupBy("kmer").count().agg(F.sum(F.expr("count * (count - 1) / 2"))).first()[0]
    assert met < 4 * len(pairs)


def test_class_signatures_bound_all_members(spark):
    arrays = repeating_texts(40)
    rows = [(i, i % 7 if i < 30 else i, a.tobytes()) for i, a in arrays.items()]
    nodes = near.signatures(spark.createDataFrame(rows, "node long, label long, words binary")).collect()
    found = near.class_signatures(spark.createDataFrame(nodes, "node long, label long, n_words int, signature array<long>")).collect()
    classes = {r["label"]: r for r in found}
    assert len(classes) == len(found) == 17
    bits = lambda a, b: sum(bin((x ^ y) & (2**64 - 1)).count("1") for x, y in zip(a, b))
    apart = {k: [bits(c["signature"], r["signature"]) for r in nodes if r["label"] == k] for k, c in classes.items()}
    assert all(max(apart[k]) == c["radius"] and min(apart[k]) == 0 for k, c in classes.items())
