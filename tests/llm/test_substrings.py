import random

import pyarrow as pa
from pyspark.sql import functions as F

from featureflow.llm import substrings
from tests.llm.cases import LONG, TEXTS, documents, plain


def words(pick, n):
    return [f"w{pick.randrange(10**6)}é" for _ in range(n)]


def corpus():
    pick = random.Random(8)
    passages = [words(pick, n) for n in (60, 80, 120)]
    rows = []
    for i in range(60):
        text = words(pick, pick.randrange(20, 200))
        if i % 4 == 0:
            at = pick.randrange(len(text))
            text[at:at] = passages[i // 4 % 3]
        if i % 4 == 1:
            text += text[:15]  # too short, and within the text itself
        rows.append((i, " ".join(text)))
    return rows


def test_planted_passages(spark):
    rows = corpus()
    for bunch in (1_000_000, 50):
        found = substrings.repeats(documents(spark, rows), substrings.Settings(bunch=bunch, slice_bytes=4000)).collect()
        assert {r["doc_id"] for r in found if r["passages"]} == {i for i, _ in rows if i % 4 == 0}
        text = dict(rows)
        for r in found:
            for p in r["passages"]:
                part = text[r["doc_id"]][p["start"] : p["end"]]
                assert len(part.split()) == p["words"] >= 25
                assert any(part.strip() in t for i, t in rows if i != r["doc_id"])
    kept = {r["doc_id"] for r in found if r["passages"] and not r["removable"]}
    assert kept == {0, 4, 8}  # the first text with each passage


def test_cutting_out(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = substrings.repeats(docs)
    cut = docs.join(found.select("doc_id", "removable"), "doc_id").select("doc_id", substrings.without(F.col("text"), F.col("removable")).alias("text"))
    again = substrings.repeats(cut).collect()
    assert not [r for r in again if r["passages"]]


def test_cuts_resist_insertions():
    pick = random.Random(3)
    text = " ".join(words(pick, 400))
    one = substrings.Chunks(pa.array([text]), substrings.Settings())
    two = substrings.Chunks(pa.array(["padding", "inserted words " + text[:2000] + " more " + text[2000:]]), substrings.Settings())
    assert len(set(one.digest.tolist()) - set(two.digest.tolist())) <= 6


def test_chunks_cover_texts():
    texts = [t for _, t in TEXTS] + ["é" * 3000, "x" * 3000, "\U0001f600" * 700, " " * 700, LONG[:5000]]
    c = substrings.Chunks(pa.array(texts), substrings.Settings())
    for i, text in enumerate(texts):
        ends = c.point_ends[c.first[i] : c.first[i + 1]]
        assert (ends[-1] if len(ends) else 0) == len(text or "")
        assert all(a < b for a, b in zip(ends, ends[1:]))
        assert c.words[c.first[i] : c.first[i + 1]].sum() == len((text or "").replace("\x1c", "x").split())
        assert all(b - a <= 260 for a, b in zip([0, *ends], ends))


def test_edge_rows(spark):
    rows = substrings.repeats(documents(spark)).collect()
    assert len(rows) == len(TEXTS)
    assert not [r for r in rows if r["passages"]]  # texts are short, or repeated in themselves alone
    more = [*TEXTS, (8, LONG), (None, LONG)]
    found = substrings.passages(substrings.repeats(documents(spark, more))).select("doc_id", "start", "end", "removable").collect()
    n = len(LONG)
    assert plain(found) == plain([(5, 0, n, True), (8, 0, n, True), (None, 0, n, False)])
    assert substrings.repeats(documents(spark, [])).count() == 0


def test_texts_of_one_id_with_half_their_digest_in_common(spark):
    passage = " ".join(f"word{i}" for i in range(40))
    pairs = [(68864, 278861), (142508, 156223), (13332, 59595)]
    for a, b in pairs:
        texts = [f"{passage} {a}", f"{passage} {b}"]
        digest = substrings.Chunks(pa.array(texts), substrings.Settings()).text.astype("u8")
        assert digest[0] >> 32 == digest[1] >> 32
        for doc in (None, 7):
            found = substrings.repeats(documents(spark, [(doc, t) for t in texts])).collect()
            assert len(found) == 2 and all(r["passages"] and r["n_repeated"] < r["n_chunks"] for r in found)
