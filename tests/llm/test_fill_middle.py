import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from featureflow.llm import fill_middle as fim
from tests.llm.cases import LONG, TEXTS, documents


@pytest.mark.parametrize("size", [1, 2, 7, 8, 9, 100, 5000, 70_000])
def test_every_rank_is_reached(size):
    widths = np.random.default_rng(size).integers(0, 9, size)
    units, total = fim.SkipList(widths), np.concatenate([[0], np.cumsum(widths)])
    assert len(units.lanes) == 1 or len(units.lanes[-1].units) < size
    for rank in {*random.Random(size).sample(range(size + 1), min(size, 300)), 0, size}:
        assert units.points_before(rank) == total[rank]


def test_lanes_carry_the_widths_they_skip():
    widths = np.random.default_rng(1).integers(1, 5, 20_000)
    for lane in fim.SkipList(widths).lanes:
        assert lane.units.sum() == len(widths) and lane.points.sum() == widths.sum()


def brute(doc_id, text, pattern=None):
    """The contract said with slices."""
    text = text or ""
    h = hashlib.sha256(b"1:" + ("" if doc_id is None else str(doc_id)).encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    ends = list(range(len(text) + 1)) if pattern is None else [0, *[m.end() for m in re.finditer(pattern, text)]]
    n = len(ends) - 1
    if text == "" or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = ends[min(h1 % (n + 1), h2 % (n + 1))], ends[max(h1 % (n + 1), h2 % (n + 1))]
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def corpus():
    pick = random.Random(3)
    signs = "ab<P>SM é漢\U0001f600́\n\r\t"
    return [(i, "".join(pick.choice(signs) for _ in range(pick.randrange(40)))) for i in range(600)]


@pytest.mark.parametrize("unit", [None, r"\s*\S+\s*", r"(?s)."])
def test_against_slices_and_back(spark, unit):
    rows = [r for r in corpus() if unit != r"\s*\S+\s*" or r[1].strip()]
    settings = fim.Settings(unit=unit)
    made = fim.transform(documents(spark, rows), settings)
    made = made.withColumn("back", fim.restored(F.col("output"), F.col("form"), settings)).collect()
    assert {r["doc_id"]: (r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in made} == {
        i: brute(i, t, unit) for i, t in rows
    }
    assert {r["doc_id"]: r["back"] for r in made} == dict(rows)
    assert {r["form"] for r in made} == {"plain", "psm", "spm"}


def test_other_marks_and_shares(spark):
    settings = fim.Settings(prefix="[[prefix]]", suffix="|", middle="~~", plain_percent=0, spm_percent=50)
    rows = [(i, f"text {i} é") for i in range(100)]
    made = fim.transform(documents(spark, rows), settings)
    back = {r["doc_id"]: (r["form"], r["back"]) for r in made.withColumn("back", fim.restored(F.col("output"), F.col("form"), settings)).collect()}
    assert {i: t for i, (_, t) in back.items()} == dict(rows)
    assert {f for f, _ in back.values()} == {"psm", "spm"}


def test_unmatched_text_belongs_to_a_unit():
    words = re.compile(r"\w+")
    assert fim.unit_widths("  ab, cd.", words).tolist() == [4, 5]
    assert fim.unit_widths("...", words).tolist() == [3]
    assert fim.unit_widths("", words).tolist() == []


def test_edge_rows(spark):
    docs = documents(spark)
    made = fim.transform(docs)
    assert [c for c in docs.columns if c not in made.columns] == []
    got = sorted([(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in made.collect()], key=repr)
    assert got == sorted((brute(i, t) for i, t in TEXTS), key=repr)
    assert all(r["score"] == "own score" for r in made.collect())
    clashing = docs.withColumn("FORM", F.lit(1)).withColumn("output", F.lit("x")).withColumn("N", F.lit(2))
    assert fim.transform(clashing).columns[-5:] == fim.FIELDS.names
    assert fim.transform(clashing).where("doc_id = 3").first()["form"] == "plain"
    sums = {r["doc_id"]: r for r in fim.digests(docs).where("doc_id IN (5, 6)").collect()}
    assert sums[5]["restored_sha256"] == hashlib.sha256(LONG.encode()).hexdigest() and sums[5]["n"] == len(LONG)
    assert fim.digests(documents(spark, [])).count() == 0
