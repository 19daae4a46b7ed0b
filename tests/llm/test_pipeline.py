import hashlib
import random

import public_tokenizers
import pytest
import tokenizers

import corpus_pipeline
from tests.llm.cases import TEXTS, documents, plain
from tests.llm.test_decontaminate import words
from tests.llm.test_near_duplicates import edited, hidden_pairs, true_classes
from tests.llm.test_secrets import base

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra string"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents with toxic ones, near copies, benchmark passages and secrets, and the tables beside them."""
    pick = random.Random(6)
    vocabulary = [f"w{i}" for i in range(2000)]
    item = [f"item{i}" for i in range(15)]
    texts = {}
    for i in range(160):
        text = [pick.choice(vocabulary) for _ in range(60)]
        if i % 8 == 1:
            text[pick.randrange(60)] = "vileword"
        elif i % 8 == 2:
            text = edited(pick, texts[i - 2], 1, i)
        elif i % 8 == 3:
            text[20:20] = item
        elif i % 8 == 4:
            text[30:30] = ["password=abcdefgh12345678", "deadbeefdeadbeef0"]
        texts[i] = text
    rows = [(i, " ".join(t), "en", "s", len(" ".join(t)), "x") for i, t in texts.items()]
    rows += [(500, None, None, None, None, None), (501, "", "en", "s", 0, "x"), (0, rows[0][1], "en", "s", 1, "y")]
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i % 8 == 1)) for i in range(120)] + [(None, 1, 1), (3, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item)), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_each_stage_against_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = corpus_pipeline.stored(stage(spark, docs, tables), name)
        got[name] = (before, docs.collect())
        if name != "encoding":
            assert docs.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")

    before, after = got["toxicity"]
    assert sorted(map(repr, after)) == sorted(repr(r) for r in before if "vileword" not in (r["text"] or ""))

    before, after = got["near_duplicates"]
    texts = sorted({(r["doc_id"], r["text"]) for r in before if r["text"]})
    classes = true_classes(texts)
    assert sorted(r["doc_id"] for r in after) == sorted({*classes.values(), 500, 501})

    before, after = got["decontamination"]
    clean = [r for r in before if "item3 item4 item5 item6 item7 item8 item9 item10 item11 item12" not in " ".join(words(r["text"]))]
    assert len(clean) < len(before) and sorted(map(repr, after)) == sorted(map(repr, clean))

    before, after = got["secrets"]
    kept = {r["doc_id"]: r for r in after}
    assert kept.keys() == {r["doc_id"] for r in before}
    for r in before:
        new = kept[r["doc_id"]]
        assert (new["text"] == r["text"]) == (not base(r["text"] or ""))
        assert not base(new["text"] or "") and ("[SECRET]" in (new["text"] or "")) == bool(base(r["text"] or ""))

    before, after = got["encoding"]
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_padding()
    library.no_truncation()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    expected = []
    for r in before:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        sums = sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))
        expected.append((r["doc_id"], r["lang"], r["source"], r["extra"], ids, len(ids), *sums))
    columns = ("doc_id", "lang", "source", "extra", "token_ids", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted((tuple(r[c] for c in columns) for r in after), key=repr) == sorted(expected, key=repr)
    assert sorted(map(repr, corpus_pipeline.run(spark, tables).collect())) == sorted(map(repr, after))


def test_empty_documents(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
        assert docs.count() == 0


def test_edge_rows(spark, tables, tmp_path):
    """Nulls, empty and very long texts, repeats, and columns that bear names used inside."""
    docs = documents(spark, clashing=("score", "_key", "node", "secrets", "token_ids", "N_Tokens", "digest", "_text", "row"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, tables), name)
        if name != "encoding":
            assert docs.columns == columns
    kept = [TEXTS[0], (2, None), (3, ""), TEXTS[4], (None, None), *TEXTS[6:9], TEXTS[10]]
    assert plain((r["doc_id"],) for r in docs.collect()) == plain((i,) for i, _ in kept)
    assert {"score", "_key", "node", "secrets", "digest", "_text", "row"} <= set(docs.columns) and docs.where("row <> 'own row'").count() == 0
    lengths = {r["doc_id"]: r["n_tokens"] for r in docs.collect()}
    assert lengths[2] == lengths[3] == 0 and lengths[5] == 5 * 4000


def test_near_duplicates_that_share_a_common_passage_alone(spark):
    """The stage drops the second text of each pair, though all that it shares is held by many texts."""
    rows, pairs = hidden_pairs(1)
    kept = corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows), "").select("doc_id").collect()
    assert {r["doc_id"] for r in kept} == {i for i, _ in rows} - {b for _, b in pairs}
