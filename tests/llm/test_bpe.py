import hashlib
import random

import public_tokenizers
import pytest
import tokenizers

from featureflow.llm import bpe
from tests.llm.cases import TEXTS, documents

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def model():
    return bpe.WordBpe(bpe.read_vocabulary(PATH))


@pytest.fixture(scope="module")
def library():
    made = tokenizers.Tokenizer.from_file(PATH)
    made.no_padding()
    made.no_truncation()
    return made


def agree(model, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert model.encode(text) == ids, repr(text)
    assert model.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_random_strings(model, library):
    pick = random.Random(5)
    signs = "aabcdet</w> >|'sStTΣσςéÉé \n\t\x1d\x85İıſK1²9³é漢\U0001f600<|endoftext|>"
    for _ in range(5000):
        text = "".join(pick.choice(signs) for _ in range(pick.randrange(30)))
        if pick.random() < 0.2:
            text = text.replace("a", "<|endoftext|>").replace("b", "<|startoftext|>")
        agree(model, library, text)


def test_long_runs(model, library):
    for text in ("a" * 5000, "ab" * 3000, "!" * 3000, "thethethe" * 700, "é" * 2000, "1" * 50):
        agree(model, library, text)


def test_cache_generations(model, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 1500)
    monkeypatch.setattr(bpe, "CACHE_PAIRS", 5)
    for text in ("some words come and go again and some come back", "come back words, come and go", "some words"):
        agree(model, library, text)


def test_digests_and_round_trip(spark, library):
    docs = documents(spark)
    vocabulary = bpe.read_vocabulary(PATH)
    rows = bpe.encoding_digests(docs, vocabulary).collect()
    assert len(rows) == len(TEXTS)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha(" ".join(map(str, ids)))
        assert r["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))
        assert r["score"] == "own score"
    both = bpe.encode_with_digests(docs, vocabulary).collect()
    key = lambda r: (str(r["doc_id"]), str(r["text"]))
    for r, one in zip(sorted(both, key=key), sorted(rows, key=key)):
        assert r["token_ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids
        assert all(r[c] == one[c] for c in bpe.OUTPUT.names) and r["bucket"] == "own bucket"
    back = bpe.decode(bpe.encode(docs, vocabulary), vocabulary).collect()
    assert all(r["decoded"] == library.decode(r["token_ids"], skip_special_tokens=False) for r in back)


def test_empty_table(spark):
    assert bpe.encoding_digests(documents(spark, []), bpe.read_vocabulary(PATH)).count() == 0
