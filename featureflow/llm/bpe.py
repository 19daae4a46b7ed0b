"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word there is exactly one token that its encoding ends with. A token that
matches at the end of the prefix is that one if the encoding of what precedes it ends with a token
that may stand before it. Two tokens may stand side by side if, undoing their merges from the latest
to the earliest, no merge across the border would have come first. Back-pointers then give the ids.

Matches at all ends come from one automaton over the vocabulary, whose suffix links list the tokens
that end at a place, longest first.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.llm.common import add_columns, bounded, fresh

WORD_END = "</w>"
#: Bytes of chunks between white space kept ready per worker, in each of two generations, and the bytes
#: that an entry takes besides its characters. Workers are reused, so later stages run beside what is kept.
CACHE_BYTES, ENTRY_BYTES = 16 << 20, 330
#: Text handled at once, in bytes.
BLOCK = 1 << 20
#: Pairs of tokens whose test is remembered per worker.
CACHE_PAIRS = 400_000
NEVER = 1 << 62
SEPARATORS = re.compile("[\x1c-\x1f]")
#: A code point that no Unicode version has assigned.
UNASSIGNED = "\u0378"

OUTPUT = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


class WordBpe:
    """Encoder of a vocabulary file with word ends, given as the file's JSON text.

    Inside, a word is a string with one character per byte; the last byte of a word has its own
    character, as a word's last symbol differs from the same byte elsewhere.
    """

    def __init__(self, file_text: str):
        spec = json.loads(file_text)
        model = spec["model"]
        if model.get("type") != "BPE" or model.get("end_of_word_suffix") != WORD_END:
            raise ValueError("the file holds no BPE model with word ends")
        vocab = model["vocab"]
        self.token = {i: t for t, i in vocab.items()}
        self.special = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        self.token.update({i: t for t, i in self.special.items()})
        patterns = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.words = regex.compile(patterns[0])
        self.special_tokens = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        self.byte_of = {c: b for b, c in enumerate(printable_bytes())}

        shape, self.rank, self.left, self.right, self.merge = {}, {}, {}, {}, {}
        for token, i in vocab.items():
            ended = token.endswith(WORD_END)
            body = token[: -len(WORD_END)] if ended else token
            if len(body) == 1:
                shape[i], self.rank[i] = chr(self.byte_of[body] + 256 * ended), -1
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            a, b, i = vocab[a], vocab[b], vocab[a + b]
            shape[i] = shape[a] + shape[b]
            self.rank[i], self.left[i], self.right[i], self.merge[a, b] = rank, a, b, rank
        self.length = {i: len(s) for i, s in shape.items()}
        self.compatible: dict[int, bool] = {}
        alone: dict[int, bool] = {}
        for i in sorted(shape, key=self.rank.get):
            a, b = self.left.get(i), self.right.get(i)
            alone[i] = a is None or alone[a] and alone[b] and self._side_by_side(a, b, self.rank[i])
        self.automaton = ahocorasick.Automaton()
        for i, s in shape.items():
            if alone[i]:  # other tokens are never the result of encoding
                self.automaton.add_word(s, i)
        self.automaton.make_automaton()
        self.known: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}
        self.held = 0

    def _side_by_side(self, x: int, y: int, limit: int) -> bool:
        """Whether no merge across the border comes before those within x and y, nor before ``limit``."""
        ends_left = ends_right = limit  # when x and y themselves are merged into something larger
        while True:
            m = self.merge.get((x, y))
            # Of equal merges the leftmost comes first, so one across the border beats one to its right.
            if m is not None and m < ends_left and m <= ends_right and m < limit:
                return False
            rx, ry = self.rank[x], self.rank[y]
            if rx < 0 and ry < 0:
                return True
            if rx > ry:
                ends_left, x = rx, self.right[x]
            else:
                ends_right, y = ry, self.left[y]

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word that the pre-tokenizer has cut out."""
        raw = word.encode("utf-8", "surrogatepass").decode("latin-1")
        s = raw[:-1] + chr(ord(raw[-1]) + 256)
        last: list[int] = [-1] * len(s)  # the last token of each prefix
        length, compatible = self.length, self.compatible
        if len(compatible) > CACHE_PAIRS:
            compatible.clear()
        for end, token in self.automaton.iter(s):
            if last[end] >= 0:
                continue
            before = end - length[token]
            if before < 0:
                last[end] = token
                continue
            pair = last[before] << 32 | token
            fits = compatible.get(pair)
            if fits is None:
                fits = compatible[pair] = self._side_by_side(last[before], token, NEVER)
            if fits:
                last[end] = token
        ids, end = [], len(s) - 1
        while end >= 0:
            ids.append(last[end])
            end -= length[last[end]]
        return ids[::-1]

    def words_of(self, chunk: str) -> list[str]:
        """The pre-tokenizer's words of a normalized text without white space."""
        if chunk.isascii() or not any(unicodedata.category(c) == "Cn" for c in chunk):
            return self.words.findall(chunk)
        # A character that this Unicode version doesn't know is neither a letter nor a number.
        known = "".join(UNASSIGNED if unicodedata.category(c) == "Cn" else c for c in chunk)
        return [chunk[m.start() : m.end()] for m in self.words.finditer(known)]

    def _learn(self, chunks: set[str]) -> None:
        """Have ids and decoded tokens of these chunks ready; those of the generation before move on."""
        if self.held > CACHE_BYTES:
            self.older, self.known, self.held = self.known, {}, 0
        for chunk in chunks:
            if chunk not in self.known:
                got = self.older.get(chunk)
                if got is None:
                    ids = [i for word in self.words_of(chunk) for i in self.encode_word(word)]
                    got = "".join([f"{i} " for i in ids]), "".join([f"{self.token[i]} " for i in ids])
                self.known[chunk] = got
                self.held += len(chunk) + len(got[0]) + len(got[1]) + ENTRY_BYTES

    def pieces(self, text: str) -> tuple[str, str]:
        """The ids and the decoded tokens of a text, joined by spaces."""
        if SEPARATORS.search(text):  # split() takes them for white space, the pre-tokenizer doesn't
            return self._whole(text)
        parts, names = [text], []
        if "<|" in text:
            parts, names = self.special_tokens.split(text), self.special_tokens.findall(text)
        found: list[tuple[str, str]] = []
        for k, part in enumerate(parts):
            chunks = self.normalized(part).split()
            distinct = set(chunks)
            if not self.known.keys() >= distinct:
                self._learn(distinct)
            found += map(self.known.__getitem__, chunks)
            if k < len(names):
                found.append((f"{self.special[names[k]]} ", f"{names[k]} "))
        ids, decoded = zip(*found) if found else ((), ())
        return "".join(ids)[:-1], "".join(decoded)[:-1]

    def _whole(self, text: str) -> tuple[str, str]:
        """The same for a text that white space alone can't cut into chunks."""
        ids: list[int] = []
        names = [*self.special_tokens.findall(text), None]
        for part, name in zip(self.special_tokens.split(text), names):
            ids += [i for word in self.words_of(self.normalized(part)) for i in self.encode_word(word)]
            ids += [self.special[name]] if name else []
        return " ".join(map(str, ids)), self.decode(ids)

    @staticmethod
    def normalized(text: str) -> str:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # lower case of each character by itself
        return text.lower()

    def encode(self, text: str | None) -> list[int]:
        return as_ids(self.pieces(text or "")[0]).tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens joined by spaces, as the file names no decoder; special tokens are kept."""
        return " ".join([self.token[i] for i in ids])

    def columns(self, texts: pa.Array, ids: bool, digests: bool) -> list[pa.Array]:
        """Of each text, a null being an empty one: its ids, and number of ids and digests of ids and decoded text.

        Each text is encoded once; its ids go into one buffer of four bytes an id.
        """
        held, counts, sums, decodings = [], [], [], []
        for value in texts:
            written, decoded = self.pieces(value.as_py() or "")
            counts.append(written.count(" ") + 1 if written else 0)
            if ids:
                held.append(as_ids(written))
            if digests:
                sums.append(hashlib.sha256(written.encode()).hexdigest())
                decodings.append(hashlib.sha256(decoded.encode()).hexdigest())
        out = []
        if ids:
            offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
            out.append(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.zeros(0, np.int32), *held]))))
        return out + ([pa.array(counts, pa.int64()), pa.array(sums, pa.string()), pa.array(decodings, pa.string())] if digests else [])


def as_ids(written: str) -> np.ndarray:
    """Decimal ids joined by spaces as numbers."""
    return np.fromstring(written, np.int32, sep=" ") if written else np.zeros(0, np.int32)


def printable_bytes() -> list[str]:
    """The printable stand-in of each byte value: itself if it is visible, else the next from U+0100 on."""
    visible = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


_ENCODERS: dict[str, WordBpe] = {}


def encoder(file_text: str) -> WordBpe:
    """One encoder per worker process and vocabulary; its word cache serves later tasks too."""
    key = hashlib.sha256(file_text.encode()).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordBpe(file_text)
    return _ENCODERS[key]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _encoded(docs: DataFrame, vocabulary: str, text: str, ids: str | None, digests: bool) -> DataFrame:
    """``docs`` with the asked columns from one encoding of each text; columns named like new ones are replaced."""
    fields = ([T.StructField(ids, T.ArrayType(T.IntegerType()))] if ids else []) + (OUTPUT.fields if digests else [])
    source, names = fresh(docs, "_text"), {f.name.lower() for f in fields}
    kept = [c for c in docs.columns if c.lower() not in names]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias(source))
    schema = T.StructType([*rows.schema.fields[: len(kept)], *fields])
    # The vocabulary's size is fixed.
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(shared.value)
        for batch in batches:
            for part in bounded(batch, len(kept), BLOCK):
                new = model.columns(part.column(len(kept)), bool(ids), digests)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *new], names=schema.names)

    return rows.mapInArrow(run, schema)


def encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with a column of token ids. ``vocabulary``: the JSON text of a vocabulary file.

    A null or empty text has no ids. A column already named like the new one is replaced.
    """
    return _encoded(docs, vocabulary, text, ids, False)


def encode_with_digests(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``encode`` and ``encoding_digests`` in one: each text is encoded once, by one worker."""
    return _encoded(docs, vocabulary, text, ids, True)


def decode(docs: DataFrame, vocabulary: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of a column of token ids; null ids give an empty text."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        model = encoder(shared.value)
        return lambda rows: [[model.decode(r or []) for r in rows]]

    return add_columns(docs, ids, T.StructType([T.StructField(text, T.StringType())]), make)


def encoding_digests(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` with the number of tokens and the digests of ids and of decoded text.

    A null text counts as empty: no tokens, digests of the empty string. Each row is encoded by
    itself, so repeated rows give repeated results. The vocabulary is broadcast; its size is fixed.
    """
    return _encoded(docs, vocabulary, text, None, True)


def digest_query(docs: DataFrame, vocabulary: str) -> DataFrame:
    rows = docs.select(F.col("doc_id"), F.col("text"))
    return encoding_digests(rows, vocabulary).select("doc_id", *OUTPUT.names)
