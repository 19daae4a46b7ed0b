"""Benchmark passages in texts, found by a prefix-filtered set join.

An item is cut into windows of consecutive words, and a text holds a window if it has the same words in
the same order. Words are ordered by rarity over all texts. A window of L words that must be contained
whole needs a prefix of L - L + 1 words: its rarest. A place of a text is a candidate only if the words
there can all be words of items (length bound), and the rarest of them is the prefix word of an item's
window of that length at the same place within the window (positional bound). Candidates are joined with
the windows by prefix word and place, and verified word by word.

What the workers get beforehand has a fixed size whatever the size of the benchmark: counters for the
rarity of words, and two bitmaps. They only rule places out; the join decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.llm.common import LOWER, add_columns, bounded, byte_words, fresh, mixed, segment_hashes, stored, text_bytes

#: Words are made of digits, letters a to z and everything beyond ASCII.
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[ord("0") : ord("9") + 1] = WORD_BYTES[ord("a") : ord("z") + 1] = WORD_BYTES[0x80:] = True

#: Counters of word rarity, and bits of each bitmap, as powers of two.
RARITY_BITS, MAP_BITS = 20, 25
#: Text handled at once, in bytes.
BLOCK = 1 << 20


class Words:
    """The words of several texts: hashes, rows and places."""

    def __init__(self, texts: pa.Array):
        data, offsets = text_bytes(texts)
        self.data = LOWER[data]
        self.starts, self.ends, self.rows = byte_words(self.data, offsets, WORD_BYTES)
        self.hashes = segment_hashes(self.data, self.starts, self.ends)
        first = np.searchsorted(self.rows, np.arange(len(texts) + 1))
        self.first, self.counts = first[:-1], np.diff(first)

    def digests(self) -> np.ndarray:
        """One number for each text's sequence of words."""
        place = np.arange(len(self.hashes), dtype=np.uint64) - np.repeat(self.first, self.counts).astype(np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(self.hashes + place * np.uint64(0xD6E8FEB86659FD93)))])
        return (sums[self.first + self.counts] - sums[self.first]).view(np.int64)

    def joined(self, at: int, length: int) -> bytes:
        """The words of a window, separated by spaces."""
        return b" ".join([self.data[a:b].tobytes() for a, b in zip(self.starts[at : at + length], self.ends[at : at + length])])


def slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - RARITY_BITS)).astype(np.int64)


def bits_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << MAP_BITS) - 1)).astype(np.int64)


def prefix_key(word: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """Prefix word, its place in the window and the window's length in one number."""
    return mixed(word + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(length << 40))


def rarest(words: Words, at: np.ndarray, length: int, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of the rarest word of each window: seldom slot first, then hash, then place."""
    best = words.hashes[at]
    seldom, place = rarity[slots(best)], np.zeros(len(at), np.int64)
    for k in range(1, length):
        h = words.hashes[at + k]
        s = rarity[slots(h)]
        better = (s < seldom) | (s == seldom) & (h < best)
        best, seldom, place = np.where(better, h, best), np.where(better, s, seldom), np.where(better, k, place)
    return best, place


def windows_of(words: Words, row: int, size: int) -> tuple[np.ndarray, int]:
    length = min(size, int(words.counts[row]))
    return words.first[row] + np.arange(int(words.counts[row]) - length + 1 if length else 0), length


def item_words(items: DataFrame) -> np.ndarray:
    """Bitmap of the words of all items."""

    def run(batches):
        seen = np.zeros(1 << MAP_BITS, bool)
        for batch in batches:
            for part in bounded(batch, 0, BLOCK):
                seen[bits_of(Words(part.column(0)).hashes)] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen))], names=["bit"])

    # At most one row for each bit.
    return bitmap(items.select("text").mapInArrow(run, "bit long"))


def bitmap(found: DataFrame) -> np.ndarray:
    seen = np.zeros(1 << MAP_BITS, bool)
    seen[found.distinct().toArrow()["bit"].to_numpy()] = True
    return np.packbits(seen)


def has(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 3] >> (7 - (places & 7)).astype(np.uint8) & 1).astype(bool)


def word_rarity(docs: DataFrame, vocabulary) -> np.ndarray:
    """How often the items' words occur in all texts, by slot."""

    def run(batches):
        counts = np.zeros(1 << RARITY_BITS, np.int64)
        for batch in batches:
            for part in bounded(batch, 0, BLOCK):
                h = Words(part.column(0)).hashes
                counts += np.bincount(slots(h[has(vocabulary.value, bits_of(h))]), minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["slot", "n"])

    # At most one row for each slot.
    found = docs.select("text").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << RARITY_BITS, np.int64)
    counts[found["slot"].to_numpy()] = found["n"].to_numpy()
    return counts


def item_windows(items: DataFrame, rarity, size: int) -> DataFrame:
    """(item_id, key, words, length): every window of every item with its prefix key."""

    def run(batches):
        for batch in batches:
            for part in bounded(batch, 1, BLOCK):
                words, ids = Words(part.column(1)), part.column(0)
                for row in range(len(ids)):
                    at, length = windows_of(words, row, size)
                    if len(at):
                        best, place = rarest(words, at, length, rarity.value)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([ids[row].as_py()] * len(at), pa.int64()),
                                pa.array(prefix_key(best, place, length).view(np.int64)),
                                pa.array([words.joined(a, length).decode() for a in at]),
                                pa.array(np.full(len(at), length, np.int32)),
                            ],
                            names=["item_id", "key", "words", "length"],
                        )

    ids = F.col("item_id").cast("long").alias("item_id")
    return items.select(ids, "text").mapInArrow(run, "item_id long, key long, words string, length int")


def candidates(docs: DataFrame, vocabulary, rarity, keys, lengths: list[int]) -> DataFrame:
    """Per text: doc_id, a digest of its words, number of words, and its candidate windows."""
    window = "struct<at: int, length: int, key: bigint, words: string>"
    kind = pa.struct([("at", pa.int32()), ("length", pa.int32()), ("key", pa.int64()), ("words", pa.string())])

    def found(words: Words, length: int):
        """First word and prefix key of the places where a window of this length may be."""
        n = len(words.hashes)
        if n < length:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        outside = np.concatenate([[0], np.cumsum(~has(vocabulary.value, bits_of(words.hashes)))])
        fits = (outside[length:] == outside[: n - length + 1]) & (words.rows[: n - length + 1] == words.rows[length - 1 :])
        at = np.flatnonzero(fits)
        best, place = rarest(words, at, length, rarity.value)
        key = prefix_key(best, place, length)
        possible = has(keys.value, bits_of(key))
        return at[possible], key[possible]

    def run(batches):
        for batch in batches:
            for part in bounded(batch, 1, BLOCK):
                words = Words(part.column(1))
                n = part.num_rows
                held: list[list] = [[] for _ in range(n)]
                for length in lengths:
                    for a, key in zip(*found(words, length)):
                        row = int(words.rows[a])
                        one = {"at": int(a - words.first[row]), "length": length, "key": int(key.view(np.int64))}
                        held[row].append(one | {"words": words.joined(a, length).decode()})
                arrays = [part.column(0), pa.array(words.digests()), pa.array(words.counts), pa.array(held, pa.list_(kind))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "digest", "n_words", "held"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, f"doc_id long, digest long, n_words long, held array<{window}>")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """One row per text: doc_id, digest, n_words, n_hit, n_items, items_sha256, contaminated, hits.

    ``docs`` has doc_id and text, ``items`` item_id and text. Words: letters A-Z lower-cased, then runs of
    digits, a-z and characters beyond ASCII. An item's windows are its runs of ``window`` words, or the
    whole item if it has fewer; items without words and items without an id have none. A word is hit if
    it lies in any occurrence of any window. ``hits`` lists where windows occur, as [first, last + 1) ranges of words.

    A null or empty text has no words and no hits. Rows that repeat id and words repeat the result;
    an item that occurs twice under one id counts once.
    """
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    items = items.where(F.col("item_id").isNotNull()).select("item_id", "text")
    vocabulary = share(item_words(items))
    rarity = share(word_rarity(docs, vocabulary))
    windows = stored(item_windows(items, rarity, window), "item-windows")
    bit = F.col("key").bitwiseAND(F.lit((1 << MAP_BITS) - 1)).alias("bit")
    keys = share(bitmap(windows.select(bit)))
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # at most `window`
    texts = stored(candidates(docs, vocabulary, rarity, keys, lengths), "candidate-windows")

    # Both sides are plain scans, so that a window that very many texts hold can be split when joined.
    held = texts.select("doc_id", "digest", F.explode("held").alias("h")).select("doc_id", "digest", "h.*")
    met = held.join(windows, ["key", "length", "words"]).select("doc_id", "digest", "at", "length", "item_id")
    # A text's windows and items are no more than its words and their windows' items.
    spans = met.groupBy("doc_id", "digest").agg(
        F.sort_array(F.collect_set(F.struct("at", (F.col("at") + F.col("length")).alias("end")))).alias("spans"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
    )
    # Windows in order of their places: each adds what lies beyond the ones before it.
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    counted = F.aggregate(
        "spans",
        state,
        lambda done, s: F.struct(
            (done["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(done["end"], s["at"]))).alias("n"),
            F.greatest(done["end"], s["end"]).alias("end"),
        ),
        lambda done: done["n"],
    )
    spans = spans.select(F.col("doc_id").alias("_doc_id"), F.col("digest").alias("_digest"), "items", "spans", counted.alias("n"))
    nothing = F.array().cast("array<struct<at: int, end: int>>")
    no_items = F.array().cast("array<string>")
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("digest") == F.col("_digest"))
    items = F.coalesce("items", no_items)
    return texts.select("doc_id", "digest", "n_words").join(spans, same, "left").select(
        "doc_id",
        "digest",
        "n_words",
        F.coalesce("n", F.lit(0).cast("long")).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        F.col("spans").isNotNull().alias("contaminated"),
        F.coalesce("spans", nothing).alias("hits"),
    )


def clean(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` without a word in a passage of an item; see ``contamination``."""
    digest, key = fresh(docs, "_digest"), fresh(docs, "_key")
    hit = contamination(docs, items, window).where("contaminated")
    hit = stored(hit.select(F.xxhash64("doc_id", "digest").alias(key)).distinct(), "contaminated")
    fields = T.StructType([T.StructField(digest, T.LongType())])
    known = add_columns(docs, "text", fields, lambda: lambda texts: [Words(pa.array(texts, pa.string())).digests()], BLOCK)
    keyed = known.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), digest))
    return keyed.join(hit, key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
