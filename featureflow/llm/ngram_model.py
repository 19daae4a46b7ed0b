"""Language model in a log-frequency Bloom filter.

An n-gram with count c is stored as its level 1 + floor(log2 c): the events (n-gram, 1) up to
(n-gram, level) go into a Bloom filter, and a lookup probes levels upwards until one is missing. Pairs of
tokens and the rarer single tokens are kept like this; the most frequent single tokens, a bounded
number, are held exactly. The filter is cut into slices by hash, each made by one task from all counts
that fall into it, and grows with the events. It is broadcast whole while it has ``broadcast_bits`` at most;
a larger one stays in the shared folder, and the distinct keys of each bunch of texts go to its slices and
come back with their levels. Both ways read the same bits, so the scores are the same.

A pair's probability is interpolated with the single token's. The weight of the pair's share follows
Witten and Bell, with histories of about the same frequency taken together. Counts read from levels
round so that shares never add up to more than one, but for the filter's rare false positives.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.llm.common import GOLDEN, LOWER, bounded, byte_words, mixed, segment_hashes, stored, text_bytes

#: Tokens are runs of anything but space and the five ASCII controls from tab to carriage return.
TOKEN_BYTES = np.ones(256, bool)
TOKEN_BYTES[[0x20, *range(0x09, 0x0E)]] = False
#: The token after the last word; it also stands before the first.
END = mixed(np.array([0x454E44], np.uint64))[0]
#: Low bits of a pair's key that hold the frequency class of its first token.
CLASS_BITS = 6
RARE, SINGLE = 0, 63
BLOCK = 1 << 20


@dataclass(frozen=True)
class Settings:
    #: Single tokens held exactly, at most.
    exact: int = 1 << 19
    #: Bits per stored event, probes per event, and bits up to which the whole filter is broadcast (128 MB).
    event_bits: int = 10
    probes: int = 6
    broadcast_bits: int = 1 << 30
    #: Bits of the whole filter at most, for who gives up the rarest n-grams; None keeps all of them.
    max_bits: int | None = None
    #: Bytes of text that are looked up together in a filter that isn't broadcast.
    bunch_bytes: int = 16 << 20
    #: Keys gathered in a task before they are handed on, and tokens for each slice.
    buffer: int = 1_500_000
    slice_tokens: int = 500_000
    #: Added to the count of every single token and of one unknown one.
    added: float = 0.1


@dataclass(frozen=True)
class Model:
    settings: Settings
    tokens: int
    distinct: int
    #: Exactly known tokens by ascending hash, and their counts.
    known: np.ndarray
    counts: np.ndarray
    #: Bits of all slices, and where each begins, in bits; empty if the filter isn't broadcast.
    bits: np.ndarray
    begins: np.ndarray
    least_level: int
    #: Weight of the pair's share by frequency class of the first token.
    weights: np.ndarray
    #: (slice, size, bits) of a filter that isn't broadcast.
    parts: DataFrame | None = None


class Tokens:
    """Hashes of the tokens of several texts, each text ending with END."""

    def __init__(self, texts: pa.Array):
        data, offsets = text_bytes(texts)
        data = LOWER[data]
        starts, ends, rows = byte_words(data, offsets, TOKEN_BYTES)
        words = np.bincount(rows, minlength=len(texts))
        self.counts = words + 1
        self.ends = np.cumsum(self.counts) - 1
        self.first = self.ends - words
        is_word = np.ones(int(self.counts.sum()), bool)
        is_word[self.ends] = False
        self.hashes = np.full(len(is_word), END, np.uint64)
        self.hashes[is_word] = segment_hashes(data, starts, ends)
        self.before = np.concatenate([[END], self.hashes[:-1]]).astype(np.uint64)

    def digests(self) -> np.ndarray:
        """One number for each text's sequence of tokens."""
        place = np.arange(len(self.hashes), dtype=np.uint64) - np.repeat(self.first, self.counts).astype(np.uint64)
        sums = mixed(self.hashes + place * GOLDEN)
        return np.add.reduceat(sums, self.first).view(np.int64) if len(self.first) else np.zeros(0, np.int64)


def summed(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with their summed counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


class Gathered:
    """Counts of keys, merged whenever many have come together."""

    def __init__(self, limit: int):
        self.limit, self.keys, self.counts, self.size = limit, [], [], 0

    def add(self, keys: np.ndarray) -> bool:
        """Take some keys in; true if it is time to hand the counts on."""
        keys, counts = np.unique(keys, return_counts=True)
        self.keys.append(keys)
        self.counts.append(counts.astype(np.int64))
        self.size += len(keys)
        if self.size > 2 * self.limit:
            keys, counts = summed(self.keys, self.counts)
            self.keys, self.counts, self.size = [keys], [counts], len(keys)
        return self.size > self.limit

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        got = summed(self.keys, self.counts)
        self.keys, self.counts, self.size = [], [], 0
        return got


def token_counts(docs: DataFrame, settings: Settings) -> DataFrame:
    """(h, n) of every token of all given texts."""

    def run(batches):
        gathered = Gathered(settings.buffer)
        for batch in batches:
            for part in bounded(batch, 0, BLOCK):
                if gathered.add(Tokens(part.column(0)).hashes):
                    yield from handed_on(*gathered.take())
        yield from handed_on(*gathered.take())

    def handed_on(keys, counts):
        for i in range(0, len(keys), 200_000):
            arrays = [pa.array(keys[i : i + 200_000].view(np.int64)), pa.array(counts[i : i + 200_000])]
            yield pa.RecordBatch.from_arrays(arrays, names=["h", "n"])

    return docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def exact_counts(counts: DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens: as many whole steps of the frequency scale as the bound allows."""
    step = F.floor(F.log2("n") * 16).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("tokens")).collect()  # about 1000 rows at most
    least, total = 1 << 30, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        total += row["tokens"]
        if total > settings.exact:
            break
        least = row["step"]
    kept = counts.where(step >= least).toArrow()
    keys, n = kept["h"].to_numpy().view(np.uint64), kept["n"].to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def lookup(keys: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Exact counts; 0 for tokens that aren't among the exactly known ones."""
    if len(known) == 0:
        return np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[at] == keys, counts[at], 0)


def pair_keys(before: np.ndarray, after: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Key of a pair; ``count`` is the first token's exact count, 0 if it is one of the rarer ones."""
    kind = np.where(count > 0, np.minimum(1 + np.log2(np.maximum(count, 1)).astype(np.int64), SINGLE - 1), RARE)
    return _tagged(mixed(before * GOLDEN + after), kind.astype(np.uint64))


def single_keys(tokens: np.ndarray) -> np.ndarray:
    return _tagged(mixed(tokens + GOLDEN), np.uint64(SINGLE))


def _tagged(keys: np.ndarray, kind) -> np.ndarray:
    return keys >> np.uint64(CLASS_BITS) << np.uint64(CLASS_BITS) | kind


def probed_keys(t: Tokens, n: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Keys of all pairs and of the rarer single tokens; ``n``: exact counts, 0 for rarer tokens."""
    before = np.concatenate([lookup(t.before[:1], known, counts), n[:-1]]) if len(n) else n
    return np.concatenate([pair_keys(t.before, t.hashes, before), single_keys(t.hashes[n == 0])])


def slices_of(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def gathered_keys(docs: DataFrame, known, slices: int, settings: Settings) -> DataFrame:
    """(slice, keys, counts): packed counts of pairs and rarer single tokens, many rows per slice."""

    def run(batches):
        gathered = Gathered(settings.buffer)
        for batch in batches:
            for part in bounded(batch, 0, BLOCK):
                t = Tokens(part.column(0))
                n = lookup(t.hashes, *known.value)
                if gathered.add(probed_keys(t, n, *known.value)):
                    yield from handed_on(*gathered.take())
        yield from handed_on(*gathered.take())

    def handed_on(keys, counts):
        # Ascending keys lie in ascending slices.
        cuts = np.searchsorted(slices_of(keys, slices), np.arange(slices + 1))
        rows = [(s, keys[a:b].tobytes(), counts[a:b].astype(np.uint32).tobytes()) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        for i in range(0, len(rows), 64):
            s, k, c = zip(*rows[i : i + 64])
            yield pa.RecordBatch.from_arrays([pa.array(s, pa.int32()), pa.array(k, pa.binary()), pa.array(c, pa.binary())], names=["slice", "keys", "counts"])

    return docs.select("text").mapInArrow(run, "slice int, keys binary, counts binary")


def positions(keys: np.ndarray, level: int, probe: int, sizes: np.ndarray) -> np.ndarray:
    h = mixed(keys + np.uint64(level * int(GOLDEN) % (1 << 64)))
    low, high = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32) | np.uint64(1)
    return (((low + np.uint64(probe) * high) & np.uint64(0xFFFFFFFF)) * sizes.astype(np.uint64) >> np.uint64(32)).astype(np.int64)


def filter_slices(packed: DataFrame, least_level: int, settings: Settings) -> DataFrame:
    """(slice, bits, size, events, types, tokens): the Bloom filter's slices and what they were made from.

    ``events`` counts the events by level, ``types`` and ``tokens`` the distinct and all pairs by class.
    """

    def build(group: pa.Table) -> pa.Table:
        keys = [np.frombuffer(b, np.uint64) for b in group.column("keys").to_pylist()]
        counts = [np.frombuffer(b, np.uint32).astype(np.int64) for b in group.column("counts").to_pylist()]
        keys, counts = summed(keys, counts)
        levels = 1 + np.log2(counts).astype(np.int64)
        kind = (keys & np.uint64((1 << CLASS_BITS) - 1)).astype(np.int64)
        by_level = np.bincount(levels, minlength=64)
        events = by_level[::-1].cumsum()[::-1]
        events[0] = 0
        size = int(-(-settings.event_bits * int(events[least_level:].sum()) // 64) * 64) + 64
        bits = np.zeros(size, bool)
        for level in range(least_level, int(levels.max()) + 1):
            some = keys[levels >= level]
            for probe in range(settings.probes):
                bits[positions(some, level, probe, np.uint64(size))] = True
        return pa.table(
            {
                "slice": group.column("slice")[:1].combine_chunks(),
                "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
                "size": pa.array([size]),
                "events": pa.array([events.tolist()], pa.list_(pa.int64())),
                "types": pa.array([np.bincount(kind, minlength=64).tolist()], pa.list_(pa.int64())),
                "tokens": pa.array([np.bincount(kind, counts, minlength=64).astype(np.int64).tolist()], pa.list_(pa.int64())),
            }
        )

    schema = "slice int, bits binary, size long, events array<long>, types array<long>, tokens array<long>"
    return packed.groupBy("slice").applyInArrow(build, schema)


def fit(docs: DataFrame, train: Column | None = None, settings: Settings = Settings()) -> tuple[Model, DataFrame]:
    """The model of the texts for which ``train`` holds, and (h, n) of all their tokens.

    A null text counts as an empty one, which is a single END.
    """
    spark = docs.sparkSession
    texts = docs.select("text", (F.lit(True) if train is None else train).alias("_train")).where("_train")
    counts = stored(token_counts(texts, settings), "token-counts")
    total = counts.agg(F.sum("n").alias("tokens"), F.count("*").alias("distinct")).first()
    tokens, distinct = total["tokens"] or 0, total["distinct"]
    known, n = exact_counts(counts, settings)
    slices = max(1, -(-tokens // settings.slice_tokens))
    packed = gathered_keys(texts, spark.sparkContext.broadcast((known, n)), slices, settings)
    least_level = 1
    made = stored(filter_slices(packed, least_level, settings), "filter")
    events = _column_sums(made, "events")
    needed = lambda: settings.event_bits * int(events[least_level:].sum()) + 128 * slices
    while settings.max_bits is not None and least_level < 63 and needed() > settings.max_bits:
        least_level += 1
    if least_level > 1:
        made = stored(filter_slices(packed, least_level, settings), "filter")
    types, pairs = _column_sums(made, "types"), _column_sums(made, "tokens")
    weights = pairs / np.maximum(pairs + types, 1)
    if needed() > settings.broadcast_bits:
        none = np.zeros(0, np.uint8), np.zeros(1, np.int64)
        return Model(settings, tokens, distinct, known, n, *none, least_level, weights, made.select("slice", "size", "bits")), counts
    sizes = np.full(slices, 64, np.int64)
    parts = [np.zeros(8, np.uint8)] * slices
    for row in made.select("slice", "size", "bits").toLocalIterator():  # bounded by broadcast_bits together
        sizes[row["slice"]], parts[row["slice"]] = row["size"], np.frombuffer(row["bits"], np.uint8)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    return Model(settings, tokens, distinct, known, n, np.concatenate(parts), begins, least_level, weights), counts


def _column_sums(df: DataFrame, column: str) -> np.ndarray:
    sums = df.select(F.posexplode(column).alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(64, np.int64)
    for row in sums:
        out[row["k"]] = row["n"]
    return out


def levels(model: Model, keys: np.ndarray) -> np.ndarray:
    """Stored level of each key, 0 if none: probe level after level until one is missing."""
    out = np.zeros(len(keys), np.int64)
    part = slices_of(keys, len(model.begins) - 1)
    begin, size = model.begins[part], (model.begins[1:] - model.begins[:-1])[part]
    alive = np.arange(len(keys))
    for level in range(model.least_level, 64):
        for probe in range(model.settings.probes):
            at = begin[alive] + positions(keys[alive], level, probe, size[alive])
            alive = alive[(model.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)]
        if len(alive) == 0:
            break
        out[alive] = level
    return out


def bunched(rows: DataFrame, settings: Settings) -> DataFrame:
    """The rows (doc_id, text, ...) with the number of a bunch of about ``bunch_bytes`` of text, stored."""
    schema = T.StructType([*rows.schema.fields, T.StructField("bunch", T.LongType())])

    def run(batches):
        bunch, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for part in bounded(batch, 1, min(BLOCK, settings.bunch_bytes)):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(part.num_rows, bunch))], names=schema.names)
                held += part.column(1).nbytes
                if held >= settings.bunch_bytes:
                    bunch, held = bunch + 1, 0

    return stored(rows.mapInArrow(run, schema), "bunches")


def levels_by_bunch(rows: DataFrame, model: Model, shared, slices: int) -> DataFrame:
    """(bunch, keys, levels): stored levels of the distinct keys of each bunch, packed, many rows per bunch."""
    bare = replace(model, known=model.known[:0], counts=model.counts[:0], parts=None)

    def probed(batches):
        bunch, held = None, []
        for batch in batches:
            for part in bounded(batch, 0, BLOCK):
                of = part.column(1).to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
                for a, b in zip(cuts, cuts[1:]):
                    if bunch != of[a]:
                        yield from handed_on(bunch, held)
                        bunch, held = int(of[a]), []
                    t = Tokens(part.column(0).slice(a, b - a))
                    known = shared.value.known, shared.value.counts
                    held.append(np.unique(probed_keys(t, lookup(t.hashes, *known), *known)))
        yield from handed_on(bunch, held)

    def handed_on(bunch, held):
        if not held:
            return
        keys = np.unique(np.concatenate(held))
        cuts = np.searchsorted(slices_of(keys, slices), np.arange(slices + 1))
        rows = [(s, bunch, keys[a:b].tobytes()) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        for i in range(0, len(rows), 64):
            s, n, k = zip(*rows[i : i + 64])
            yield pa.RecordBatch.from_arrays([pa.array(s, pa.int32()), pa.array(n, pa.int64()), pa.array(k, pa.binary())], names=["slice", "bunch", "keys"])

    def find(part: pa.Table, group: pa.Table) -> pa.Table:
        packed = group.column("keys").to_pylist()
        keys = np.frombuffer(b"".join(packed), np.uint64)
        level = np.zeros(len(keys), np.uint8)
        if part.num_rows and len(keys):
            size, bits = part.column("size")[0].as_py(), np.frombuffer(part.column("bits")[0].as_py(), np.uint8)
            level = levels(replace(bare, bits=bits, begins=np.array([0, size])), keys).astype(np.uint8)
        ends = np.cumsum([len(k) // 8 for k in packed], dtype=np.int64)
        found = [level[e - len(k) // 8 : e].tobytes() for e, k in zip(ends, packed)]
        return pa.table({"bunch": group.column("bunch"), "keys": pa.array(packed, pa.binary()), "levels": pa.array(found, pa.binary())})

    keys = rows.select("text", "bunch").mapInArrow(probed, "slice int, bunch long, keys binary")
    return model.parts.groupBy("slice").cogroup(keys.groupBy("slice")).applyInArrow(find, "bunch long, keys binary, levels binary")


def log_probabilities(model: Model, t: Tokens, n: np.ndarray, look: Callable | None = None) -> np.ndarray:
    """Log10 probability of every token after the one before it; ``n``: exact counts, 0 for rarer tokens.

    ``look`` gives the stored levels of keys, by default from the model's own bits.
    """
    look = look or partial(levels, model)
    add = model.settings.added
    whole = model.tokens + add * (model.distinct + 1)
    rare = n == 0
    level = np.zeros(len(n), np.int64)
    level[rare] = look(single_keys(t.hashes[rare]))
    least = np.where(rare, np.where(level > 0, 1 << np.maximum(level - 1, 0), 0), n)
    most = np.where(rare, np.where(level > 0, (1 << level) - 1, 0), n)
    first = lookup(t.before[:1], model.known, model.counts)
    history_exact = np.concatenate([first, n[:-1]])
    history = np.concatenate([most[t.ends[:1]], most[:-1]])  # END stands before the first token too
    keys = pair_keys(t.before, t.hashes, history_exact)
    pair = look(keys)
    pair = np.where(pair > 0, 1 << np.maximum(pair - 1, 0), 0)
    weight = np.where(history > 0, model.weights[(keys & np.uint64((1 << CLASS_BITS) - 1)).astype(np.int64)], 0.0)
    share = np.minimum(pair / np.maximum(history, 1), 1.0)
    return np.log10(weight * share + (1 - weight) * (least + add) / whole)


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """One row per text: doc_id, n_tokens, n_known, base_score, score, and the columns of ``docs`` but text.

    ``base_score`` sums the log10 probabilities of single tokens with exact counts, ``score`` those of the
    model. A null text counts as empty: END alone. Exact counts of rarer tokens are joined; rows that
    repeat id and text share them. An empty model gives each score as if all tokens were unknown.
    """
    kept = [c for c in docs.columns if c.lower() not in ("text", "doc_id", "n_tokens", "n_known", "base_score", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, parts=None))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct(F.lit(0).alias("_"), *kept).alias("row"))
    add = model.settings.added
    whole = max(model.tokens + add * (model.distinct + 1), add)

    def judged(part, model, look):
        t = Tokens(part.column(1))
        n = lookup(t.hashes, model.known, model.counts)
        exact = np.where(n > 0, np.log10((n + add) / whole), 0.0)
        rare_at = np.flatnonzero(n == 0)
        row = np.repeat(np.arange(len(t.counts)), t.counts)[rare_at]
        order = np.lexsort((t.hashes[rare_at], row))
        key, of = t.hashes[rare_at][order], row[order]
        new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (of[1:] != of[:-1])])) if len(key) else np.zeros(0, np.int64)
        times = np.diff(np.append(new, len(key)))
        offsets = pa.array(np.searchsorted(of[new], np.arange(len(t.counts) + 1)).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [
                part.column(0),
                part.column(2),
                pa.array(t.digests()),
                pa.array(t.counts.astype(np.int64)),
                pa.array(np.add.reduceat(n > 0, t.first, dtype=np.int64)),
                pa.array(np.add.reduceat(exact, t.first)),
                pa.array(np.add.reduceat(log_probabilities(model, t, n, look), t.first)),
                pa.ListArray.from_arrays(offsets, pa.array(key[new].view(np.int64))),
                pa.ListArray.from_arrays(offsets, pa.array(times)),
            ],
            names=schema.names,
        )

    def run(batches):
        for batch in batches:
            for part in bounded(batch, 1, BLOCK):
                yield judged(part, shared.value, None)

    def run_bunch(texts: pa.Table, found: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(found.column("keys").to_pylist()), np.uint64)
        level = np.frombuffer(b"".join(found.column("levels").to_pylist()), np.uint8).astype(np.int64)
        order = np.argsort(keys)
        look = partial(lookup, known=keys[order], counts=level[order])
        parts = [part for batch in texts.to_batches() for part in bounded(batch, 1, BLOCK)]
        return pa.Table.from_batches([judged(part, shared.value, look) for part in parts])

    schema = docs.sparkSession.createDataFrame(
        [], "doc_id long, row int, digest long, n_tokens long, known long, base double, score double, rare array<long>, times array<long>"
    ).schema
    schema["row"].dataType = rows.schema["row"].dataType
    if model.parts is None:
        scored = rows.mapInArrow(run, schema)
    else:
        rows = bunched(rows, model.settings)
        schema["row"].dataType = rows.schema["row"].dataType
        found = levels_by_bunch(rows, model, shared, max(1, -(-model.tokens // model.settings.slice_tokens)))
        scored = rows.groupBy("bunch").cogroup(found.groupBy("bunch")).applyInArrow(run_bunch, schema)
    scored = stored(scored, "scored")

    # One more entry for each row, so that repeated rows can be told from repeated tokens.
    entries = F.arrays_zip(F.concat(F.array(F.lit(None).cast("long")), "rare").alias("h"), F.concat(F.array(F.lit(1).cast("long")), "times").alias("times"))
    words = scored.where(F.size("rare") > 0).select("doc_id", "digest", F.explode(entries).alias("e")).select("doc_id", "digest", "e.*")
    met = words.where("h IS NOT NULL").join(counts, "h", "left").select("doc_id", "digest", "times", F.coalesce("n", F.lit(0)).alias("n"), F.lit(0).alias("rows"))
    met = met.unionByName(words.where("h IS NULL").select("doc_id", "digest", F.lit(0).cast("long").alias("times"), F.lit(0).cast("long").alias("n"), F.lit(1).alias("rows")))
    rest = met.groupBy(F.col("doc_id").alias("_doc_id"), F.col("digest").alias("_digest")).agg(
        (F.sum(F.col("times") * F.log10((F.col("n") + add) / F.lit(whole))) / F.sum("rows")).alias("rest"),
        (F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)) / F.sum("rows")).cast("long").alias("rest_known"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("digest") == F.col("_digest"))
    return scored.drop("rare", "times").join(rest, same, "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"),
        "score",
        *[F.col("row")[c].alias(c) for c in kept],
    )
