"""Passages that several texts share, by content-defined chunks.

A gear hash rolls over the bytes: each step shifts it by one bit and adds a random number of the new
byte, so that it depends on the last 8 bytes alone. Where its low bits are zero a chunk may end, unless
another such place lies closely before it; the cut then moves to the next word. Cuts depend on what
stands around them and not on what stands far before, so an insertion shifts only the chunks it touches.
Chunks are compared by 64-bit digests; a run of consecutive chunks counts as a repeated passage if each
of them occurs in another text too and together they have enough words.

Digests travel packed, one entry per digest and bunch of texts, to slices of bounded size; a digest that
very many texts hold therefore costs a slice one entry per bunch.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm.common import GOLDEN, bounded, mixed, segment_hashes, text_bytes

BLOCK = 1 << 20
#: Bytes that the rolling hash depends on.
REACH = 8
GEAR = (mixed(np.arange(1, 257, dtype=np.uint64) * GOLDEN) >> np.uint64(40)).astype(np.uint8)
#: Stands for a null id in packed entries.
NO_ID = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Settings:
    #: A cut is possible where so many of the hash's upper bits are zero: every 16 bytes on average ...
    bits: int = 4
    #: ... if the last such place is at least so many bytes away.
    least_bytes: int = 8
    #: Longer chunks are cut after so many bytes.
    most_bytes: int = 256
    #: Words of a run of repeated chunks from which on it counts. Passages of twice as many words are
    #: found almost surely: at either end the shared chunks begin or stop a few words late or early.
    least_words: int = 25
    #: Entries of a bunch, and bytes of text for each slice.
    bunch: int = 1_000_000
    slice_bytes: int = 24 << 20


class Chunks:
    """Chunks of several texts: byte and code point ends, rows, digests and words."""

    def __init__(self, texts: pa.Array, settings: Settings):
        data, offsets = text_bytes(texts)
        lengths = np.diff(offsets)
        n = len(data)
        row = np.repeat(np.arange(len(lengths)), lengths)
        # Rows lie REACH empty places apart, so that no hash reaches into the row before.
        at = np.arange(n) + REACH * (row + 1)
        h = np.zeros(n + REACH * (len(lengths) + 1), np.uint8)
        h[at] = GEAR[data]
        for k in (1, 2, 4):
            h[k:] += h[:-k] << np.uint8(k)
        candidate = np.flatnonzero(h[at] >> np.uint8(8 - settings.bits) == 0) + 1
        far = np.diff(candidate, prepend=-settings.least_bytes) >= settings.least_bytes
        first_of_row = np.diff(row[candidate - 1], prepend=-1) > 0 if len(candidate) else far
        cut = candidate[far | first_of_row]

        white = (data == 0x20) | (data >= 0x09) & (data <= 0x0D)
        before = np.concatenate([[True], white[:-1]]) if n else white
        before[offsets[:-1][lengths > 0]] = True
        word = before & ~white
        starts = np.append(np.flatnonzero(word), n)
        cut = starts[np.searchsorted(starts, cut)]
        ends = np.unique(np.concatenate([cut, offsets[1:]]))
        ends = ends[ends > 0]
        begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        extra = (ends - begins - 1) // settings.most_bytes
        if extra.any():
            step = np.arange(int(extra.sum())) - np.repeat(np.cumsum(extra) - extra, extra) + 1
            more = np.repeat(begins, extra) + step * settings.most_bytes
            for _ in range(3):  # to the start of a character
                more += (more < n) & (data[np.minimum(more, n - 1)] & 0xC0 == 0x80)
            ends = np.unique(np.concatenate([ends, more]))
            begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        self.row = np.searchsorted(offsets, begins, side="right") - 1 if len(ends) else np.zeros(0, np.int64)
        self.first = np.searchsorted(self.row, np.arange(len(lengths) + 1))
        self.digest = segment_hashes(data, begins, ends)
        points = np.concatenate([[0], np.cumsum(data & 0xC0 != 0x80)])
        self.point_ends = points[ends] - points[offsets[self.row]] if len(ends) else ends
        words = np.concatenate([[0], np.cumsum(word)])
        self.words = words[ends] - words[begins]
        place = (np.arange(len(ends)) - self.first[self.row]).astype(np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(self.digest + place * GOLDEN))])
        #: A 64-bit digest of each whole text, to tell rows of one id apart.
        self.text = sums[self.first[1:]] - sums[self.first[:-1]]


ENTRY = np.dtype([("digest", "<u8"), ("doc", "<i8"), ("text", "<u8"), ("place", "<u4")])


def packed_entries(docs: DataFrame, slices: int, settings: Settings) -> DataFrame:
    """(slice, open, settled): entries that other bunches decide about, and those known to be repeated."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for part in bounded(batch, 1, BLOCK):
                c = Chunks(part.column(1), settings)
                some = np.zeros(len(c.digest), ENTRY)
                some["digest"], some["text"] = c.digest, c.text[c.row]
                some["doc"] = part.column(0).fill_null(int(NO_ID)).to_numpy()[c.row]
                some["place"] = np.arange(len(c.digest)) - c.first[c.row]
                held.append(some)
                size += len(some)
                if size > settings.bunch:
                    yield from handed_on(np.concatenate(held))
                    held, size = [], 0
        if size:
            yield from handed_on(np.concatenate(held))

    def handed_on(entries):
        entries, first, several = sorted_entries(entries)
        group = np.cumsum(first) - 1
        is_open = first.copy()
        settled = ~first & several[group]
        # A chunk that comes again within its own text only goes the way of the first.
        own = ~first & ~several[group]
        is_open |= own
        part = (entries["digest"] >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32)
        known = np.zeros(len(entries), bool)
        known[first] = several
        cuts = np.searchsorted(part, np.arange(slices + 1, dtype=np.uint64))
        rows = []
        for s in np.flatnonzero(np.diff(cuts)):
            of = slice(cuts[s], cuts[s + 1])
            some = entries[of]
            rows.append((int(s), some[is_open[of]].tobytes(), np.packbits(known[of][is_open[of]]).tobytes(), some[settled[of]].tobytes()))
            if len(rows) == 64:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)

    def batch_of(rows):
        s, o, k, d = zip(*rows)
        columns = [pa.array(s, pa.int32()), *[pa.array(x, pa.binary()) for x in (o, k, d)]]
        return pa.RecordBatch.from_arrays(columns, names=["slice", "open", "known", "settled"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "slice int, open binary, known binary, settled binary")


def sorted_entries(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries by digest, text and place; whether each is its digest's first; whether the digest has several texts."""
    entries = entries[np.lexsort((entries["place"], entries["text"], entries["doc"], entries["digest"]))]
    first = np.concatenate([[True], entries["digest"][1:] != entries["digest"][:-1]]) if len(entries) else np.zeros(0, bool)
    group = np.cumsum(first) - 1
    head = np.flatnonzero(first)
    other = (entries["doc"] != entries["doc"][head][group]) | (entries["text"] != entries["text"][head][group])
    several = np.logical_or.reduceat(other, head) if len(head) else np.zeros(0, bool)
    return entries, first, several


def repeated_chunks(packed: DataFrame) -> DataFrame:
    """(doc_id, text_hash, place, first): chunks that several texts hold; first: the one that stays."""

    def decide(group: pa.Table) -> pa.Table:
        entries = np.concatenate([np.frombuffer(b, ENTRY) for b in group.column("open").to_pylist()])
        known = np.concatenate(
            [np.unpackbits(np.frombuffer(b, np.uint8))[: len(o) // ENTRY.itemsize] for b, o in zip(group.column("known").to_pylist(), group.column("open").to_pylist())]
        ).astype(bool)
        marked = np.unique(entries["digest"][known])
        entries, first, several = sorted_entries(entries)
        at = np.minimum(np.searchsorted(marked, entries["digest"]), max(len(marked) - 1, 0))
        repeated = several[np.cumsum(first) - 1]
        if len(marked):
            repeated = repeated | (marked[at] == entries["digest"])
        # Two bunches may hold the same row's text; equal rows share their answer.
        settled = np.concatenate([np.frombuffer(b, ENTRY) for b in group.column("settled").to_pylist()])
        out = np.concatenate([entries[repeated], settled])
        first = np.concatenate([first[repeated], np.zeros(len(settled), bool)])
        return pa.table({"doc": pa.array(out["doc"]), "text_hash": pa.array(out["text"].view(np.int64)), "place": pa.array(out["place"].astype(np.int32)), "first": pa.array(first)})

    return packed.groupBy("slice").applyInArrow(decide, "doc long, text_hash long, place int, first boolean")


def runs(ends: np.ndarray, words: np.ndarray, marked: np.ndarray, least_words: int) -> list[tuple[int, int, int]]:
    """(start, end, words) of the runs of marked chunks that have enough words."""
    step = np.diff(marked.astype(np.int8), prepend=0, append=0)
    total = np.concatenate([[0], np.cumsum(words)])
    out = []
    for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1)):
        if total[b] - total[a] >= least_words:
            out.append((int(ends[a - 1]) if a else 0, int(ends[b - 1]), int(total[b] - total[a])))
    return out


def repeats(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per text: doc_id, n_words, n_chunks, n_repeated, passages, removable.

    ``passages`` lists the runs of repeated chunks as (start, end, words) in code points, ``removable``
    those runs of which every chunk occurs first in another text (lower id first), so that cutting them out leaves each
    passage once. A null or empty text has no chunks. Rows that repeat both id and text are one text, as
    are repeats within a text; rows that share an id but not the text are several.
    """
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    marks = repeated_chunks(packed_entries(docs, max(1, -(-total // settings.slice_bytes)), settings))
    marks = marks.groupBy("doc", "text_hash").agg(F.collect_list(F.struct("place", "first")).alias("marks"))  # at most one text's chunks, twice

    def chunked(batches):
        for batch in batches:
            for part in bounded(batch, 1, BLOCK):
                c = Chunks(part.column(1), settings)
                spans = list(zip(c.first, c.first[1:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).fill_null(int(NO_ID)),
                        pa.array(c.text.view(np.int64)),
                        pa.array([c.point_ends[a:b].astype(np.uint32).tobytes() for a, b in spans], pa.binary()),
                        pa.array([c.words[a:b].astype(np.uint32).tobytes() for a, b in spans], pa.binary()),
                    ],
                    names=["doc_id", "hash", "ends", "words"],
                )

    def judged(batches):
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32())]))
        as_rows = lambda found: [dict(zip(("start", "end", "words"), x)) for x in found]
        for batch in batches:
            out = []
            for doc, ends, words, marks in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                ends, words = np.frombuffer(ends, np.uint32), np.frombuffer(words, np.uint32).astype(np.int64)
                repeated, later = np.zeros(len(ends), bool), np.zeros(len(ends), bool)
                if marks:
                    place = np.array([m["place"] for m in marks])
                    stays = np.array([m["first"] for m in marks])
                    repeated[place] = later[place] = True
                    later[place[stays]] = False
                passages = as_rows(runs(ends, words, repeated, settings.least_words))
                removable = as_rows(runs(ends, words, later, settings.least_words))
                out.append((None if doc == NO_ID else doc, int(words.sum()), len(ends), int(repeated.sum()), passages, removable))
            columns = list(zip(*out)) if out else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), kind, kind]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "n_words", "n_chunks", "n_repeated", "passages", "removable"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(chunked, "doc_id long, hash long, ends binary, words binary")
    joined = rows.join(marks, (F.col("doc_id") == F.col("doc")) & (F.col("hash") == F.col("text_hash")), "left")
    run = "array<struct<start: int, end: int, words: int>>"
    return joined.select("doc_id", "ends", "words", "marks").mapInArrow(
        judged, f"doc_id long, n_words long, n_chunks long, n_repeated long, passages {run}, removable {run}"
    )


def passages(found: DataFrame) -> DataFrame:
    """One row per repeated passage: doc_id, start, end, words, and whether all of it can be cut out."""
    each = found.select("doc_id", "removable", F.explode("passages").alias("p"))
    covered = F.exists("removable", lambda r: (r["start"] <= F.col("p")["start"]) & (r["end"] >= F.col("p")["end"]))
    return each.select("doc_id", "p.*", covered.alias("removable"))


def without(text, spans):
    """The text with the given spans, in ascending order, cut out; a null text stays null."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda s, x: F.struct(x["end"].alias("at"), F.concat(s["out"], F.substring(text, s["at"] + 1, x["start"] - s["at"])).alias("out"))
    return F.aggregate(spans, state, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
