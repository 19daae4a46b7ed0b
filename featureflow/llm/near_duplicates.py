"""Near duplicates by order MinHash, verified by banded alignment.

A text's k-mers are its runs of five words, each labelled with how often it has occurred before in the
text. A sketch takes the few labelled k-mers that are smallest under a random order and keeps them in
the order of the text, so that two texts agree in a sketch with a probability that falls with their edit
distance, moved parts included. Texts that agree in one of many sketches share a bucket and are
candidates; they are linked if the edit similarity of their words, 1 - distance / longer length, is at
least 0.8. Classes are the connected components of the links.

Texts of the same words are one node from the start. Within a bucket not all pairs are made. First, in the
buckets of a few sketches, the first node is compared with all others; then, in all buckets, the nodes
outside the bucket's largest class with that class's first node. What is left are buckets with nodes of
different classes, such as texts that share a passage and nothing else. Their nodes go through an exact
join: two similar texts share some of the rarest words, or rarest pairs of words, of either. Classes are
joined by these first, and of classes that share enough those nodes are compared whose words, as far as
signatures tell, may be similar. So a similar pair is missed only if it shares no sketch; no bucket, word
or text is cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.llm.common import GOLDEN, add_columns, bounded, fresh, mixed, stored
from featureflow.llm.decontaminate import Words
from featureflow.operators.order import range_count
from featureflow.session import scratch_path
from featureflow.sources.feature_tables import write_bucketed

#: Bytes of text, or of packed words, that are worked on at once.
BLOCK = 1 << 20
#: Bits, as a power of two, of the map that spares most texts without partners the way to the join of words.
MAP_BITS = 25
#: Texts on which words and pairs of words are tried before one of them is chosen; either is exact.
TRIED_TEXTS = 4096
#: Longs of a signature. The bits should be some times the words in which two texts of common length differ: what
#: falls on one bit twice is not seen.
SIGNATURE = 32


@dataclass(frozen=True)
class Settings:
    words: int = 5
    #: k-mers of a sketch, and sketches of a text.
    kept: int = 2
    sketches: int = 72
    similarity: float = 0.8
    #: Sketches that the first step goes by; it only shares out the work.
    early: int = 6
    #: For ``candidates`` alone: k-mers of a text that are looked at, and texts that may hold one of them before it
    #: counts as a common passage.
    taken: int = 64
    few: int = 32


# --- sketches --------------------------------------------------------------------------------------


def node_ids(words: Words) -> np.ndarray:
    """One number for each text's sequence of words; 0 if it has none."""
    place = np.arange(len(words.hashes), dtype=np.uint64) - np.repeat(words.first, words.counts).astype(np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(words.hashes + place * GOLDEN))])
    ids = mixed(sums[words.first + words.counts] - sums[words.first] + words.counts.astype(np.uint64))
    return np.where(words.counts > 0, ids, 0).view(np.int64)


def numbered_kmers(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every k-mer, its number among equal ones of its text, and the text; a shorter text is one k-mer."""
    rows, h = words.rows, words.hashes
    n = len(h)
    left = (words.first + words.counts)[rows] - np.arange(n)  # words from here to the end of the text
    begins = (left >= k) | (np.arange(n) == words.first[rows])
    kmer = np.zeros(n, np.uint64)
    for i in range(min(k, n)):
        part = np.zeros(n, np.uint64)
        part[: n - i] = h[i:]
        kmer = mixed(kmer * GOLDEN + np.where(left > i, part, np.uint64(0)) + np.uint64(i))
    kmer, rows = kmer[begins], rows[begins]
    order = np.lexsort((kmer, rows))
    same = np.concatenate([[False], (kmer[order][1:] == kmer[order][:-1]) & (rows[order][1:] == rows[order][:-1])]) if len(kmer) else np.zeros(0, bool)
    run = np.arange(len(kmer)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(kmer))))
    number = np.zeros(len(kmer), np.uint64)
    number[order] = run.astype(np.uint64)
    return kmer, number, rows


def labelled_kmers(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text of every k-mer, its number among equal ones in the hash."""
    kmer, number, rows = numbered_kmers(words, k)
    return mixed(kmer + number * np.uint64(0xD6E8FEB86659FD93)), rows


def sketches(words: Words, settings: Settings) -> np.ndarray:
    """Text by sketch: hash of the smallest k-mers in text order; texts without words have zeros."""
    return smallest(*labelled_kmers(words, settings.words), len(words.counts), settings.kept, settings.sketches)


def smallest(items: np.ndarray, rows: np.ndarray, n: int, kept: int, count: int) -> np.ndarray:
    """Row by sketch: hash of the ``kept`` items that are smallest under each random order, in the order of the row.

    ``rows`` ascend from 0 to ``n`` - 1; rows without items have zeros.
    """
    out = np.zeros((n, count), np.uint64)
    used, first = np.unique(rows, return_index=True)
    if len(used) == 0:
        return out
    sizes = np.diff(np.append(first, len(items)))
    text = np.repeat(np.arange(len(used)), sizes)
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    multipliers = mixed(np.arange(1, count + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)
    for s, a in enumerate(multipliers):
        order = items * a
        order ^= order >> np.uint64(32)
        at = np.full((len(used), kept), len(items))
        for i in range(kept):
            least = np.minimum.reduceat(order, first)
            hit = np.flatnonzero(order == least[text])
            hit = hit[np.concatenate([[True], text[hit][1:] != text[hit][:-1]])]
            left = np.minimum(sizes, kept) > i  # a short text has fewer items
            hit = hit[left[text[hit]]]
            at[text[hit], i] = hit
            order[hit] = top
        at.sort(axis=1)
        value = np.full(len(used), s + 1, np.uint64)
        padded = np.append(items, np.uint64(0))
        for i in range(kept):
            value = mixed(value * GOLDEN + padded[at[:, i]])
        out[used, s] = value
    return out


def sketched(docs: DataFrame, settings: Settings) -> DataFrame:
    """(doc_id, node, n_words, buckets) of every text."""

    def run(batches):
        for batch in batches:
            for part in bounded(batch, 1, BLOCK):
                words = Words(part.column(1))
                values = sketches(words, settings).view(np.int64)
                n = np.where(words.counts > 0, settings.sketches, 0)
                offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                buckets = pa.ListArray.from_arrays(offsets, pa.array(values[words.counts > 0].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(node_ids(words)), pa.array(words.counts.astype(np.int32)), buckets], names=["doc_id", "node", "n_words", "buckets"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, node long, n_words int, buckets array<long>")


# --- alignment -------------------------------------------------------------------------------------


def distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edit distance of two sequences if it is at most ``most``, else ``most`` + 1.

    Only a band of ``most`` places around the main diagonal is computed. Its columns are bit vectors that
    move down a row with each column, so the last cell's diagonal keeps its bit.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return most + 1
    n = len(b)
    differs = np.flatnonzero(a[:n] != b)
    head = int(differs[0]) if len(differs) else n
    a, b = a[head:], b[head:]
    if len(b):
        differs = np.flatnonzero(a[len(a) - len(b) :][::-1] != b[::-1])
        tail = int(differs[0]) if len(differs) else len(b)
        a, b = a[: len(a) - tail], b[: len(b) - tail]
    if len(b) == 0:
        return len(a)
    more = len(a) - len(b)
    if common_count(a, b) < len(a) - most:
        return most + 1

    where: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | 1 << i
    d = min(most, len(a))
    width = 2 * d + 1
    mask = (1 << width) - 1
    up, down = mask ^ ((1 << d) - 1), 0  # steps of +1 and -1 from row to row, from row 1 on
    diagonal = 1 << d + more
    far = more
    for j, x in enumerate(b.tolist(), 1):
        equal = where.get(x, 0)
        shift = j - d - 1  # the lowest row of the window, counted from 0
        equal = (equal >> shift if shift > 0 else equal << -shift) & mask
        level = ((((equal & up) + up) ^ up) | equal | down) & mask
        if not level & diagonal:
            far += 1
            if far > most:
                return most + 1
        right = down | (mask ^ (level | up))
        left = level & up
        level >>= 1
        up = left | (mask ^ (level | right))
        down = level & right
    return far


def common_count(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the common part of two sequences as multisets."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return int(np.minimum(n[i], m[j]).sum())


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    longer = max(len(a), len(b))
    most = int((1 - least) * longer + 1e-9)
    return distance(a, b, most) <= most


# --- links and classes -----------------------------------------------------------------------------


def needed_words(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, words): packed word hashes of the given nodes, one row each.

    The join decides which texts are needed. A map of fixed size, its bits set on the executors, only keeps
    texts that can't be from being sent there; it spares less the more nodes there are.
    """
    place = F.pmod(F.col("node"), F.lit(1 << MAP_BITS))
    bits = nodes.select(F.shiftright(place, 6).alias("at"), F.expr("shiftleft(1L, cast(pmod(node, 64) AS int))").alias("bit"))
    # At most 2**MAP_BITS / 64 rows of 64 bits, whatever the number of nodes.
    got = bits.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    held = np.zeros(1 << MAP_BITS - 6, np.int64)
    held[got["at"].to_numpy()] = got["bits"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(held)

    def run(batches):
        for batch in batches:
            for part in bounded(batch, 0, BLOCK):
                words = Words(part.column(0))
                ids = node_ids(words)
                at = ids % (1 << MAP_BITS)
                rows = np.flatnonzero((words.counts > 0) & ((shared.value[at >> 6] >> (at & 63)) & 1).astype(bool))
                packed = [words.hashes[a : a + n].astype(np.uint32).tobytes() for a, n in zip(words.first[rows], words.counts[rows])]
                yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(packed, pa.binary())], names=["node", "words"])

    found = docs.select("text").mapInArrow(run, "node long, words binary")
    # Rows of a node are equal, and collapse before they are sent.
    return found.join(nodes, "node", "left_semi").groupBy("node").agg(F.max("words").alias("words"))


# --- what few texts hold ---------------------------------------------------------------------------


def rare_kmers(words: DataFrame, settings: Settings) -> DataFrame:
    """(node, n_words, kmer): of each text the labelled k-mers with the smallest hashes, ``settings.taken`` at most.

    Small hashes are the same ones in every text, so two texts that share k-mers share some of these.
    """

    def run(batches):
        for batch in batches:
            for part in bounded(batch, 1, BLOCK):
                texts = Packed(part.column(1))
                kmer, rows = labelled_kmers(texts, settings.words)
                order = np.lexsort((kmer, rows))
                kmer, rows = kmer[order], rows[order]
                sizes = np.bincount(rows, minlength=part.num_rows)
                place = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                at = np.flatnonzero(place < settings.taken)
                columns = [part.column(0).take(pa.array(rows[at])), pa.array(texts.counts[rows[at]].astype(np.int32)), pa.array(kmer[at].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "n_words", "kmer"])

    return words.select("node", "words").mapInArrow(run, "node long, n_words int, kmer long")


class Packed:
    """The words of packed texts, in the form of ``Words``."""

    def __init__(self, held: pa.Array):
        self.counts = pc.binary_length(held).to_numpy(zero_copy_only=False).astype(np.int64) // 4
        self.first = np.cumsum(self.counts) - self.counts
        self.rows = np.repeat(np.arange(len(self.counts)), self.counts)
        self.hashes = mixed(np.frombuffer(b"".join(held.to_pylist()), np.uint32).astype(np.uint64))


def candidates(words: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """Distinct (a, b) of nodes with different labels and fitting lengths that share one of their rare k-mers.

    ``words`` has (node, words), ``labels`` (node, label). A k-mer of few texts joins each with each; one of
    more, such as a common passage, only with the first of them. Either way a k-mer's pairs are at most
    ``settings.few`` times its texts. This is a quick look that leaves pairs out; ``classes`` goes by
    ``exact_candidates``.
    """
    held = stored(rare_kmers(words, settings).join(labels, "node"), "rare-kmers")
    often = held.groupBy("kmer").agg(F.count("*").alias("n"), F.min(F.struct("node", "label", "n_words")).alias("lead")).where("n > 1")
    often = stored(often, "kmer-counts")

    def met(pairs: DataFrame) -> DataFrame:
        fits = F.least("n_words_a", "n_words_b") >= settings.similarity * F.greatest("n_words_a", "n_words_b") - 1e-9
        pairs = pairs.where(fits & (F.col("label_a") != F.col("label_b")))
        return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))

    names = ("node", "label", "n_words")
    few = held.join(often.where(F.col("n") <= settings.few).select("kmer"), "kmer")
    one, two = (few.select("kmer", *[F.col(c).alias(f"{c}_{end}") for c in names]) for end in "ab")
    many = often.where(F.col("n") > settings.few).select("kmer", *[F.col(f"lead.{c}").alias(f"{c}_a") for c in names])
    first = held.select("kmer", *[F.col(c).alias(f"{c}_b") for c in names]).join(many, "kmer")
    return met(one.join(two, "kmer").where("node_a < node_b")).union(met(first)).distinct()


# --- exact join ------------------------------------------------------------------------------------


def needed_shared(n: Column, k: int, settings: Settings) -> tuple[Column, Column]:
    """Length of the prefix of a text of ``n`` words, and how much of it the shorter of two similar texts has in common with the longer's.

    An edit breaks k of the n - k + 1 k-mers at most, which leaves L, as a multiset, in common with any similar text
    that is not longer. L doesn't fall with n, so it holds for the shorter text too. Texts that share L of their
    k-mers in all share 1 of the rarest n - k + 1 - L + 1, and x more of x more.
    """
    least = F.greatest(F.ceil((1 - k * (1 - settings.similarity)) * n - k + 1 - 1e-6), F.lit(1))
    more = F.floor(((1 - settings.similarity) * n + 1e-9) / 8)
    return F.greatest(n - k + 1, F.lit(1)) - least + 1 + more, F.least(1 + more, least)


def kmer_runs(words: Words, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and size of the runs of equal k-mers in each text: the first, the second, the third and fourth, the fifth to eighth and so on.

    A text that repeats a word a thousand times has eleven runs of it, not a thousand labelled words. Two texts that
    hold the same run share as many k-mers of it as the one that has less of it.
    """
    kmer, number, rows = numbered_kmers(words, k)
    run = mixed(kmer + np.frexp(number.astype(np.float64))[1].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.lexsort((run, rows))
    run, rows = run[order], rows[order]
    first = np.flatnonzero(np.concatenate([[True], (run[1:] != run[:-1]) | (rows[1:] != rows[:-1])])) if len(run) else np.zeros(0, np.int64)
    return run[first], rows[first], np.diff(np.append(first, len(run)))


def rarest_kmers(words: DataFrame, k: int, share: int, settings: Settings) -> DataFrame:
    """(node, label, n_words, needed, kmer, times): the prefix of each text, its rarest runs of k-mers and how much of them.

    Rarest is what makes the fewest pairs of texts for each k-mer of the prefixes it fills, counted over all texts
    that are taken: every ``share``-th. So a long run, such as a line repeated throughout, comes before the same
    line's short ones, and fills with one meeting what they would with several. Runs of one text alone come first in
    its prefix, and as they meet nothing, only their number is needed.
    """

    def run(batches):
        for batch in batches:
            for part in bounded(batch, 1, BLOCK):
                kmer, rows, times = kmer_runs(Packed(part.column(1)), k)
                columns = [part.column(0).take(pa.array(rows)), pa.array(kmer.view(np.int64)), pa.array(times.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "kmer", "times"])

    taken = words.where(F.pmod(F.xxhash64("node"), F.lit(share)) == 0)
    held = taken.select("node", "words").mapInArrow(run, "node long, kmer long, times int")
    often = held.groupBy("kmer").agg(F.count("*").alias("n"), F.sum("times").alias("held")).where("n > 1")
    often = stored(often.select("kmer", (F.col("n") * F.col("n") / F.col("held")).alias("cost")), "kmer-counts")
    # What comes before a run is what neither it nor one of more cost holds.
    after = Window.partitionBy("node").orderBy(F.col("cost").desc(), F.col("kmer").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = held.join(often, "kmer").withColumn("rest", F.sum("times").over(after))
    length, needed = needed_shared(F.col("n_words"), k, settings)
    left = length - (F.greatest(F.col("n_words") - k + 1, F.lit(1)) - F.col("rest"))
    rows = ranked.join(taken.select("node", "label", word_count().alias("n_words")), "node").withColumn("left", left).where("left > 0")
    return rows.select("node", "label", "n_words", needed.alias("needed"), "kmer", F.least("times", "left").alias("times"))


def word_count() -> Column:
    return (F.octet_length("words") / 4).cast("int")


def signatures(words: DataFrame) -> DataFrame:
    """(node, label, n_words, signature): of each bit's labelled words, whether their number is odd."""

    def run(batches):
        for batch in batches:
            for part in bounded(batch, 3, BLOCK):
                word, rows = labelled_kmers(Packed(part.column(3)), 1)
                bit = word % np.uint64(64 * SIGNATURE)
                held = np.zeros((part.num_rows, SIGNATURE), np.uint64)
                np.bitwise_xor.at(held, (rows, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
                offsets = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * SIGNATURE)
                signature = pa.ListArray.from_arrays(offsets, pa.array(held.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], signature], names=["node", "label", "n_words", "signature"])

    rows = words.select("node", "label", word_count().alias("n_words"), "words")
    return rows.mapInArrow(run, "node long, label long, n_words int, signature array<long>")


def differing_bits(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, n: total + n)


def may_be_similar(longest: Column, apart: Column, settings: Settings) -> Column:
    """Whether the columns ``signature_a`` and ``signature_b`` leave it open that texts are similar whose lengths are ``apart``.

    An edit changes one word of either text at most, or one of one text, and a word changes a bit at most.
    """
    most = F.floor((1 - settings.similarity) * longest + 1e-9)
    return differing_bits("signature_a", "signature_b") <= 2 * most - apart


def class_signatures(nodes: DataFrame) -> DataFrame:
    """(label, signature, radius): the first node's signature of each class and the most bits that another's differs from it.

    So nodes of two classes differ in as many bits as these signatures, less both radii, at least.
    """
    lead = nodes.groupBy("label").agg(F.min("node").alias("node"), F.count("*").alias("size"))
    lead = stored(lead.join(nodes.select("node", "signature"), "node").select("label", "node", "signature", "size"), "class-leads")
    several = lead.where("size > 1").select("label", F.col("node").alias("lead"), F.col("signature").alias("signature_a"))
    others = nodes.select("label", "node", F.col("signature").alias("signature_b")).join(several, "label").where("node <> lead")
    radius = others.groupBy("label").agg(F.max(differing_bits("signature_a", "signature_b")).alias("radius"))
    return lead.join(radius, "label", "left").select("label", "signature", F.coalesce("radius", F.lit(0)).alias("radius"))


def exact_candidates(words: DataFrame, settings: Settings) -> DataFrame:
    """Distinct (a, b) of nodes with different labels, among them all whose texts are similar.

    ``words`` has (node, label, words). A prefix-filtered join: two similar texts have many words in common, and
    many pairs of words in a row, so each has some of them among its rarest. Words or pairs are taken by what makes
    fewer pairs of classes on some texts; either is complete. First labels are joined, with as much of each run as
    one of their nodes has, then the nodes of labels that share enough. So a class meets another text once for each
    run, whatever the number of its nodes, and two nodes meet once.
    """
    share = max(1, words.count() // TRIED_TEXTS)
    best = None
    # Below 0.75, two similar texts of few words may have no pair of words in common.
    for k in (1, 2) if settings.similarity >= 0.75 else (1,):
        often = rarest_kmers(words, k, share, settings).select("kmer", "label").distinct().groupBy("kmer").agg(F.count("*").alias("n"))
        made = often.agg(F.sum(F.col("n") * (F.col("n") - 1.0))).first()[0] or 0.0
        if best is None or made < best[0]:
            best = made, k
    nodes = stored(signatures(words), "signatures")
    by_class = rarest_kmers(words, best[1], 1, settings).groupBy("kmer", "label")
    held = by_class.agg(
        *[F.max("times").alias("times"), F.min("needed").alias("needed"), F.min("n_words").alias("shortest"), F.max("n_words").alias("longest")],
        F.count("*").alias("nodes"),
    )
    held = stored(held, "class-kmers")
    several = held.groupBy("kmer").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("kmer")
    held = held.join(stored(several, "mixed-kmers"), "kmer")
    held = stored(held.join(class_signatures(nodes), "label"), "signed-kmers")

    one, two = (held.select("kmer", *[F.col(c).alias(f"{c}_{end}") for c in held.columns if c != "kmer"]) for end in "ab")
    least = settings.similarity
    fits = (F.col("longest_a") >= least * F.col("shortest_b") - 1e-9) & (F.col("longest_b") >= least * F.col("shortest_a") - 1e-9)
    # Signatures that are apart by so much more than the radii leave no two nodes of the classes similar.
    apart = F.greatest(F.col("shortest_a") - F.col("longest_b"), F.col("shortest_b") - F.col("longest_a"), F.lit(0))
    near = may_be_similar(F.greatest("longest_a", "longest_b"), apart - F.col("radius_a") - F.col("radius_b"), settings)
    met = one.join(two, "kmer").where((F.col("label_a") < F.col("label_b")) & fits & near)
    shared, needed = F.sum(F.least("times_a", "times_b")), F.min(F.least("needed_a", "needed_b"))
    met = met.groupBy("label_a", "label_b").agg(shared.alias("shared"), needed.alias("needed"), (F.sum("nodes_a") <= F.sum("nodes_b")).alias("fewer"))
    met = met.where("shared >= needed")
    # The class that seems smaller is dealt out first.
    met = met.select(F.expr("if(fewer, label_a, label_b)").alias("label_a"), F.expr("if(fewer, label_b, label_a)").alias("label_b"))

    one, two = (nodes.select(*[F.col(c).alias(f"{c}_{end}") for c in nodes.columns]) for end in "ab")
    fits = F.least("n_words_a", "n_words_b") >= least * F.greatest("n_words_a", "n_words_b") - 1e-9
    near = may_be_similar(F.greatest("n_words_a", "n_words_b"), F.abs(F.col("n_words_a") - F.col("n_words_b")), settings)
    pairs = met.join(one, "label_a").join(two, "label_b").where(fits & near)
    return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))


def linked(pairs: DataFrame, words: DataFrame, settings: Settings) -> DataFrame:
    """Those (a, b) of the pairs whose texts are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = ([np.frombuffer(x.as_buffer(), np.uint32) for x in batch.column(i)] for i in (2, 3))
            ok = pa.array([similar(x, y, settings.similarity) for x, y in zip(a, b)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])

    one = words.select(F.col("node").alias("a"), F.col("words").alias("words_a"))
    two = words.select(F.col("node").alias("b"), F.col("words").alias("words_b"))
    rows = pairs.join(one, "a").join(two, "b").select("a", "b", "words_a", "words_b")
    return rows.mapInArrow(run, "a long, b long")


def components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after the links' ends get one label: the smallest in each connected component.

    The links are first drawn between labels. In each round a label moves to the smallest target among
    its own, its neighbours' and its target's.
    """
    one = labels.select(F.col("node").alias("a"), F.col("label").alias("x"))
    two = labels.select(F.col("node").alias("b"), F.col("label").alias("y"))
    drawn = links.join(one, "a").join(two, "b").where("x <> y")
    ways = F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y")))
    edges = stored(drawn.select(F.explode(ways).alias("e")).select("e.x", "e.y").distinct(), "edges")
    moved = stored(edges.groupBy(F.col("x").alias("label")).agg(F.least(F.min("y"), F.col("label")).alias("to")), "moved")
    while True:
        near = edges.join(moved.select(F.col("label").alias("y"), "to"), "y").groupBy(F.col("x").alias("label")).agg(F.min("to").alias("near"))
        jump = moved.select(F.col("label").alias("to"), F.col("to").alias("next"))
        after = moved.join(near, "label").join(jump, "to").select("label", F.col("to").alias("was"), F.least("to", "near", "next").alias("to"))
        after = stored(after, "moved")
        changed = after.where("was <> to").limit(1).count()
        moved = after.select("label", "to")
        if not changed:
            break
    return stored(labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")


def classes(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per text: doc_id, node, class_node, class_id.

    ``node`` stands for a sequence of words, ``class_node`` for the class, ``class_id`` is the smallest doc_id
    of the class (null if none of its texts has an id). Words: letters A-Z lower-cased, then runs of digits, a-z and characters beyond ASCII. A
    null or empty text, and any text without words, has node 0, no class_node, and its own id as
    class_id. Rows that repeat a text share its class.
    """
    texts = stored(sketched(docs, settings), "sketches")
    # Copies of one node collapse before its buckets are dealt out.
    nodes = stored(texts.where("node <> 0").groupBy("node").agg(F.first("n_words").alias("n_words"), F.first("buckets").alias("buckets")), "nodes")
    buckets = nodes.select("node", "n_words", F.posexplode("buckets").alias("sketch", "bucket"))
    sizes = buckets.groupBy("bucket").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead < last").drop("last")
    shared = stored(buckets.join(stored(sizes, "bucket-leads"), "bucket"), "shared-buckets")

    def compared(those: DataFrame, leads: DataFrame) -> DataFrame:
        """Distinct pairs of the given nodes with their buckets' leads."""
        fits = F.least("n", "n_words") >= settings.similarity * F.greatest("n", "n_words") - 1e-9
        met = those.join(leads, "bucket").where(fits & (F.col("node") != F.col("target")))
        return stored(met.select(F.least("node", "target").alias("a"), F.greatest("node", "target").alias("b")).distinct(), "pairs")

    def joined(labels: DataFrame, pairs: DataFrame) -> DataFrame:
        return components(labels, stored(linked(pairs, words, settings), "links"))

    def mixed_buckets(rows: DataFrame, labels: DataFrame) -> DataFrame:
        """(bucket, node, n_words, label) of the buckets that hold several classes."""
        marked = stored(rows.select("bucket", "node", "n_words").join(labels, "node"), "marked")
        several = marked.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        return stored(marked.join(stored(several.select("bucket"), "mixed-buckets"), "bucket"), "open-buckets")

    early = shared.where(F.col("sketch") < settings.early)
    lead = early.where("node = lead").select("bucket", F.col("node").alias("target"), F.col("n_words").alias("n"))
    labels = stored(shared.select("node").distinct().select("node", F.col("node").alias("label")), "labels")
    # Dealt out and sorted by node, as the words are joined by it time and again: then only the pairs are sent.
    words = write_bucketed(needed_words(docs, labels.select("node")), scratch_path(docs.sparkSession, "node-words"), "node", range_count(docs))
    labels = joined(labels, compared(early, lead))

    held = mixed_buckets(shared, labels)
    by_class = held.groupBy("bucket", "label").agg(F.count("*").alias("size"), F.min(F.struct("node", "n_words")).alias("first"))
    most = by_class.groupBy("bucket").agg(F.max_by(F.struct("label", "first"), F.struct("size", "label")).alias("most"))
    most = stored(most.select("bucket", F.col("most.label").alias("own"), F.col("most.first.node").alias("target"), F.col("most.first.n_words").alias("n")), "largest-classes")
    others = stored(held.join(most.select("bucket", "own"), "bucket").where("label <> own"), "outside-largest")
    labels = joined(labels, compared(others, most.drop("own")))

    held = mixed_buckets(held, labels)
    left = stored(words.join(held.select("node", "label").distinct(), "node").select("node", "label", "words"), "open-words")
    labels = joined(labels, stored(exact_candidates(left, settings), "pairs"))

    known = texts.select("doc_id", "node").join(labels, "node", "left")
    known = known.select("doc_id", "node", F.when(F.col("node") != 0, F.coalesce("label", "node")).alias("class_node"))
    known = stored(known, "classes")
    least = known.where("class_node IS NOT NULL").groupBy("class_node").agg(F.min("doc_id").alias("least"))
    least = stored(least, "class-ids").withColumnRenamed("class_node", "_class")
    joined = known.join(least, F.col("class_node") == F.col("_class"), "left")
    own = F.when(F.col("class_node").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return joined.select("doc_id", "node", "class_node", own.alias("class_id"))


def representatives(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that stay: of each class one row of its smallest doc_id, ids before null.

    Of rows that share id and words one stays, the one whose text comes first. A text without words is
    a class of its own with all rows of that id and no words.
    """
    node, key, place = (fresh(docs, name) for name in ("_node", "_key", "_place"))
    found = classes(docs.select("doc_id", "text"), settings)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("one")
    chosen = found.where("node <> 0").groupBy("class_node").agg(first).select("one.doc_id", "one.node")
    chosen = chosen.union(found.where("node = 0").select("doc_id", "node").distinct())
    chosen = stored(chosen.select(F.xxhash64("doc_id", "node").alias(key)).distinct(), "chosen")
    fields = T.StructType([T.StructField(node, T.LongType())])
    noded = add_columns(docs, "text", fields, lambda: lambda texts: [node_ids(Words(pa.array(texts, pa.string())))], BLOCK)
    keyed = noded.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), node))
    # Only rows that stay are sorted by their text.
    left = keyed.join(chosen, key, "left_semi")
    once = left.withColumn(place, F.row_number().over(Window.partitionBy(key).orderBy("text"))).where(F.col(place) == 1)
    return once.select(*[F.col(f"`{c}`") for c in docs.columns])
