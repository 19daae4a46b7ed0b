"""Nearest neighbours by multiprobe p-stable hashing, with exact reranking.

On unit vectors the largest cosine is the smallest distance. Each of several tables cuts the space by
random projections, shifted and divided into cells of one width; a bucket is a cell of all projections of
a table. A query looks into its own bucket and into those next to it, in the order of how likely they
hold near vectors: a step over a border costs the squared distance to it, and the cheapest sums come
first. Candidates of all tables are compared exactly.

Equal vectors are one entry with their smallest ids, more of which no answer can contain. Width and
number of probes are fitted on a bounded sample of queries, whose true neighbours come from a comparison
with all vectors. Queries that end up with too few neighbours are compared with all vectors, in blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featureflow.llm.common import GOLDEN, mixed, stored


@dataclass(frozen=True)
class Settings:
    tables: int = 4
    projections: int = 6
    #: Queries of the sample, at most, and the share of their true neighbours that probes must reach.
    sample: int = 100
    reached: float = 0.97
    #: Cell width, as a multiple of the median distance of the sample's last true neighbours.
    width: float = 1.8
    #: Vectors and queries that are compared in one go, about; larger buckets are dealt out.
    vectors: int = 4096
    queries: int = 1024


@dataclass(frozen=True)
class Hashing:
    settings: Settings
    width: float
    probes: int

    def projected(self, x: np.ndarray, table: int) -> np.ndarray:
        """Place of unit vectors along a table's projections, in cells."""
        random = np.random.default_rng([table, x.shape[1]])
        directions = random.standard_normal((x.shape[1], self.settings.projections))
        return x @ directions / self.width + random.uniform(0, 1, self.settings.projections)

    @staticmethod
    def bucket(cells: np.ndarray, table: int, dimension: int) -> np.ndarray:
        out = np.full(len(cells), table * 1_000_003 + dimension, np.uint64)
        for j in range(cells.shape[1]):
            out = mixed(out * GOLDEN + cells[:, j].astype(np.int64).view(np.uint64))
        return out.view(np.int64)


def steps(fraction: np.ndarray, most: int) -> list[tuple[int, ...]]:
    """Up to ``most`` neighbouring cells of a place in its cell, cheapest first, beginning with no step.

    Each is a set of single steps (j: down, j + M: up along projection j), never both along one.
    """
    m = len(fraction)
    cost = np.concatenate([fraction**2, (1 - fraction) ** 2])
    order = np.argsort(cost, kind="stable")
    price = cost[order].tolist()
    out: list[tuple[int, ...]] = [()]
    heap = [(price[0], (0,))]
    while heap and len(out) < most:
        total, chosen = heapq.heappop(heap)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - price[last] + price[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (total + price[last + 1], (*chosen, last + 1)))
        single = [int(order[k]) for k in chosen]
        if len({s % m for s in single}) == len(single):
            out.append(tuple(single))
    return out


def moved(cell: np.ndarray, taken: list[tuple[int, ...]]) -> np.ndarray:
    m = len(cell)
    cells = np.repeat(cell[None], len(taken), axis=0)
    for k, single in enumerate(taken):
        for s in single:
            cells[k, s % m] += 1 if s >= m else -1
    return cells


# --- vectors ---------------------------------------------------------------------------------------


def vectors_of(rows: DataFrame) -> DataFrame:
    """(vec_id, vec): packed doubles of the rows that take part, scaled by a power of two.

    Rows without id, and vectors that are null, zero, or hold null or non-finite components, are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, packed = [], []
            column = batch.column(1)
            for i, vec_id in enumerate(batch.column(0).to_pylist()):
                value = column[i]
                if vec_id is None or not value.is_valid or value.values.null_count:
                    continue
                x = value.values.to_numpy(zero_copy_only=False)
                largest = np.abs(x).max(initial=0.0)
                if np.isfinite(x).all() and largest > 0:
                    ids.append(vec_id)
                    packed.append((np.ldexp(x, -int(np.frexp(largest)[1])) + 0.0).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(packed, pa.binary())], names=["vec_id", "vec"])

    typed = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return typed.mapInArrow(run, "vec_id long, vec binary")


def entries_of(vectors: DataFrame, k: int) -> DataFrame:
    """(key, vec, ids): one row per distinct vector with its k + 1 smallest ids."""
    place = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    few = vectors.distinct().withColumn("_place", place).where(F.col("_place") <= k + 1)
    return few.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(F.md5("vec").alias("key"), "vec", "ids")


def unpacked(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Packed vectors of one length as a matrix."""
    rows = [np.frombuffer(b.as_buffer(), np.float64) for b in column]
    return np.stack(rows) if rows else np.zeros((0, 1))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def best(q: np.ndarray, v: np.ndarray, first_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, cosine) of each query's k + 1 best vectors: largest cosine, then smallest id.

    The product only preselects; the cosines are computed pair by pair, alike in every block.
    """
    rough = unit(q) @ unit(v).T
    n = min(k + 1, len(v))
    least = np.partition(rough, len(v) - n, axis=1)[:, len(v) - n]
    at, to = np.nonzero(rough >= least[:, None] - 1e-12)
    exact = cosines(q, v, at, to)
    order = np.lexsort((first_ids[to], -exact, at))
    at, to, exact = at[order], to[order], exact[order]
    rank = np.arange(len(at)) - np.searchsorted(at, at)
    return at[rank < n], to[rank < n], exact[rank < n]


def cosines(q: np.ndarray, v: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    out = np.zeros(len(at))
    nq, nv = np.sqrt((q * q).sum(axis=1)), np.sqrt((v * v).sum(axis=1))
    for i in range(0, len(at), 65536):
        a, b = at[i : i + 65536], to[i : i + 65536]
        out[i : i + 65536] = (q[a] * v[b]).sum(axis=1) / (nq[a] * nv[b])
    return out


FOUND = "qkey string, key string, score double, ids array<long>"


def found_rows(qkeys: pa.Array, q, keys, v, ids, k: int) -> pa.Table:
    first = np.array([i[0].as_py() for i in ids], np.int64)
    at, to, exact = best(q, v, first, k)
    return pa.table({"qkey": qkeys.take(pa.array(at)), "key": keys.take(pa.array(to)), "score": pa.array(exact), "ids": ids.take(pa.array(to))})


def whole(array) -> pa.Array:
    return array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array


def compared_with_all(entries: DataFrame, qkeys: list[str], packed: list[bytes], k: int) -> DataFrame:
    """The best entries for a block of queries, by comparison with every entry."""
    shared = entries.sparkSession.sparkContext.broadcast((qkeys, packed))  # a block's size is bounded

    def run(batches):
        qkeys, packed = shared.value
        sizes = {}
        for i, b in enumerate(packed):
            sizes.setdefault(len(b), []).append(i)
        for batch in batches:
            lengths = np.array([len(b.as_buffer()) for b in batch.column("vec")])
            for size, of in sizes.items():
                rows = batch.filter(pa.array(lengths == size))
                q = np.stack([np.frombuffer(packed[i], np.float64) for i in of])
                for i in range(0, rows.num_rows, 4096):
                    some = rows.slice(i, 4096)
                    got = found_rows(pa.array([qkeys[j] for j in of]), q, some.column("key"), unpacked(some.column("vec")), some.column("ids"), k)
                    yield from got.to_batches()

    return entries.mapInArrow(run, FOUND)


def top_entries(found: DataFrame, k: int) -> DataFrame:
    """The k + 1 best entries of each distinct query vector."""
    place = F.row_number().over(Window.partitionBy("qkey").orderBy(F.col("score").desc(), F.col("ids")[0], "key"))
    return found.dropDuplicates(["qkey", "key"]).withColumn("_place", place).where(F.col("_place") <= k + 1).drop("_place")


def fitted(entries: DataFrame, queries: DataFrame, k: int, settings: Settings) -> Hashing:
    """Cell width and number of probes that reach the wanted share of a sample's true neighbours."""
    sample = queries.orderBy(F.xxhash64("key"), "key").limit(settings.sample).collect()
    vec = {r["key"]: np.frombuffer(r["vec"], np.float64) for r in sample}
    true = top_entries(compared_with_all(entries, list(vec), [v.tobytes() for v in vec.values()], k), k)
    true = true.where("qkey <> key").join(entries.select("key", "vec"), "key").select("qkey", "vec").collect()
    pairs = [(unit(vec[r["qkey"]][None]), unit(np.frombuffer(r["vec"], np.float64)[None])) for r in true]
    most = 3**settings.projections
    if not pairs:
        return Hashing(settings, 1.0, most)
    last: dict[str, float] = {}
    for r, (a, b) in zip(true, pairs):
        last[r["qkey"]] = max(last.get(r["qkey"], 0.0), float(np.linalg.norm(a - b)))
    width = max(settings.width * float(np.median(list(last.values()))), 1e-3)
    for _ in range(8):
        hashing = Hashing(settings, width, most)
        ranks = []
        for a, b in pairs:
            rank = float("inf")
            for table in range(settings.tables):
                p, o = hashing.projected(a, table)[0], np.floor(hashing.projected(b, table)[0])
                step = o - np.floor(p)
                if np.abs(step).max() <= 1:
                    wanted = {j + (len(step) if s > 0 else 0) for j, s in enumerate(step) if s}
                    taken = steps(p - np.floor(p), most)
                    rank = min(rank, next(i for i, s in enumerate(taken) if set(s) == wanted))
            ranks.append(rank)
        needed = sorted(ranks)[min(len(ranks) - 1, int(np.ceil(settings.reached * len(ranks))))]
        if np.isfinite(needed):
            return Hashing(settings, width, int(needed) + 1)
        width *= 1.4
    return Hashing(settings, width, most)


def hashed(rows: DataFrame, hashing: Hashing, probing: bool) -> DataFrame:
    """The rows once for each bucket that they lie in, or that they probe."""

    def run(batches):
        for batch in batches:
            lengths = np.array([len(b.as_buffer()) for b in batch.column("vec")])
            for size in np.unique(lengths):
                some = batch.filter(pa.array(lengths == size))
                x = unit(unpacked(some.column("vec")))
                for table in range(hashing.settings.tables):
                    place = hashing.projected(x, table)
                    cells = np.floor(place)
                    if not probing:
                        yield with_bucket(some, hashing.bucket(cells, table, x.shape[1]))
                        continue
                    for i in range(len(x)):
                        around = moved(cells[i], steps(place[i] - cells[i], hashing.probes))
                        repeated = some.slice(i, 1).take(pa.array(np.zeros(len(around), np.int64)))
                        yield with_bucket(repeated, hashing.bucket(around, table, x.shape[1]))

    def with_bucket(batch, bucket):
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(bucket)], names=[*batch.schema.names, "bucket"])

    kinds = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    return rows.mapInArrow(run, f"{kinds}, bucket long")


def nearest(rows: DataFrame, queries: DataFrame, k: int = 5, settings: Settings = Settings()) -> DataFrame:
    """(query_id, rank, vec_id, score): for each id in ``queries`` its k nearest rows by cosine, others than itself.

    ``rows`` has vec_id and embedding (any array of numbers), ``queries`` the vec_ids that ask. Ties go to the
    smaller vec_id; with k or fewer other rows all are returned. Rows without id, and vectors that are
    null, zero, or hold null or non-finite components, neither ask nor answer. Only vectors of one
    length are compared. Rows that repeat id and vector count once.
    """
    vectors = stored(vectors_of(rows), "vectors")
    entries = stored(entries_of(vectors, k), "vector-entries")
    asking = vectors.join(queries.select("vec_id").distinct(), "vec_id").distinct()
    asking = stored(asking.select(F.col("vec_id").alias("query_id"), F.md5("vec").alias("qkey"), "vec"), "queries")
    distinct = stored(asking.dropDuplicates(["qkey"]).select(F.col("qkey").alias("key"), "vec"), "query-entries")
    hashing = fitted(entries, distinct, k, settings)

    index = stored(hashed(entries, hashing, False), "index")
    probes = stored(hashed(distinct, hashing, True), "probes")
    # Buckets with many vectors or queries are dealt out: each part of one side meets each of the other.
    parts = lambda n, size: F.ceil(n / size).cast("int")
    sizes = index.groupBy("bucket").agg(parts(F.count("*"), settings.vectors).alias("vparts"))
    asked = probes.groupBy("bucket").agg(parts(F.count("*"), settings.queries).alias("qparts"))
    sizes = stored(sizes.join(asked, "bucket"), "bucket-sizes")
    part_of = lambda key, n: F.pmod(F.xxhash64(key), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = index.join(sizes, "bucket").select("bucket", "key", "vec", "ids", part_of("key", F.col("vparts")).alias("vpart"), every(F.col("qparts")).alias("qpart"))
    right = probes.join(sizes, "bucket").select("bucket", "key", "vec", part_of("key", F.col("qparts")).alias("qpart"), every(F.col("vparts")).alias("vpart"))

    def compare(v: pa.Table, q: pa.Table) -> pa.Table:
        if v.num_rows == 0 or q.num_rows == 0:
            return pa.table({"qkey": pa.array([], pa.string()), "key": pa.array([], pa.string()), "score": pa.array([], pa.float64()), "ids": pa.array([], pa.list_(pa.int64()))})
        return found_rows(whole(q.column("key")), unpacked(q.column("vec")), whole(v.column("key")), unpacked(v.column("vec")), whole(v.column("ids")), k)

    keys = ["bucket", "vpart", "qpart"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, FOUND)
    found = stored(top_entries(met, k), "found")

    # Entries hold all ids but those that k + 1 smaller ones of the same vector precede.
    got = found.groupBy("qkey").agg(F.sum(F.size("ids")).alias("n"))
    lacking = distinct.join(got, distinct["key"] == got["qkey"], "left").where(F.coalesce("n", F.lit(0)) <= k).select("key", "vec")
    lacking = stored(lacking, "lacking")
    others = []
    for block in _blocks(lacking, settings.queries):
        others.append(stored(top_entries(compared_with_all(entries, [r["key"] for r in block], [bytes(r["vec"]) for r in block], k), k), "found"))
    for other in others:
        found = found.unionByName(other)
    if others:
        found = stored(top_entries(found, k), "found")

    answers = asking.select("query_id", "qkey").join(found, "qkey").select("query_id", "score", F.explode("ids").alias("vec_id"))
    answers = answers.where("vec_id <> query_id")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    once = answers.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _blocks(rows: DataFrame, size: int) -> Iterator[list]:
    block: list = []
    for row in rows.toLocalIterator():
        block.append(row)
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block
