"""Prefix trie of conversations by truncation peeling.

A node is a distinct sequence of first turns. The conversations are grouped by their whole sequence, and
then the trie is peeled from its deepest level up: the nodes of a level are the conversations that end
there merged with what survives of the level below, each of whose nodes loses its last turn and is grouped
anew. Counts, leaves and saved tokens add up on the way, so each level is found and summed in one pass.
Where a sequence shares its first turns with no other, all its further turns are peeled off at once, so a
few very long conversations cost no pass a turn.

A sequence is known by two 64-bit numbers, the exclusive or of hashes of its turns at their places;
taking the last turn off is one more exclusive or. A node carries 20 bytes a turn and no text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.llm.common import stored
from featureflow.session import scratch_path

#: Bytes of comma-joined ids that are packed into one row on their way to a node's digest.
RUN_BYTES = 1 << 16
#: Depths that are peeled one by one; more of them go by halves.
BY_LEVEL = 8
KEY = ("x", "y")
TURN = "array<struct<d: binary, bytes: bigint>>"
NODE = (
    "x long, parent_x long, y long, parent_y long, depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"
)


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as digest of role and text and bytes of the text.

    Null turns come first; equal ones go by role, then by the digest. A null role or text is an empty one.
    Rows without conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(whole, 256)), 1, 16)
    ordered = F.struct(
        F.col("turn").isNotNull().alias("given"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
        role.alias("role"),
        digest.alias("d"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    rows = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), ordered.alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    return grouped.select("conv_id", F.transform("ts", lambda t: F.struct(t["d"].alias("d"), t["bytes"].alias("bytes"))).alias("turns"))


def rebuilt(conversations: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """(conv_id, turns): the first h turns are those of conversation c - c % family, the others its own.

    h is the crc32 of the decimal c modulo ``heads``. A conversation has at most ``family`` - 1 others that
    take its head, so no key of the join is hot.
    """
    sources = conversations.where(F.col("conv_id") % family == 0)
    sources = sources.select(F.col("conv_id").alias("source"), F.slice("turns", 1, heads).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    own = conversations.withColumn("h", h).withColumn("source", F.col("conv_id") - F.col("conv_id") % family)
    joined = own.join(sources, "source", "left")
    head = F.slice(F.coalesce("head", F.array().cast(TURN)), F.lit(1), F.col("h"))
    tail = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(head, tail).alias("turns"))


def keyed(conversations: DataFrame) -> DataFrame:
    """(conv_id, x, y, depth, turns): turns as their hashes by place; x and y stand for the whole sequence."""
    placed = F.transform(
        "turns",
        lambda t, i: F.struct(F.xxhash64(t["d"], i).alias("x"), F.xxhash64(i, t["d"], F.lit("y")).alias("y"), t["bytes"].cast("int").alias("bytes")),
    )
    rows = conversations.select("conv_id", placed.alias("turns"))

    def whole(name: str) -> Column:
        return F.aggregate("turns", F.lit(0).cast("long"), lambda s, t: s.bitwiseXOR(t[name])).alias(name)

    return rows.select("conv_id", whole("x"), whole("y"), F.size("turns").alias("depth"), "turns")


def ends_digests(ended: DataFrame) -> DataFrame:
    """(x, y, ends): SHA-256 of the ascending decimal conv_ids of each sequence, joined by commas.

    The ids are sorted over value ranges that may cut a sequence's ids anywhere and packed into runs there,
    so one task reads a run a row, in order, for the sequence that a third of all conversations share.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, run, size = None, 0, [], 0
        for batch in batches:
            out = []
            for x, y, i in zip(*(column.to_pylist() for column in batch.columns)):
                if (x, y) != key or size > RUN_BYTES:
                    if run:
                        out.append((*key, first, ",".join(run)))
                    key, first, run, size = (x, y), i, [], 0
                run.append(str(i))
                size += len(run[-1]) + 1
            if out:
                yield _runs(out)
        if run:
            yield _runs([(*key, first, ",".join(run))])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            out = []
            for x, y, ids in zip(*(batch.column(c).to_pylist() for c in (0, 1, 3))):
                if (x, y) != key:
                    if key:
                        out.append((*key, digest.hexdigest()))
                    key, digest = (x, y), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if out:
                yield _digests(out)
        if key:
            yield _digests([(*key, digest.hexdigest())])

    order = (*KEY, "conv_id")
    runs = ended.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    runs = runs.mapInArrow(packed, "x long, y long, first long, ids string")
    runs = runs.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return runs.mapInArrow(hashed, "x long, y long, ends string")


def _runs(rows: list[tuple]) -> pa.RecordBatch:
    types = pa.int64(), pa.int64(), pa.int64(), pa.string()
    return pa.RecordBatch.from_arrays([*map(pa.array, zip(*rows), types)], names=["x", "y", "first", "ids"])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    types = pa.int64(), pa.int64(), pa.string()
    return pa.RecordBatch.from_arrays([*map(pa.array, zip(*rows), types)], names=["x", "y", "ends"])


# --- peeling ---------------------------------------------------------------------------------------


def merged(rows: DataFrame) -> DataFrame:
    """Rows that reach one node, from conversations that end there and from nodes below it, become one."""
    return rows.groupBy(*KEY, "depth").agg(
        F.first("turns").alias("turns"),
        F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.sum("children").alias("children"),
        F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"),
        F.max("ends").alias("ends"),
    )


def cut_key(name: str, depth: int) -> Column:
    """Half of the key that a sequence has once it is cut to ``depth`` turns."""
    gone = F.slice("turns", F.lit(depth + 1), F.greatest(F.col("depth") - depth, F.lit(0)))
    return F.aggregate(gone, F.col(name), lambda s, t: s.bitwiseXOR(t[name]))


def shortened(rows: DataFrame, depth: int) -> DataFrame:
    """What merged rows add to the nodes of a smaller depth, to which each is the only way from below."""
    gone = F.slice("turns", F.lit(depth + 1), F.col("depth") - depth)
    bytes_gone = F.aggregate(gone, F.lit(0).cast("long"), lambda s, t: s + t["bytes"])
    return rows.select(
        *[cut_key(c, depth).alias(c) for c in KEY],
        F.lit(depth).alias("depth"),
        F.slice("turns", 1, depth).alias("turns"),
        "n_convs",
        "conv_id",
        F.lit(1).cast("long").alias("children"),
        F.when(F.col("children") == 0, F.lit(1).cast("long")).otherwise(F.col("leaves")).alias("leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * bytes_gone).alias("saved"),
        F.lit(None).cast("string").alias("ends"),
    )


def nodes_down_to(rows: DataFrame, least: int) -> DataFrame:
    """The nodes of merged rows, from each row's own down to depth ``least``, none of which has another row below it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            turns = batch.column("turns")
            sizes = pc.list_value_length(turns).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = turns.flatten()
            row = np.repeat(np.arange(len(sizes)), sizes)
            begin = np.cumsum(sizes) - sizes
            place = np.arange(len(row)) - begin[row] + 1
            get = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
            at = np.flatnonzero(place >= least)
            own, depth = row[at], place[at]
            last = depth == sizes[own]
            columns = {}
            for c in KEY:
                sums = np.concatenate([[0], np.bitwise_xor.accumulate(flat.field(c).to_numpy(zero_copy_only=False))]) if len(flat) else np.zeros(1, np.int64)
                columns[c] = sums[at + 1] ^ sums[begin[own]]
                columns[f"parent_{c}"] = sums[at] ^ sums[begin[own]]
            total = np.concatenate([[0], np.cumsum(flat.field("bytes").to_numpy(zero_copy_only=False).astype(np.int64))])
            n, children = get("n_convs")[own], get("children")[own]
            columns["depth"] = depth.astype(np.int32)
            columns["conv_id"], columns["n_convs"] = get("conv_id")[own], n
            columns["n_children"] = np.where(last, children, 1)
            columns["n_leaves"] = np.where(children == 0, 1, get("leaves")[own])
            columns["saved_tokens"] = get("saved")[own] + (n - 1) * (total[begin[own] + sizes[own]] - total[at])
            ends = pc.if_else(pa.array(last), batch.column("ends").take(pa.array(own)), pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns.values()), ends], names=[*columns, "ends"])

    return rows.mapInArrow(run, NODE)


class Peeling:
    """The nodes found so far, and the steps that find more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def found(self, nodes: DataFrame) -> None:
        self.paths.append(scratch_path(self.spark, "trie-nodes"))
        nodes.write.parquet(self.paths[-1])

    def nodes(self) -> DataFrame:
        return self.spark.read.schema(NODE).parquet(*self.paths)

    def level(self, rows: DataFrame, depth: int) -> DataFrame:
        """Find the nodes of one depth; returns what they add to the level above."""
        whole = stored(merged(rows), "trie-level")
        self.found(nodes_down_to(whole, depth))
        return shortened(whole, depth - 1)

    def block(self, rows: DataFrame, low: int, high: int) -> DataFrame | None:
        """Find all nodes of depths above ``low`` to ``high``; returns what they add to depth ``low``.

        A row that shares its first ``low`` turns with no other loses all further turns at once. The others
        go by the upper half of the depths and then by the lower, and level by level once that is short.
        """
        if high - low <= BY_LEVEL:
            for depth in range(high, low, -1):
                # What a level adds to the next is one of that one's rows.
                rows = self.level(rows.where(F.col("depth") == depth), depth).unionByName(rows.where(F.col("depth") < depth))
            return rows
        whole = merged(rows)
        whole = stored(whole.select("*", *[cut_key(c, low).alias(f"low_{c}") for c in KEY]), "trie-block")
        names = [f"low_{c}" for c in KEY]
        crowded = whole.groupBy(*names).agg(F.count("*").alias("n")).where("n > 1").drop("n")
        crowded = stored(crowded, "trie-crowded")
        if crowded.isEmpty():
            self.found(nodes_down_to(whole.drop(*names), low + 1))
            return shortened(whole, low)
        alone = stored(whole.join(crowded, names, "left_anti").drop(*names), "trie-alone")
        self.found(nodes_down_to(alone, low + 1))
        others = stored(whole.join(crowded, names, "left_semi").drop(*names), "trie-others")
        middle = (low + high) // 2
        deep = others.where(F.col("depth") > middle)
        others = others.where(F.col("depth") <= middle)
        if not deep.isEmpty():
            others = others.unionByName(self.block(deep, middle, high))
        return shortened(alone, low).unionByName(self.block(others, low, middle))


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of (conv_id, turns).

    Columns: x, y, conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. conv_ids are distinct. Turnless conversations are members of the root
    alone; without conversations there is no node. The number of jobs follows the logarithm of the most turns
    and the depths at which different conversations part; a conversation is one row of 20 bytes a turn.
    """
    rows = stored(keyed(conversations), "trie-conversations")
    # Copies of one sequence collapse before they are sent.
    ended = rows.groupBy(*KEY).agg(
        F.first("depth").alias("depth"), F.first("turns").alias("turns"), F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")
    )
    none = F.lit(0).cast("long")
    ended = ended.join(ends_digests(rows), list(KEY)).select(
        *KEY, "depth", "turns", "n_convs", "conv_id", none.alias("children"), none.alias("leaves"), none.alias("saved"), "ends"
    )
    ended = stored(ended.sortWithinPartitions("depth"), "trie-ended")
    deepest = ended.agg(F.max("depth")).first()[0]
    peeling = Peeling(conversations.sparkSession)
    if deepest is None:
        return _without_nodes(rows)
    bounds = [0]
    while bounds[-1] < deepest:
        bounds.append(min(deepest, max(BY_LEVEL, 2 * bounds[-1])))
    carried = None
    for low, high in zip(bounds[-2::-1], bounds[:0:-1]):
        new = ended.where((F.col("depth") > low) & (F.col("depth") <= high))
        carried = peeling.block(new if carried is None else new.unionByName(carried), low, high)
    top = ended.where("depth = 0")
    top = stored(merged(top if carried is None else top.unionByName(carried)), "trie-root")
    root = top.first()["conv_id"]
    leaves = F.when(F.col("children") == 0, F.lit(1).cast("long")).otherwise(F.col("leaves"))
    top = top.select(*KEY, "depth", "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", F.col("children").alias("n_children"),
                     leaves.alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends")
    both = top
    if peeling.paths:
        nodes = peeling.nodes()
        parents = nodes.select(F.col("x").alias("parent_x"), F.col("y").alias("parent_y"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
        # Every first turn has the root above it, which is one row. The others join as plain scans, so that Spark
        # can split the key of a node with very many children.
        first = nodes.where("depth = 1").withColumn("parent_conv_id", F.lit(root).cast("long"))
        later = nodes.where("depth > 1").join(parents, ["parent_x", "parent_y", "depth"], "left")
        both = both.unionByName(first.drop("parent_x", "parent_y")).unionByName(later.drop("parent_x", "parent_y"))
    nobody = hashlib.sha256(b"").hexdigest()
    return both.select(
        *KEY, "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends", F.lit(nobody)).alias("ends_sha256"),
    )


def _without_nodes(rows: DataFrame) -> DataFrame:
    """No nodes, with the columns of a trie."""
    longs = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    return rows.limit(0).select(*KEY, *[F.lit(None).cast("long").alias(c) for c in longs], F.lit(None).cast("string").alias("ends_sha256"))
