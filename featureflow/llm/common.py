"""What the operators share: table access, folds, columns computed batch by batch, word hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the table to the shared scratch folder and read it back: computed once, lineage cut."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like the given one that ``df`` doesn't use."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def add_columns(
    df: DataFrame,
    source: str,
    fields: T.StructType,
    make: Callable[[], Callable[[list], Sequence]],
    limit: int = 8 << 20,
) -> DataFrame:
    """``df`` with more columns computed from one column, about ``limit`` bytes of it at once, in its own partitions.

    ``make`` runs once per task and gives a function from the list of values (nulls are None) to one
    list of values per field. Columns of ``df`` that bear the name of a new one are replaced.
    """
    names = {f.name.lower() for f in fields}
    kept = [c for c in df.columns if c.lower() not in names]
    hidden = source.lower() in names
    rows = df.select(*[F.col(f"`{c}`") for c in kept], *([F.col(f"`{source}`").alias("_source")] if hidden else []))
    position = len(kept) if hidden else [c.lower() for c in kept].index(source.lower())
    schema = T.StructType([*rows.schema.fields[: len(kept)], *fields.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for part in bounded(batch, position, limit):
                new = compute(part.column(position).to_pylist())
                arrays = [*part.columns[: len(kept)], *map(pa.array, new, types)]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(f.dataType) for f in fields]
    return rows.mapInArrow(run, schema)


def bounded(batch: pa.RecordBatch, position: int, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``limit`` bytes of the given text or list column each, in order."""
    if batch.num_rows == 0:
        return
    column = batch.column(position)
    size_of = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
    sizes = size_of(column).fill_null(0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


# --- words of many texts at once -------------------------------------------------------------------

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the whole word."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


_ODD = np.uint64(0xD6E8FEB86659FD93)
_POSITION = mixed(np.arange(1, 4097, dtype=np.uint64) * GOLDEN) | np.uint64(1)


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range; ranges are ascending, disjoint and not empty.

    Each byte is multiplied by a random odd number of its place within the range, the products are
    summed, and sum and length are mixed.
    """
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    taken = data[np.repeat(starts, lengths) + place].astype(np.uint64) + np.uint64(1)
    if int(lengths.max()) > len(_POSITION):
        taken *= _POSITION[place % len(_POSITION)] + (place // len(_POSITION)).astype(np.uint64) * _ODD * np.uint64(2)
    else:
        taken *= _POSITION[place]
    return mixed(np.add.reduceat(taken, first) + lengths.astype(np.uint64) * GOLDEN)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the n + 1 offsets of its rows; a null is an empty text."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data[:0], offsets - offsets[0]


#: Lower-cases A-Z and leaves other bytes alone.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def byte_words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of word bytes that stays within one row, and each run's row.

    ``is_word`` is a table over byte values. Word classes that treat all bytes from 0x80 on alike can
    be decided on UTF-8 bytes.
    """
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = is_word[data]
    step = np.diff(inside)
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    cut = np.unique(cut[(inside[cut] == 1) & (inside[cut + 1] == 1)])
    starts = np.sort(np.concatenate([np.flatnonzero(step == 1), cut]))
    ends = np.sort(np.concatenate([np.flatnonzero(step == -1), cut]))
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows
