"""Fill-in-the-middle: texts cut at two ranks, their parts put in another order between marks.

The units of a text (code points, or the matches of a pattern) form an indexable skip list. Its lowest
lane holds every unit; each express lane holds some of the units of the lane below. A link carries how
many units and how many code points it skips, so descending from the highest lane by accumulated unit
widths reaches the unit of a rank, and the accumulated code-point widths say where to cut the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featureflow.llm.common import bounded, fresh, mixed

PLAIN, PSM, SPM = "plain", "psm", "spm"

#: Bits of a unit's hash that must be zero to rise by one lane: one unit in eight does.
RISE_BITS = 3

FIELDS = T.StructType(
    [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Settings:
    #: Marks before prefix, suffix and middle.
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    #: Of 100 texts so many keep their form, and of 100 others so many have the suffix first.
    plain_percent: int = 10
    spm_percent: int = 20
    seed: str = "1:"
    #: A unit is a match of this pattern with what precedes it unmatched; None: a code point.
    unit: str | None = None


# --- the skip list ---------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _heights(size: int) -> np.ndarray:
    """Lane that the unit at each place rises to, by the place's hash."""
    h = mixed(np.arange(1, size + 1, dtype=np.uint64))
    heights = np.zeros(size, np.uint8)
    for lane in range(1, 64 // RISE_BITS):
        risen = h & np.uint64((1 << RISE_BITS * lane) - 1) == 0
        if not risen.any():
            break
        heights[risen] = lane
    return heights


@dataclass(frozen=True)
class Lane:
    #: Units and code points that each link skips, and the place of its start in the lane below.
    units: np.ndarray
    points: np.ndarray
    below: np.ndarray


class SkipList:
    """Units with their widths in code points."""

    def __init__(self, widths: np.ndarray):
        self.size = len(widths)
        heights = _heights(1 << max(10, self.size.bit_length()))[: self.size]
        units, points, starts = np.ones(self.size, np.int32), widths.astype(np.int32), np.arange(self.size)
        self.lanes = [Lane(units, points, starts)]
        while len(starts) > 1 << RISE_BITS:
            risen = heights[starts] >= len(self.lanes)
            risen[0] = True  # the head of every lane
            below = np.flatnonzero(risen)
            if len(below) == len(starts):
                break
            units, points, starts = np.add.reduceat(units, below), np.add.reduceat(points, below), starts[below]
            self.lanes.append(Lane(units, points, below))

    def points_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units."""
        units = points = at = 0
        for k in range(len(self.lanes) - 1, -1, -1):
            lane = self.lanes[k]
            while at < len(lane.units) and units + int(lane.units[at]) <= rank:
                units, points, at = units + int(lane.units[at]), points + int(lane.points[at]), at + 1
            if units == rank:
                break
            at = int(lane.below[at])
        return points


def unit_widths(text: str, pattern: re.Pattern | None) -> np.ndarray:
    """Code points of each unit; what no match covers belongs to the next match, at the end to the last."""
    if pattern is None:
        return np.ones(len(text), np.int32)
    ends = [m.end() for m in pattern.finditer(text) if m.end() > m.start()]
    if text:
        ends[-1:] = [len(text)]
    return np.diff(np.array([0, *ends], np.int64)).astype(np.int32)


# --- forms -----------------------------------------------------------------------------------------


def draws(key: str, seed: str) -> list[int]:
    """Four numbers of 32 bits from the key's digest."""
    digest = hashlib.sha256((seed + key).encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def transformed(key: str, text: str, settings: Settings, pattern: re.Pattern | None) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle, and the text in its form."""
    widths = unit_widths(text, pattern)
    n = len(widths)
    h1, h2, h3, h4 = draws(key, settings.seed)
    marks = settings.prefix, settings.suffix, settings.middle
    if not text or any(mark in text for mark in marks) or h3 % 100 >= 100 - settings.plain_percent:
        return n, PLAIN, None, None, text
    units = SkipList(widths)
    a, b = (units.points_before(rank) for rank in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < settings.spm_percent:
        form, output = SPM, "".join((settings.suffix, suffix, settings.prefix, prefix, settings.middle, middle))
    else:
        form, output = PSM, "".join((settings.prefix, prefix, settings.suffix, suffix, settings.middle, middle))
    return n, form, a, b - a, output


def transform(docs: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with each text's number of units, form, sizes of prefix and middle, and output.

    The cuts and the form follow from the row's key alone, so repeated rows and repeated runs agree. A null
    text counts as empty and a null key as an empty one; empty texts and texts that hold a mark stay plain,
    and plain texts have null sizes. Each text is handled whole by itself, at any length. Columns that bear
    the name of a new one are replaced, unless they are the key or the text, which the result then lacks.
    """
    own, source = fresh(docs, "_key"), fresh(docs, "_source")
    names = {f.name for f in FIELDS}
    kept = [c for c in docs.columns if c.lower() not in names]
    keyed = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias(own)
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], keyed, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(source))
    schema = T.StructType([*rows.schema.fields[: len(kept)], *FIELDS.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = None if settings.unit is None else re.compile(settings.unit)
        for batch in batches:
            for part in bounded(batch, len(kept) + 1, 2 << 20):
                keys, texts = (part.column(len(kept) + i).to_pylist() for i in (0, 1))
                new = zip(*[transformed(k, t, settings, pattern) for k, t in zip(keys, texts)])
                types = pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *map(pa.array, new, types)], names=schema.names)

    return rows.mapInArrow(run, schema)


def restored(output: Column, form: Column, settings: Settings = Settings()) -> Column:
    """The text that an output and its form were made from.

    Only plain texts hold marks of their own, so in the other forms the first of each mark is the one put in.
    """

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = F.substr(output, F.lit(len(first) + 1))
        to_second, to_middle = F.instr(rest, second), F.instr(rest, settings.middle)
        one = F.left(rest, to_second - 1)
        start = to_second + len(second)
        two = F.substr(rest, start, to_middle - start)
        return one, two, F.substr(rest, to_middle + len(settings.middle))

    prefix, suffix, middle = parts(settings.prefix, settings.suffix)
    turned_suffix, turned_prefix, turned_middle = parts(settings.suffix, settings.prefix)
    return (
        F.when(form == PSM, F.concat(prefix, middle, suffix))
        .when(form == SPM, F.concat(turned_prefix, turned_middle, turned_suffix))
        .otherwise(output)
    )


def digests(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every text."""
    made = transform(docs.select("doc_id", "text"), settings)
    back = restored(F.col("output"), F.col("form"), settings)
    sums = F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *sums)
