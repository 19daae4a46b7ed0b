"""Secrets in texts, by patterns and by Shannon entropy in sliding windows; DataFrame functions only.

Three patterns give the base spans. Besides, long runs of token characters are candidates: a window
slides over each, and the entropy of its characters follows from the counts of the one that enters and
the one that leaves. A window counts if all its characters are of a class and its entropy reaches the
class's threshold. Candidates that match an allow-list pattern are left out; base spans never are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns, their order and the least lengths that decide the base spans.
ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_LEAST = 12
# A run of 18 or more characters from AKIA on, or of 16 or more hex digits: shorter ones never hide these.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "entropy")

#: Matches whose places are added up in one go.
BLOCK = 256


@dataclass(frozen=True)
class Settings:
    candidate: str = "[A-Za-z0-9+/_=-]{20,}"
    window: int = 20
    #: Character classes and the entropy, in bits a character, that a window of the class must reach.
    classes: tuple[tuple[str, float], ...] = (("[0-9A-Fa-f]", 3.05), ("[A-Za-z0-9+/_=-]", 3.85))
    #: Candidates that match one of these whole are no secrets: identifiers, dates, slugs, alphabets, digests with a name.
    allowed: tuple[str, ...] = (
        "[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
        "[0-9]{4}-[0-9]{2}-[0-9]{2}[A-Za-z0-9-]*",
        "[A-Za-z]+([-_/][A-Za-z]+)*([-_/][0-9]+)*/?",
        "0123456789[A-Za-z+/=]*",
        "sha(1|256|384|512)[-=].*",
    )
    mask: str = "[SECRET]"


def places(text: str, pattern: str, found: str) -> dict[str, Column]:
    """Text before each match, and the matches with group 2 if there is one, in arrays."""
    t, p = F.col(text), F.lit(pattern)
    hit = t.rlike(pattern)
    columns = {f"{found}_gaps": F.split(t, pattern, -1), f"{found}_all": F.regexp_extract_all(t, p, F.lit(0))}
    if pattern == ASSIGN:
        columns[f"{found}_values"] = F.regexp_extract_all(t, p, F.lit(2))
    return {name: F.when(hit, c) for name, c in columns.items()}


def lengths(found: str, values: bool) -> Column:
    """Per match: length of the text before it, its own length and that of its value."""
    own = F.transform(f"{found}_all", lambda m: F.length(m))
    before = F.transform(F.slice(f"{found}_gaps", 1, F.size(f"{found}_all")), lambda g: F.length(g))
    value = F.transform(f"{found}_values", lambda v: F.length(v)) if values else own
    kinds = "array<struct<before: int, own: int, value: int>>"
    return F.coalesce(F.arrays_zip(before.alias("before"), own.alias("own"), value.alias("value")).cast(kinds), F.array().cast(kinds))


def spans(steps: str, kind: int) -> Column:
    """(start, kind, end, value) of the matches, from the lengths: places add up block by block."""
    kinds = "array<struct<start: int, kind: int, end: int, value: int>>"
    n = F.size(steps)
    blocks = F.when(n > 0, F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))

    def block(b: Column) -> Column:
        at = F.aggregate(F.slice(steps, F.lit(1), b * BLOCK), F.lit(0), lambda s, x: s + x["before"] + x["own"])
        return F.aggregate(
            F.slice(steps, b * BLOCK + 1, F.lit(BLOCK)),
            F.struct(at.alias("at"), F.array().cast(kinds).alias("out")),
            lambda s, x: F.struct(
                (s["at"] + x["before"] + x["own"]).alias("at"),
                F.array_append(
                    s["out"],
                    F.struct(
                        (s["at"] + x["before"]).alias("start"),
                        F.lit(kind).alias("kind"),
                        (s["at"] + x["before"] + x["own"]).alias("end"),
                        x["value"].alias("value"),
                    ),
                ).alias("out"),
            ),
            lambda s: s["out"],
        )

    return F.flatten(F.transform(blocks, block))


def entropy_range(settings: Settings, chars: Column) -> Column:
    """(first, end) over the windows of a candidate that count; end is 0 if none does.

    ``chars`` is a field of a lambda variable, so it is there once per candidate. The sum of c * log2(c)
    over the counts c of a window changes only by the character that leaves and the one that enters.
    """
    w = settings.window

    def count(window: Column, c: Column) -> Column:
        return F.size(F.filter(window, lambda x: x == c))

    def weight(n: Column) -> Column:
        n = F.greatest(n, F.lit(1)).cast("double")
        return n * F.log2(n)

    def step(state: Column, i: Column) -> Column:
        entering = F.element_at(chars, i)
        leaving = F.when(i > w, F.element_at(chars, F.greatest(i - w, F.lit(1))))
        before = F.slice(chars, F.greatest(i - w, F.lit(1)), F.least(i - 1, F.lit(w)))
        left = F.when(i > w, count(before, leaving)).otherwise(0)
        inside = count(before, entering) - F.when(leaving == entering, 1).otherwise(0)
        total = state["total"] + weight(inside + 1) - weight(inside) + F.when(i > w, weight(left - 1) - weight(left)).otherwise(0.0)
        foreign = [
            (state[f"foreign{k}"] + (~entering.rlike(c)).cast("int") - F.when(i > w, (~leaving.rlike(c)).cast("int")).otherwise(0)).alias(f"foreign{k}")
            for k, (c, _) in enumerate(settings.classes)
        ]
        return F.struct(
            total.alias("total"), *foreign, i.alias("i"), state["first"].alias("first"), state["end"].alias("end")
        )

    def judged(state: Column) -> Column:
        entropy = F.round(F.lit(math.log2(w)) - state["total"] / w, 9)
        counts = F.lit(False)
        for k, (_, least) in enumerate(settings.classes):
            counts = counts | (state[f"foreign{k}"] == 0) & (entropy >= least)
        counts = counts & (state["i"] >= w)
        kept = [state[f"foreign{k}"].alias(f"foreign{k}") for k in range(len(settings.classes))]
        return F.struct(
            state["total"].alias("total"),
            *kept,
            state["i"].alias("i"),
            F.when(counts & (state["end"] == 0), state["i"] - w).otherwise(state["first"]).alias("first"),
            F.when(counts, state["i"]).otherwise(state["end"]).alias("end"),
        )

    zero = F.lit(0)
    start = F.struct(
        F.lit(0.0).alias("total"), *[zero.alias(f"foreign{k}") for k in range(len(settings.classes))],
        zero.alias("i"), zero.alias("first"), zero.alias("end"),
    )
    # A one-element transform binds the stepped state, so that it is computed once.
    fold = lambda s, i: F.element_at(F.transform(F.array(step(s, i)), judged), 1)
    return F.aggregate(F.sequence(F.lit(1), F.size(chars)), start, fold, lambda s: F.struct(s["first"].alias("first"), s["end"].alias("end")))


def find(docs: DataFrame, text: str = "text", column: str = "secrets", settings: Settings = Settings()) -> DataFrame:
    """``docs`` with an array of (start, kind, end): all spans by start, then kind; `kind` counts from 0 in KINDS.

    Places count code points, end exclusive. A null or empty text has none. Spans of different kinds may
    overlap; spans of one kind don't. Each row stands by itself, so repeated rows repeat their spans. A
    column already named like the new one is replaced.
    """
    kept = [c for c in docs.columns if c.lower() != column.lower()]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "entropy": settings.candidate}
    found = rows.select("row", *[c.alias(name) for k, p in patterns.items() for name, c in places("t", p, k).items()])
    steps = found.select("row", "entropy_all", *[lengths(k, k == "assign").alias(k) for k in patterns])
    at = steps.select("row", "entropy_all", *[spans(k, i).alias(k) for i, k in enumerate(KINDS)])

    secret = lambda x: x["text"].rlike("[0-9]") & x["text"].rlike("[A-Za-z]") & ~x["text"].rlike(f"^({'|'.join(settings.allowed)})$")
    texts = F.coalesce("entropy_all", F.array().cast("array<string>"))
    candidates = F.filter(F.arrays_zip(texts.alias("text"), F.col("entropy").alias("span")), secret)
    candidates = F.transform(candidates, lambda x: F.struct(x["span"]["start"].alias("start"), F.split(x["text"], "").alias("chars")))
    ranges = F.transform(candidates, lambda x: F.struct(x["start"].alias("start"), entropy_range(settings, x["chars"]).alias("range")))
    at = at.select("row", "assign", "access", "hex", ranges.alias("ranges"))

    plain = lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))
    entropy = F.transform(
        F.filter("ranges", lambda x: x["range"]["end"] > 0),
        lambda x: F.struct(
            (x["start"] + x["range"]["first"]).alias("start"),
            F.lit(KINDS.index("entropy")).alias("kind"),
            (x["start"] + x["range"]["end"]).alias("end"),
        ),
    )
    every = F.concat(
        F.transform(F.filter("assign", lambda x: x["value"] >= ASSIGN_LEAST), plain),
        F.transform("access", plain),
        F.transform("hex", plain),
        entropy,
    )
    return at.select("row", F.array_sort(every).alias("_spans")).select("row.*", F.col("_spans").alias(column))


def joined(found: Column) -> Column:
    """`kind:start:end` of the spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(found, one), ",")


def summary(found: DataFrame, column: str = "secrets") -> dict[str, Column]:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""
    spans_of = F.col(column)

    def number(kind: int) -> Column:
        return F.size(F.filter(spans_of, lambda s: s["kind"] == kind)).cast("long")

    counts = {f"n_{kind}": number(i) for i, kind in enumerate(KINDS[:3])}
    base = F.filter(spans_of, lambda s: s["kind"] < 3)
    return counts | {"base_sha256": F.sha2(joined(base), 256), "spans": joined(spans_of)}


def masked(text: Column, found: Column, settings: Settings = Settings()) -> Column:
    """The text with each run of overlapping spans replaced by the mask; a null text stays null."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        new = x["start"] >= s["at"]
        before = F.when(new, F.substring(text, s["at"] + 1, x["start"] - s["at"])).otherwise("")
        mask = F.when((x["start"] < s["at"]) & (s["at"] > 0), "").otherwise(settings.mask)
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.concat(s["out"], before, mask).alias("out"))

    whole = F.aggregate(found, state, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(found) > 0, whole).otherwise(text)
