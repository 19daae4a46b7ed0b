"""Rows that every operator over texts must bear: nulls, empty and long texts, repeats, clashing columns."""

LONG = "Alpha beta gamma delta. " * 4000

TEXTS = [
    (1, "One plain text with a few words in it, nothing more."),
    (1, "One plain text with a few words in it, nothing more."),
    (2, None),
    (3, ""),
    (None, "A text without an id and some words"),
    (None, None),
    (4, " \t\n"),
    (5, LONG),
    (6, "été Straße \U0001f600 漢字 ΑΣ \x00 \x1c end"),
    (7, "One plain text with a few words in it, nothing more."),
    (7, "Another text under the same id as the one before."),
]

#: Names that operators use themselves, and one that differs by case alone.
CLASHING = ("score", "Digest", "node", "secrets", "n_tokens", "held", "bucket", "lang", "_key", "y", "words", "row", "_source")


def documents(spark, rows=TEXTS, clashing=CLASHING):
    """The rows with further columns that bear names used inside the operators."""
    more = [(i, t, *[f"own {c}" for c in clashing]) for i, t in rows]
    schema = ", ".join(["doc_id long", "text string", *[f"`{c}` string" for c in clashing]])
    return spark.createDataFrame(more, schema).repartition(3)


def plain(rows):
    """Rows as tuples in an order that bears nulls."""
    return sorted((tuple(r) for r in rows), key=repr)
