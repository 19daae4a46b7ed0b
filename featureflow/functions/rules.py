"""Keyword rules for grape varieties: main type, subtype, alternative labelings and suggestions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from featureflow.functions.text import Hint, Rule, classify, contains_any, squash, squash_terms, suggest

# The word lists below decide the labels and are part of the expected results.
RED_TERMS = (
    "red", "pinot noir", "pinot nero", "carmenère", "nero d'avola", "mourvèdre",
    "blaufränkisch", "primitivo", "zinfandel", "merlot", "syrah", "malbec",
    "sangiovese", "nebbiolo", "tempranillo", "touriga nacional", "tannat",
    "dolcetto", "pinotage", "cabernet franc", "petit verdot", "grenache", "shiraz", "barbera",
    "garnacha", "petitesirah", "gamay", "corvina", "aglianico",
    "bordeaux", "burgundy", "beaujolais", "barolo", "chianti", "rioja",
)
WHITE_TERMS = (
    "white", "pinot bianco", "pinot blanc", "grüner veltliner", "sauvignon blanc",
    "riesling", "pinot gris", "pinot grigio", "melon", "vermentino", "sémillon",
    "fiano", "alvarinho", "friulano", "nerello", "greco", "grillo",
    "viognier", "gewürztraminer", "chenin blanc", "malvasia", "verdejo",
    "trebbiano", "moschofilero", "moscato", "chablis", "sancerre", "soave",
)
FORTIFIED_TERMS = ("port", "sherry", "tokay", "muscat", "tawny", "botrytis")
SPARKLING_TERMS = ("champagne", "sparkling", "prosecco", "spumante", "cava")
ROSE_TERMS = ("rosé", "rose", "rosado", "rosato")
RED_INDICATORS = ("malbec", "cab", "noir", "shiraz", "syrah", "zinfandel", "merlot")
WHITE_INDICATORS = ("blanc", "sauv", "chard", "riesling", "grigio", "gris", "semillon")

FULL_RED = ("shiraz", "cabernet sauvignon", "durif", "malbec", "mourvèdre", "petit verdot")
MEDIUM_RED = (
    "merlot", "grenache", "tempranillo", "sangiovese", "montepulciano", "cabernet franc",
    "barbera", "nero d'avola",
)
LIGHT_RED = ("pinot noir", "pinot meunier", "gamay")
LIGHT_WHITE = (
    "sauvignon blanc", "riesling", "semillon", "pinot gris", "pinot grigio",
    "grüner veltliner", "marsanne", "fiano", "moscato",
)
FULL_WHITE = (
    "chardonnay", "viognier", "vermentino", "verdelho", "albariño", "gewürztraminer", "arneis",
)
RED_BLENDS = ("red blend", "bordeaux-style red blend")
WHITE_BLENDS = ("white blend", "bordeaux-style white blend")
SPARKLING_SUBTYPES = ("champagne", "prosecco")
FORTIFIED_SUBTYPES = ("tokay", "muscat", "sherry", "tawny", "botrytis")

EXTRA_RED = (
    "cabernet franc", "petit verdot", "grenache", "shiraz", "mencia",
    "corvina", "aglianico", "cab", "cinsault", "gamay", "bonarda",
    "petit sirah", "barbera", "lagrein", "frappato", "nero", "petitesirah", "garnacha",
    "bordeaux", "burgundy", "beaujolais", "châteauneuf", "barolo",
    "chianti", "rioja", "brunello", "amarone", "valpolicella",
)
EXTRA_WHITE = (
    "malvasia", "verdejo", "trebbiano", "moschofilero", "moscato",
    "chenin blanc", "torrontés", "viura", "furmint", "roussanne",
    "gewürztraminer", "marsanne", "assyrtiko", "godello", "garganega",
    "viognier", "grünerveltliner", "chablis", "sancerre", "soave", "pouilly-fumé", "orvieto",
    "albariño", "vouvray",
)
CHECKED_RED = ("petitesirah", "grenache", "barbera", "garnacha")
CHECKED_WHITE = ("viognier", "grünerveltliner", "gewürztraminer")
SWEET_TERMS = ("dessert", "sweet", "late harvest")
REGIONAL_TERMS = ("bordeaux", "burgundy", "beaujolais")

WIDER_RED = RED_TERMS + EXTRA_RED
WIDER_WHITE = WHITE_TERMS + EXTRA_WHITE

MAIN_TYPE_RULES = (
    Rule("sparkling", SPARKLING_TERMS),
    Rule("rosé", ROSE_TERMS),
    Rule("fortified", FORTIFIED_TERMS),
    Rule("red", squash_terms(RED_TERMS)),
    Rule("white", squash_terms(WHITE_TERMS)),
    Rule("red", RED_INDICATORS),
    Rule("white", WHITE_INDICATORS),
    Rule("red blend", ("blend",)),
)

SUBTYPE_RULES = (
    Rule("sparkling rosé", SPARKLING_SUBTYPES, also=ROSE_TERMS),
    Rule("sparkling", SPARKLING_SUBTYPES),
    Rule("fortified", FORTIFIED_SUBTYPES),
    Rule("rosé", ROSE_TERMS),
    Rule("red blend", squash_terms(RED_BLENDS)),
    Rule("white blend", squash_terms(WHITE_BLENDS)),
    Rule("full-bodied red", squash_terms(FULL_RED)),
    Rule("medium-bodied red", squash_terms(MEDIUM_RED)),
    Rule("light-bodied red", squash_terms(LIGHT_RED)),
    Rule("light-bodied white", squash_terms(LIGHT_WHITE)),
    Rule("full-bodied white", squash_terms(FULL_WHITE)),
)

# Alternative labelings, matched on the lower-cased value with its spaces.
_EXACT_FIRST = (
    Rule("red", WIDER_RED, exact=True),
    Rule("white", WIDER_WHITE, exact=True),
)
_CHECKED = (
    Rule("red", CHECKED_RED),
    Rule("white", CHECKED_WHITE),
)
_WIDER_CONTAINS = (
    Rule("sparkling", SPARKLING_TERMS),
    Rule("rosé", ROSE_TERMS),
    Rule("fortified", FORTIFIED_TERMS + SWEET_TERMS),
    Rule("red", WIDER_RED),
    Rule("white", WIDER_WHITE),
    Rule("red blend", ("blend",)),
)
EXACT_FIRST_RULES = _EXACT_FIRST + _WIDER_CONTAINS
EXACT_CHECKED_RULES = _EXACT_FIRST + _CHECKED + _WIDER_CONTAINS
# Matched on the squashed value.
WIDER_SQUASHED_RULES = (
    Rule("red", squash_terms(WIDER_RED)),
    Rule("white", squash_terms(WIDER_WHITE)),
    *_CHECKED,
    Rule("red blend", ("blend",)),
)

SUGGESTION_HINTS = (
    Hint("red", 0.9, "Contains red term", RED_TERMS),
    Hint("white", 0.9, "Contains white term", WHITE_TERMS),
    Hint("red", 0.8, "Contains red indicator", RED_INDICATORS),
    Hint("white", 0.8, "Contains white indicator", WHITE_INDICATORS),
    Hint("regional", 0.7, "Contains regional reference", REGIONAL_TERMS, name_term=False),
)


def main_type(variety: Column) -> Column:
    return classify(squash(variety), MAIN_TYPE_RULES)


def subtype(variety: Column) -> Column:
    """Finer label; values without one keep their main type."""
    return classify(squash(variety), SUBTYPE_RULES, default=main_type(variety))


def alternative_type(variety: Column, method: str = "squashed") -> Column:
    """Labelings with the wider word lists: ``exact``, ``checked`` or ``squashed`` matching."""
    if method == "squashed":
        return classify(squash(variety), WIDER_SQUASHED_RULES)
    rules = {"exact": EXACT_FIRST_RULES, "checked": EXACT_CHECKED_RULES}[method]
    return classify(F.lower(variety), rules)


def suggest_type(variety: Column) -> Column:
    return suggest(variety, SUGGESTION_HINTS)


def term_flags(variety: Column) -> tuple[Column, Column]:
    """Does any wider red / white term occur in the lower-cased value?"""
    text = F.lower(variety)
    return contains_any(text, WIDER_RED), contains_any(text, WIDER_WHITE)
