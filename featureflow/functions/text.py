"""Text normalisation and ordered keyword rules as native Column expressions."""

from __future__ import annotations

import operator
import string
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ASCII_PUNCTUATION = string.punctuation

# The characters that count as whitespace in Unicode-aware text processing.
UNICODE_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def normalize_text(col: Column, null_token: str = "nan") -> Column:
    """Lower-case, then remove ASCII punctuation and all whitespace; accents stay.

    One ``translate`` does both removals in a single pass over the string. ``null_token`` is what a
    null becomes: ``'nan'`` on training tables, ``'unknown'`` on tables to be scored.
    """
    text = F.lower(F.coalesce(col.cast("string"), F.lit(null_token)))
    return F.translate(text, ASCII_PUNCTUATION + UNICODE_WHITESPACE, "")


def squash(col: Column) -> Column:
    """Lower-case without spaces: the form keyword rules are matched against."""
    return F.replace(F.lower(col), F.lit(" "), F.lit(""))


def squash_terms(terms: Iterable[str]) -> tuple[str, ...]:
    return tuple(term.lower().replace(" ", "") for term in terms)


def contains_any(col: Column, terms: Sequence[str]) -> Column:
    """True where the value holds at least one of the terms.

    A chain of plain substring searches stays inside generated code and measured 2-6 times faster than a
    regex alternation or an ``exists`` over a literal array.
    """
    return reduce(operator.or_, [F.contains(col, F.lit(t)) for t in terms])


def is_blend(col: Column) -> Column:
    """True where the value mentions a blend, whatever the case; null counts as no."""
    return F.contains(F.lower(F.coalesce(col.cast("string"), F.lit("nan"))), F.lit("blend"))


@dataclass(frozen=True)
class Rule:
    """``label`` applies where a term occurs (or equals the value, with ``exact``).

    ``also`` asks for one more term out of a second list.
    """

    label: str
    terms: tuple[str, ...]
    also: tuple[str, ...] = ()
    exact: bool = False

    def applies(self, col: Column) -> Column:
        hit = col.isin(*self.terms) if self.exact else contains_any(col, self.terms)
        return hit & contains_any(col, self.also) if self.also else hit


def classify(col: Column, rules: Sequence[Rule], default: Column | str = "other") -> Column:
    """Label of the first rule that applies, else ``default``; null goes to the default."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    branches = None
    for rule in rules:
        label = F.lit(rule.label)
        condition = rule.applies(col)
        branches = F.when(condition, label) if branches is None else branches.when(condition, label)
    return fallback if branches is None else branches.otherwise(fallback)


@dataclass(frozen=True)
class Hint:
    """A group of terms with the label, confidence and wording of the reason they give."""

    label: str
    confidence: float
    reason: str
    terms: tuple[str, ...]
    name_term: bool = True


def suggest(col: Column, hints: Sequence[Hint]) -> Column:
    """``struct(label, confidence, reason)`` from the first group with a match.

    Within a group the first term in list order is the one named in the reason. One conditional finds
    the number of the first matching term; the three fields are looked up by that number.
    """
    text = F.lower(col)
    verdicts = [
        (hint.label, hint.confidence, f"{hint.reason}: {term}" if hint.name_term else hint.reason)
        for hint in hints
        for term in hint.terms
    ]
    terms = [term for hint in hints for term in hint.terms]
    number = F.when(col.isNull(), len(terms))
    for i, term in enumerate(terms):
        number = number.when(F.contains(text, F.lit(term)), i)
    number = number.otherwise(len(terms) + 1)
    verdicts += [("other", 0.0, "Not a string"), ("other", 0.2, "No identifiable pattern")]
    labels, confidences, reasons = (F.array(*[F.lit(v) for v in field]) for field in zip(*verdicts))
    return F.struct(
        F.get(labels, number).alias("label"),
        F.get(confidences, number).alias("confidence"),
        F.get(reasons, number).alias("reason"),
    )
