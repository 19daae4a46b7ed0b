"""Bucketing, replacement, clipping and naming."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score buckets.
POINT_BUCKETS = ((85, "Low"), (90, "Medium"))
TOP_BUCKET = "High"

# Country spellings unified before the continent lookup.
COUNTRY_SPELLINGS = {"US": "United States", "England": "United Kingdom"}

# Continent of each country; anything else is 'Other'.
CONTINENTS = {
    "Africa": (
        "Algeria", "Angola", "Benin", "Botswana", "Burkina Faso", "Burundi", "Cabo Verde", "Cameroon",
        "Central African Republic", "Chad", "Comoros", "Congo", "Djibouti", "Egypt", "Equatorial Guinea",
        "Eritrea", "Eswatini", "Ethiopia", "Gabon", "Gambia", "Ghana", "Guinea", "Guinea-Bissau",
        "Ivory Coast", "Kenya", "Lesotho", "Liberia", "Libya", "Madagascar", "Malawi", "Mali", "Mauritania",
        "Mauritius", "Morocco", "Mozambique", "Namibia", "Niger", "Nigeria", "Rwanda", "Senegal",
        "Seychelles", "Sierra Leone", "Somalia", "South Africa", "South Sudan", "Sudan", "Togo", "Tunisia",
        "Uganda", "Zambia", "Zimbabwe",
    ),
    "Asia": (
        "Afghanistan", "Armenia", "Azerbaijan", "Bahrain", "Bangladesh", "Bhutan", "Brunei", "Cambodia",
        "China", "Cyprus", "Georgia", "Hong Kong", "India", "Indonesia", "Iran", "Iraq", "Israel", "Japan",
        "Jordan", "Kazakhstan", "Kuwait", "Kyrgyzstan", "Laos", "Lebanon", "Malaysia", "Maldives",
        "Mongolia", "Myanmar", "Nepal", "North Korea", "Oman", "Pakistan", "Palestine", "Philippines",
        "Qatar", "Saudi Arabia", "Singapore", "South Korea", "Sri Lanka", "Syria", "Taiwan", "Tajikistan",
        "Thailand", "Turkey", "Turkmenistan", "United Arab Emirates", "Uzbekistan", "Vietnam", "Yemen",
    ),
    "Europe": (
        "Albania", "Andorra", "Austria", "Belarus", "Belgium", "Bosnia and Herzegovina", "Bulgaria",
        "Croatia", "Czech Republic", "Czechia", "Denmark", "Estonia", "Finland", "France", "Germany",
        "Greece", "Hungary", "Iceland", "Ireland", "Italy", "Kosovo", "Latvia", "Liechtenstein",
        "Lithuania", "Luxembourg", "Malta", "Moldova", "Monaco", "Montenegro", "Netherlands",
        "North Macedonia", "Norway", "Poland", "Portugal", "Romania", "Russia", "San Marino", "Serbia",
        "Slovakia", "Slovenia", "Spain", "Sweden", "Switzerland", "Ukraine", "United Kingdom",
    ),
    "North America": (
        "Bahamas", "Barbados", "Belize", "Bermuda", "Canada", "Costa Rica", "Cuba", "Dominica",
        "Dominican Republic", "El Salvador", "Greenland", "Grenada", "Guatemala", "Haiti", "Honduras",
        "Jamaica", "Mexico", "Nicaragua", "Panama", "Puerto Rico", "Saint Lucia", "Trinidad and Tobago",
        "United States",
    ),
    "Oceania": (
        "Australia", "Fiji", "Kiribati", "Marshall Islands", "Nauru", "New Zealand", "Palau",
        "Papua New Guinea", "Samoa", "Solomon Islands", "Tonga", "Tuvalu", "Vanuatu",
    ),
    "South America": (
        "Argentina", "Bolivia", "Brazil", "Chile", "Colombia", "Ecuador", "Guyana", "Paraguay", "Peru",
        "Suriname", "Uruguay", "Venezuela",
    ),
}


def bucket_points(
    points: Column, buckets: Sequence[tuple[float, str]] = POINT_BUCKETS, top: str = TOP_BUCKET
) -> Column:
    """First bucket whose bound the value is below; null lands in the top bucket."""
    branches = F.when(points < buckets[0][0], buckets[0][1])
    for bound, label in buckets[1:]:
        branches = branches.when(points < bound, label)
    return branches.otherwise(top)


def replace_values(col: Column, mapping: Mapping[str, str]) -> Column:
    """Swap listed values; others, and null, stay as they are."""
    branches = None
    for old, new in mapping.items():
        branches = (F.when if branches is None else branches.when)(col == old, new)
    return col if branches is None else branches.otherwise(col)


def continent_of(country: Column, miss: str = "Other", more: Mapping[str, str] | None = None) -> Column:
    """Continent of a standardised country name through fixed membership sets (no join needed).

    ``more`` adds countries, or other spellings, with their continents.
    """
    branches = None
    for continent, names in CONTINENTS.items():
        added = [c for c, where in (more or {}).items() if where == continent]
        member = country.isin(*names, *added)
        branches = (F.when if branches is None else branches.when)(member, continent)
    return branches.otherwise(miss)


def clip(col: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; null stays null (``least``/``greatest`` alone would skip it)."""
    return F.when(col.isNotNull(), F.least(F.greatest(col, F.lit(low)), F.lit(high)))


def nan_to_null(col: Column) -> Column:
    """One missing value instead of two: Spark orders NaN above every number."""
    return F.when(~F.isnan(col), col)


def flag_to_int(col: Column) -> Column:
    """Boolean to 0/1, null to 0."""
    return F.coalesce(col, F.lit(False)).cast("int")


def round_2dp(col: Column) -> Column:
    """Two decimals, halves to even, by scaling: the rounding array libraries do."""
    return F.rint(col * 100) / 100


def feature_name(name: str, max_length: int = 63) -> str:
    """Name allowed in a feature table: lower-case letters, digits and ``_``, starting with a letter."""
    clean = re.sub(r"[^a-z0-9_]", "_", str(name).lower())
    if not clean[:1].isalpha():
        clean = "f_" + clean
    return clean[:max_length]


def feature_names(names: Sequence[str]) -> dict[str, str]:
    """Old name -> allowed name; two columns that would collide are an error."""
    renamed = {name: feature_name(name) for name in names}
    if len(set(renamed.values())) < len(renamed):
        raise ValueError(f"column names collide after cleaning: {renamed}")
    return renamed
