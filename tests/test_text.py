from pyspark.sql import functions as F

import pytest

from featureflow.functions import rules, scalar
from featureflow.functions.text import is_blend, normalize_text


def apply(spark, values, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


NORMALIZED = {
    "Pinot Noir": "pinotnoir",
    "Chardonnay": "chardonnay",
    "Red Blend": "redblend",
    "Cabernet Sauvignon": "cabernetsauvignon",
    "Bordeaux-style Red Blend": "bordeauxstyleredblend",
    "Syrah": "syrah",
    "Sauvignon Blanc": "sauvignonblanc",
    "Riesling": "riesling",
    "Merlot": "merlot",
    "Rosé": "rosé",
    None: "nan",
}


def test_normalize(spark):
    assert apply(spark, list(NORMALIZED), normalize_text) == list(NORMALIZED.values())
    assert apply(spark, [None], lambda c: normalize_text(c, "unknown")) == ["unknown"]


def test_normalize_removes_all_whitespace_and_punctuation(spark):
    import string

    text = "a" + string.punctuation + "b \t\n  　\x1cC"
    assert apply(spark, [text], normalize_text) == ["abc"]


def test_points(spark):
    values = [80, 84, 85, 89, 90, 100, None]
    expected = ["Low", "Low", "Medium", "Medium", "High", "High", "High"]
    assert apply(spark, values, scalar.bucket_points, "int") == expected


MAIN = {
    "Champagne": "sparkling",
    "Sparkling Blend": "sparkling",
    "Prosecco": "sparkling",
    "Rosé": "rosé",
    "Rose Blend": "rosé",
    "Port": "fortified",
    "Sherry": "fortified",
    "Tokay": "fortified",
    "Botrytis": "fortified",
    "Pinot Noir": "red",
    "Merlot": "red",
    "Syrah": "red",
    "Zinfandel": "red",
    "Pinotage": "red",
    "Sauvignon Blanc": "white",
    "Riesling": "white",
    "Pinot Grigio": "white",
    "Cabernet Sauvignon": "red",
    "Chardonnay": "white",
    "Shiraz": "red",
    "Portuguese Red": "fortified",
    "redblend": "red",
    "G-S-M Blend": "red blend",
    "Unknown Variety": "other",
    "": "other",
    None: "other",
}


def test_main_type(spark):
    assert apply(spark, list(MAIN), rules.main_type) == list(MAIN.values())


SUB = {
    "Champagne": "sparkling",
    "Champagne Rosé": "sparkling rosé",
    "Prosecco": "sparkling rosé",
    "Tokay": "fortified",
    "Sherry": "fortified",
    "port": "fortified",
    "Rosé": "rosé",
    "Sparkling Rosé": "rosé",
    "Red Blend": "red blend",
    "Bordeaux-style Red Blend": "red blend",
    "White Blend": "white blend",
    "Cabernet Sauvignon": "full-bodied red",
    "Malbec": "full-bodied red",
    "shiraz": "full-bodied red",
    "Merlot": "medium-bodied red",
    "Sangiovese": "medium-bodied red",
    "Pinot Noir": "light-bodied red",
    "Sauvignon Blanc": "light-bodied white",
    "Riesling": "light-bodied white",
    "Chardonnay": "full-bodied white",
    "Viognier": "full-bodied white",
    "Unknown Variety": "other",
    None: "other",
}


def test_subtype(spark):
    assert apply(spark, list(SUB), rules.subtype) == list(SUB.values())


def test_terms_keep_apostrophes(spark):
    # The normalised value has lost its apostrophe, so this term cannot match it.
    assert apply(spark, ["nerodavola", "nero d'avola"], rules.main_type) == ["other", "red"]


def test_continent(spark):
    cases = {
        "United States": "North America",
        "France": "Europe",
        "Italy": "Europe",
        "Australia": "Oceania",
        "Argentina": "South America",
        "Chile": "South America",
        "South Africa": "Africa",
        "Japan": "Asia",
        "InvalidCountry": "Other",
        "": "Other",
        None: "Other",
    }
    assert apply(spark, list(cases), scalar.continent_of) == list(cases.values())


def test_country_spellings(spark):
    swap = lambda c: scalar.replace_values(c, scalar.COUNTRY_SPELLINGS)
    assert apply(spark, ["US", "England", "Italy", None], swap) == [
        "United States",
        "United Kingdom",
        "Italy",
        None,
    ]
    assert sum(map(len, scalar.CONTINENTS.values())) < 200


def test_blend(spark):
    assert apply(spark, ["Red BLEND", "Merlot", None], is_blend) == [True, False, False]


def test_suggestions(spark):
    got = apply(spark, ["Big Red Merlot", "Soave Classico", "Cab Franc", "Sauv Gris", "Tannat", None, "xyz"], rules.suggest_type)
    assert [tuple(r) for r in got] == [
        ("red", 0.9, "Contains red term: red"),
        ("white", 0.9, "Contains white term: soave"),
        ("red", 0.8, "Contains red indicator: cab"),
        ("white", 0.8, "Contains white indicator: sauv"),
        ("red", 0.9, "Contains red term: tannat"),
        ("other", 0.0, "Not a string"),
        ("other", 0.2, "No identifiable pattern"),
    ]


def test_alternative_labelings(spark):
    values = ["Petite Sirah", "petitesirah", "Late Harvest Riesling", "pinotnoir", None, "Some Blend"]
    assert apply(spark, values, lambda c: rules.alternative_type(c, "exact")) == [
        "other", "red", "fortified", "other", "other", "red blend",
    ]
    assert apply(spark, values, lambda c: rules.alternative_type(c, "squashed")) == [
        "red", "red", "white", "red", "other", "red blend",
    ]


def test_feature_names():
    assert scalar.feature_name("Price (USD)") == "price__usd_"
    assert scalar.feature_name("1st") == "f_1st"
    assert scalar.feature_name("_x") == "f__x"
    assert len(scalar.feature_name("9" + "a" * 100)) == 63
    with pytest.raises(ValueError):
        scalar.feature_names(["a b", "a-b"])


def test_clip_keeps_null(spark):
    assert apply(spark, [-5.0, 50.0, 500.0, None], lambda c: scalar.clip(c, 0.0, 100.0), "double") == [
        0.0, 50.0, 100.0, None,
    ]
