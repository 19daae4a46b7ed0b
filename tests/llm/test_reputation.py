import pytest

from featureflow.llm import reputation
from tests.llm.cases import plain

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def judged(spark, urls, marks=(), rules=RULES, **settings):
    pages = spark.createDataFrame([(i, u, f"own {i}") for i, u in urls], "page_id long, url string, host string")
    labels = spark.createDataFrame(list(marks), "doc_id long, quality int, toxic int")
    return reputation.judge(pages, labels, rules, reputation.Settings(**settings))


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("http://A.Example.ORG/en/1?x#y", "a.example.org", "/en/1", "example.org/en/1", "block"),
        ("http://example.org/en/1", "example.org", "/en/1", "example.org/en/1", "block"),
        ("http://notexample.org/en/1", "notexample.org", "/en/1", "org/", "allow"),
        ("http://example.org", "example.org", "", None, "allow"),
        ("x://com/fr/", "com", "/fr/", "com/fr/", "allow"),
        ("https://Ä.com/de/#", "Ä.com", "/de/", "com/de/", "block"),
        ("https://a.com/dex", "a.com", "/dex", None, "allow"),
        ("https://a.com?/de/", "a.com", "", None, "allow"),
        ("no scheme.com/de/", "", "", None, "allow"),
        ("://x.org/", "x.org", "/", "org/", "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("http://a\nb.org/é\n?q", "a\nb.org", "/é\n", "org/", "allow"),
    ],
)
def test_host_path_and_rules(spark, url, host, path, rule, verdict):
    row = judged(spark, [(1, url)]).select("page_id", "host", "path", "rule", "verdict").first()
    assert tuple(row) == (1, host, path, rule, verdict)


def test_levels(spark):
    names = ["a.b.example.co.uk:80", "user@www.example.com", "com", "10.0.0.1", "", "example.org"]
    rows = reputation.with_levels(spark.createDataFrame([(n,) for n in names], "host string"), reputation.Settings()).collect()
    assert {r["host"]: (r["domain"], r["suffix"]) for r in rows} == {
        "a.b.example.co.uk:80": ("example.co.uk", "co.uk"),
        "user@www.example.com": ("example.com", "com"),
        "com": ("com", ""),
        "10.0.0.1": ("10.0.0.1", ""),
        "": ("", ""),
        "example.org": ("example.org", "org"),
    }


def test_bad_host_is_blocked_and_unseen_ones_follow_their_domain(spark):
    urls = [(i, f"http://h{i % 10}.good{i % 7}.net/") for i in range(700)]
    urls += [(1000 + i, f"http://h{i % 3}.bad.net/") for i in range(90)] + [(2000, "http://new.bad.net/"), (2001, "http://new.good1.net/")]
    marks = [(i, 1, 0) for i in range(700)] + [(1000 + i, 0, 0) for i in range(90)]
    got = {r["host"]: r for r in judged(spark, urls, marks).collect()}
    assert got["h1.bad.net"]["verdict"] == "block" and got["new.bad.net"]["verdict"] == "block"
    assert got["h1.good1.net"]["verdict"] == "allow" and got["new.good1.net"]["verdict"] == "allow"
    assert got["h1.bad.net"]["bound"] < got["h1.bad.net"]["share"]


def test_shrinkage_by_hand(spark):
    groups = spark.createDataFrame([(10, 9, 0.3), (20, 2, 0.3), (0, 0, 0.3)], "n long, bad long, m double")
    seen = ((9 - 3) ** 2 + (2 - 6) ** 2) / 0.21
    within = (seen - 30) / (90 + 380)
    assert reputation.strength(groups) == pytest.approx(1 / within - 1)
    assert reputation.strength(groups.where("n < 2")) == 1.0


def test_repeats_nulls_and_empty_tables(spark):
    urls = [(1, "http://a.net/"), (1, "http://a.net/"), (None, "http://a.net/"), (2, None)]
    marks = [(1, None, None), (1, 0, None), (1, 1, 1), (None, 0, 1)]
    rows = judged(spark, urls, marks).select("page_id", "host", "n", "bad").collect()
    assert plain(rows) == plain([(1, "a.net", 2, 2), (1, "a.net", 2, 2), (None, "a.net", 2, 2), (2, "", 0, 0)])
    assert judged(spark, []).count() == 0
