"""Every registered query against its reference SQL, over whole test tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(rows):
    def text(v):
        if v is None:
            return "~"
        return repr(float(v) + 0.0) if isinstance(v, float) else str(v)

    return sorted(tuple(text(v) for v in row) for row in rows)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["lang", "label", "subtype", "n"]
    assert result.count() > 0


# Neither joins of everything with everything nor Python workers in any query.
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = df.select(*[f"`{c}`" for c in columns]).collect()
    answer = duck.execute(SQL[name])
    order = [d[0] for d in answer.description]
    assert sorted(order) == columns
    expected = [tuple(row[order.index(c)] for c in columns) for row in answer.fetchall()]
    assert canonical(got) == canonical(expected)
    assert not [w for w in UNWANTED if w in plan_of(df)]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
