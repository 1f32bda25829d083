"""Every query of the core against its SQL on the smallest tables."""

import os

import pytest

from inkmill.plans import queries

FOLDER = os.environ.get("INKMILL_TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{FOLDER}/{t}'")
    df = queries.QUERIES[name](spark, FOLDER)
    want = con.sql(queries.SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    order = [want.columns.index(c) for c in df.columns]
    got = sorted(repr([plain(v) for v in r]) for r in df.collect())
    assert got == sorted(repr([plain(r[k]) for k in order]) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_other_queries_have_rows(spark, name):
    assert queries.QUERIES[name](spark, FOLDER).count() > 0


def test_the_rest_works_without_the_other_subpackage():
    import subprocess
    import sys

    code = "import sys; sys.modules['inkmill.llm'] = None; import __spark_entry__ as e; assert e.queries() and not any(k.startswith('p7') for k in e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
