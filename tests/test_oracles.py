"""Every registered query of the analytics operators against its DuckDB oracle, on the smallest tables."""

import math
import os

import duckdb
import pytest

from tidemill.plans.registry import ORACLE_SQL, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def norm(x):
    if x is None:
        return (0, "")
    if isinstance(x, (int, float)) or hasattr(x, "as_integer_ratio"):
        return (1, "nan" if isinstance(x, float) and math.isnan(x) else float(x))
    return (2, str(x))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    mine = sorted((tuple(norm(r[c]) for c in columns) for r in df.collect()), key=str)
    cur = duck.execute(ORACLE_SQL[name])
    theirs = [d[0] for d in cur.description]
    assert columns == sorted(theirs)
    at = [theirs.index(c) for c in columns]
    assert mine == sorted((tuple(norm(r[i]) for i in at) for r in cur.fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs_and_repeats(spark, name):
    a, b = (sorted(map(str, QUERIES[name](spark, DATA).collect())) for _ in range(2))
    assert a and a == b
