"""Every registered query with SQL against DuckDB on the smallest tables; the others run."""

import os
from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = entry.queries(), entry.oracle_sql()
OWN = [n for n in QUERIES if not n.startswith("op") and n != "pipeline"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


def norm(v):
    if isinstance(v, (float, Decimal)):
        return round(float(v), 6)
    return v.isoformat() if isinstance(v, datetime) else v


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    df = QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    got = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    if name in SQL:
        want = con.sql(SQL[name])
        assert sorted(want.columns) == cols
        assert got == Counter(tuple(norm(dict(zip(want.columns, r, strict=True))[c]) for c in cols) for r in want.fetchall())


def test_no_python_in_plans(spark):
    """The warehouse's plans stay in the JVM, and join by keys."""
    for name in ("country_history", "user_resolution", "facts_days_active"):
        plan = QUERIES[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Cartesian" not in plan
