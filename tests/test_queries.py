"""Every query with SQL gives what DuckDB gives on the same tables; every other one runs."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()
CORE = [n for n in QUERIES if not QUERIES[n].__module__.startswith("tessella.llm")]


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value if isinstance(value, (int, str, bool)) else str(value)


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for f in os.listdir(data):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{data}/{f}'")
    return c


def test_all_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES) and {f"p{n}_found" for n in (1, 5)} <= set(QUERIES)


@pytest.mark.parametrize("name", CORE)
def test_query(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in SQL:
        return
    found = duck.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    expected = Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall())
    assert got == expected


def test_entry(spark, data):
    assert entry.entry(spark).count() > 0
