from __future__ import annotations

import decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from graftline.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = lambda v: f"{float(v):.9g}" if isinstance(v, (float, decimal.Decimal)) else str(v)
    return sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    res = con.execute(registry.ORACLE_SQL[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert normal(df.columns, df.collect()) == normal(columns, res.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(entry.queries()) and set(registry.ORACLE_SQL) <= set(entry.oracle_sql())
