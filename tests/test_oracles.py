"""Every query with SQL against DuckDB on the same tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
MAIN = entry.ORACLES


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    return str(v)[:19] if hasattr(v, "isoformat") else v


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(MAIN))
def test_query_gives_the_rows_of_its_sql(name, spark, duck, sf_dir):
    got = entry.queries()[name](spark, sf_dir)
    want = duck.sql(MAIN[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    rows = sorted(str(tuple(map(plain, r))) for r in got.select(*names).collect())
    assert rows == sorted(str(tuple(map(plain, r))) for r in want.project(", ".join(f'"{c}"' for c in names)).fetchall())


def test_names_of_sql_are_names_of_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
