"""Every query with checking SQL gives the same rows and types as DuckDB."""

import os

import duckdb
import pytest
from conftest import SMALL

from spritelake.plans import oracles, queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def text(v):
    return "NULL" if v is None or v != v else repr(v)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
@pytest.mark.parametrize("name", sorted(oracles.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    found = queries.QUERIES[name](spark, SMALL)
    answer = duck.execute(oracles.ORACLE_SQL[name])
    names = [c[0] for c in answer.description]
    assert sorted(names) == sorted(found.columns)
    kinds = {c[0]: str(c[1]) for c in answer.description}
    assert {c: TYPES.get(t, t) for c, t in found.dtypes} == kinds
    expected = sorted(tuple(map(text, r)) for r in answer.fetchall())
    assert sorted(tuple(text(r[c]) for c in names) for r in found.collect()) == expected


def test_every_query_is_checked():
    assert set(queries.QUERIES) - set(oracles.ORACLE_SQL) == set()
