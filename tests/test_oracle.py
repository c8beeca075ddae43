"""Every query against its SQL, on the sf0.01 tables unless ORACLE_SF says otherwise."""

import math
import os

import duckdb
import pytest

from cinetally.workload import oracle, queries
from conftest import TESTDATA

FOLDER = f"{TESTDATA}/{os.environ.get('ORACLE_SF', 'sf0.01')}"
SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}
QUERIES = queries.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for file in sorted(os.listdir(FOLDER)):
        name = file.removesuffix(".parquet")
        db.sql(f"create view {name} as select * from '{FOLDER}/{file}'")
    return db


def _sortable(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    columns = sorted(result.columns)
    got = [tuple(_plain(r[c]) for c in columns) for r in result.collect()]
    relation = duck.sql(SQL[name])
    assert sorted(relation.columns) == columns
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert types == {f.name: SQL_TYPES[f.dataType.simpleString()] for f in result.schema}
    order = [relation.columns.index(c) for c in columns]
    expected = [tuple(_plain(r[i]) for i in order) for r in relation.fetchall()]
    assert len(got) > 0
    assert len(got) == len(expected)
    assert sorted(got, key=_sortable) == sorted(expected, key=_sortable)
