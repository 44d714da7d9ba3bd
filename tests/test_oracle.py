"""Every registered query against its SQL, on the same Parquet tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from catalogue import queries as catalogue

QUERIES, CHECKS = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, connection, name):
    result = QUERIES[name](spark, sf_dir)
    got = _rows(result.columns, [tuple(r) for r in result.collect()])
    expected = connection.execute(CHECKS[name])
    columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(columns)
    assert got == _rows(columns, expected.fetchall())
