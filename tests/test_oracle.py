"""Every registered query against its SQL in DuckDB, on whole tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF_DIR):
        con.execute(f"create view {name.removesuffix('.parquet')} as from '{SF_DIR}/{name}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def normal(columns, rows):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in at], sorted(tuple(plain(r[i]) for i in at) for r in map(tuple, rows)) \
        if not any(v is None for r in rows for v in r) \
        else sorted((tuple(plain(r[i]) for i in at) for r in map(tuple, rows)), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, duck, name):
    got = queries()[name](spark, SF_DIR)
    expected = duck.execute(oracle_sql()[name])
    names = [d[0] for d in expected.description]
    want = normal(names, expected.fetchall())
    have = normal(got.columns, got.collect())
    assert have[0] == want[0]
    assert len(have[1]) == len(want[1]) > 0
    assert have[1] == want[1]
