from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from geoledger import registry
from geoledger.registry.views import TABLES

SMALL = "/root/testdata/sf0.001"
QUICK = [
    name
    for name in registry.QUERIES
    if name in registry.CHECKS and name.split("_")[0] in {"p1", "p3", "p8", "p11", "p16", "j1", "j3", "j4", "j7", "j8", "a1", "a4", "m1", "f6", "f9", "f16", "s8", "x3"}
]


def plain(value):
    return None if value is None else str(value)


def rows_of(names, records):
    return sorted([tuple(plain(r[n]) for n in names) for r in records], key=lambda r: [x or "" for x in r])


def test_every_check_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.QUERIES) == set(registry.CHECKS)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, name):
    base = duckdb.connect()
    for table in TABLES:
        base.execute(f"create view {table} as select * from read_parquet('{SMALL}/{table}.parquet')")
    df = entry.queries()[name](spark, SMALL)
    names = sorted(df.columns)
    result = base.execute(entry.oracle_sql()[name])
    columns = [part[0] for part in result.description]
    assert sorted(columns) == names
    expected = [dict(zip(columns, record)) for record in result.fetchall()]
    assert rows_of(names, df.collect()) == rows_of(names, expected)


def test_flagship(spark):
    assert entry.entry(spark).count() == 1
