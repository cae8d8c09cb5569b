"""Every query of items, matching, reports and deliveries against its SQL, and the entry's registry."""

import os

import duckdb
import pytest

from loomspan.plans import delivery_queries, item_queries, matching_queries, report_queries

MODULES = (item_queries, matching_queries, report_queries, delivery_queries)


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for name in os.listdir(small):
        con.execute(f"create view {name[:-8]} as select * from read_parquet('{small}/{name}')")
    return con


@pytest.mark.parametrize("name", sorted(n for m in MODULES for n in m.SQL))
def test_query_equals_sql(spark, small, duck, name):
    module = next(m for m in MODULES if name in m.SQL)
    frame, found = module.QUERIES[name](spark, small), duck.execute(module.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(frame.columns)
    rows = lambda data: sorted(tuple(str(x) for x in r) for r in data)
    got = rows(frame.select(*names).collect())
    assert got == rows(found.fetchall()) and got


def test_every_module_is_registered():
    import __spark_entry__ as entry

    known, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(known)
    for module in MODULES:
        assert set(module.QUERIES) <= set(known) and all(sql[n] == s for n, s in module.SQL.items())
