"""Every query of the catalog against its SQL in an independent engine, and the driver's contract."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from gridloom.plans import catalog

SF = "/root/testdata/sf0.001"


def plain(rows, columns):
    def value(v):
        if v is None or v != v:
            return None
        if isinstance(v, float):
            return round(v, 6)
        return str(v)[:26] if hasattr(v, "isoformat") else v

    return sorted((tuple(value(r[columns.index(c)]) for c in sorted(columns)) for r in rows), key=repr)


@pytest.fixture(scope="module")
def oracle():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_oracle(spark, oracle, name):
    df = catalog.QUERIES[name](spark, SF)
    found = oracle.execute(catalog.ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert plain([tuple(r) for r in df.collect()], df.columns) == plain(found.fetchall(), columns)


def test_contract(spark):
    assert entry.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
