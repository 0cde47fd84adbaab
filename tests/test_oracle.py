"""Every query with SQL gives the rows that DuckDB gives, types and names included."""

import os
from decimal import Decimal

import duckdb
import pytest

from tidemark.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "decimal(18,2)": "DECIMAL(18,2)", "date": "DATE"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(value):
    return repr(float(value)) if isinstance(value, (float, Decimal)) else str(value)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_same_rows(spark, duck, name):
    got = catalog.queries()[name](spark, SF)
    wanted = duck.sql(catalog.oracle_sql()[name])
    assert sorted(got.columns) == sorted(wanted.columns)
    kinds = dict(zip(wanted.columns, map(str, wanted.types)))
    assert {c: TYPES[k] for c, k in got.dtypes} == kinds
    at = [wanted.columns.index(c) for c in got.columns]
    assert sorted(tuple(map(plain, r)) for r in got.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in wanted.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, SF).collect() is not None
