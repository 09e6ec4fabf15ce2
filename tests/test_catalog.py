"""Every query of the library proper against its SQL, on the smallest tables."""

import math
import os

import pytest

import __spark_entry__
from papyra.plans import catalog, records  # noqa: F401

DIR = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels embeddings conversations region nation".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


def rows(names, table):
    plain = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else v
    return sorted(repr(tuple(plain(r[names.index(c)]) for c in sorted(names))) for r in table)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, DIR)
    got = df.collect()
    if name in catalog.ORACLE_SQL:
        rel = duck.sql(catalog.ORACLE_SQL[name])
        assert sorted(df.columns) == sorted(rel.columns)
        assert rows(df.columns, got) == rows(rel.columns, rel.fetchall())
    else:
        assert got


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 4
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
