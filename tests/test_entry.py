"""Every query with SQL against DuckDB, on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__
from cairn import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def rows(names, data):
    order = sorted(range(len(names)), key=names.__getitem__)
    cell = lambda v: round(float(v), 6) if isinstance(v, float) else v
    return [names[i] for i in order], sorted((tuple(cell(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = catalog.QUERIES[name](spark, SF)
    got = con.execute(catalog.ORACLE_SQL[name])
    want = rows([x[0] for x in got.description], got.fetchall())
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == want


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 6
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
