"""Every query against its SQL on a second engine."""

import os

import duckdb
import pytest

import __spark_entry__
from strataline.plans import inventory, measures  # noqa: F401  registers

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(table):
    columns = [table.column(c).to_pylist() for c in sorted(table.column_names)]
    return sorted((tuple("nan" if isinstance(v, float) and v != v else repr(v) for v in r) for r in zip(*columns, strict=True)), key=str)


@pytest.mark.parametrize("name", sorted(inventory.QUERIES))
def test_query(spark, duck, name):
    got = __spark_entry__.queries()[name](spark, SF).toArrow()
    sql = __spark_entry__.oracle_sql().get(name)
    if sql is None:
        assert got.num_rows > 0
        return
    want = duck.sql(sql).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert rows(got) == rows(want)


def test_entry(spark):
    row = __spark_entry__.entry(spark).first()
    assert row["queries"] == 100 and round(row["map"], 4) == 0.0948
