"""Every registered query against its SQL on the driver's tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


NAMES = sorted(q.__name__ for q in driver.QUERIES) + ["sequence_groups"]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, sf_dir, name):
    found = driver.queries()[name](spark, sf_dir)
    result = duck.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(found.columns) == sorted(columns)
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(expected) > 0
    assert canonical(got, found.columns) == canonical(expected, columns)


def test_every_query_has_sql():
    assert set(NAMES) <= set(driver.oracle_sql())
