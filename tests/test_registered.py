"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from registered.oracles import ORACLES
from registered.queries import REGISTRY
from tools.check_queries import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(REGISTRY)
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        path = f"{FOLDER}/{table}.parquet"
        if os.path.exists(path):
            connection.execute(f"create view {table} as select * from read_parquet('{path}')")
    return connection


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)
    assert set(REGISTRY) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, database, name):
    message, equal = compare(spark, FOLDER, name, database)
    assert equal, message
