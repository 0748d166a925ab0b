"""Every registered query against the same question in SQL, over the whole small tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from tests.conftest import TESTDATA

TABLES = "region nation customer supplier part orders lineitem events".split()
SCALE = TESTDATA / "sf0.001"


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(comparable(row[i]) for i in order) for row in rows), key=lambda row: tuple(map(repr, row)))


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SCALE}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(contract.own_queries()) == set(contract.own_sql())


@pytest.mark.parametrize("name", sorted(contract.own_queries()))
def test_matches_sql(spark, db, name):
    ours = contract.own_queries()[name](spark, str(SCALE))
    cursor = db.execute(contract.own_sql()[name])
    theirs = normal([column[0] for column in cursor.description], cursor.fetchall())
    got = normal(ours.columns, [tuple(row) for row in ours.collect()])
    assert got[0] == theirs[0]
    assert len(got[1]) == len(theirs[1]) and got[1] == theirs[1]
    assert got[1], "an empty result proves nothing"
