"""Each query against its SQL in DuckDB: names, types and values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tunemill import oracle, queries

DATA = Path("/root/testdata")
SF = "0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/sf{SF}/{name}.parquet'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    made = []
    for row in rows:
        values = (row[i] for i in order)
        made.append(tuple(None if isinstance(v, float) and math.isnan(v) else v for v in values))
    return [columns[i] for i in order], sorted(made, key=lambda r: tuple((v is not None, str(v)) for v in r))


SPARK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def test_every_query_has_sql():
    assert queries.queries().keys() == oracle.oracle_sql().keys()
    assert contract.queries().keys() >= queries.queries().keys()


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, f"{DATA}/sf{SF}")
    found = comparable(df.columns, [tuple(row) for row in df.collect()])
    relation = duck.sql(contract.oracle_sql()[name])
    expected = comparable(relation.columns, relation.fetchall())
    assert found[0] == expected[0]
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {f.name: SPARK_TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    assert len(found[1]) == len(expected[1]) > 0
    assert found[1] == expected[1]


def test_entry(spark):
    rows = {r.split: r.n_rows for r in contract.entry(spark).collect()}
    total = sum(rows.values())
    assert rows["test"] == math.ceil(0.2 * total)
