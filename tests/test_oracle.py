"""Every query against DuckDB on the same tables."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(picked, key=lambda row: [(value is None, str(value)) for value in row])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


SAME_TYPE = {
    "VARCHAR": "string",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_equals_oracle(spark, duck, key):
    found = QUERIES[key](spark, SF_DIR)
    wanted = duck.execute(ORACLE_SQL[key])
    names = [column[0] for column in wanted.description]
    types = {column[0]: SAME_TYPE[str(column[1])] for column in wanted.description}
    assert dict(found.dtypes) == types
    expected = _sorted(wanted.fetchall(), names)
    assert _sorted([tuple(row) for row in found.collect()], found.columns) == expected
    if not key == "segment_innovator":
        assert expected
