"""Every registered query against its SQL, and the driver contract."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from review_lens.plans.registry import oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    frame = queries()[name](spark, SF_DIR)
    ours = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    sql = oracle_sql().get(name)
    if sql is None:
        assert ours[1]
        return
    result = db.execute(sql)
    assert ours == canonical([d[0] for d in result.description], result.fetchall())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["aspect", "code", "comments"] and frame.count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
