"""Every registered query against its SQL counterpart, at the smallest scale."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as contract
from check_queries import TABLES, rows_of

SF_DIR = Path(contract.SMOKE_DIR)
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", contract.queries())
def test_query(spark, duck, name):
    columns, rows = rows_of(contract.queries()[name](spark, str(SF_DIR)).toPandas())
    assert rows
    if name in contract.oracle_sql():
        wanted_columns, wanted = rows_of(duck.execute(contract.oracle_sql()[name]).df())
        assert (columns, rows) == (wanted_columns, wanted)


def test_every_sql_text_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 15


def test_stored_models_score_alike(spark):
    row = contract.queries()["model_roundtrip"](spark, str(SF_DIR)).first()
    assert (row["customers"], row["changed"]) == (15, 0)
