"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no tables")
@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_is_its_sql(spark, db, name):
    text, _, good = compare(spark, db, name, FOLDER)
    assert good, text


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no tables")
def test_entry(spark):
    assert entry.entry(spark).columns == ["semana", "semana_anio", "anio", "volumen", "series"]
