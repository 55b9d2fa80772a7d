"""Every query that has SQL, on the smallest tables, against DuckDB."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry  # noqa: E402
from tests.conftest import SF  # noqa: E402
from tools.check_oracles import canonical, kind  # noqa: E402

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in sorted(Path(SF).glob("*.parquet")):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, db, name):
    frame = entry.queries()[name](spark, SF)
    wanted = db.sql(ORACLES[name])
    assert sorted(frame.columns) == sorted(wanted.columns)
    assert {c: kind(t) for c, t in frame.dtypes} == {
        c: kind(t) for c, t in zip(wanted.columns, wanted.types)}
    assert canonical(frame.collect(), frame.columns) == canonical(wanted.fetchall(), wanted.columns)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
