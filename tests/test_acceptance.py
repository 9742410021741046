"""Every query against its SQL at the smallest scale."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from acceptance.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    with connect(FOLDER) as con:
        yield con


def test_every_oracle_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry_gives_rows(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query(spark, database, name):
    mine = entry_point.queries()[name](spark, FOLDER).toArrow()
    if name in entry_point.oracle_sql():
        theirs = database.sql(entry_point.oracle_sql()[name]).to_arrow_table()
        assert difference(mine, theirs) is None
    else:
        assert mine.num_rows > 0
