"""Each registered query against its SQL, at the smallest scale."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
import check
from tidemark.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="test tables are not here")

# Those of the subpackage that may be left out have tests beside its own.
NAMES = sorted(QUERIES)
# At this scale the day that is repaired has no lost rows.
MAY_BE_EMPTY = {"late_row_repair"}


@pytest.fixture(scope="module")
def db():
    return check.connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, db, name):
    problem = check.difference(spark, db, name, SF)
    assert problem is None or (problem == "no rows" and name in MAY_BE_EMPTY), problem


def test_every_query_has_sql():
    assert set(NAMES) == set(SQL)
    assert set(NAMES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0
