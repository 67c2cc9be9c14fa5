"""Every registered query against its SQL in DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as registered
import check
from millrace.plans import all_oracles, all_queries
from tests.conftest import SMALL

# These look at a short time span, in which the smallest tables may hold nothing.
MAY_BE_EMPTY = {"failed_loads"}
# These are compared row by row, in order.
ORDERED = {"ordered_history"}


@pytest.fixture(scope="module")
def connection():
    return check.connect(SMALL)


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(registered.queries())
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, connection, name):
    df = registered.queries()[name](spark, SMALL)
    problem = check.compare(df, connection, registered.oracle_sql()[name], name in ORDERED)
    if name in MAY_BE_EMPTY:
        problem = problem.replace("no rows at all", "")
    assert problem == ""


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns == ["fiscal_year", "fiscal_quarter", "total_items", "business_day_items"]
    assert df.count() > 0
