"""Every query with SQL gives the rows and column types DuckDB gives."""

from __future__ import annotations

import pytest

from flowledger.oracle import all_sql
from flowledger.plans.queries import all_queries
from flowledger.plans.reports import REPORTS
from tests.compare import connect, duck_kinds, duck_rows, kinds, spark_rows

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(name, spark, sf_dir, duck):
    frame = QUERIES[name](spark, sf_dir)
    assert spark_rows(frame) == duck_rows(duck, SQL[name])
    assert kinds(frame) == duck_kinds(duck, SQL[name])


@pytest.mark.parametrize("name", sorted(name for name in REPORTS if "ORDER BY" in SQL[name]))
def test_reports_come_in_order(name, spark, sf_dir, duck):
    """Reports that sort their rows give them in the order DuckDB gives them."""
    rows = [tuple(row) for row in QUERIES[name](spark, sf_dir).collect()]
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    place = [columns.index(c) for c in QUERIES[name](spark, sf_dir).columns]
    assert rows == [tuple(row[i] for i in place) for row in result.fetchall()]
