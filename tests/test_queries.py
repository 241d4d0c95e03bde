"""Every registered query against its SQL twin, and the untwinned ones for rows."""

from __future__ import annotations

import pytest

from sluice.plans.queries import ORACLES, QUERIES
from tests.compare import connect, spark_side, sql_side


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, sf_dir, name):
    columns, rows = spark_side(spark, name, sf_dir)
    assert rows, "no rows"
    assert (columns, rows) == sql_side(con, name)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry_reads_the_smallest_tables(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
