"""Every query with SQL gives the rows that DuckDB gives."""

import pytest
from compare import both

from lodestack.plans import registry

SQL = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_rows_equal(spark, data, duck, name):
    own, theirs = both(registry.queries()[name](spark, data), duck, SQL[name])
    assert own == theirs


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(SQL)))
def test_runs(spark, data, name):
    assert registry.queries()[name](spark, data).count() > 0


def test_entry_module(spark, data):
    import __spark_entry__ as entry

    assert set(SQL) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["subject", "superseding", "superseded", "confidence"]
