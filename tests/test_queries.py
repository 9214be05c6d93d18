"""Every registered query runs, and agrees with its SQL twin."""

import pytest

from checks import registry
from checks.compare import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", [n for n in registry.QUERIES if n in registry.ORACLES])
def test_same_rows_as_sql(spark, con, name):
    ok, line = compare(spark, con, name, registry.QUERIES[name], registry.ORACLES[name], FOLDER)
    assert ok, line


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
