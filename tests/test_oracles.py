"""Every registered query against its SQL twin on the small tables."""

from __future__ import annotations

import pytest

from lakewright.catalog import ENTRIES
from tests.conftest import SMALL
from tests.oracle_compare import connect, differences


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(ENTRIES))
def test_equals_sql(spark, duck, name):
    entry = ENTRIES[name]
    assert entry.sql, "every query has a twin"
    assert differences(entry.run(spark, SMALL), duck, entry.sql) == []


def test_entry_points(spark):
    import __spark_entry__ as entry_file

    assert ENTRIES.keys() <= entry_file.queries().keys()
    assert ENTRIES.keys() <= entry_file.oracle_sql().keys() <= entry_file.queries().keys()
    assert entry_file.entry(spark).count() > 0
