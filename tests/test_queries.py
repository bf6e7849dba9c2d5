"""Every query of the library against its SQL on the smallest tables."""

from __future__ import annotations

import os

import compare
import pytest

from isobar import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    return compare.database(SF)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, database, name):
    assert compare.differences(catalog.QUERIES[name](spark, SF), database, catalog.ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_entry_is_imported_without_a_session():
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert len(e.queries()) > 150 and e.oracle_sql()"], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
