"""Every registered query next to its SQL twin on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    text, _ = check.compare(spark, con, name, SF)
    assert text.startswith(("ok", "rows")), text


def test_entry(spark):
    assert entry.entry(spark).count() > 0
