"""Every named query against its SQL statement on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as spark_entry
import oracle
from skygauge.plans import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_entry(spark):
    rows = spark_entry.entry(spark).collect()
    assert len(rows) == 10 and all(r.days > 0 for r in rows)


def test_every_statement_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert oracle.differences(spark, con, name, FOLDER) is None
