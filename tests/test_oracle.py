"""Every registered query against its SQL, over the smallest generated tables."""

from pathlib import Path

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from tripfold.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no generated tables here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ours, theirs, n = differences(queries()[name](spark, SF_DIR), con, oracle_sql()[name])
    assert n > 0 and (ours, theirs) == ([], [])


def test_entry(spark):
    assert entry(spark).count() > 0
