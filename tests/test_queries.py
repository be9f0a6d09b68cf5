"""Every registered query of the core against its SQL."""

import os

import pytest

from littoral import queries as core

from .check_oracles import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
ORACLES = core.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, db, name):
    got, want = compare(spark, db, SF, core.queries()[name], ORACLES[name])
    assert got == want


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 22
    assert set(core.NAMES) <= set(entry.queries())
