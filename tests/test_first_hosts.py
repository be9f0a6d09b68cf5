"""One host for each polygon is found cell by cell, without pairs as rows."""

import os

import pytest

from littoral import queries as core
from littoral.operators import overlap

from .check_oracles import compare, connect
from .test_large import ONE_HOST_EACH

SF = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", ONE_HOST_EACH)
def test_no_pairs_for_one_host_each(spark, monkeypatch, name):
    monkeypatch.setattr(overlap, "FEW", 100_000)
    monkeypatch.setattr(overlap, "grid_join", None)
    got, want = compare(spark, connect(SF), SF, core.queries()[name], core.oracle_sql()[name])
    assert got == want
