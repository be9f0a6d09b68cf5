"""Rows of the fold's output are numbered together."""

from littoral import scratch
from littoral.kernel import register
from littoral.plans import fold as folding

from .test_large import sides


def test_output_is_numbered_in_one_go(spark, monkeypatch):
    """F16 merged_water, F15: hosts and extras were sorted and written one after the other, and hosts counted in between."""
    register(spark)
    water, area = sides(spark, 12, 60, 4)
    done = folding.fold(water, area, cell=50)
    names, write = [], scratch.materialize
    monkeypatch.setattr(scratch, "materialize", lambda df, name, by=(): names.append(name) or write(df, name, by))
    got = sorted(done.output().collect())
    assert names == ["fids"]
    hosts = [bytes(r.geom) for r in done.water.orderBy("wid").collect()]
    extras = [bytes(r.geom) for r in done.extras.orderBy("ord", "wid", "piece").collect()]
    assert [r.fid for r in got] == list(range(len(hosts) + len(extras)))
    assert [bytes(r.geom) for r in got] == hosts + extras
