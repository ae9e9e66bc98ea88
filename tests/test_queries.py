"""Every registered query of the core against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from chronolith.plans import basics, checks, contests, lake, marts, neutral, pass_windows, pits, ratings, replay_frames, replays, reports, serving, small, stop_timing, streams, technique, traces  # noqa: F401
from chronolith.plans.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    out = duckdb.connect()
    out.execute("set timezone = 'UTC'")
    for name in os.listdir(SF):
        if name.endswith(".parquet"):
            out.execute(f"create view {name[:-8]} as select * from '{SF}/{name}'")
    return out


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    return float(v) if isinstance(v, int) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    rows = sorted((tuple(plain(r[c]) for c in sorted(got.columns)) for r in got.collect()), key=str)
    if name not in ORACLE:
        return
    out = duck.execute(ORACLE[name])
    names = [c[0] for c in out.description]
    assert sorted(names) == sorted(got.columns)
    at = [names.index(c) for c in sorted(names)]
    want = sorted((tuple(plain(r[i]) for i in at) for r in out.fetchall()), key=str)
    assert rows == want


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
