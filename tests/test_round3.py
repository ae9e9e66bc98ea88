"""Steps that were mended for size: the same rows as the plain way, without its cost."""

import os
import random

import pytest

from pyspark.sql import functions as F

from chronolith.operators import contests as K, stop_timing as T
from chronolith.plans import pass_windows

SF = "/root/testdata/sf0.001"


def test_bootstrapped_equals_decided_refits(spark):
    """A stop stays one row, with the verdict of its refits' rows."""
    rng = random.Random(4)
    rows = [(1, d, k + 1, k // 14 + 1, ("SOFT", "HARD", "MEDIUM")[k // 14 % 3], k % 14 + 1.0, "1", 0.3 * (k % 14) + rng.random()) for d in (1, 2, 3) for k in range(42)]
    laps = spark.createDataFrame(rows, "race long, driver long, lap_number long, stint long, compound string, tyre_life double, track_status string, residual double")
    by = ["race", "driver"]
    stops = T.models(laps, by, last=9)
    want = T.decided(T.scenarios(stops, by), T.redrawn(stops, by, samples=40), by, samples=40, least=10)
    got = T.bootstrapped(stops, by, samples=40, least=10)
    plain = lambda df: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(want.columns).collect())
    assert plain(got) == plain(want) and any(r["eligible"] for r in got.collect())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_scored_windows_make_laps_once(spark):
    """Laps are numbered and timed once, then read; not once for each of their seven uses."""
    assert not any("lineitem" in f for f in pass_windows.dq18_scored_windows(spark, SF).inputFiles())


def test_exchanges_in_parts_equal_whole_races(spark):
    """A race that comes in parts, with the ticks around each, has the exchanges of the whole, each once."""
    rng, rows = random.Random(3), []
    for race in (1, 2):
        order = [0, 1, 2, 3]
        for t in range(80):
            if rng.random() < 0.3:
                k = rng.randrange(3)
                order[k], order[k + 1] = order[k + 1], order[k]
            rows += [(race, car, t, p + 1, 0.5 if p else None, float(p), float(t)) for p, car in enumerate(order) if rng.random() > 0.02]
    samples = spark.createDataFrame(rows, "race long, car long, t long, place long, gap double, x double, y double")
    halo = F.explode(F.sequence(F.floor((F.col("t") - 4) / 10), F.floor((F.col("t") + 2) / 10)))
    parts = samples.withColumn("part", halo).repartition("race", "part")
    find = lambda df, **more: sorted(map(tuple, K.exchanges(df, ["race"], "car", "t", "place", "gap", share=0.1, **more).collect()))
    want = find(samples)
    assert len(want) > 5 and find(parts, part="part", length=10) == want
