"""Steps that were mended for disk and time in round 4: the same rows as the plain way, without its cost."""

import os
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from chronolith.operators import bootstrap as B, contests as K, edge_draws as D, graph as G, joins as J, replicates as M


def shown(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_snapshot_sends_nothing_after_its_join(spark):
    """The pairs in reach are results at once: above the join nothing is grouped, and they equal brute force."""
    rng = random.Random(5)
    events = [(rng.choice("ab"), i, rng.randrange(400)) for i in range(40)]
    samples = [(rng.choice("ab"), rng.choice([1, 2, None]), rng.randrange(400), rng.choice([None, 1.0, 2.0, 3.0])) for _ in range(120)]
    got = J.snapshot(spark.createDataFrame(events, "k string, event_id long, at long"), spark.createDataFrame(samples, "k string, u long, t long, v double"), ["k"], "u", "t", "v", 30)
    assert "Aggregate" not in shown(got).split("Join")[0]
    low, want = lambda s: (s[0], s[1] is not None, s[1] or 0), []
    for k, i, at in events:
        for u in (1, 2, None):
            near = [(t, v) for key, who, t, v in samples if (key, who) == (k, u) and abs(t - at) <= 30]
            before, after = [s for s in near if s[0] <= at], [s for s in near if s[0] >= at]
            if near:
                want.append((k, i, at, u, max(before, key=low)[1] if before else None, min(after, key=low)[1] if after else None))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def kept_tables(spark) -> set[str]:
    probe = M.kept(spark.range(1), "probe")
    M.dropped(probe)
    return set(os.listdir(os.path.dirname(probe.kept_at.removeprefix("file://").removeprefix("file:"))))


def test_a_solve_leaves_its_last_state_only(spark):
    """Edges, lists and the states of earlier steps are deleted when they are used up; the result can still be read."""
    before = kept_tables(spark)
    pairs = spark.createDataFrame([(a, b, float(a - b)) for a in range(12) for b in range(a + 1, 12)], "a long, b long, g double")
    out = D.bootstrapped(pairs, 20)
    left = sorted(kept_tables(spark) - before)
    assert [name.split("-")[-1] for name in left] == ["times"] and out.count() == 12
    both = pairs.union(pairs.selectExpr("b", "a", "-g")).withColumn("w", F.lit(1.0))
    before = kept_tables(spark)
    out = M.solved_together(both, "a", "b", "w", "g", np.array([2.0, 8.0]))
    assert len(kept_tables(spark) - before) == 1 and out.count() == 12


def test_drawn_edges_travel_pressed(spark):
    """An edge's counts are no row of a byte a replicate: what is dealt by ends are lists under zstd."""
    rng, many = np.random.default_rng(1), 300
    counts = rng.poisson(1.0, (40, many)).astype(np.uint8)
    rows = M.drawn_lists(np.repeat([1, 2], 20), np.arange(40), np.ones(40), [counts], pa.int64())
    assert rows.num_rows == 2 and sum(len(z.as_py()) for z in rows.column("w0")) < counts.size // 3


def test_exchanges_read_samples_once(spark, tmp_path):
    """Parts are looked through in one pass whose finds are kept; samples were made anew for each of five joins and windows."""
    rows = [(1, car, t, (car + t // 10) % 2 + 1, 0.5, 0.0, float(t)) for t in range(40) for car in (0, 1)]
    spark.createDataFrame(rows, "race long, car long, t long, place long, gap double, x double, y double").write.parquet(f"{tmp_path}/samples")
    out = K.exchanges(spark.read.parquet(f"{tmp_path}/samples"), ["race"], "car", "t", "place", "gap")
    assert [(r["t"], r["place"], r["passer"], r["passed"]) for r in out.orderBy("t").collect()] == [(10, 1, 1, 0), (20, 1, 0, 1), (30, 1, 1, 0)]
    assert not any("samples" in f for f in out.inputFiles())


def test_contests_meet_passes_by_their_car(spark):
    """A car's lists of ticks and its passes meet once: the rows are those of episodes and then their contests, and no episode is dealt anew."""
    rng, rows = random.Random(9), []
    for race in (1, 2):
        order, gap = [0, 1, 2, 3], 0.5
        for t in range(200):
            if rng.random() < 0.05:
                k = rng.randrange(3)
                order[k], order[k + 1] = order[k + 1], order[k]
            gap = rng.choice([0.4, 0.9, 1.4, 3.0]) if rng.random() < 0.1 else gap
            rows += [(race, car, car // 2, t, p + 1, gap if p else None, 2, 0.5 - p / 100, rng.random() > 0.01, rng.random() < 0.01, t // 50) for p, car in enumerate(order) if rng.random() > 0.04]
    ticks = spark.createDataFrame(rows, "race long, car long, team long, t long, place long, gap double, lap long, inside double, green boolean, pit boolean, part long")
    passes = spark.createDataFrame([(race, t, a, b, 0.9) for race in (1, 2) for t in range(3, 200, 7) for a, b in ((0, 1), (2, 1))], "race long, t long, passer long, passed long, confidence double")
    sort = lambda df: sorted(map(tuple, df.collect()), key=str)
    want = sort(K.contests(K.episodes(ticks, ["race"], "car", guard=5), passes, ["race"], "car", least=2))
    got = K.contested(ticks, passes, ["race"], "car", guard=5, part="part", least=2)
    assert sort(got) == want and len(want) > 20 and any(r[-1] != "insufficient" for r in want)
    plan = shown(got)
    assert "Join" not in plan and plan.count("FlatMapCoGroupsInArrow") == 1 and "Window" not in plan


def test_two_totals_are_problems_of_one_solve(spark):
    """Gaps on the same edges are solved together, each as alone."""
    rng = random.Random(2)
    rows = [(a, b, rng.randrange(3), 1.0, rng.random(), rng.random()) for a in range(8) for b in range(a + 1, 8)]
    both = spark.createDataFrame(rows + [(b, a, c, w, -g, -h) for a, b, c, w, g, h in rows], "a long, b long, c int, w double, g double, h double")
    shares, priors = np.array([[1.0, 0.0], [2.0, 1.0], [0.0, 3.0]]), np.array([8.0, 2.0])
    solve = lambda total: {r["a"]: r["ratings"] for r in M.solved_together(both, "a", "b", "w", total, priors, "c", shares).collect()}
    one, two, got = solve("g"), solve("h"), solve(["g", "h"])
    assert len(got) == 8 and all(np.allclose(got[a], one[a] + two[a], atol=1e-9) for a in got)


def test_components_leave_no_links(spark):
    before = kept_tables(spark)
    got = {r["id"]: r["component"] for r in G.components(spark.createDataFrame([(3, 1), (1, 2), (5, 4), (2, 1), (6, 6)], "a long, b long"), "a", "b").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6}
    assert sorted(n.split("-")[-1] for n in kept_tables(spark) - before) == ["ends"]


def test_median_draws_are_no_rows(spark):
    """Only the last range table of a bootstrap of medians stays, and its counts are short numbers."""
    before = kept_tables(spark)
    df = spark.range(3000).selectExpr("id % 2 as g", "id as i", "cast(id % 97 as double) as v")
    assert B.bootstrap_median(df, "g", "v", ["i"], 5).count() == 2
    left = sorted(n.split("-")[-1] for n in kept_tables(spark) - before)
    assert left == ["before", "ranged"]
