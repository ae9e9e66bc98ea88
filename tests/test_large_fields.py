"""Steps that paired, or held, a whole field: each at a field on which the product would not end, or its plan without it, and against a plain computation."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from chronolith.operators import bootstrap as B, evidence as E, pits as P, quality as Q, replay as R, resample as RS


def test_medians_of_others(spark):
    rng = random.Random(3)
    values = {g: [rng.choice([None, 1.0, 2.0, 2.0, 5.0, 9.0]) for _ in range(n)] for g, n in enumerate((1, 2, 3, 4, 5, 6, 9, 12, 30))}
    rows = spark.createDataFrame([(g, v) for g, vs in values.items() for v in vs], "g long, v double")
    got = {(r["g"], r["v"]): r["m"] for r in Q.medians_of_others(rows, ["g"], "v", "m", 3).collect()}
    for g, vs in values.items():
        for i, v in enumerate(vs):
            others = [x for k, x in enumerate(vs) if k != i and x is not None]
            assert got.get((g, v)) == (statistics.median(others) if len(others) >= 3 else None), (g, v)


def test_medians_of_a_field_of_many(spark):
    rows = spark.range(300_300).select(F.lit(1).alias("g"), (F.col("id") % 1001).cast("double").alias("v"))  # 9e10 pairs
    assert {r["m"] for r in Q.medians_of_others(rows, ["g"], "v", "m", 3).collect()} == {500.0}


def test_counts_near_times(spark):
    rng = random.Random(5)
    kinds = ["fresh", "stale"]
    samples = [(g, rng.randrange(400), rng.choice(kinds)) for g in (1, 2) for _ in range(60)]
    asked = [(g, d, rng.randrange(400)) for g in (1, 2, 3) for d in range(40)]
    got = {tuple(r) for r in E.counted_near(spark.createDataFrame(samples, "g long, t long, s string"), spark.createDataFrame(asked, "g long, d long, at long"), ["g"], "t", "s", "at", 10, 60, kinds).select("g", "d", "at", "s", "samples", "before").collect()}
    want = set()
    for g, d, at in asked:
        for kind in kinds:
            near = [t for q, t, s in samples if q == g and s == kind and at - 10 <= t <= at + 60]
            if near:
                want.add((g, d, at, kind, len(near), sum(t < at for t in near)))
    assert got == want


def test_counts_near_times_of_many(spark):
    t = spark.range(300_000).select(F.lit(1).alias("g"), (F.col("id") % 50).alias("t"), F.lit("fresh").alias("s"))
    got = E.counted_near(t, t.select("g", F.col("t").alias("at")), ["g"], "t", "s", "at", 10, 60, ["fresh"])  # 9e10 pairs
    assert got.agg(F.count("*"), F.max("samples"), F.max("before")).first()[:] == (300_000, 300_000, 60_000)


def test_undercuts_of_a_large_field(spark):
    n = 30_000
    stops = spark.range(n).select(F.lit(1).alias("race"), F.lit(1).alias("k"), F.col("id").alias("car"), (1000 + F.col("id") % 2).alias("t"), F.col("id").alias("before"), (n - F.col("id")).alias("after"))
    got = P.undercuts(stops, ["race"], "car", "k", "t", 5000, 3)  # 2e8 pairs in time
    assert {r["outcome"]: r["count"] for r in got.groupBy("outcome").count().collect()} == {"undercut": n - 3, "overcut": n - 1}


def test_a_recorded_order_is_not_held_in_its_rows(spark):
    cars = spark.range(4_000).select(F.lit(1).alias("race"), F.col("id").alias("car"), (F.col("id") + 1).alias("estimate"))
    ticks = cars.withColumn("t", F.explode(F.array(F.lit(10), F.lit(20))))
    recorded = cars.select("race", "car", F.lit(10).alias("t"), (4_000 - F.col("car")).alias("position")).unionByName(cars.where("car < 2").select("race", "car", F.lit(20).alias("t"), F.lit(1).cast("long").alias("position")))
    out = R.overlaid(ticks, recorded, ["race"], "car", "t", "estimate", "position", 100)
    assert "collect_set" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["t"], r["source"], r["same"]): r["count"] for r in out.groupBy("t", "source", (F.col("place") == F.col("estimate")).alias("same")).count().collect()} == {(10, "recorded", False): 4_000, (20, "estimate", True): 4_000}


def test_gaps_need_no_sort_of_a_race(spark):
    ticks = spark.createDataFrame([(1, c, 60 * k, p) for c, ps in {"a": [0.0, 1.2, 1.2, 3.5], "b": [0.5, 1.0, 2.4, 3.0], "c": [0.2, None, 0.7, 3.5]}.items() for k, p in enumerate(ps)], "race long, car string, t long, progress double")
    out = R.leader_gap(ticks, ["race"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    got = {(r["car"], r["t"]): r["gap"] for r in out.collect()}
    edge = [(0.5, 0.0), (1.2, 60.0), (2.4, 120.0), (3.5, 180.0)]
    for (car, t), gap in got.items():
        p = next(r["progress"] for r in ticks.collect() if (r["car"], r["t"]) == (car, t))
        spans = [(a, b) for a, b in zip(edge, edge[1:]) if p is not None and a[0] <= p <= b[0]]
        want = t - (spans[0][0][1] + (p - spans[0][0][0]) / (spans[0][1][0] - spans[0][0][0]) * (spans[0][1][1] - spans[0][0][1])) if spans else None
        assert gap == pytest.approx(want) if want is not None else gap is None, (car, t)


def test_passes_join_nothing(spark):
    rows = [(1, c, t, p, 10.0 - p / 100, s) for c, ps in {"a": [1, 2, 2, 1, 2], "b": [2, 1, 1, 2, 1]}.items() for t, (p, s) in enumerate(zip(ps, [1, 1, 1, 1, 2 if c == "b" else 1]))]
    out = R.passes(spark.createDataFrame(rows, "race long, car string, t long, place long, progress double, stint long"), ["race"], "car", "place", 1, 0.05, "stint")
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    assert [(r["t"], r["attacker"], r["defender"]) for r in out.collect()] == [(0, "b", "a")]


def test_small_groups_share_a_batch(spark, monkeypatch):
    monkeypatch.setattr("pyspark.sql.GroupedData.applyInArrow", None)
    points = [(g, i, x) for g in range(50) for i, x in enumerate([1.0, 1.1, 9.0, 9.1, 1.3, 0.0])]
    rows = spark.createDataFrame(points, "g long, t long, x double").withColumn("y", F.when(F.col("x") == 0, 0.0).otherwise(1.0))
    got = RS.drop_jumps(rows, ["g"], "t", "x", "y", 0.2)
    assert sorted((r["g"], r["t"]) for r in got.collect()) == [(g, t) for g in range(50) for t in (0, 1, 4)]


def test_refits_join_nothing(spark):
    rows = spark.createDataFrame([(1, i, float(i), 2.0 * i) for i in range(8)], "g long, i long, x double, y double")
    out = B.refitted(rows, ["g"], "i", "x", "y", draws=20, kept=10, least=6)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    assert [round(r["slope"], 9) for r in out.collect()] == [2.0] * 10
