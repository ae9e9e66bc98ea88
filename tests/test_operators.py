"""Operators on small frames: joins, windows, robust fits, resampling, partitions and streams."""

import datetime
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from chronolith.functions import columns as C
from chronolith.operators import bootstrap as B, evidence as E, graph as G, joins as J, neutral as NE, quality as Q, replay as RP, resample as RS, robust as R, sequences as SQ, windows as W
from chronolith.sources import bundles as BU, partitions as P
from chronolith.streaming import twins


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


def test_durations(spark):
    for text, want in (("1:30.5", 90.5), ("0:45.25", 45.25), ("88.75", 88.75), ("", None), (None, None), ("x", None)):
        assert one(spark, C.parse_duration(F.lit(text).cast("string"))) == want
    assert one(spark, C.format_duration(F.lit(90.5))) == "1:30.500"


def test_scalars(spark):
    assert one(spark, C.category(F.lit(" nan "))) == "UNKNOWN" and one(spark, C.category(F.lit(" soft"))) == "SOFT"
    assert one(spark, C.finite(F.lit(float("inf")))) is None and one(spark, C.ratio(F.lit(1.0), F.lit(0.0))) is None
    seconds, laps = C.structured_gap(F.lit("+1 LAP"))
    assert one(spark, seconds) is None and one(spark, laps) == 1
    assert tuple(one(spark, C.marker(F.lit("VIRTUAL  safety car deployed")))) == ("VSC", "start")
    assert tuple(one(spark, C.marker(F.lit("SAFETY CAR IN THIS LAP")))) == ("SC", "end")
    low, high = C.wilson(F.lit(0), F.lit(4))
    assert one(spark, low) is None and one(spark, high) is None


def test_asof_ties_nulls_and_age(spark):
    left = spark.createDataFrame([(1, 5.0, "a"), (1, 1.0, "b"), (2, 5.0, "c")], "k long, t double, n string")
    right = spark.createDataFrame([(1, 5.0, "x"), (1, 2.0, None)], "k long, t double, v string")
    got = lambda **o: {r["n"]: r["v"] for r in J.asof(left, right, ["k"], "t", ["v"], **o).collect()}
    assert got() == {"a": "x", "b": None, "c": None}
    assert got(strict=True) == {"a": None, "b": None, "c": None}
    right = spark.createDataFrame([(1, 3.0, "x")], "k long, t double, v string")
    assert {r["n"]: r["v"] for r in J.asof(left, right, ["k"], "t", ["v"], or_first=True).collect()} == {"a": "x", "b": "x", "c": None}
    assert {r["n"]: r["v"] for r in J.asof(left, right, ["k"], "t", ["v"], max_age=1.0).collect()} == {"a": None, "b": None, "c": None}


def test_snapshot_and_unique(spark):
    events = spark.createDataFrame([(1, 7, 10.0)], "k long, event_id long, at double")
    samples = spark.createDataFrame([(1, "a", 8.0, 1.0), (1, "a", 9.5, 2.0), (1, "a", 11.0, 3.0), (1, "b", 20.0, 9.0)], "k long, e string, t double, v double")
    assert [tuple(r) for r in J.snapshot(events, samples, ["k"], "e", "t", "v", 3.0).collect()] == [(1, 7, 10.0, "a", 2.0, 3.0)]
    with pytest.raises(Exception, match="not unique"):
        J.require_unique(samples, ["k"]).collect()


def test_loo_median(spark):
    rows = [(1, i, float(v)) for i, v in enumerate([5, 1, 9, 9, 2, 7])] + [(2, 0, 1.0), (2, 1, 2.0)]
    rng = random.Random(4)
    rows += [(g, i, rng.choice([None, 1.0, 2.0, 2.0, 3.5, 8.0])) for g in range(3, 30) for i in range(rng.randint(1, 9))] + [(None, i, float(i)) for i in range(5)]
    for r in W.loo_median(spark.createDataFrame(rows, "g long, i long, v double"), ["g"], "v", "m").collect():
        others = [v for g, i, v in rows if g == r["g"] and i != r["i"] and v is not None]
        assert r["m"] == (statistics.median(others) if len(others) >= 3 else None), r
    with pytest.raises(ValueError):
        W.loo_median(None, ["g"], "v", "m", peers=1)


def test_ranks_and_quantiles_without_a_whole_window(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice("ab"), rng.choice([None, *map(float, range(12))])) for i in range(300)]
    df = spark.createDataFrame(rows, "i long, g string, v double").repartition(5)
    for descending in (False, True):
        for r in W.ranked(df, "v", descending).collect():
            known = sorted((v for _, _, v in rows if v is not None), reverse=descending)
            if r["v"] is None:
                assert r["rank"] is None
            else:
                first = known.index(r["v"]) + 1
                assert (r["rank"], r["dense_rank"], r["mean_rank"]) == (first, sorted(set(known), reverse=descending).index(r["v"]) + 1, first + (known.count(r["v"]) - 1) / 2)
    for r in R.quantiles(df, ["g"], "v", low=0.05, mid=0.5, high=0.93).collect():
        own = sorted(v for _, g, v in rows if g == r["g"] and v is not None)
        at = lambda q: own[int(q * (len(own) - 1))] + (q * (len(own) - 1) % 1) * (own[min(len(own) - 1, int(q * (len(own) - 1)) + 1)] - own[int(q * (len(own) - 1))])  # noqa: B023, E731
        assert r["n"] == len(own) and all(math.isclose(r[k], at(q), abs_tol=1e-9) for k, q in (("low", 0.05), ("mid", 0.5), ("high", 0.93)))


def test_asof_without_a_time(spark):
    left = spark.createDataFrame([(1, 5.0, "a"), (1, None, "b"), (2, 1.0, "c")], "k long, t double, n string")
    right = spark.createDataFrame([(1, None, "none"), (1, 3.0, "x"), (2, None, "none")], "k long, t double, v string")
    got = lambda **o: {r["n"]: r["v"] for r in J.asof(left, right, ["k"], "t", ["v"], **o).collect()}
    assert got() == {"a": "x", "b": None, "c": None} and got(or_first=True) == {"a": "x", "b": "x", "c": None} and got(max_age=1.0) == {"a": None, "b": None, "c": None}


def test_bracketed(spark):
    left = spark.createDataFrame([(1, float(x)) for x in (-1, 0, 1, 4, 5, 30)] + [(1, None), (2, 1.0)], "k long, x double")
    right = spark.createDataFrame([(1, 0.0, 10.0), (1, 4.0, 18.0), (1, 20.0, 0.0)], "k long, x double, v double")
    assert {(r["k"], r["x"]): r["v"] for r in J.bracketed(left, right, ["k"], "x", ["v"], widest=5).collect()} == {(1, -1.0): None, (1, 0.0): 10.0, (1, 1.0): 12.0, (1, 4.0): 18.0, (1, 5.0): None, (1, 30.0): None, (1, None): None, (2, 1.0): None}


def test_one_to_one_is_greedy(spark):
    rng = random.Random(9)
    left = [(rng.randint(0, 3), i, float(a), float(a + rng.randint(0, 12))) for i, a in enumerate(rng.choices(range(60), k=40))]
    right = [(rng.randint(0, 3), 100 + i, float(t)) for i, t in enumerate(rng.choices(range(70), k=50))]
    want, used = {}, set()
    for k, i, a, z in sorted(left, key=lambda x: (x[2], x[1])):
        free = sorted((t, j) for g, j, t in right if g == k and a <= t <= z and j not in used)
        if free:
            want[i] = free[0][1]
            used.add(free[0][1])
    got = J.one_to_one(spark.createDataFrame(left, "k long, i long, a double, z double"), spark.createDataFrame(right, "k long, j long, t double"), ["k"], "i", "j", "a", "z", "t")
    assert {r["i"]: r["j"] for r in got.collect()} == want


def test_sequence_matches_are_the_most(spark):
    rng = random.Random(2)
    for _ in range(4):
        a, b = ([(1, rng.choice("xyz"), rng.randint(0, 12)) for _ in range(rng.randint(0, 9))] for _ in range(2))
        x, y = sorted(a, key=lambda r: (r[2], r[1])), sorted(b, key=lambda r: (r[2], r[1]))
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, p in enumerate(x):
            for j, q in enumerate(y):
                fits = p[1] == q[1] and abs(p[2] - q[2]) <= 2
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + 1 if fits else 0)
        frames = [spark.createDataFrame(r, "g long, l string, at long") for r in (a, b)]
        got = [tuple(r) for r in SQ.sequence_matches(*frames, ["g"], "l", "at", 2).collect()]
        assert got == ([(1, best[-1][-1], len(a), len(b))] if a or b else [])


def test_drop_jumps_keeps_the_last_kept_point(spark):
    rng = random.Random(3)
    rows = [(k, float(i // 2), rng.choice([0.0, 1.0, 2.0, 30.0, 31.0]), rng.choice([0.0, 1.0]), i) for k in range(6) for i in range(40)]
    want = []
    for k in range(6):
        last = None
        for r in sorted((r for r in rows if r[0] == k and (r[2], r[3]) != (0, 0)), key=lambda r: r[1]):
            if last is None or r[1] <= last[1] or math.hypot(r[2] - last[2], r[3] - last[3]) <= 3.0 * (r[1] - last[1]):
                want.append((k, r[4]))
                last = r
    got = RS.drop_jumps(spark.createDataFrame(rows, "k long, t double, x double, y double, i long").coalesce(1), ["k"], "t", "x", "y", 3.0)
    assert sorted((r["k"], r["i"]) for r in got.collect()) == sorted(want)


def test_battles(spark):
    """Release restarts after a short one, a missing tick breaks, pressure is the longest unbroken contact."""
    gap = [0.5, 0.1, 0.1, 0.5, 0.1, 0.9, 0.9, 0.9, 0.1, 0.1]
    rows = [(1, 7, 8, t, g) for t, g in enumerate(gap)] + [(1, 7, 8, 20, 0.1), (1, 7, 9, 21, 0.1)]
    got = RP.battles(spark.createDataFrame(rows, "race long, car long, rival long, t long, gap double"), ["race"], "car", "rival", "t", "gap", 1, 0.2, 0.8, 2)
    assert sorted((r["start"], r["end"], r["rival"], r["samples"], r["contacts"], r["pressure"], r["closed"]) for r in got.collect()) == [(1, 7, 8, 7, 3, 1, True), (8, 9, 8, 2, 2, 1, False), (20, 20, 8, 1, 1, 0, False), (21, 21, 9, 1, 1, 0, False)]


def test_neutralisations(spark):
    rows = [(1, "SC", "end"), (2, "SC", "start"), (3, "VSC", "end"), (4, "RED", "start"), (5, "SC", "end"), (6, "RED", "end"), (7, "SC", "start"), (8, "SC", "start"), (9, "SC", "end"), (10, "VSC", "start"), (11, "SC", "start"), (11, "SC", "end")]
    df = spark.createDataFrame([(1, i, *r) for i, r in enumerate(rows)], "race long, i long, t long, kind string, edge string")
    got = NE.neutralisations(df, ["race"], ["t", "i"], "t", "kind", "edge", {"SC": ["RED", "VSC"], "VSC": ["RED", "SC"]})
    assert sorted((r["start"], r["kind"], r["end"], r["status"]) for r in got.collect()) == [(2, "SC", 4, "interrupted"), (4, "RED", 6, "complete"), (7, "SC", 8, "interrupted"), (8, "SC", 9, "complete"), (10, "VSC", 11, "interrupted")]


def test_donor_and_restore_are_strict(spark, tmp_path):
    own = spark.createDataFrame([(1, 1.0, None), (2, 2.0, "b")], "k long, v double, c string")
    fill = lambda rows: sorted(tuple(r) for r in P.fill_columns(own, spark.createDataFrame(rows, own.schema), ["k"], ["v"], ["c"]).collect())
    assert fill([(1, 1.0, "a"), (2, 2.0, None)]) == [(1, 1.0, "a"), (2, 2.0, "b")]
    for bad in ([(1, 1.0, "a")], [(1, 1.5, "a"), (2, 2.0, None)], [(1, 1.0, "a"), (2, 2.0, "z")]):
        with pytest.raises(Exception, match="does not fit"):
            fill(bad)
    for season in (2024, 2025):
        with pytest.raises(ValueError):
            P.restore(spark.createDataFrame([(1, 2023)], "v long, season long").where("season = 2023" if season == 2024 else "false"), f"file://{tmp_path}/r", season=season)


def test_runs(spark):
    df = spark.createDataFrame([(1, t, v) for t, v in enumerate([0, 0, 0, 1, 1, 1, 1, 0, 1])], "k long, t long, on long")
    runs = sorted((r["start"], r["end"], r["anchor"]) for r in W.collapse_runs(df, ["k"], "t", "on").collect())
    assert runs == [(0, 2, 1.0), (3, 6, 4.5), (7, 7, 7.0), (8, 8, 8.0)]
    assert W.longest_run(df, ["k"], "t", F.col("on") == 1, 1).first()["longest"] == 3
    assert [r["t"] for r in W.onsets(df, ["k"], "t", "on", 2, 2).collect()] == [3]
    assert [r["t"] for r in W.persists(df, ["k"], "t", F.col("on") == 1, 3, 1, "p").where("p").collect()] == [3]
    assert [r["t"] for r in W.persists(df.where("t <> 5"), ["k"], "t", F.col("on") == 1, 3, 1, "p").where("p").collect()] == []


def test_theil_sen_ignores_an_outlier(spark):
    rows = [(1, x, 2.0 * x + 1 + (50 if x == 3 else 0)) for x in range(9)]
    r = R.theil_sen(spark.createDataFrame(rows, "g long, x long, y double"), ["g"], "x", "y").first()
    assert (r["n"], r["slope"], r["intercept"], r["residual_mad"]) == (9, 2.0, 1.0, 0.0)
    z = R.robust_z(spark.createDataFrame([(1, 1.0), (1, 1.0), (1, 9.0)], "g long, v double"), ["g"], "v", "z")
    assert [x["z"] for x in z.collect()] == [0.0, 0.0, 0.0]


def test_grid_and_jumps(spark):
    s = spark.createDataFrame([(1, 0.0, 0.0), (1, 4.0, 8.0), (1, 20.0, 0.0)], "k long, t double, v double")
    got = {r["t"]: r["v"] for r in RS.grid(s, ["k"], "t", ["v"], 2, max_gap=10).collect()}
    assert got[2] == 4.0 and got[4] == 8.0 and got[6] is None and got[20] == 0.0 and len(got) == 11
    xy = spark.createDataFrame([(1, 0.0, 1.0, 0.0), (1, 1.0, 100.0, 0.0), (1, 2.0, 3.0, 0.0), (1, 3.0, 0.0, 0.0)], "k long, t double, x double, y double")
    assert sorted(r["t"] for r in RS.drop_jumps(xy, ["k"], "t", "x", "y", 5.0).collect()) == [0.0, 2.0]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 12)] + [(100, 101), (101, 100), (7, 7), (200, 200)]
    got = {r["id"]: r["component"] for r in G.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 1 for i in range(1, 13)}, 100: 100, 101: 100, 200: 200}
    big = G.largest_component(spark.createDataFrame(edges, "a long, b long"), "a", "b")
    assert {x for r in big.collect() for x in (r["a"], r["b"])} == set(range(1, 13))


def test_ratings_recover_a_chain(spark):
    true = {1: -1.0, 2: 0.0, 3: 1.0}
    edges = [(i, j, true[i] - true[j]) for i in true for j in true if i != j for _ in range(200)]
    got = {r["a"]: r["rating"] for r in G.ratings(spark.createDataFrame(edges, "a long, b long, g double"), "a", "b", "g", prior=0.0, rounds=8, tolerance=1e-2).collect()}
    assert all(math.isclose(got[k], v, abs_tol=5e-2) for k, v in true.items())
    shrunk = {r["a"]: r["rating"] for r in G.ratings(spark.createDataFrame(edges[::100], "a long, b long, g double"), "a", "b", "g", rounds=3).collect()}
    assert abs(shrunk[1]) < 1.0


def test_bootstrap_repeats(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(20)], "g string, i long, v double")
    a, b = (B.bootstrap_median(df, "g", "v", ["i"], 30).first() for _ in range(2))
    assert a == b and a["low"] <= a["median"] <= a["high"]


def test_quality(spark):
    df = spark.createDataFrame([(1, 2, 0.5), (2, 1, -0.5), (3, 4, 1.0)], "a long, b long, g double")
    assert Q.antisymmetric(df, [], "a", "b", "g").first()["violations"] == 1
    x, y = (Q.fingerprint(d, []).first() for d in (df, df.select("g", F.col("b").cast("double").alias("b"), "a").orderBy("g")))
    assert x == y and Q.fingerprint(df.where("a < 3"), []).first() != x
    big = spark.createDataFrame([(1, 2**53), (2, 2**53 + 1)], "g long, v long")
    assert len({r["xor"] for r in Q.fingerprint(big, ["g"]).collect()}) == 2
    assert tuple(Q.table_diff(df, df.where("a < 3").union(df.where("a = 1"))).first()) == (1, 1)


def test_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2), (3, 2025, 1)], "v long, season long, round long")
    path = f"file://{tmp_path}/t"
    P.write_touched(df, path, ["season", "round"])
    P.write_touched(df.where("season = 2025").withColumn("v", F.lit(9)), path, ["season", "round"])
    assert sorted(r["v"] for r in P.scan(spark, path).collect()) == [1, 2, 9]
    assert [r["v"] for r in P.scan(spark, path, season=2025).collect()] == [9]
    with pytest.raises(Exception, match="null partition key"):
        P.write_touched(df.withColumn("round", F.lit(None).cast("long")), path, ["round"])
    with pytest.raises(Exception, match="outside"):
        P.replaced_partition(df, df, season=2024).collect()
    assert P.replaced_partition(df, df.limit(0), season=2024).count() == 1
    root = f"file://{tmp_path}/b"
    BU.write({"x": df}, root)
    BU.write({"x": df.limit(1)}, root)
    assert BU.read(spark, root)["x"].count() == 1
    assert P.fill_partitions(df.where("season = 2024"), df.withColumn("v", F.lit(0)), ["season"]).agg(F.sum("v")).first()[0] == 3


def test_scd2(spark):
    t0 = datetime.datetime(2024, 1, 1)
    now = spark.createDataFrame([(1, "a", t0, None), (2, "b", t0, None)], "k long, c string, valid_from timestamp, valid_to timestamp")
    new = spark.createDataFrame([(1, "a"), (2, None), (3, "d")], "k long, c string")
    got = sorted((r["k"], r["c"] or "", r["valid_to"] is None) for r in P.scd2(now, new, "k", ["c"], "2024-02-01").collect())
    assert got == [(1, "a", True), (2, "", True), (2, "b", False), (3, "d", True)]


def test_flatten(spark):
    docs = spark.createDataFrame([(1, '{"laps": [{"n": 1}, {"n": "x"}]}'), (2, "{}")], "id long, doc string")
    got = P.flatten(docs, "doc", "laps array<struct<n: string>>", "laps").select("id", F.col("item.n").try_cast("int").alias("n"))
    assert sorted((r["id"], r["n"] or 0) for r in got.collect()) == [(1, 0), (1, 1), (2, 0)]


def test_stream_equals_batch(spark, tmp_path):
    t0 = datetime.datetime(2024, 1, 1)
    rows = [(i % 3, t0 + datetime.timedelta(seconds=i // 2), i % 4 != 0) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, ts timestamp, ok boolean")
    df.union(df).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")

    def ran(out, name, mode="append"):
        out.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start().awaitTermination(120)
        return spark.table(name)

    got = ran(twins.deduplicated(stream, "ts", ["k", "ts", "ok"], "1 hour"), "dedupe")
    assert got.count() == df.distinct().count()
    counts = ran(twins.tick_counts(stream, "ts", ["k"], "ok", "10 seconds", "0 seconds"), "ticks", "complete")
    batch = df.union(df).groupBy(F.window("ts", "10 seconds"), "k").agg(F.count("*").alias("samples"), F.count_if("ok").alias("valid")).select("window.start", "k", "samples", "valid")
    assert counts.exceptAll(batch).count() == 0 and batch.exceptAll(counts).count() == 0
