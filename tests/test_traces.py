"""Trace operators against plain Python on random, repeated, null and empty samples."""

import math
import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from chronolith.operators import traces as T

CHANNELS = ["speed", "throttle", "brake"]
SAMPLE = "lap long, x double, seq long, speed double, throttle double, brake int"


def close(a, b):
    return a is None and b is None or a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def clean(spark, rows):
    valid = (F.col("x") >= 0) & (F.col("speed") > 0) & (F.col("speed") <= 400) & F.col("throttle").isNotNull() & F.col("brake").isin(0, 1)
    return T.cleaned(spark.createDataFrame(rows, SAMPLE), ["lap"], "x", "seq", CHANNELS, {"throttle": (0.0, 100.0)}, valid)


def test_cleaned_keeps_the_last_valid_sample_and_counts(spark):
    nan = float("nan")
    rows = [
        (1, 0.0, 0, 100.0, 120.0, 0), (1, 0.0, 1, 110.0, -3.0, 1), (1, 0.0, 2, 900.0, 5.0, 0), (1, 25.0, 3, 0.0, 5.0, 0), (1, 50.0, 4, nan, 5.0, 0),
        (1, None, 5, 90.0, 5.0, 0), (1, 75.0, 6, 90.0, None, 0), (1, 100.0, 7, 90.0, 7.0, 2), (1, 125.0, 8, 90.0, 7.0, None), (1, -5.0, 9, 90.0, 7.0, 1), (2, None, 0, None, None, None),
    ]
    at = clean(spark, rows)
    assert [(r["lap"], r["x"], r["speed"], r["throttle"], r["brake"]) for r in at.where("ok").collect()] == [(1, 0.0, 110.0, 0.0, 1)]
    got = {r["lap"]: (r["valid"], r["coverage"], r["clipped"]) for r in T.audited(at, ["lap"]).collect()}
    assert got == {1: (1, 10.0, 2), 2: (0, 0.0, 0)}
    assert clean(spark, []).count() == 0 and T.audited(clean(spark, []), ["lap"]).count() == 0


def test_onsets_need_quiet_and_held_distance(spark):
    rng = random.Random(5)
    rows, want = [], set()
    for lap in range(12):
        xs = sorted(rng.sample([i * 25.0 for i in range(40)] + [i * 25.0 + 10 for i in range(40)], 50)) if lap % 2 else [i * 25.0 for i in range(40)]
        flags = [int(rng.random() < 0.5) for _ in xs]
        rows += [(lap, x, f) for x, f in zip(xs, flags)]
        for i, x in enumerate(xs):
            before = [(p, f) for p, f in zip(xs, flags) if x - 50 <= p < x]
            after = [(p, f) for p, f in zip(xs, flags) if x <= p <= x + 50]
            if flags[i] and before and min(before)[0] <= x - 50 and max(after)[0] >= x + 50 and not any(f for _, f in before) and all(f for _, f in after):
                want.add((lap, x))
    out = T.with_onsets(spark.createDataFrame(rows, "lap long, x double, f int"), ["lap"], "x", "f", 50, 50, "on")
    assert {(r["lap"], r["x"]) for r in out.where("on").collect()} == want
    assert want and out.where("on is null").count() == 0


@pytest.fixture(scope="module")
def drawn(spark):
    rng = random.Random(9)
    rows = [(p, d, x, rng.choice([60.0, 120.0, 180.0, 240.0]), rng.choice([0.0, 3.0, 50.0, 99.0, 100.0]), int(rng.random() < 0.6)) for p in range(6) for d in (1, 2) for x in sorted(rng.sample([i * 25.0 for i in range(40)], 33))]
    rows += [(6, 1, 0.0, 80.0, 1.0, 0), (6, 2, 0.0, 90.0, 1.0, 0), (7, 1, 0.0, 80.0, 1.0, 0), (7, 2, 25.0, 90.0, 1.0, 0)]
    at = spark.createDataFrame(rows, "p long, d long, x double, speed double, throttle double, brake int").select("p", "d", F.lit(1).alias("n"), "x", *CHANNELS, F.lit(True).alias("ok"))
    pairs = spark.createDataFrame([(p, 1, 1, 2, 1) for p in range(8)], "p long, d long, n int, other_d long, other_n int")
    return rows, at, T.common(pairs, at, ["p"], "d", "n", "x", CHANNELS)


def matched(rows, p):
    side = [{r[2]: r[3:] for r in rows if r[0] == p and r[1] == d} for d in (1, 2)]
    xs = sorted(side[0].keys() & side[1].keys())
    return xs, [[s[x] for x in xs] for s in side]


def mean(pairs):
    total = sum(w for _, w in pairs)
    return sum(v * w for v, w in pairs) / total if total > 0 else None


def test_technique_of_pairs(drawn):
    rows, _, wide = drawn
    got = {r["p"]: r for r in T.technique(wide, ["p"], "x", 99.0, 5.0, 160.0, 50, 50).collect()}
    assert set(got) == set(range(7))  # pair 7 has no distance in common
    found = 0
    for p in range(7):
        xs, both = matched(rows, p)
        dx = [b - a for a, b in zip(xs, xs[1:])]
        assert got[p]["points"] == len(xs)
        for name, side in zip("ab", both):
            share = lambda ok: mean([(float(ok(s)), w) for s, w in zip(side[1:], dx)])
            onsets = [side[i][0] for i in range(len(xs)) if side[i][2] and {xs[i] - 50, xs[i] + 50} <= set(xs) and all(not s[2] for x, s in zip(xs, side) if xs[i] - 50 <= x < xs[i]) and all(s[2] for x, s in zip(xs, side) if xs[i] <= x <= xs[i] + 50)]
            found += len(onsets)
            want = {
                "flat_out": share(lambda s: s[1] >= 99), "coasting": share(lambda s: s[1] <= 5 and s[2] == 0), "braking": share(lambda s: s[2] == 1), "onset_speed": median(onsets) if onsets else None,
                "low_speed": mean([(side[i + 1][0], w) for i, w in enumerate(dx) if (both[0][i + 1][0] + both[1][i + 1][0]) / 2 <= 160]),
            }
            for c, v in want.items():
                assert close(got[p][f"{name}_{c}"], v), (p, name, c)
    assert found


def test_microsectors_and_elapsed_time(drawn):
    rows, at, wide = drawn
    got = {(r["p"], r["segment"]): r for r in T.microsectors(wide, ["p"], "x", 100.0, ["speed"]).collect()}
    want = {}
    for p in range(8):
        xs, (a, b) = matched(rows, p)
        for i in range(1, len(xs)):
            x0, x = xs[i - 1], xs[i]
            w = want.setdefault((p, int(x0 // 100) + 1), [x0, x, 0.0, 0.0, []])
            w[1] = x
            for k, s in ((2, a), (3, b)):
                w[k] += 7.2 * (x - x0) / (s[i][0] + s[i - 1][0])
            w[4].append((a[i][0], x - x0))
    assert set(got) == set(want)
    for k, (start, end, ta, tb, speeds) in want.items():
        r = got[k]
        assert (r["start"], r["end"]) == (start, end) and close(r["a_time"], ta) and close(r["b_time"], tb) and close(r["a_speed"], mean(speeds))
    run = {(r["p"], r["d"], r["x"]): r["t"] for r in T.elapsed(at, ["p", "d"], "x", "speed", "t").collect()}
    for p in range(8):
        for d in (1, 2):
            own, t = sorted((r[2], r[3]) for r in rows if r[:2] == (p, d)), 0.0
            for i, (x, v) in enumerate(own):
                t += 7.2 * (x - own[i - 1][0]) / (v + own[i - 1][1]) if i else 0.0
                assert close(run[p, d, x], t)


def test_both_ways_and_opened(spark):
    one = spark.createDataFrame([(1, 5, 6, 2.0, 3.0)], "k long, d long, e long, a double, b double")
    out = T.both_ways(one, ["k"], {"d": ("d", "e"), "v": ("a", "b")})
    assert sorted(tuple(r) for r in out.collect()) == [(1, 5, 2.0, 6, 3.0), (1, 6, 3.0, 5, 2.0)] and out.columns == ["k", "d", "v", "other_d", "other_v"]
    rows = spark.createDataFrame([(1, [0.5, None]), (2, []), (3, None)], "k long, s array<float>")
    assert [tuple(r) for r in T.opened(rows, ["k"], "s", 25, "x", {"v": 2 * F.col("_v")}).orderBy("x").collect()] == [(1, 0.0, 0, 1.0), (1, 25.0, 1, None)]


def test_best_loop_is_closed_complete_and_smooth(spark):
    square = [(0.0, 0.0), (0.0, 3.0), (4.0, 3.0), (4.0, 0.0), (0.0, 0.5)]
    rows = [(1, 1, i, x, y) for i, (x, y) in enumerate(square)] + [(1, 2, i, x, y) for i, (x, y) in enumerate(square[:4])] + [(1, 3, i, x, y) for i, (x, y) in enumerate(square)] + [(1, 0, 0, 0.0, 0.0), (1, 0, 1, None, 0.0), (2, 1, 0, 1.0, 1.0)]
    out = T.best_loop(spark.createDataFrame(rows, "g long, lap long, i long, x double, y double"), ["g"], ["lap"], "i", "x", "y", 5).orderBy("i").collect()
    assert [(r["g"], r["lap"], r["i"]) for r in out] == [(1, 1, i) for i in range(5)]
    assert close(out[-1]["length"], 10 + math.hypot(4, 0.5)) and out[0]["step"] == 0
