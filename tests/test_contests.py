"""Exchanges, episodes, contests, replicates and stop timing against plain Python, on small frames."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronolith.operators import contests as K, joins as J, replicates as M, stop_timing as T

# exchanges


def brute_exchanges(samples, pits, near=2.0, persist=3, guard=3, share=0.02, transition=2, widest=1):
    """samples: {(car, t): (place, gap, x, y)} of one race; pits: {car: [(a, z)]}."""
    ticks = sorted({t for _, t in samples})
    held = {(t, s[0]): car for (car, t), s in samples.items()}
    place = lambda car, t: samples[car, t][0] if (car, t) in samples else None
    xs, ys = [s[2] for s in samples.values()], [s[3] for s in samples.values()]
    diagonal = np.hypot(max(xs) - min(xs), max(ys) - min(ys))
    limit, out = share * diagonal if diagonal > 0 else np.inf, []
    for i, t in enumerate(ticks):
        for p in {s[0] for (_, at), s in samples.items() if at == t}:
            a, b = held.get((t, p)), held.get((t, p + 1))
            if i == 0 or t < guard or a is None or b is None or held.get((ticks[i - 1], p)) == a:
                continue
            anchor = None
            for j in range(i - 1, -1, -1):
                if t - ticks[j] > transition:
                    break
                if held.get((ticks[j], p)) == b and held.get((ticks[j], p + 1)) == a:
                    between = [(place(a, x), place(b, x)) for x in ticks[j + 1 : i]]
                    if all(v in (None, p, p + 1) for pair in between for v in pair) and not any(None not in pair and pair[0] < pair[1] for pair in between):
                        anchor = j
                        break
            if anchor is None or any(x <= t <= z for car in (a, b) for x, z in pits.get(car, [])):
                continue
            (_, _, ax, ay), (_, gap, bx, by) = samples[a, t], samples[b, t]
            if not np.hypot(ax - bx, ay - by) < limit or gap is None or not 0 <= gap < near:
                continue
            end = next((k for k, x in enumerate(ticks) if x >= t + persist), None)
            if end is None or any(y - x > widest for x, y in zip(ticks[i:end], ticks[i + 1 : end + 1], strict=True)):
                continue
            if all(place(a, x) is not None and place(b, x) is not None and place(a, x) < place(b, x) for x in ticks[i : end + 1]):
                out.append((t, p, a, b, "adjacent" if anchor == i - 1 else "after_short_transition"))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_exchanges_equal_brute_force(spark, seed):
    rng, samples = random.Random(seed), {}
    order, hot = list(range(6)), 0
    for t in range(0, 160):
        if t in (70, 71) and seed % 2:
            continue  # a gap in the feed
        if rng.random() < 0.25 and hot <= t:
            k, hot = rng.randrange(5), t + rng.choice([1, 3, 5])
            order[k], order[k + 1] = order[k + 1], order[k]
        seen = [c for c in order if rng.random() > 0.06]
        for c in seen:
            samples[c, t] = (order.index(c) + 1, rng.choice([0.4, 1.5, 2.5, None]) if rng.random() < 0.3 else 0.7, rng.choice([0.0, 1.0, 90.0]) if rng.random() < 0.1 else 0.5, 100.0 if t == 0 else 0.0)
    pits = {c: [(20 * c + 10, 20 * c + 25)] for c in range(3)}
    rows = [(1, c, t, *s) for (c, t), s in samples.items()]
    frame = spark.createDataFrame(rows, "race long, car long, t long, place long, gap double, x double, y double")
    spans = spark.createDataFrame([(1, c, a, z) for c, x in pits.items() for a, z in x], "race long, car long, entered long, left long")
    got = K.exchanges(frame, ["race"], "car", "t", "place", "gap", spans)
    want = brute_exchanges(samples, pits)
    assert sorted((r["t"], r["place"], r["passer"], r["passed"], r["reason"]) for r in got.collect()) == want
    assert want and {w[-1] for w in want} <= {"adjacent", "after_short_transition"}


def test_exchanges_need_unique_samples(spark):
    frame = spark.createDataFrame([(1, 1, 5, 1, 0.1, 0.0, 0.0)] * 2, "race long, car long, t long, place long, gap double, x double, y double")
    with pytest.raises(Exception, match="not unique"):
        K.exchanges(frame, ["race"], "car", "t", "place", "gap").collect()


# episodes: a state machine over one car's rows


def brute_episodes(rows, contact=1.5, pressure=1.0, release=2.0, patience=15, guard=60, widest=3):
    """rows: one car's (t, rival, gap, same, green, pit, lap) in order; green and pit hold for both cars."""
    steps = sorted(b[0] - a[0] for a, b in zip(rows, rows[1:], strict=False) if 0 < b[0] - a[0] <= widest)
    tick = float(np.median(steps)) if steps else widest / 3
    out, state = [], None

    def close(ended):
        out.append((state["start"], state["last"], ended, state["n"], state["contacts"], state["pressures"], state["same"], state["longest"], state["last"] - state["far"] if state["far"] is not None else 0.0))

    for t, rival, gap, same, green, pit, lap in rows:
        near = gap is not None and 0 < gap <= contact and same
        touch = near and rival is not None and green and not pit and lap > 1 and t >= guard
        if state is not None:
            ended = "feed_gap" if t - state["last"] > widest else "third_car_change" if rival is None or rival != state["rival"] else "non_green" if not green else "pit_boundary" if pit else ""
            if ended:
                close(ended)
                state = None
        if state is None:
            if touch:
                state = {"start": t, "rival": rival, "n": 0, "contacts": 0, "pressures": 0, "same": 0, "longest": 0.0, "press": None, "far": None, "last": None}
            else:
                continue
        if state["last"] is not None and t - state["last"] > tick + 1e-6:
            state["press"] = state["far"] = None
        hot = near and gap <= pressure
        state["press"] = (state["press"] if state["press"] is not None else t) if hot else None
        if hot:
            state["longest"] = max(state["longest"], t - state["press"] + tick)
        state["n"], state["same"], state["contacts"], state["pressures"] = state["n"] + 1, state["same"] + same, state["contacts"] + near, state["pressures"] + hot
        away = gap is not None and gap > release and same
        state["far"] = (state["far"] if state["far"] is not None else t) if away else None
        state["last"] = t
        if away and t - state["far"] >= patience:
            close("gap_released")
            state = None
    if state is not None:
        close("race_or_feed_end")
    return out


@pytest.mark.parametrize("seed", range(4))
def test_episodes_equal_a_state_machine(spark, seed):
    rng = random.Random(seed)
    t, rows, gap, rival = 50, [], 1.0, 1
    for _ in range(500):
        t += rng.choices([1, 2, 5], [20, 1, 0.4])[0]
        rival = rng.choice([1, 1, 2]) if rng.random() < 0.02 else rival
        gap = rng.choice([0.5, 1.2, 1.8, 3.0, 3.0]) if rng.random() < 0.12 else gap
        rows.append((t, rival, None if rng.random() < 0.01 else gap, rng.random() > 0.03, rng.random() > 0.01, rng.random() < 0.01, 3))
    frame = []
    for at, who, g, same, green, pit, lap in rows:
        frame += [(1, who, 7, at, 1, None, lap if same else lap + 5, 0.5, green, pit), (1, 9, 8, at, 2, g, lap, 0.4, True, False)]
    ticks = spark.createDataFrame(frame, "race long, car long, team long, t long, place long, gap double, lap long, inside double, green boolean, pit boolean")
    got = K.episodes(ticks, ["race"], "car", patience=6).where("car = 9").orderBy("start").collect()
    want = brute_episodes(rows, patience=6)
    assert [(r["start"], r["end"], r["ended"], r["samples"], r["contacts"], r["pressures"], r["same_lap"], r["longest_pressure"], r["release_run"]) for r in got] == want
    assert len(want) > 3


def test_contests_own_each_pass_once(spark):
    schema = "race long, car long, rival long, start long, `end` long, ended string, place long, same_team boolean, samples long, contacts long, pressures long, same_lap long, closest double, median_gap double, longest_pressure double, release_run double, first_lap long, last_lap long, tick double"
    row = lambda start, end, ended, pressure=12.0, samples=None, same=None: (1, 5, 6, start, end, ended, 3, False, n := samples or end - start + 1, n, n, same if same is not None else n, 0.5, 0.6, pressure, 0.0, 4, 5, 1.0)
    found = spark.createDataFrame([row(10, 20, "third_car_change"), row(22, 40, "gap_released"), row(50, 60, "pit_boundary"), row(70, 80, "gap_released", 4.0), row(90, 120, "feed_gap", samples=20), row(130, 150, "gap_released", same=5)], schema)
    passes = spark.createDataFrame([(1, t, a, b, 0.9) for t, a, b in ((22, 5, 6), (23, 5, 6), (24, 6, 5), (61, 5, 6))], "race long, t long, passer long, passed long, confidence double")
    got = {r["start"]: r for r in K.contests(found, passes, ["race"], "car").collect()}
    assert [(got[s]["outcome"], got[s]["pass_t"], got[s]["reversal_t"]) for s in (10, 22)] == [("Converted", 22, 24), ("Converted", 23, 24)]
    assert (got[50]["outcome"], got[50]["terminal_reason"], got[50]["exclusion_reason"]) == ("Interrupted", "pit_boundary", "pit_boundary")
    assert [(got[s]["eligible"], got[s]["exclusion_reason"]) for s in (10, 70, 90, 130)] == [(True, ""), (False, "insufficient_sustained_pressure"), (False, "under_covered_episode"), (False, "lap_deficit_changed")]
    assert (got[10]["confidence"], got[50]["confidence"], got[70]["confidence"]) == ("medium", "low", "insufficient")


# replicates


def test_vector_sums(spark):
    rng = np.random.default_rng(1)
    keys, values = rng.integers(0, 40, 3000), rng.normal(size=(3000, 7))
    df = spark.createDataFrame([(int(k), v.tolist()) for k, v in zip(keys, values, strict=True)], "k long, v array<double>").repartition(5)
    got = {r["k"]: r["v"] for r in M.vector_sums(df, ["k"], ["v"], 7).collect()}
    assert len(got) == len(set(keys.tolist()))
    for k, v in got.items():
        np.testing.assert_allclose(v, values[keys == k].sum(axis=0))


def test_copies_draw_as_many_as_there_are(spark):
    df = spark.createDataFrame([(s, i) for s in range(3) for i in range(10 + s)], "s long, i long").repartition(3)
    for strata, order in ((["s"], ["i"]), ([], ["s", "i"])):
        rows = M.copies(df, strata, order, 20).collect()
        total = {}
        for r in rows:
            total[r["s"] if strata else 0] = np.array(r["copies"]) + total.get(r["s"] if strata else 0, 0)
        assert all((v == (10 + k if strata else 33)).all() for k, v in total.items())


def test_solved_equals_a_dense_solve(spark):
    rng, nodes, many = np.random.default_rng(2), 12, 5
    edges, want = [], np.zeros((many, nodes))
    a, b = np.triu_indices(nodes, 1)
    w = rng.integers(0, 3, (len(a), many)).astype(float)
    g = rng.normal(size=len(a))
    w[(a == 0) | (b == 0), 1] = 0  # node 0 is absent from replicate 1
    for i, j, ws, gap in zip(a, b, w, g, strict=True):
        edges += [(int(i), int(j), ws.tolist(), (ws * gap).tolist()), (int(j), int(i), ws.tolist(), (-ws * gap).tolist())]
    for r in range(many):
        A, rhs = np.diag(np.full(nodes, 8.0)), np.zeros(nodes)
        for i, j, ws, s in edges:
            A[i, i] += ws[r]
            A[i, j] -= ws[r]
            rhs[i] += s[r]
        want[r] = np.linalg.solve(A, rhs)
    df = spark.createDataFrame(edges, "a long, b long, w array<double>, s array<double>").repartition(4)
    t = M.solved(df, "a", "b", "w", "s", many)
    got = {r["a"]: r["ratings"] for r in t.collect()}
    assert got[0][1] is None
    for i, values in got.items():
        np.testing.assert_allclose([v for v in values if v is not None], [want[r, i] for r in range(many) if (i, r) != (0, 1)], atol=1e-9)
    spans = {r["a"]: r for r in M.intervals(t, "a", "ratings", 0.9).collect()}
    assert spans[0]["present"] == 4 and spans[0]["low"] is None
    np.testing.assert_allclose([spans[3]["low"], spans[3]["high"]], np.quantile(got[3], [0.05, 0.95]))


# linear windows


def test_bracketed_is_linear(spark):
    """Four times the rows of one key take less than eight times as long (a quadratic frame: sixteen)."""

    def took(n):
        left = spark.range(n).select(F.lit(1).alias("k"), (F.col("id") * 2.0 + 1).alias("x"))
        right = spark.range(n).select(F.lit(1).alias("k"), (F.col("id") * 2.0).alias("x"), F.col("id").cast("double").alias("v"))
        began = time.time()
        assert J.bracketed(left, right, ["k"], "x", ["v"]).agg(F.count("v")).first()[0] == n - 1
        return time.time() - began

    took(1000)
    assert took(60_000) < 8 * max(took(15_000), 0.5)


# stop timing


def test_lines():
    x = np.array([[1.0, 2, 3, 4], [2, 2, 2, 2], [1, 1, 2, 9]])
    y = np.array([[3.0, 5, 7, 90], [1, 2, 3, 4], [0, 2, 4, 4]])
    a, b, mad = T.line(x, y)
    assert np.isnan([a[1], b[1], mad[1]]).all()
    for k in (0, 2):
        slopes = [(y[k, j] - y[k, i]) / (x[k, j] - x[k, i]) for i in range(4) for j in range(i + 1, 4) if x[k, i] != x[k, j]]
        assert b[k] == np.median(slopes) and a[k] == np.median(y[k] - b[k] * x[k]) and mad[k] == np.median(np.abs(y[k] - a[k] - b[k] * x[k]))


def race(stint=14, laps=42, noise=0.0):
    rng = random.Random(4)
    return [(1, d, k + 1, k // stint + 1, ("SOFT", "HARD", "MEDIUM")[k // stint % 3], k % stint + 1.0, "1", 0.1 * (k % stint) + (1.0 if 1 <= k % stint <= 6 and k >= stint else 0.0) + noise * rng.random()) for d in (1, 2) for k in range(laps)]


LAPS = "race long, driver long, lap_number long, stint long, compound string, tyre_life double, track_status string, residual double"


def test_stop_scenarios_equal_a_sum_over_laps(spark):
    m = T.models(spark.createDataFrame(race(), LAPS), ["race", "driver"], warm=6, last=12, tail=9)
    stops = {(r["driver"], r["out_lap"]): r for r in m.collect()}
    assert {r["reason"] for r in stops.values()} == {""}
    options = T.scenarios(m, ["race", "driver"]).collect()
    assert len(options) == 7 * len(stops)
    for o in options:
        s = stops[o["driver"], o["out_lap"]]

        def cost(shift, s=s):
            total, out = 0.0, s["out_lap"] + shift
            for lap in range(s["out_lap"] - 3, s["out_lap"] + 10):
                if lap < out:
                    total += s["old_a"] + s["old_b"] * (s["in_age"] + lap - (s["out_lap"] - 1))
                elif lap > out:
                    k = lap - out
                    total += s["warm"][k - 1] if k <= 6 else s["new_a"] + s["new_b"] * k
            return total

        if o["supported"]:
            assert o["cost"] == pytest.approx(cost(o["shift"])) and o["delta"] == pytest.approx(cost(o["shift"]) - cost(0), abs=1e-9)
    assert {o["old_beyond"] for o in options if o["shift"] == 3} == {4.0}


def test_stop_reasons(spark):
    rows = race()
    rows = [r for r in rows if not (r[1] == 1 and r[2] == 20)]
    rows = [(*r[:6], "4" if r[1] == 2 and r[2] == 31 else "1", None if r[1] == 2 and 2 <= r[2] <= 12 else r[7]) for r in rows]
    got = {(r["driver"], r["out_lap"]): r["reason"] for r in T.models(spark.createDataFrame(rows, LAPS), ["race", "driver"]).collect()}
    assert got == {(1, 15): "incomplete_evaluation_window", (1, 29): "", (2, 15): "insufficient_old_reference_laps", (2, 29): "non_green_evaluation_window"}


def test_refits_are_drawn_again_until_valid(spark):
    stops = T.models(spark.createDataFrame(race(noise=0.3), LAPS), ["race", "driver"], last=9)
    rows = T.redrawn(stops, ["race", "driver"], samples=40).collect()
    counts = {}
    for r in rows:
        counts.setdefault((r["driver"], r["out_lap"]), []).append(r["attempt"])
    assert counts and all(len(v) == 40 for v in counts.values())
    assert any(max(v) >= 40 for v in counts.values()), "three mature laps give invalid draws"
    out = T.decided(T.scenarios(stops, ["race", "driver"]), T.redrawn(stops, ["race", "driver"], samples=40), ["race", "driver"], samples=40, least=10).collect()
    for r in out:
        if r["eligible"]:
            assert r["attempted"] == max(counts[r["driver"], r["out_lap"]]) + 1 and 0 <= r["wins"] <= 100 and r["p25"] <= r["p75"]
