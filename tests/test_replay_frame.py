"""Parts of the replay frame against plain Python: coherence of recorded orders, anchors, support, gate, estimate and overlay."""

import random

import pytest

from chronolith.operators import replay_frame as RF


def test_coherence_is_a_whole_order_of_the_roster(spark):
    rng = random.Random(8)
    roster = [(g, c) for g in range(6) for c in range(4)] + [(6, 0)]
    feed = []
    for g in range(6):
        order = list(range(1, 5))
        for t in range(40):
            if rng.random() < 0.4:
                rng.shuffle(order)
            for c in range(4):
                if rng.random() < (0.9 if t % 5 == 0 else 0.2):
                    feed.append((g, c, t, order[c] if rng.random() < 0.95 else rng.choice([0, 5, 9])))
    feed += [(0, 9, 3, 1), (6, 0, 2, 1)]  # not of the roster; a roster of one
    got = {(r["g"], r["t"]): (r["coherent"], r["epoch"]) for r in RF.coherence(spark.createDataFrame(feed, "g long, c long, t long, position long"), spark.createDataFrame(roster, "g long, c long"), ["g"], "c").collect()}
    want = {}
    for g in range(7):
        cars, held, epoch = {c for h, c in roster if h == g}, {}, None
        rows = [r for r in feed if r[0] == g and r[1] in cars and r[3] > 0]
        for t in sorted({r[2] for r in rows}):
            for _, c, _, p in (r for r in rows if r[2] == t):
                epoch = t if held.get(c) != p else epoch
                held[c] = p
            want[g, t] = (sorted(held.values()) == list(range(1, len(cars) + 1)), epoch)
    assert got == want and {c for c, _ in want.values()} == {True, False}


def test_anchors_stand_in_the_middle_of_a_run(spark):
    rows = [(1, 0, 5.0, 5.0), (1, 10, 5.0, 5.5), (1, 20, 9.0, 5.0), (1, 20, 8.0, 5.0), (1, 30, 0.0, 0.0), (1, 40, 20.0, 5.0), (1, 50, 20.0, 5.0), (1, 60, None, 5.0), (1, None, 7.0, 7.0), (2, 5, 1.0, 1.0), (3, 5, 0.0, 0.0), (3, 6, float("nan"), 1.0)]
    got = RF.anchored(spark.createDataFrame(rows, "c long, t long, x double, y double"), ["c"], 1.0).orderBy("c", "t").collect()
    assert [(r["c"], r["t"], r["x"], r["last"], r["raw_a"], r["raw_z"], r["moved"]) for r in got] == [(1, 5.0, 5.0, False, 0, 50, 40), (1, 20.0, 9.0, False, 0, 50, 40), (1, 40.0, 20.0, True, 0, 50, 40), (2, 5.0, 1.0, True, 5, 5, 5)]


def test_ticks_need_support_and_end_after_the_last_movement(spark):
    points = RF.anchored(spark.createDataFrame([(1, 0, 2.0, 1.0), (1, 20, 6.0, 1.0), (1, 60, 10.0, 1.0), (1, 100, 10.0, 1.0)], "c long, t long, x double, y double"), ["c"], 1.0)
    at = lambda finish, **k: [(r["t"], r["x"]) for r in RF.on_ticks(points, spark.createDataFrame([(1, finish)], "c long, finish long"), ["c"], 10, **k).orderBy("t").collect()]
    assert at(70, buffer=20, linger=50, max_gap=30) == [(0, 2.0), (10, 4.0), (20, 6.0), (60, 10.0), (70, 10.0), (80, 10.0)]
    assert at(60, buffer=90, linger=30, max_gap=40) == [(0, 2.0), (10, 4.0), (20, 6.0), (30, 7.0), (40, 8.0), (50, 9.0), (60, 10.0), (70, 10.0), (80, 10.0), (90, 10.0)]
    assert at(0, buffer=0, linger=10, max_gap=40) == [(0, 2.0), (10, 4.0)]


LAPS = "g long, c long, lap_number long, start_ms long, end_ms long, lap_ms long"


@pytest.fixture(scope="module")
def race(spark):
    laps = [(1, c, n, (n - 1) * ms, n * ms, ms) for c, ms in ((1, 100), (2, 110), (3, 150)) for n in (1, 2, 3)]
    fixes = [(1, c, t, float(t + 1), 1.0) for c, end in ((1, 300), (2, 330), (3, 450)) for t in range(0, end + 1, 10)]
    return spark.createDataFrame(laps, LAPS), spark.createDataFrame(fixes, "g long, c long, t long, x double, y double")


def replay(spark, race, order=(), gaps=(), **k):
    laps, fixes = race
    recorded = spark.createDataFrame([(1, *r) for r in order], "g long, c long, t long, position long")
    intervals = spark.createDataFrame([(1, *r) for r in gaps], "g long, c long, t long, gap_leader double, gap_ahead double")
    out = RF.frame(fixes, laps, recorded, intervals, ["g"], "c", 50, [], buffer=1000, linger=1000, max_gap=100, max_age=60, least=k.pop("least", 0.5)).collect()
    return {(r["c"], r["t"]): r for r in out}


def test_gate_fails_closed(spark, race):
    laps, fixes = race
    got = RF.gate(fixes, laps, ["g"], "c", 0.7).collect()
    assert [(r["g"], round(r["coverage"], 6)) for r in got] == [(1, round(330 / 450, 6))]
    assert RF.gate(fixes, laps, ["g"], "c", 0.74).count() == 0 and RF.gate(fixes.limit(0), laps, ["g"], "c", 0.1).count() == 0
    assert replay(spark, race, least=0.74) == {}


def test_estimate_orders_and_holds_gaps(spark, race):
    at = replay(spark, race)
    assert [at[c, 200]["place"] for c in (1, 2, 3)] == [1, 2, 3] and {r["place_source"] for r in at.values()} == {"estimate"}
    assert at[1, 200]["gap"] == 0 and at[2, 200]["gap"] == pytest.approx(200 - 200 / 1.1) and at[3, 200]["gap"] == pytest.approx(200 - 200 / 1.5)
    assert at[3, 200]["ahead"] == pytest.approx(200 / 1.1 - 200 / 1.5)
    assert at[1, 300]["lap"] == 3 and at[1, 300]["inside"] == 1 and (1, 350) not in at and at[3, 450]["gap"] == pytest.approx(150)


def test_recorded_order_and_fresh_gaps_replace_the_estimate(spark, race):
    order = [(1, 100, 2), (2, 100, 1), (3, 120, 3), (1, 240, 1)]
    gaps = [(1, 110, 7.0, 7.0), (3, 90, 5.0, 5.0), (3, 140, 9.0, 2.0), (1, 190, -1.0, 3.0)]
    at = replay(spark, race, order, gaps)
    shown = lambda c, t: tuple(at[c, t][n] for n in ("place", "place_source", "place_seen", "gap_source", "gap_seen"))
    assert shown(1, 100)[:3] == (1, "estimate", None)  # car 3 has no position yet
    assert shown(2, 150) == (1, "recorded", 100, "recorded", 100) and at[2, 150]["gap"] == 0
    assert shown(1, 150) == (2, "recorded", 100, "estimate", None)  # its gap is older than the order
    assert shown(3, 150) == (3, "recorded", 120, "recorded", 140) and (at[3, 150]["gap"], at[3, 150]["ahead"]) == (9.0, 2.0)
    assert shown(3, 250)[1] == "estimate"  # two cars claim the first place
    assert shown(3, 200)[3:] == ("recorded", 140) and shown(1, 200)[3:] == ("estimate", None)  # a negative gap is none
