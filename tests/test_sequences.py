"""Ordered matching against exhaustive search, its pieces, exchanges and coverage."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from chronolith.operators import runs, sequences as SQ

EVENT = "g long, l string, at long, t long"


def frames(spark, a, b):
    return spark.createDataFrame(a, EVENT), spark.createDataFrame(b, EVENT)


def chains(pairs, after=(-1, -1)):
    """All chains of (found, true) numbers that rise in both."""
    yield ()
    for p in pairs:
        if p[0] > after[0] and p[1] > after[1]:
            for rest in chains(pairs, p):
                yield (p, *rest)


def expected(a, b, within):
    x, y = sorted(a, key=lambda r: (r[2], r[3])), sorted(b, key=lambda r: (r[2], r[3]))
    pairs = [(j, i) for j, q in enumerate(y) for i, p in enumerate(x) if p[1] == q[1] and abs(p[2] - q[2]) <= within]
    best = min(chains(pairs), key=lambda c: (-len(c), c))
    return sorted((x[i][1], x[i][2], y[j][2]) for j, i in best)


def test_matched_pairs_are_the_earliest_largest_set(spark):
    rng = random.Random(4)
    for within in (0, 1, 2):
        sides = [[], []]
        for g in range(12):
            for side in sides:
                times = rng.sample(range(100), 8)
                side += [(g, rng.choice("xy"), t // 12, t) for t in times[: rng.randint(0, 8)]]
        got = {}
        for r in SQ.matched(*frames(spark, *sides), ["g"], "l", "at", within, ties=["t"]).collect():
            got.setdefault(r["g"], []).append((r["l"], r["at"], r["found_at"]))
        for g in range(12):
            assert sorted(got.get(g, [])) == expected(*[[r for r in s if r[0] == g] for s in sides], within), (within, g)
        counts = {r["g"]: (r["matched"], r["truth"], r["found"]) for r in SQ.sequence_matches(*frames(spark, *sides), ["g"], "l", "at", within, ties=["t"]).collect()}
        want = {g: (len(got.get(g, [])), *(sum(r[0] == g for r in s) for s in sides)) for g in range(12)}
        assert counts == {g: w for g, w in want.items() if w[1] + w[2]}


def test_pieces_are_cut_where_no_pair_crosses(spark):
    a = [(1, "x", 1, 0), (1, "x", 2, 0), (1, "y", 4, 0), (1, "x", 5, 0), (1, "z", 5, 1), (1, "x", 9, 0)]
    b = [(1, "x", 2, 0), (1, "y", 4, 0), (1, "x", 6, 0), (1, "z", 5, 1), (1, "x", 9, 0)]
    pairs = SQ.pieces(SQ.candidates(*frames(spark, a, b), ["g"], "l", "at", 1, ["t"]), ["g"])
    got = {}
    for r in pairs.collect():
        got.setdefault(r["_piece"], set()).add((r["_at"], r["_found_at"]))
    assert list(map(got.get, sorted(got))) == [{(1.0, 2.0), (2.0, 2.0)}, {(4.0, 4.0)}, {(5.0, 6.0), (5.0, 5.0)}, {(9.0, 9.0)}]


def test_a_dense_group_is_many_tasks(spark):
    a = [(1, str(i % 7), i, 0) for i in range(2000)]
    pairs = SQ.pieces(SQ.candidates(*frames(spark, a, a), ["g"], "l", "at", 1, ["t"]), ["g"])
    assert pairs.agg(F.count_distinct("_piece")).first()[0] == 2000
    assert SQ.sequence_matches(*frames(spark, a, a), ["g"], "l", "at", 1, ["t"]).first()["matched"] == 2000


def test_small_pieces_share_a_batch(spark, monkeypatch):
    """A piece of its own costs a call of the worker: 60,000 pieces took minutes."""
    monkeypatch.setattr("pyspark.sql.GroupedData.applyInArrow", None)
    at = F.col("id") % 30
    a = spark.range(20_000).select(F.floor(F.col("id") / 10).alias("g"), F.lit("x").alias("l"), (3 * at).alias("at"), F.lit(0).cast("long").alias("t"))
    got = SQ.matched(a, a.withColumn("at", F.col("at") + F.when(F.col("g") % 2 == 0, 1).otherwise(0)), ["g"], "l", "at", 1, ["t"])
    assert got.agg(F.count("*"), F.sum(F.col("found_at") - F.col("at"))).first()[:] == (20_000, 10_000)


def test_groups_that_cross_batches_stay_whole(spark):
    keys = [None, 1.0, 1.0, float("nan"), float("nan"), 2.0, 2.0, 2.0, 2.0, 3.0]
    table = pa.table({"k": pa.array(keys), "v": range(10)})
    for size in (1, 2, 3, 4, 10):
        parts = [[x if x == x else "nan" for x in b.column("k").to_pylist()] for b in runs.whole(table.to_batches(max_chunksize=size), ["k"])]
        assert sum(parts, []) == [x if x == x else "nan" for x in keys]
        assert all(p[-1] != q[0] for p, q in zip(parts, parts[1:]))


def test_nulls_repeats_and_empty_sides(spark):
    a = [(1, None, 1, 0), (1, "x", None, 0), (None, "x", 1, 0), (2, "x", 1, 0), (2, "x", 1, 0)]
    b = [(1, None, 1, 0), (1, "x", None, 0), (None, "x", 1, 0), (2, "x", 1, 0), (2, "x", 1, 0), (2, "x", 1, 0)]
    got = {r["g"]: (r["matched"], r["truth"], r["found"]) for r in SQ.sequence_matches(*frames(spark, a, b), ["g"], "l", "at", 1).collect()}
    assert got == {1: (0, 2, 2), None: (0, 1, 1), 2: (2, 2, 3)}
    assert SQ.matched(*frames(spark, [], b), ["g"], "l", "at", 1).count() == 0
    assert SQ.sequence_matches(*frames(spark, [], []), ["g"], "l", "at", 1).count() == 0


def test_exchanges_and_coverage(spark):
    rows = spark.createDataFrame([(1, t, a) for t, a in enumerate([True, True, False, None, False, True])], "g long, t long, a boolean")
    assert [(r["t"], r["up"]) for r in SQ.exchanges(rows, ["g"], "t", F.col("a"), "up").collect()] == [(2, False), (5, True)]
    at = {1: [0, 3, 6, 10], 2: [0, 4, 10], 3: [2, 5, 8], 4: [1, 4, 7, 9], 5: [0, 0, 3, 6, 9], 6: [5]}
    ticks = spark.createDataFrame([(g, t, 0, 10) for g, ts in at.items() for t in ts] + [(1, 99, 0, 10)], "g long, t long, a long, z long")
    assert {r["g"]: r["covered"] for r in SQ.covered(ticks, ["g"], "t", "a", "z", 1, 4).collect()} == {1: True, 2: False, 3: False, 4: True, 5: False, 6: False}
