"""Evidence operators on small frames: ties, nulls, unmatched and empty input."""

import hashlib
import math
import os
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronolith.operators import bootstrap as B, evidence as E, graph as G, quality as Q
from chronolith.plans import ratings

SF = "/root/testdata/sf0.001"


def test_matched_baseline_needs_a_match(spark):
    rows = spark.createDataFrame([(1, 1, "4", 10.0, 1), (1, 2, "1", 8.0, 2), (1, 3, "1", 6.0, 9), (2, 4, "4", 5.0, 1)], "k long, i long, s string, v double, x long")
    out = E.matched_baseline(rows, ["k"], F.col("s") == "4", "v", "x", 2, ["i"]).collect()
    assert [(r["i"], r["matched"], r["baseline"]) for r in out] == [(1, 1, 8.0)]


def test_marker_intervals(spark):
    marks = [(1, 1, "start"), (1, 2, "start"), (1, 3, None), (1, 4, "end"), (1, 5, "end"), (1, 6, "start"), (2, 1, "end")]
    rows = spark.createDataFrame(marks, "k long, t long, e string")
    assert [tuple(r) for r in E.marker_intervals(rows, ["k"], ["t"], "t", "e").orderBy("start").collect()] == [(1, 1, 4), (1, 6, None)]
    assert E.marker_intervals(rows.limit(0), ["k"], ["t"], "t", "e").count() == 0


def test_order_is_withheld_for_incomplete_ticks(spark):
    rows = spark.createDataFrame([(1, 1, 2.0), (1, 2, 3.0), (2, 1, None), (2, 2, 1.0)], "t long, e long, p double")
    assert {(r["t"], r["e"]): r["place"] for r in E.dense_order(rows, ["t"], "p", ["e"]).collect()} == {(1, 1): 2, (1, 2): 1, (2, 1): None, (2, 2): None}


def test_ledger_and_thresholds(spark):
    of = lambda *ids: spark.createDataFrame([(i,) for i in ids], "k long")
    assert {r["k"]: r["status"] for r in E.coverage_ledger(of(1, 2, 3), of(1, 1), of(1, 2), ["k"]).collect()} == {1: "available", 2: "unavailable", 3: "not_attempted"}
    empty = of(1).limit(0)
    assert [r["passed"] for r in Q.thresholds(("n", empty, F.count("*"), 0, None), ("m", empty, F.max("k"), 0, None)).collect()] == [True, False]
    assert [r["k"] for r in Q.lost_partitions(of(1, 2), of(2), ["k"]).collect()] == [1]


def test_backtest_scores_only_rated_ends(spark):
    rows = [(1, 2, 2001, 1.0), (2, 1, 2001, -1.0), (1, 2, 2002, 2.0), (1, 3, 2002, 1.0)]
    out = G.backtest(spark.createDataFrame(rows, "a long, b long, season long, gap double"), "a", "b", "season", "gap", rounds=5).collect()
    assert [(r["fold"], r["n"], r["hits"]) for r in out] == [(2002, 1, 1.0)]


def quantile(values, q):
    values, at = sorted(values), q * (len(values) - 1)
    return values[math.floor(at)] + (at % 1) * (values[math.ceil(at)] - values[math.floor(at)])


def test_cluster_bootstrap_against_brute_force(spark):
    rows = [(g, 2000 + c // 4, c % 4, float((c * 37 + i * 11) % 50)) for g in ("a", "b") for c in range(9) for i in range(c % 3 + 1)]
    rows += [("a", 2001, 1, None), ("a", 2001, 1, math.nan), ("a", None, 1, 7.0), ("b", 2010, 0, None), ("c", None, None, 1.0)]
    got = {r[0]: r for r in B.cluster_bootstrap_median(spark.createDataFrame(rows, "g string, season int, round int, v double"), "g", ["season", "round"], "v").collect()}
    for g in ("a", "b"):
        races = {}
        for x in rows:
            if x[0] == g and x[1] is not None:
                races.setdefault(x[1:3], []).extend([x[3]] if x[3] is not None and x[3] == x[3] else [])
        m = [statistics.median(v) if v else None for _, v in sorted(races.items())]
        drawn = [[m[int(hashlib.md5(f"7|{r}|{g}|{k}".encode()).hexdigest()[:8], 16) % len(m)] for k in range(len(m))] for r in range(1000)]
        medians = [statistics.median(v for v in d if v is not None) for d in drawn]
        values = [x[3] for x in rows if x[0] == g and x[3] is not None and x[3] == x[3]]
        want = (len(values), len(m), statistics.median(values), quantile(medians, 0.05), quantile(medians, 0.95))
        assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(got[g][1:], want, strict=True))
    assert tuple(got["c"]) == ("c", 1, 0, 1.0, None, None)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
def test_race_bootstrap_takes_all_rows(spark):
    out = ratings.nr09_race_bootstrap(spark, SF).collect()
    assert sum(r["n"] for r in out) == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert all(r["low"] <= r["high"] for r in out)


def direct(rows, prior):
    """Ratings of (i, j, gap, weight) by a dense solve."""
    ids = sorted({x for r in rows for x in r[:2]})
    at, a, y = {x: k for k, x in enumerate(ids)}, np.eye(len(ids)) * prior, np.zeros(len(ids))
    for i, j, g, w in rows:
        a[at[i], at[i]] += w
        a[at[i], at[j]] -= w
        y[at[i]] += w * g
    return dict(zip(ids, np.linalg.solve(a, y), strict=True))


def chain(n=8):
    """A chain, which takes many damped rounds."""
    rows = [(i, i + 1, math.sin(i) + 1, 3.0) for i in range(n)]
    return rows + [(j, i, -g, w) for i, j, g, w in rows]


def test_ratings_reach_the_fixed_point(spark):
    df = spark.createDataFrame(chain(), "a long, b long, g double, w double")
    want = direct(chain(), 0.5)
    got = G.ratings(df, "a", "b", "g", prior=0.5, weight="w").collect()
    assert all(r["converged"] and math.isclose(r["rating"], want[r["a"]], abs_tol=1e-8) for r in got) and len(got) == len(want)
    few = G.ratings(df, "a", "b", "g", prior=0.5, weight="w", rounds=2).collect()
    assert not any(r["converged"] for r in few) and max(abs(r["rating"] - want[r["a"]]) for r in few) > 1


def test_ratings_side_by_side(spark):
    rows = [(*r, p) for r in chain(4) for p in (0.5, 8.0)]
    df = spark.createDataFrame(rows, "a long, b long, g double, w double, p double")
    want = {p: direct(chain(4), p) for p in (0.5, 8.0)}
    got = G.ratings(df, "a", "b", "g", prior="p", weight="w", by=("p",)).collect()
    assert len(got) == 10 and all(math.isclose(r["rating"], want[r["p"]][r["a"]], abs_tol=1e-8) for r in got)


def test_one_way_edges_go_by_damped_rounds(spark):
    rows = [(1, 2, 1.0, 1.0), (2, 1, -1.0, 2.0), (2, 3, 0.5, 1.0), (3, 2, 0.0, 1.0)]
    got = G.ratings(spark.createDataFrame(rows, "a long, b long, g double, w double"), "a", "b", "g", prior=8.0, tolerance=1e-3, weight="w").collect()
    want = direct(rows, 8.0)
    assert all(r["converged"] and math.isclose(r["rating"], want[r["a"]], abs_tol=1e-2) for r in got)


def test_dynamic_ratings_and_backtest_reach_the_fixed_point(spark):
    rows = [(i, j, s, 0.3 * (i - j) + 0.1 * (s - 2001) * (i + j) * (1 if i < j else -1)) for s in (2001, 2002, 2004) for i in range(1, 5) for j in range(1, 5) if i != j]
    df = spark.createDataFrame(rows, "a long, b long, season long, gap double")
    net = [(a * 10000 + s, b * 10000 + s, g, 1.0) for a, b, s, g in rows]
    net += [(x, y, 0.0, 2.0 / abs(s - t)) for a in range(1, 5) for s, t in ((2001, 2002), (2002, 2004)) for x, y in ((a * 10000 + s, a * 10000 + t), (a * 10000 + t, a * 10000 + s))]
    want = direct(net, 8.0)
    got = G.ratings(G.dynamic_edges(df, "a", "b", "season", "gap", 2.0), "i", "j", "gap", weight="weight").collect()
    assert len(got) == len(want) and all(math.isclose(r["rating"], want[r["i"]], abs_tol=1e-8) for r in got)
    for r in G.backtest(df, "a", "b", "season", "gap").collect():
        d = direct([(a, b, g, 1.0) for a, b, s, g in rows if s < r["fold"]], 8.0)
        errors = [abs(g - d[a] + d[b]) for a, b, s, g in rows if s == r["fold"]]
        assert r["n"] == len(errors) and math.isclose(r["mae"], sum(errors) / len(errors), abs_tol=1e-8)
