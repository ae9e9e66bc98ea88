"""Problems solved together on the same edges, against dense systems; edges that are not copied for each problem."""

import numpy as np

from chronolith.operators import graph as G, replicates as M


def dense(rows, shares, priors, nodes):
    out = np.full((nodes, len(priors)), np.nan)
    for p, prior in enumerate(priors):
        left, right = np.zeros((nodes, nodes)), np.zeros(nodes)
        for i, j, c, w, g in rows:
            left[i, i] += shares[c, p] * w
            left[i, j] -= shares[c, p] * w
            right[i] += shares[c, p] * g
        seen = np.diag(left) > 0
        out[:, p] = np.where(seen, np.linalg.solve(left + prior * np.eye(nodes), right), np.nan)
    return out


def edges(spark, rng, nodes, n, kinds):
    rows = []
    for _ in range(n):
        i, j = rng.choice(nodes, 2, replace=False)
        c, w, g = int(rng.integers(kinds)), float(rng.integers(1, 4)), float(rng.normal())
        rows += [(int(i), int(j), c, w, g), (int(j), int(i), c, w, -g)]
    return rows, spark.createDataFrame(rows, "i long, j long, c int, w double, g double")


def test_problems_share_edges(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows, df = edges(spark, rng, 40, 300, 4)
    rows, hub = rows + [(0, 1, 3, 1.0, 0.5), (1, 0, 3, 1.0, -0.5)] * 400, df.unionByName(spark.createDataFrame([(0, 1, 3, 1.0, 0.5), (1, 0, 3, 1.0, -0.5)] * 400, df.schema))
    shares, priors = np.array([[1, 0, 2], [1, 1, 0], [0, 0, 3], [1, 0, 1]], float), np.array([2.0, 8.0, 32.0])
    want = dense(rows, shares, priors, 40)
    for held in (1 << 26, 1 << 7):  # broadcast vectors, and vectors that meet the lists by a shuffle
        monkeypatch.setattr(M, "HELD", held)
        got = {r["i"]: r["ratings"] for r in M.solved_together(hub, "i", "j", "w", "g", priors, "c", shares).collect()}
        for i, values in got.items():
            assert np.allclose([np.nan if v is None else v for v in values], want[i], atol=1e-8, equal_nan=True)
    rated = {(r["prior"], r["i"]): r["rating"] for r in G.problems(hub, "i", "j", "w", "g", {"prior": [2.0, 8.0, 32.0]}, list(priors), "c", shares).collect()}
    assert len(rated) == int((~np.isnan(want)).sum()) and all(abs(rated[p, i] - want[i, k]) < 1e-8 for k, p in enumerate(priors) for i in range(40) if not np.isnan(want[i, k]))


def test_sums_are_taken_when_full():
    sums = M._Sums(2)
    rng, want = np.random.default_rng(1), {}
    for _ in range(30):
        ids, rows = rng.integers(0, 50, 20), rng.normal(size=(20, 2))
        sums.add(ids, rows)
        for i, r in zip(ids, rows):
            want[int(i)] = want.get(int(i), 0) + r
    got = {i: (a[0], b[0]) for batch in sums.taken(["i", "a", "b"], None) for i, a, b in zip(*(batch.column(k).to_pylist() for k in range(3)))}
    assert sorted(got) == sorted(want) and all(np.allclose(got[i], want[i]) for i in want) and sums.used == 0


def test_a_fold_copies_no_edges(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows, df = edges(spark, rng, 12, 120, 3)
    sizes = []
    real = M._lists
    monkeypatch.setattr(M, "_lists", lambda e: sizes.append(e.count()) or real(e))
    out = G.tuned(df.withColumnRenamed("c", "season"), "i", "j", "season", "g", (2.0, 8.0, 32.0), quantile=0.9, least_covered=0.8).collect()
    pairs = len({(i, j, c) for i, j, c, _, _ in rows})
    assert sizes == [pairs] and len(out) == 1  # one solve, an edge once
