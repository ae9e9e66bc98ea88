"""Graph operators on edge tables."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from chronolith.operators import replicates as M


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components: one row (id, component) for each end of an edge; component is the smallest id reachable.

    Each round points every vertex at its smallest neighbour, follows the pointers once more and contracts the edges;
    the number of rounds is logarithmic in practice, as edges shrink. Only a count reaches the driver. Lineage is cut by
    kept tables; the links of one round are there at a time. Nulls and loops add no links; a loop's end is a component of its own.
    """
    whole = M.kept(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "links")
    labels = M.kept(whole.select(F.col("a").alias("id")).union(whole.select("b")).distinct().select("id", F.col("id").alias("component")), "ends")
    left = whole.where("a <> b")
    while not left.isEmpty():
        ends = left.select(F.col("a").alias("v"), F.least("a", "b").alias("p")).union(left.select("b", F.least("a", "b")))
        parent = ends.groupBy("v").agg(F.min("p").alias("p"))
        grand = parent.select(F.col("v").alias("p"), F.col("p").alias("g"))
        jump = parent.join(grand, "p", "left").select("v", F.coalesce("g", "p").alias("p")).checkpoint()
        labels = labels.join(jump.withColumnRenamed("v", "component"), "component", "left").select("id", F.coalesce("p", "component").alias("component"))
        left = left.join(jump.select(F.col("v").alias("a"), F.col("p").alias("pa")), "a").join(jump.select(F.col("v").alias("b"), F.col("p").alias("pb")), "b")
        last, left = whole, M.kept(left.where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links")
        M.dropped(last)
        whole = left
    M.dropped(whole)
    return labels


def largest_component(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Edges inside the component with most vertices; of equal ones that with the smallest id."""
    labels = components(edges, a, b).checkpoint()
    top = labels.groupBy("component").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "component").limit(1).select("component")
    inside = labels.join(F.broadcast(top), "component", "left_semi").select(F.col("id").alias(a))
    return edges.join(inside, a, "left_semi")


def ratings(edges: DataFrame, a: str, b: str, gap: str, prior: float | str = 8.0, rounds: int | None = None, damping: float = 0.5, tolerance: float = 1e-10, weight: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Shrunk ratings: d_i = sum(w * (d_j + gap)) / (sum(w) + prior) over directed edges i -> j.

    Without ``rounds`` they are the fixed point: a damped round from it moves no rating by ``tolerance``. Networks whose
    edges lie both ways with equal weights are solved by conjugate gradients, others (and prior 0) by up to 3,000 damped
    rounds; what does not converge is an error. With ``rounds``, at most so many damped rounds are made, and ``converged``
    tells whether the tolerance was met. ``by`` columns (a fold, a replicate, a prior) key problems that are solved side by
    side in the same jobs; ``prior`` may name one of them. prior 0 recentres each round. Only a row of sums for each
    problem reaches the driver; each round's vector is checkpointed.
    """
    w = F.col(weight) if weight else F.lit(1.0)
    e = edges.select(*by, F.col(a).alias("i"), F.col(b).alias("j"), (w * F.col(gap)).alias("g"), w.alias("w"))
    e = e.groupBy(*by, "i", "j").agg(F.sum("g").alias("g"), F.sum("w").alias("w")).checkpoint()
    d = e.groupBy(*by, "i").agg(F.sum("w").alias("n")).withColumn("d", F.lit(0.0)).checkpoint()
    key, shrink = [*by, "i"], F.col(prior) if isinstance(prior, str) else F.lit(prior)
    if rounds is None and prior and not by and not isinstance(prior, str) and _mirrored(e, by):
        t = M.solved_together(e, "i", "j", "w", "g", np.array([float(prior)]), tolerance=tolerance)
        return t.select(F.col("i").alias(a), F.col("ratings")[0].alias("rating"), F.col("weight")[0].alias("weight"), F.lit(True).alias("converged"))
    if rounds is None and prior and _mirrored(e, by) and (not isinstance(prior, str) or d.where(~(shrink > 0)).isEmpty()):
        d, met = _solved(e, d, by, shrink, damping, tolerance), True
    else:
        d, met = _damped(e, d, by, shrink, rounds or 3000, damping, tolerance, recentre=not prior)
        if rounds is None and not met:
            raise ValueError(f"ratings have not converged to {tolerance} in 3000 rounds")
    return d.select(*by, F.col("i").alias(a), F.col("d").alias("rating"), F.col("n").alias("weight"), F.lit(met).alias("converged"))


def _pull(e: DataFrame, d: DataFrame, by: tuple[str, ...], value: str, g: Column) -> DataFrame:
    """s of each end i: the sum of g + w * value over its edges, with the other ends' values."""
    return e.join(d.select(*by, F.col("i").alias("j"), value), [*by, "j"]).groupBy(*by, "i").agg(F.sum(g + F.col("w") * F.col(value)).alias("_s"))


def _damped(e: DataFrame, d: DataFrame, by: tuple[str, ...], shrink: Column, rounds: int, damping: float, tolerance: float, recentre: bool) -> tuple[DataFrame, bool]:
    """Ratings after damped rounds, and whether the last one met the tolerance."""
    key, change = [*by, "i"], None
    for k in range(rounds):
        new = d.join(_pull(e, d, by, "d", F.col("g")), key).withColumn("new", (1 - damping) * F.col("d") + damping * F.col("_s") / (F.col("n") + shrink))
        if recentre:
            means = F.broadcast(new.groupBy(*by).agg(F.avg("new").alias("_mean")))  # a row for each problem
            new = (new.join(means, list(by)) if by else new.crossJoin(means)).withColumn("new", F.col("new") - F.col("_mean")).drop("_mean")
        new = new.checkpoint()  # the next round reads it twice
        change = new.agg(F.max(F.abs(F.col("new") - F.col("d")))).first()[0]
        d = new.select(*key, "n", F.col("new").alias("d"))
        if change is None or change < tolerance:
            return d, True
    return d, False


def _mirrored(e: DataFrame, by: tuple[str, ...]) -> bool:
    """True if each edge has one the other way of equal weight."""
    back = e.select(*by, F.col("i").alias("j"), F.col("j").alias("i"), F.col("w").alias("_v"))
    return e.join(back, [*by, "i", "j"], "left").where(F.col("_v").isNull() | (F.abs(F.col("w") - F.col("_v")) > 1e-12 * F.abs(F.col("w")))).isEmpty()


def _solved(e: DataFrame, d: DataFrame, by: tuple[str, ...], shrink: Column, damping: float, tolerance: float, limit: int = 3000) -> DataFrame:
    """The fixed point by conjugate gradients on (diag(n + prior) - W) d = sum(g), scaled by the diagonal.

    The scaled residual u times the damping is what a damped round would move. It is computed anew from d at the end; if it
    is too large there, as rounding has piled up, the iteration starts again from d. Both scalar products of a step are
    taken at once (Chronopoulos and Gear); a row of them for each problem reaches the driver.
    """
    key, scale, k = [*by, "i"], F.col("n") + shrink, 0
    totals = (F.sum(F.col("_r") * F.col("_u")).alias("ru"), F.sum(F.col("_u") * F.col("_v")).alias("uv"), F.max(F.abs(damping * F.col("_u"))).alias("change"))
    times = lambda df: df.join(_pull(e, df, by, "_u", F.lit(0.0)), key).withColumn("_v", scale * F.col("_u") - F.col("_s")).drop("_s").checkpoint()
    while True:
        at = d.join(_pull(e, d, by, "d", F.col("g")), key).withColumn("_r", F.col("_s") - scale * F.col("d")).withColumns({"_u": F.col("_r") / scale, "_p": F.lit(0.0), "_q": F.lit(0.0)})
        at, last = times(at.drop("_s").checkpoint()), {}
        while True:
            found = at.groupBy(*by).agg(*totals).collect()
            change = max((r["change"] for r in found if r["change"] is not None), default=0.0)
            if change < (tolerance / 2 if last else tolerance):
                break
            if k == limit:
                raise ValueError(f"ratings have not converged to {tolerance} in {limit} steps")
            k, steps = k + 1, {}
            for r in found:
                one = tuple(r[c] for c in by)
                if r["change"] is None or r["change"] < tolerance / 2:  # done: its rounding must not build up while others go on
                    steps[one] = (0.0, 0.0, 0.0)
                    continue
                before = last.get(one, (0.0, 0.0))
                beta = r["ru"] / before[0] if before[0] > 0 else 0.0
                down = r["uv"] - (beta * r["ru"] / before[1] if before[1] else 0.0)
                steps[one] = (r["ru"], r["ru"] / down if down > 0 else 0.0, beta)
            last = steps
            if by:
                schema = [f.simpleString().replace(":", " ", 1) for f in at.select(*by).schema]
                size = e.sparkSession.createDataFrame([(*one, x[1], x[2]) for one, x in steps.items()], ", ".join([*schema, "_alpha double", "_beta double"]))
                at = at.join(F.broadcast(size), list(by))
            else:
                at = at.withColumns({"_alpha": F.lit(steps[()][1]), "_beta": F.lit(steps[()][2])})
            at = at.withColumns({"_p": F.col("_u") + F.col("_beta") * F.col("_p"), "_q": F.col("_v") + F.col("_beta") * F.col("_q")})
            at = at.withColumns({"d": F.col("d") + F.col("_alpha") * F.col("_p"), "_r": F.col("_r") - F.col("_alpha") * F.col("_q")})
            at = times(at.withColumn("_u", F.col("_r") / scale).drop("_v", "_alpha", "_beta"))
        if not last:
            return at.select(*key, "n", "d")
        d = at.select(*key, "n", "d")


def dynamic_edges(edges: DataFrame, a: str, b: str, season: str, gap: str, link: float) -> DataFrame:
    """Edges (i, j, gap, weight) of a network whose nodes are entity * 10000 + season: the given ones, and both ways between
    an entity's neighbouring seasons with gap 0 and weight ``link`` / seasons apart."""
    node = lambda c: F.col(c) * 10000 + F.col(season)
    own = edges.select(node(a).alias("i"), node(b).alias("j"), F.col(gap).alias("gap"), F.lit(1.0).alias("weight"))
    w = Window.partitionBy(a).orderBy(season)
    nodes = edges.select(a, season).distinct().withColumns({"_n": node(a), "_next": F.lead(node(a)).over(w), "_d": F.lead(season).over(w) - F.col(season)}).where("_next is not null")
    ways = F.explode(F.array(F.struct(F.col("_n").alias("i"), F.col("_next").alias("j")), F.struct(F.col("_next").alias("i"), F.col("_n").alias("j"))))
    return own.unionByName(nodes.select(ways.alias("e"), (F.lit(link) / F.col("_d")).alias("weight")).select("e.i", "e.j", F.lit(0.0).alias("gap"), "weight"))


def joint_edges(edges: DataFrame, a: str, b: str, season: str, gaps: dict[str, Column], across: float, link: float) -> DataFrame:
    """Edges (i, j, gap, weight) between nodes entity * 100000 + season * 10 + discipline.

    ``gaps``: {gap column: weight}, a discipline each, in order; directed rows both count, so weights are doubled. An
    entity's disciplines of a season are linked with weight ``across``, its neighbouring seasons with ``link`` / seasons apart.
    """
    node = lambda c, k: F.col(c) * 100000 + F.col(season) * 10 + k
    out = None
    for k, (gap, w) in enumerate(gaps.items()):
        own = edges.select(node(a, k).alias("i"), node(b, k).alias("j"), F.col(gap).alias("gap"), (2 * w).alias("weight"))
        out = own if out is None else out.unionByName(own)
    seasons = edges.select(a, season).distinct()
    pairs = [(x, y) for x in range(len(gaps)) for y in range(len(gaps)) if x != y]
    cross = seasons.select(F.explode(F.array(*[F.struct(node(a, x).alias("i"), node(a, y).alias("j")) for x, y in pairs])).alias("e"))
    out = out.unionByName(cross.select("e.i", "e.j", F.lit(0.0).alias("gap"), F.lit(float(across)).alias("weight")))
    w = Window.partitionBy(a).orderBy(season)
    steps = seasons.withColumn("_next", F.lead(season).over(w)).where("_next is not null")
    ends = lambda k: (F.col(a) * 100000 + F.col(season) * 10 + k, F.col(a) * 100000 + F.col("_next") * 10 + k)
    ways = [F.struct(x.alias("i"), y.alias("j")) for k in range(len(gaps)) for x, y in (ends(k), ends(k)[::-1])]
    return out.unionByName(steps.select(F.explode(F.array(*ways)).alias("e"), (F.lit(link) / (F.col("_next") - F.col(season))).alias("weight")).select("e.i", "e.j", F.lit(0.0).alias("gap"), "weight"))


def problems(edges: DataFrame, a: str, b: str, weight: str, total: str, by: dict[str, list], priors: list[float], kind: str | None = None, shares: np.ndarray | None = None) -> DataFrame:
    """by, a, rating, weight of problems that are solved together on the same edges (``replicates.solved_together``).

    ``by``: the problems' keys, column by column, as many as ``priors``; nodes without an edge in a problem are left out of it.
    """
    t = M.solved_together(edges, a, b, weight, total, np.array(priors, float), kind, shares)
    keys = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(by, values, strict=True)]) for values in zip(*by.values(), strict=True)])
    each = t.select(a, F.explode(F.arrays_zip(keys.alias("k"), F.col("ratings").alias("r"), F.col("weight").alias("w"))).alias("_x"))
    return each.where("_x.r is not null").select("_x.k.*", a, F.col("_x.r").alias("rating"), F.col("_x.w").alias("weight"))


def _number(values: list, c: Column) -> Column:
    """The place of ``c`` among ``values``, from 0."""
    return F.array_position(F.array(*[F.lit(v) for v in values]), c) - 1


def _seasons(edges: DataFrame, season: str) -> list:
    """The seasons, ascending: one number each."""
    return sorted(r[0] for r in edges.where(F.col(season).isNotNull()).select(season).distinct().collect())


def _fold_ratings(edges: DataFrame, a: str, b: str, season: str, gap: str, priors: tuple[float, ...]) -> DataFrame | None:
    """fold, prior, ``a``, rating: every season's (fold's) ratings by the seasons before it, for each prior, in one solve. None if edges do not lie both ways."""
    seasons = _seasons(edges, season)
    sums = edges.groupBy(season, F.col(a).alias("i"), F.col(b).alias("j")).agg(F.sum(gap).alias("g"), F.count(gap).cast("double").alias("w")).where("w > 0").checkpoint()
    if len(seasons) < 2 or not all(p > 0 for p in priors) or not _mirrored(sums, (season,)):
        return None
    keys = [(f, float(p)) for f in seasons[1:] for p in priors]
    shares = np.array([[float(s < f) for f, _ in keys] for s in seasons])
    rows = sums.withColumn("c", _number(seasons, F.col(season)))
    return problems(rows, "i", "j", "w", "g", {"fold": [f for f, _ in keys], "prior": [p for _, p in keys]}, [p for _, p in keys], "c", shares).withColumnRenamed("i", a)


def _folds(edges: DataFrame, a: str, b: str, season: str, gap: str) -> DataFrame:
    """Sums of each pair and season, repeated for every later season (fold)."""
    folds = edges.agg(F.collect_set(season).alias("_f"))  # one row with the seasons
    past = edges.groupBy(season, a, b).agg(F.sum(gap).alias("_g"), F.count(gap).cast("double").alias("_w"))  # before rows are repeated
    return past.crossJoin(F.broadcast(folds)).withColumns({"fold": F.explode(F.filter("_f", lambda x: x > F.col(season))), "_m": F.col("_g") / F.col("_w")}).drop("_f")


def _scored(edges: DataFrame, rated: DataFrame, a: str, b: str, season: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Edges with ``predicted`` from the ratings (fold, by, entity, rating) of the fold that is their season; unrated ends are not scored."""
    left = rated.select(F.col("fold").alias(season), *by, F.col("entity").alias(a), F.col("rating").alias("_a"))
    right = rated.select(F.col("fold").alias(season), *by, F.col("entity").alias(b), F.col("rating").alias("_b"))
    return edges.join(left, [season, a]).join(right, [season, b, *by]).withColumns({"predicted": F.col("_a") - F.col("_b"), "fold": F.col(season)}).drop("_a", "_b")


def predictions(edges: DataFrame, a: str, b: str, season: str, gap: str, prior: float = 8.0, rounds: int | None = None) -> DataFrame:
    """Edges with fold (their season) and ``predicted``, by ratings fitted on the seasons before it. All folds are solved in the same jobs."""
    rated = _fold_ratings(edges, a, b, season, gap, (prior,)) if rounds is None else None
    if rated is None:
        rated = ratings(_folds(edges, a, b, season, gap), a, b, "_m", prior, rounds, weight="_w", by=("fold",))
    return _scored(edges, rated.select("fold", F.col(a).alias("entity"), "rating"), a, b, season)


def dynamic_predictions(edges: DataFrame, a: str, b: str, season: str, gap: str, link: float, prior: float = 8.0) -> DataFrame:
    """As ``predictions``, by the dynamic ratings: each entity's latest node before the fold."""
    means = edges.groupBy(a, b, season).agg(F.avg(gap).alias("_m"), F.count(gap).cast("double").alias("_w"))
    node = lambda c: F.col(c) * 10000 + F.col(season)
    links = dynamic_edges(edges, a, b, season, gap, link).where((F.col("gap") == 0) & (F.floor(F.col("i") / 10000) == F.floor(F.col("j") / 10000)))
    whole = means.select(node(a).alias("i"), node(b).alias("j"), F.col("_m").alias("gap"), F.col("_w").alias("weight")).unionByName(links)
    seasons = _seasons(edges, season)
    later = whole.withColumn("_s", F.greatest(F.col("i") % 10000, F.col("j") % 10000)).where("weight > 0").groupBy("i", "j", "_s").agg(F.sum("weight").alias("w"), F.sum(F.col("weight") * F.col("gap")).alias("g")).checkpoint()
    if len(seasons) > 1 and prior > 0 and _mirrored(later, ("_s",)):  # an edge belongs to the folds after both its ends
        shares = np.array([[float(s < f) for f in seasons[1:]] for s in seasons])
        rated = problems(later.withColumn("c", _number(seasons, F.col("_s"))), "i", "j", "w", "g", {"fold": seasons[1:]}, [prior] * (len(seasons) - 1), "c", shares)
    else:
        folds = edges.agg(F.collect_set(season).alias("_f"))
        past = whole.crossJoin(F.broadcast(folds)).withColumn("fold", F.explode(F.filter("_f", lambda x: x > F.greatest(F.col("i") % 10000, F.col("j") % 10000)))).drop("_f")  # one row
        rated = ratings(past, "i", "j", "gap", prior, weight="weight", by=("fold",))
    latest = rated.groupBy("fold", F.floor(F.col("i") / 10000).alias("entity")).agg(F.max_by("rating", F.col("i") % 10000).alias("rating"))
    return _scored(edges, latest, a, b, season)


def backtest(edges: DataFrame, a: str, b: str, season: str, gap: str, prior: float = 8.0, rounds: int | None = None) -> DataFrame:
    """fold, n, mae, rmse, hits (share of right signs), r and skill against zero of ``predictions``: each season by the seasons before it."""
    y, p = F.col(gap), F.col("predicted")
    e = F.abs(y - p)
    return predictions(edges, a, b, season, gap, prior, rounds).groupBy("fold").agg(
        F.count("*").alias("n"), F.avg(e).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.when(F.signum(y) == F.signum(p), 1.0).otherwise(0.0)).alias("hits"), F.corr(gap, "predicted").alias("r"), (1 - F.avg(e) / F.avg(F.abs(y))).alias("skill")
    )


def tuned(edges: DataFrame, a: str, b: str, season: str, gap: str, priors: tuple[float, ...], quantile: float, least_covered: float) -> DataFrame:
    """One row: the prior with the least error on the inner folds, its error and interval on the last season, and whether it is promoted.

    radius is the quantile of the inner folds' absolute errors; promotion asks for a smaller error than that of zero and
    for enough coverage. The folds of a prior are solved in the same jobs; a row for each prior is compared.
    """
    rated = _fold_ratings(edges, a, b, season, gap, priors)
    if rated is None:
        parts = [predictions(edges, a, b, season, gap, float(p)).withColumn("prior", F.lit(float(p))) for p in priors]
        scored = reduce(DataFrame.unionByName, parts)
    else:
        scored = _scored(edges, rated.select("fold", "prior", F.col(a).alias("entity"), "rating"), a, b, season, ("prior",))
    scored = scored.withColumn("_e", F.abs(F.col(gap) - F.col("predicted")))
    last = scored.agg(F.max("fold").alias("_last"))
    scored = scored.crossJoin(F.broadcast(last)).checkpoint()  # one row
    inner = scored.where("fold < _last").groupBy("prior").agg(F.avg("_e").alias("inner_mae"), F.percentile("_e", quantile).alias("radius"))
    best = inner.orderBy(F.round("inner_mae", 9), "prior").limit(1)
    held = scored.where("fold = _last").join(F.broadcast(best), "prior")
    out = held.groupBy("prior", "inner_mae", "radius").agg(F.avg("_e").alias("holdout_mae"), F.avg(F.when(F.col("_e") <= F.col("radius"), 1.0).otherwise(0.0)).alias("covered"), F.avg(F.abs(gap)).alias("_zero"))
    return out.withColumn("promoted", (F.col("holdout_mae") < F.col("_zero")) & (F.col("covered") >= least_covered)).drop("_zero")


def ablated(edges: DataFrame, a: str, b: str, season: str, kind: str, gap: str, target: str, priors: tuple[float, ...], quantile: float, least_covered: float) -> DataFrame:
    """A row for each kind of evidence that is left out (``none`` first): its prior of least inner error, errors, interval, coverage, and gain, what leaving the kind out costs.

    Edges are tagged by ``kind``; a model pools the kinds that it keeps. Folds, priors and what is left out are problems of one solve
    on the same edges, which have to lie both ways in each season and kind. Models are scored on the edges of the ``target`` kind; the last season
    is held out. The whole model is promoted if its held-out error is below that of zero and not above that of any
    model that lacks a kind, and enough of the held-out gaps lie in its interval.
    """
    kinds = [r[0] for r in edges.select(kind).distinct().orderBy(kind).collect()]  # the kinds of evidence
    sums = edges.groupBy(season, kind, a, b).agg(F.sum(gap).alias("_g"), F.count(gap).cast("double").alias("_w"))  # before rows are repeated
    seasons, missing = _seasons(edges, season), ["none", *kinds]
    keys = [(f, x, float(p)) for f in seasons[1:] for x in missing for p in priors]
    shares = np.array([[float(s < f and k != x) for f, x, _ in keys] for s in seasons for k in kinds])
    rows = sums.where(F.col("_w") > 0).withColumn("_c", _number(seasons, F.col(season)) * len(kinds) + _number(kinds, F.col(kind)))
    rated = problems(rows, a, b, "_w", "_g", {"fold": [f for f, _, _ in keys], "ablated": [x for _, x, _ in keys], "prior": [p for _, _, p in keys]}, [p for _, _, p in keys], "_c", shares)
    scored = _scored(edges.where(F.col(kind) == target), rated.select("fold", "ablated", "prior", F.col(a).alias("entity"), "rating"), a, b, season, ("ablated", "prior")).withColumn("_e", F.abs(F.col(gap) - F.col("predicted")))
    scored = scored.crossJoin(F.broadcast(scored.agg(F.max("fold").alias("_last")))).checkpoint()  # one row
    inner = scored.where("fold < _last").groupBy("ablated", "prior").agg(F.avg("_e").alias("inner_mae"), F.percentile("_e", quantile).alias("radius"))
    best = inner.groupBy("ablated").agg(F.min_by(F.struct("prior", "inner_mae", "radius"), F.struct(F.round("inner_mae", 9), "prior")).alias("_b")).select("ablated", "_b.*")
    held = scored.where("fold = _last").join(best, ["ablated", "prior"]).groupBy("ablated", "prior", "inner_mae", "radius").agg(F.avg("_e").alias("holdout_mae"), F.avg(F.when(F.col("_e") <= F.col("radius"), 1.0).otherwise(0.0)).alias("covered"), F.avg(F.abs(gap)).alias("_zero"))
    whole = held.agg(F.min(F.when(F.col("ablated") == "none", F.col("holdout_mae"))).alias("_own"), F.min(F.when(F.col("ablated") != "none", F.col("holdout_mae"))).alias("_others"))  # one row
    x = held.crossJoin(F.broadcast(whole))
    good = (F.col("holdout_mae") < F.col("_zero")) & (F.round(F.col("holdout_mae") - F.col("_others"), 9) <= 0) & (F.col("covered") >= least_covered)
    return x.select("ablated", "prior", "inner_mae", "radius", "holdout_mae", "covered", (F.col("holdout_mae") - F.col("_own")).alias("gain"), F.when(F.col("ablated") == "none", good).alias("promoted"))
