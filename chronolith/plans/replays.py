"""Replay queries: grids, progress, gaps, recorded orders, passes and battles."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from chronolith.operators import evidence as E, joins as J, replay as R, resample as RS
from chronolith.plans.bindings import dealt, view
from chronolith.plans.registry import query
from chronolith.plans.serving import _PLACED, placed, timed

S = SparkSession
RACE, STEP = ["season", "round"], 60_000
r6 = lambda c: F.round(c, 6)

_GRID = (
    f"g AS MATERIALIZED (SELECT season, round, driver_id, t, lap_number AS lap, lap_number - 1 + (t - start_ms) / lap_ms AS progress, stint, compound, tyre_life, track_status FROM "
    f"(SELECT *, unnest(range(CAST(ceil(start_ms / {STEP}) AS BIGINT), CAST(ceil(end_ms / {STEP}) AS BIGINT))) * {STEP} AS t FROM b_timed))"
)


def grid(spark: S, d: str) -> DataFrame:
    return R.grid(timed(spark, d), RACE, "driver_id", STEP, ["stint", "compound", "tyre_life", "track_status"])


@query(
    "WITH s AS (SELECT user_id, day, t_s, avg(value) AS value FROM b_ticks GROUP BY 1, 2, 3), n AS (SELECT *, lead(t_s) OVER (PARTITION BY user_id, day ORDER BY t_s) AS t1 FROM s), "
    "g AS (SELECT *, unnest(range(CAST(ceil(t_s / 600) AS BIGINT), CAST(CASE WHEN t1 IS NULL THEN floor(t_s / 600) ELSE ceil(t1 / 600) - 1 END AS BIGINT) + 1)) * 600 AS g FROM n) SELECT user_id, day, g AS t_s, t1 IS NULL OR g = t_s OR t1 - t_s <= 3600 AS supported FROM g"
)
def ca30_support(spark: S, d: str) -> DataFrame:
    samples = view(spark, d, "b_ticks").groupBy("user_id", "day", "t_s").agg(F.avg("value").alias("value"))
    return RS.grid(samples, ["user_id", "day"], "t_s", ["value"], 600, max_gap=3600).select("user_id", "day", "t_s", F.col("value").isNotNull().alias("supported"))


@query(
    f"WITH {_GRID}, e AS (SELECT season, round, driver_id, max(lap_number) AS p, max(end_ms) AS e FROM b_timed GROUP BY 1, 2, 3), z AS (SELECT season, round, max(end_ms) AS z FROM b_timed GROUP BY 1, 2) "
    f"SELECT season, round, driver_id, t, round(progress, 6) AS progress FROM g UNION ALL SELECT season, round, driver_id, unnest(range(CAST(ceil(e / {STEP}) AS BIGINT), CAST(floor(z / {STEP}) AS BIGINT) + 1)) * {STEP}, CAST(p AS DOUBLE) FROM e JOIN z USING (season, round)"
)
def ca31_progress(spark: S, d: str) -> DataFrame:
    return R.frozen(timed(spark, d), grid(spark, d), RACE, "driver_id", STEP).withColumn("progress", r6("progress"))


@query(f"WITH {_GRID} SELECT season, round, driver_id, t, lap, stint, compound, tyre_life, round(progress - floor(progress), 6) AS inside FROM g")
def ca32_step_state(spark: S, d: str) -> DataFrame:
    p = F.col("progress")
    return grid(spark, d).select(*RACE, "driver_id", "t", "lap", "stint", "compound", "tyre_life", r6(p - F.floor(p)).alias("inside"))


@query(
    "WITH e AS (SELECT season, round, driver_id, max(end_ms) AS e, max(lap_number) AS l FROM b_timed GROUP BY 1, 2, 3), w AS (SELECT season, round, max(l) AS wl, arg_max(e, (l, -e)) AS f FROM e GROUP BY 1, 2) "
    "SELECT season, round, driver_id, least(e + 30000, f + 60000) AS until, l < wl AND e < f AS retired FROM e JOIN w USING (season, round)"
)
def ca33_activity(spark: S, d: str) -> DataFrame:
    return R.activity(timed(spark, d), RACE, "driver_id", 30_000, 60_000)


_GAPS = (
    f"{_GRID}, m AS (SELECT season, round, t, max(p) OVER (PARTITION BY season, round ORDER BY t) AS p FROM (SELECT season, round, t, max(progress) AS p FROM g GROUP BY 1, 2, 3)), v AS (SELECT season, round, p, min(t) AS f FROM m GROUP BY 1, 2, 3), "
    "x AS (SELECT g.*, g.t - CASE WHEN a.p = g.progress THEN a.f ELSE a.f + (g.progress - a.p) / (b.p - a.p) * (b.f - a.f) END AS gap FROM g ASOF LEFT JOIN v a ON g.season = a.season AND g.round = a.round AND g.progress >= a.p ASOF LEFT JOIN v b ON g.season = b.season AND g.round = b.round AND g.progress <= b.p)"
)


@query(f"WITH {_GAPS} SELECT season, round, driver_id, t, round(gap, 3) AS gap FROM x")
def ca34_leader_gap(spark: S, d: str) -> DataFrame:
    return R.leader_gap(grid(spark, d), RACE).select(*RACE, "driver_id", "t", F.round("gap", 3).alias("gap"))


_ORDER = "o AS (SELECT *, CAST(row_number() OVER (PARTITION BY season, round, t ORDER BY round(progress, 9) DESC, driver_id) AS BIGINT) AS place FROM g)"


def ordered(spark: S, d: str) -> DataFrame:
    """The grid with places; a tick's field is dealt as laps are, to tasks that do not grow with the table."""
    return E.dense_order(dealt(spark, d, grid(spark, d), *RACE, "t").withColumn("_p", F.round("progress", 9)), [*RACE, "t"], "_p", ["driver_id"]).drop("_p")


@query(
    f"WITH {_GRID}, {_ORDER}, {_PLACED}, h AS (SELECT o.*, CASE WHEN o.t - p.end_ms <= 100000 THEN p.position END AS r FROM o ASOF LEFT JOIN placed p ON o.season = p.season AND o.round = p.round AND o.driver_id = p.driver_id AND o.t >= p.end_ms), "
    "c AS (SELECT season, round, t, count(r) = count(*) AND count(DISTINCT r) = count(*) AND max(r) = count(*) AS whole FROM h GROUP BY 1, 2, 3) SELECT season, round, driver_id, t, CASE WHEN whole THEN r ELSE place END AS place, CASE WHEN whole THEN 'recorded' ELSE 'estimate' END AS source FROM h JOIN c USING (season, round, t)"
)
def ca36_overlay(spark: S, d: str) -> DataFrame:
    recorded = placed(spark, d).select(*RACE, "driver_id", F.col("end_ms").alias("t"), "position")
    out = R.overlaid(ordered(spark, d).withColumnRenamed("place", "estimate"), recorded, RACE, "driver_id", "t", "estimate", "position", 100_000)
    return out.select(*RACE, "driver_id", "t", "place", "source")


@query(
    f"WITH {_GAPS}, {_ORDER}, e AS (SELECT season, round, driver_id, max(end_ms) AS e, max(lap_number) AS l FROM b_timed GROUP BY 1, 2, 3), w AS (SELECT season, round, arg_max(e, (l, -e)) AS f FROM e GROUP BY 1, 2) "
    "SELECT x.season, x.round, x.driver_id, x.t, x.lap, x.stint, x.compound, round(x.progress, 6) AS progress, round(x.gap, 3) AS gap, o.place FROM x JOIN o ON o.season = x.season AND o.round = x.round AND o.t = x.t AND o.driver_id = x.driver_id "
    "JOIN e ON e.season = x.season AND e.round = x.round AND e.driver_id = x.driver_id JOIN w ON w.season = x.season AND w.round = x.round WHERE x.t <= least(e + 30000, f + 60000)"
)
def ca37_replay(spark: S, d: str) -> DataFrame:
    t = timed(spark, d)
    ticks = R.leader_gap(ordered(spark, d), RACE)
    active = ticks.join(R.activity(t, RACE, "driver_id", 30_000, 60_000), [*RACE, "driver_id"]).where("t <= until")
    return active.select(*RACE, "driver_id", "t", "lap", "stint", "compound", r6("progress").alias("progress"), F.round("gap", 3).alias("gap"), "place")


_PASSES = (
    f"{_GRID}, {_ORDER}, b AS (SELECT *, lag(driver_id) OVER (PARTITION BY season, round, t ORDER BY place) AS d, lag(progress) OVER (PARTITION BY season, round, t ORDER BY place) - progress AS near FROM o), "
    f"p AS (SELECT b.season, b.round, b.t, b.driver_id AS attacker, b.d AS defender FROM b JOIN o a1 ON a1.season = b.season AND a1.round = b.round AND a1.t = b.t + {STEP} AND a1.driver_id = b.driver_id JOIN o d0 ON d0.season = b.season AND d0.round = b.round AND d0.t = b.t AND d0.driver_id = b.d "
    f"JOIN o d1 ON d1.season = b.season AND d1.round = b.round AND d1.t = b.t + {STEP} AND d1.driver_id = b.d JOIN o a2 ON a2.season = b.season AND a2.round = b.round AND a2.t = b.t + {2 * STEP} AND a2.driver_id = b.driver_id JOIN o d2 ON d2.season = b.season AND d2.round = b.round AND d2.t = b.t + {2 * STEP} AND d2.driver_id = b.d "
    "WHERE near < 0.05 AND a1.place < d1.place AND a2.place < d2.place AND b.stint = a1.stint AND a1.stint = a2.stint AND d0.stint = d1.stint AND d1.stint = d2.stint)"
)


def passes(spark: S, d: str) -> DataFrame:
    return R.passes(ordered(spark, d), RACE, "driver_id", "place", STEP, 0.05, "stint", partial(dealt, spark, d))


@query(f"WITH {_PASSES} SELECT * FROM p")
def ca38_passes(spark: S, d: str) -> DataFrame:
    return passes(spark, d)


_BATTLE_ROWS = "r AS (SELECT season, round, driver_id, d AS rival, t, near AS gap FROM b WHERE d IS NOT NULL AND track_status = '1')"
_BY = "PARTITION BY season, round, driver_id"
_BATTLES = (
    f"{_PASSES}, {_BATTLE_ROWS}, i1 AS (SELECT *, sum(f) OVER ({_BY} ORDER BY t) AS isl FROM (SELECT *, CASE WHEN lag(t) OVER ({_BY} ORDER BY t) IS NULL OR t - lag(t) OVER ({_BY} ORDER BY t) > {STEP} OR rival <> lag(rival) OVER ({_BY} ORDER BY t) THEN 1 ELSE 0 END AS f FROM r)), "
    f"i2 AS (SELECT *, sum(f2) OVER ({_BY}, isl ORDER BY t) AS run FROM (SELECT *, gap > 0.06 AS far, CASE WHEN lag(gap > 0.06) OVER ({_BY}, isl ORDER BY t) IS NULL OR (gap > 0.06) <> lag(gap > 0.06) OVER ({_BY}, isl ORDER BY t) THEN 1 ELSE 0 END AS f2 FROM i1)), "
    f"i3 AS (SELECT *, t - min(t) OVER ({_BY}, isl, run) AS since FROM i2), i4 AS (SELECT *, CASE WHEN far AND since >= {STEP} AND coalesce(lag(since) OVER ({_BY}, isl, run ORDER BY t), -1) < {STEP} THEN 1 ELSE 0 END AS closes FROM i3), "
    f"i5 AS (SELECT *, coalesce(sum(closes) OVER ({_BY}, isl ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sub FROM i4), i6 AS (SELECT *, sum(CASE WHEN gap <= 0.03 THEN 1 ELSE 0 END) OVER ({_BY}, isl, sub ORDER BY t) AS opened FROM i5), "
    f"i7 AS (SELECT *, sum(f7) OVER ({_BY}, isl, sub ORDER BY t) AS press FROM (SELECT *, CASE WHEN lag(gap <= 0.03) OVER ({_BY}, isl, sub ORDER BY t) IS DISTINCT FROM (gap <= 0.03) THEN 1 ELSE 0 END AS f7 FROM i6 WHERE opened > 0)), "
    "h AS (SELECT season, round, driver_id, isl, sub, press, any_value(rival) AS rival, min(t) AS a, max(t) AS z, count(*) AS n, count(*) FILTER (gap <= 0.03) AS c, min(gap) FILTER (gap <= 0.03) AS g, bool_or(closes = 1) AS cl FROM i7 GROUP BY ALL), "
    'e AS (SELECT season, round, driver_id, any_value(rival) AS rival, min(a) AS start, max(z) AS "end", CAST(sum(n) AS BIGINT) AS samples, CAST(sum(c) AS BIGINT) AS contacts, round(min(g), 6) AS closest, max(z - a) FILTER (c > 0) AS pressure, bool_or(cl) AS closed FROM h GROUP BY season, round, driver_id, isl, sub)'
)


def battles(spark: S, d: str) -> DataFrame:
    w = Window.partitionBy(*RACE, "t").orderBy("place")
    rows = ordered(spark, d).withColumns({"rival": F.lag("driver_id").over(w), "near": F.lag("progress").over(w) - F.col("progress")}).where("rival is not null and track_status = '1'")
    return R.battles(dealt(spark, d, rows.select(*RACE, "driver_id", "rival", "t", "near"), *RACE, "driver_id"), RACE, "driver_id", "rival", "t", "near", STEP, 0.03, 0.06, STEP)


@query(f"WITH {_BATTLES} SELECT * FROM e")
def ca39_battles(spark: S, d: str) -> DataFrame:
    return battles(spark, d).withColumn("closest", r6("closest"))


@query(None)
def jn27_one_to_one(spark: S, d: str) -> DataFrame:
    number = lambda who, at: F.col("season") * 100000000000000 + F.col("round") * 10000000000000 + F.col(who) * 100000000 + F.floor(F.col(at) / 1000)
    k = battles(spark, d).select(*RACE, "driver_id", "rival", F.col("start").alias("a"), (F.col("end") + STEP).alias("z"), number("driver_id", "start").alias("battle"))
    p = passes(spark, d).select(*RACE, F.col("attacker").alias("driver_id"), F.col("defender").alias("rival"), "t", number("attacker", "t").alias("pass"))
    return J.one_to_one(k, p, [*RACE, "driver_id", "rival"], "battle", "pass", "a", "z", "t")
