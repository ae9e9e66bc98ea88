"""Technique and circuit queries: metrics of lap pairs, profile stability, negative controls, archetypes and paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from chronolith.operators import evidence as E, joins as J, technique as T
from chronolith.plans.basics import laps
from chronolith.plans.registry import query

S = SparkSession
RACE, DRIVER, STINT = ["season", "round"], ["season", "round", "driver_id"], ["season", "round", "driver_id", "stint"]
r6 = lambda c: F.round(c, 6)

_METRICS = (
    "x AS (SELECT season, round, team, driver_id, stint, speed, lap_time_sec, tyre_life, tyre_life - lag(tyre_life) OVER w AS dx, lag(speed) OVER w AS s0 FROM b_laps WINDOW w AS (PARTITION BY season, round, driver_id, stint ORDER BY lap_number)), "
    "m AS (SELECT season, round, team, driver_id, stint, sum(dx * (CASE WHEN speed >= 40 THEN 1 ELSE 0 END)) / sum(dx) AS full_share, sum(dx * (CASE WHEN speed < 10 THEN 1 ELSE 0 END)) / sum(dx) AS slow_share, sum(dx * speed) / sum(dx) AS mean_speed, sum(dx * lap_time_sec) / sum(dx) AS mean_time, count(*) FILTER (speed < 10 AND s0 >= 10) AS onsets FROM x WHERE dx IS NOT NULL GROUP BY 1, 2, 3, 4, 5 HAVING sum(dx) >= 5)"
)


def metrics(spark: S, d: str) -> DataFrame:
    """A stint stands for a lap, its laps for the samples along it."""
    shares = {"full_share": F.when(F.col("speed") >= 40, 1).otherwise(0), "slow_share": F.when(F.col("speed") < 10, 1).otherwise(0), "mean_speed": F.col("speed"), "mean_time": F.col("lap_time_sec")}
    return T.metrics(laps(spark, d), [*RACE, "team", "driver_id", "stint"], "lap_number", "tyre_life", shares, F.col("speed") < 10, least=5)


@query(
    f"WITH {_METRICS} SELECT a.season, a.round, a.driver_id, b.driver_id AS other_driver_id, a.stint, round(a.full_share - b.full_share, 6) AS full_share, round(a.slow_share - b.slow_share, 6) AS slow_share, round(a.mean_speed - b.mean_speed, 6) AS mean_speed, round(a.mean_time - b.mean_time, 6) AS mean_time, a.onsets - b.onsets AS onsets "
    "FROM m a JOIN m b ON a.season = b.season AND a.round = b.round AND a.team = b.team AND a.stint = b.stint AND a.driver_id <> b.driver_id"
)
def ca64_technique(spark: S, d: str) -> DataFrame:
    names = ["full_share", "slow_share", "mean_speed", "mean_time"]
    p = J.pairs(metrics(spark, d), [*RACE, "team", "stint"], "driver_id", [*names, "onsets"])
    return p.select(*RACE, "driver_id", "other_driver_id", "stint", *[r6(F.col(c) - F.col(f"other_{c}")).alias(c) for c in names], (F.col("onsets") - F.col("other_onsets")).alias("onsets"))


@query(
    "WITH r AS (SELECT season, round, driver_id, round(avg(speed) - 25, 9) AS v FROM b_laps GROUP BY 1, 2, 3 HAVING count(*) >= 5), w AS (SELECT season, driver_id, count(*) AS races, median(v) AS m, median(v) FILTER (round % 2 = 1) AS odd, median(v) FILTER (round % 2 = 0) AS even FROM r GROUP BY 1, 2 HAVING count(*) >= 3), "
    "l AS (SELECT a.season, a.driver_id, a.round, median(b.v) AS m FROM r a JOIN r b ON a.season = b.season AND a.driver_id = b.driver_id AND a.round <> b.round GROUP BY 1, 2, 3), o AS (SELECT w.season, w.driver_id, max(abs(l.m - w.m)) AS moved FROM w JOIN l USING (season, driver_id) GROUP BY 1, 2), "
    "g AS (SELECT w.season, w.driver_id, 100.0 * count(*) FILTER (sign(v) = sign(w.m)) / count(*) AS agreement FROM w JOIN r USING (season, driver_id) GROUP BY 1, 2) "
    "SELECT season, driver_id, races, round(m, 6) AS median, round(abs(odd - even), 6) AS halves, round(moved, 6) AS moved, round(agreement, 6) AS agreement, coalesce(abs(odd - even) <= 6 AND moved <= 4 AND agreement >= 60, false) AS stable FROM w JOIN o USING (season, driver_id) JOIN g USING (season, driver_id)"
)
def ca67_stability(spark: S, d: str) -> DataFrame:
    races = laps(spark, d).groupBy(*RACE, "driver_id").agg(F.round(F.avg("speed") - 25, 9).alias("v"), F.count("*").alias("n")).where("n >= 5")
    out = T.stability(races, ["season", "driver_id"], "round", "v", least=3, halves=6.0, moved=4.0, agreement=60.0)
    return out.select("season", "driver_id", "races", *[r6(c).alias(c) for c in ("median", "halves", "moved", "agreement")], "stable")


@query(
    "WITH v AS (SELECT season, round, driver_id, avg(speed) AS v FROM b_laps GROUP BY 1, 2, 3), n AS (SELECT *, row_number() OVER (PARTITION BY season, round ORDER BY driver_id) AS k FROM v), t AS (SELECT season, stddev_pop(m) AS real FROM (SELECT season, driver_id, median(v) AS m FROM v GROUP BY 1, 2) GROUP BY 1), "
    "s AS (SELECT season, round, v, r, row_number() OVER (PARTITION BY season, round, r ORDER BY md5(concat_ws('|', '7', r, season, round, driver_id)), driver_id) AS k FROM (SELECT *, unnest(range(10)) AS r FROM v)), "
    "x AS (SELECT s.season, r, stddev_pop(m) AS spread FROM (SELECT s.season, s.r, n.driver_id, median(s.v) AS m FROM s JOIN n ON n.season = s.season AND n.round = s.round AND n.k = s.k GROUP BY 1, 2, 3) s GROUP BY 1, 2) "
    "SELECT season, round(any_value(real), 6) AS real, round(avg(spread), 6) AS shuffled, round(any_value(real) / avg(spread), 6) AS ratio FROM x JOIN t USING (season) GROUP BY season"
)
def ca68_negative_control(spark: S, d: str) -> DataFrame:
    v = laps(spark, d).groupBy(*DRIVER).agg(F.avg("speed").alias("v"))
    out = T.negative_control(v, ["season"], "round", "driver_id", "v", 10)
    return out.select("season", *[r6(c).alias(c) for c in ("real", "shuffled", "ratio")])


@query(
    "WITH f AS (SELECT season, round, avg(speed) AS v, avg(lap_time_sec) AS t FROM b_laps GROUP BY 1, 2), q AS (SELECT quantile_cont(v, 0.67) AS qv, quantile_cont(t, 0.67) AS qt FROM f), k AS (SELECT season, round, CASE WHEN v >= qv THEN 'fast' WHEN t >= qt THEN 'long' ELSE 'plain' END AS kind FROM f, q), "
    "g AS (SELECT l.driver_id, kind, season, round, round(avg(l.speed) - 25, 9) AS gain FROM b_laps l JOIN k USING (season, round) GROUP BY ALL), m AS (SELECT driver_id, kind, count(*) AS n, median(gain) AS m, quantile_cont(gain, 0.05) AS lo, quantile_cont(gain, 0.95) AS hi FROM g GROUP BY 1, 2) "
    "SELECT m.driver_id, m.kind, any_value(n) AS n, round(any_value(m), 6) AS gain, round(100.0 * count(*) FILTER (sign(gain) = sign(m)) / count(*), 6) AS agreement, CASE WHEN any_value(n) >= 5 THEN round(any_value(lo), 6) END AS low, CASE WHEN any_value(n) >= 5 THEN round(any_value(hi), 6) END AS high FROM m JOIN g ON g.driver_id = m.driver_id AND g.kind = m.kind GROUP BY 1, 2"
)
def ca70_archetypes(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d)
    kinds = E.classified(rows.groupBy(*RACE).agg(F.avg("speed").alias("v"), F.avg("lap_time_sec").alias("t")), {"v": (0.67, "fast"), "t": (0.67, "long")}, "plain", "kind").select(*RACE, "kind")
    gains = rows.groupBy("driver_id", *RACE).agg(F.round(F.avg("speed") - 25, 9).alias("gain")).join(F.broadcast(kinds), RACE)  # a row for each race
    enough = F.count("*") >= 5
    fit = gains.groupBy("driver_id", "kind").agg(F.count("*").alias("n"), r6(F.percentile("gain", 0.5)).alias("m"), F.when(enough, r6(F.percentile("gain", 0.05))).alias("low"), F.when(enough, r6(F.percentile("gain", 0.95))).alias("high"))
    return fit.withColumnRenamed("m", "gain").join(E.sign_agreement(gains, ["driver_id", "kind"], "gain"), ["driver_id", "kind"]).withColumn("agreement", r6("agreement"))


@query(
    "WITH s AS (SELECT *, abs(speed - lag(speed) OVER w) AS step FROM b_laps WINDOW w AS (PARTITION BY season, round, driver_id, stint ORDER BY lap_number)), q AS (SELECT season, round, driver_id, stint, max(step) AS widest, abs(arg_max(speed, lap_number) - arg_min(speed, lap_number)) AS closure, count(*) / 8.0 AS covered, sum(step) AS length FROM s GROUP BY 1, 2, 3, 4 HAVING count(step) > 0), "
    "b AS (SELECT season, round, arg_min((driver_id, stint), (round(widest + closure + 50 * (1 - covered), 9), driver_id, stint)) AS best FROM q GROUP BY 1, 2) "
    "SELECT s.season, s.round, s.driver_id, s.stint, s.lap_number, round(sum(coalesce(step, 0)) OVER (PARTITION BY s.season, s.round ORDER BY s.lap_number ROWS UNBOUNDED PRECEDING), 6) AS length FROM s JOIN b ON b.season = s.season AND b.round = s.round AND s.driver_id = best[1] AND s.stint = best[2]"
)
def ca71_path(spark: S, d: str) -> DataFrame:
    best = T.best_path(laps(spark, d), RACE, ["driver_id", "stint"], "lap_number", "speed", 8)
    w = Window.partitionBy(*RACE).orderBy("lap_number").rowsBetween(Window.unboundedPreceding, 0)
    return best.select(*RACE, "driver_id", "stint", "lap_number", r6(F.sum(F.coalesce("step", F.lit(0.0))).over(w)).alias("length"))
