"""Pit and tyre queries: contexts, boundaries, visits, warm-up, undercuts and stop-timing scenarios."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronolith.operators import bootstrap as B, evidence as E, pits as P, robust as R, windows as W
from chronolith.plans.basics import laps
from chronolith.plans.bindings import table
from chronolith.plans.registry import query
from chronolith.plans.serving import _PLACED, placed, timed

S = SparkSession
RACE, DRIVER, LAP = ["season", "round"], ["season", "round", "driver_id"], ["season", "round", "driver_id", "lap_number"]
STINT = ["season", "round", "driver_id", "stint"]
r6 = lambda c: F.round(c, 6)


@query(
    "WITH u AS (SELECT season, round, driver_id, lap_number, 'stint' AS s FROM b_laps WHERE tyre_life = 8 UNION ALL SELECT season, round, driver_id, lap_number, 'slow' FROM b_laps WHERE lap_time_sec >= 87 UNION ALL SELECT season, round, driver_id, lap_number - 1, 'out' FROM b_laps WHERE tyre_life = 1 AND stint > 1), "
    "c AS (SELECT season, round, driver_id, lap_number, string_agg(DISTINCT s, '+' ORDER BY s) AS sources, count(DISTINCT s) AS n FROM u GROUP BY 1, 2, 3, 4) SELECT *, CASE WHEN n >= 2 THEN 'confirmed' WHEN sources = 'slow' THEN 'rejected' ELSE 'candidate' END AS status, CASE WHEN n < 2 THEN 'only ' || sources END AS reason FROM c"
)
def ca41_pit_context(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d)
    out_laps = rows.where("tyre_life = 1 and stint > 1").withColumn("lap_number", F.col("lap_number") - 1)
    c = E.contexts(LAP, stint=rows.where("tyre_life = 8"), slow=rows.where("lap_time_sec >= 87"), out=out_laps).withColumnRenamed("n_sources", "n")
    status = F.when(F.col("n") >= 2, "confirmed").when(F.col("sources") == "slow", "rejected").otherwise("candidate")
    return c.withColumns({"status": status, "reason": F.when(F.col("n") < 2, F.concat(F.lit("only "), "sources"))})


_BOUNDS = "b AS (SELECT user_id, epoch_us(ts) // 1000000 AS t, event_id, CASE event_type WHEN 'purchase' THEN 'in' ELSE 'out' END AS edge FROM events WHERE event_type IN ('purchase', 'signup'))"
_BW = "(PARTITION BY user_id ORDER BY t, event_id)"


def bounds(spark: S, d: str) -> DataFrame:
    edge = F.when(F.col("event_type") == "purchase", "in").when(F.col("event_type") == "signup", "out")
    return table(spark, d, "events").select("user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"), "event_id", edge.alias("edge")).where("edge is not null")


@query(
    f"WITH {_BOUNDS}, x AS (SELECT *, lead(edge) OVER {_BW} AS e1, lead(t) OVER {_BW} AS t1, lag(edge) OVER {_BW} AS e0, lag(t) OVER {_BW} AS t0 FROM b), "
    "s AS (SELECT user_id, bool_or(edge IS NOT DISTINCT FROM e0 OR (e0 IS NULL AND edge = 'out') OR t IS NOT DISTINCT FROM t0) AS bad FROM x GROUP BY 1) SELECT user_id, t AS entered, t1 AS \"left\", bad FROM x JOIN s USING (user_id) WHERE edge = 'in' AND e1 = 'out'"
)
def ca43_boundaries(spark: S, d: str) -> DataFrame:
    return P.boundaries(bounds(spark, d), ["user_id"], ["t", "event_id"], "t", "edge")


@query(
    f"WITH {_BOUNDS}, x AS (SELECT *, lead(edge) OVER {_BW} AS e1, lead(t) OVER {_BW} AS t1, lag(edge) OVER {_BW} AS e0 FROM b), v AS (SELECT user_id, t AS entered, CASE WHEN e1 = 'out' THEN t1 END AS \"left\" FROM x WHERE edge = 'in' UNION ALL SELECT user_id, NULL, t FROM x WHERE edge = 'out' AND e0 IS DISTINCT FROM 'in'), "
    "n AS (SELECT user_id, epoch_us(ts) // 1000000 AS turn FROM events WHERE event_type = 'error'), "
    "q AS (SELECT n.user_id, n.turn FROM n WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.user_id = n.user_id AND n.turn BETWEEN coalesce(entered, \"left\") - 3600 AND coalesce(\"left\", entered) + 3600)) "
    "SELECT user_id, entered, \"left\", CASE WHEN entered IS NOT NULL AND \"left\" IS NOT NULL THEN 'recorded' ELSE 'partial' END AS kind FROM v UNION ALL SELECT user_id, turn, turn, 'inferred' FROM q"
)
def ca44_visits(spark: S, d: str) -> DataFrame:
    turns = table(spark, d, "events").where("event_type = 'error'").select("user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("at"))
    return P.visits(bounds(spark, d), turns, ["user_id"], ["t", "event_id"], "t", "edge", "at", 3600)


_TS = "(SELECT x.season, x.round, x.driver_id, x.stint, median((y.lap_time_sec - x.lap_time_sec) / (y.tyre_life - x.tyre_life)) AS slope FROM m x JOIN m y ON x.season = y.season AND x.round = y.round AND x.driver_id = y.driver_id AND x.stint = y.stint AND x.tyre_life < y.tyre_life GROUP BY 1, 2, 3, 4)"
_ON = "USING (season, round, driver_id, stint)"


@query(
    f"WITH m AS (SELECT * FROM b_laps WHERE tyre_life >= 5), l AS (SELECT season, round, driver_id, stint, any_value(slope) AS slope, median(lap_time_sec - slope * tyre_life) AS a FROM m JOIN {_TS} s {_ON} GROUP BY 1, 2, 3, 4 HAVING count(*) >= 3), "
    f"r AS (SELECT b.*, round(b.lap_time_sec - a - slope * tyre_life, 9) AS r FROM b_laps b JOIN l {_ON}), p AS (SELECT *, abs(r) <= 1.5 AS h, lead(abs(r) <= 1.5) OVER w AS h1, lead(lap_number) OVER w AS l1 FROM r WINDOW w AS (PARTITION BY season, round, driver_id, stint ORDER BY lap_number)) "
    "SELECT season, round, driver_id, stint, round(sum(r) FILTER (tyre_life <= 4), 6) AS loss, min(tyre_life) FILTER (h AND h1 AND l1 = lap_number + 1) AS settled, CASE WHEN min(tyre_life) FILTER (h AND h1 AND l1 = lap_number + 1) IS NULL THEN 'censored' WHEN min(tyre_life) FILTER (h AND h1 AND l1 = lap_number + 1) <= 4 THEN 'settled' ELSE 'late' END AS status FROM p GROUP BY 1, 2, 3, 4"
)
def ca50_warm_up(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d)
    lines = R.theil_sen(rows.where("tyre_life >= 5"), STINT, "tyre_life", "lap_time_sec", least=3).select(*STINT, "slope", "intercept")
    return P.warm_up(rows, lines, STINT, "lap_number", "tyre_life", "lap_time_sec", early=4, band=1.5).withColumn("loss", r6("loss"))


_STOPS = f"{_PLACED}, s AS (SELECT p.season, p.round, p.driver_id, p.stint, p.lap_number, b.position AS before, a.position AS after, p.end_ms FROM placed p JOIN placed b ON b.season = p.season AND b.round = p.round AND b.driver_id = p.driver_id AND b.lap_number = p.lap_number - 1 JOIN placed a ON a.season = p.season AND a.round = p.round AND a.driver_id = p.driver_id AND a.lap_number = p.lap_number + 2 WHERE p.tyre_life = 8)"


def stops(spark: S, d: str) -> DataFrame:
    rows = placed(spark, d)
    at = lambda shift, name: rows.select(*DRIVER, (F.col("lap_number") - shift).alias("lap_number"), F.col("position").alias(name))
    return rows.where("tyre_life = 8").select(*STINT, "lap_number", "end_ms").join(at(-1, "before"), LAP).join(at(2, "after"), LAP)


@query(
    f"WITH {_STOPS} SELECT a.season, a.round, a.stint, a.driver_id AS first, b.driver_id AS second, b.before - a.before AS lead, b.after - a.after AS lead_after, CASE WHEN a.before > b.before AND a.after < b.after THEN 'undercut' WHEN a.before < b.before AND a.after > b.after THEN 'overcut' ELSE 'unchanged' END AS outcome "
    "FROM s a JOIN s b ON a.season = b.season AND a.round = b.round AND a.stint = b.stint AND a.driver_id <> b.driver_id AND b.end_ms - a.end_ms > 0 AND b.end_ms - a.end_ms <= 5000 AND abs(a.before - b.before) <= 3"
)
def ca51_undercuts(spark: S, d: str) -> DataFrame:
    return P.undercuts(stops(spark, d), RACE, "driver_id", "stint", "end_ms", 5000, 3)


_LINES = "f AS (SELECT season, round, driver_id, stint, regr_slope(lap_time_sec, tyre_life) AS b, regr_intercept(lap_time_sec, tyre_life) AS a, count(*) AS n FROM b_laps WHERE track_status = '1' GROUP BY 1, 2, 3, 4 HAVING count(*) >= 5 AND regr_slope(lap_time_sec, tyre_life) IS NOT NULL)"


@query(
    f"WITH {_LINES}, p AS (SELECT o.season, o.round, o.driver_id, o.stint, o.a AS a0, o.b AS b0, n.a AS a1, n.b AS b1, unnest(range(-3, 4)) AS shift FROM f o JOIN f n ON o.season = n.season AND o.round = n.round AND o.driver_id = n.driver_id AND n.stint = o.stint + 1), "
    "c AS (SELECT season, round, driver_id, stint, shift, CASE WHEN shift > 0 THEN shift * (a0 + b0 * (8 + (shift + 1) / 2.0)) - shift * (a1 + b1 * (8 - (shift - 1) / 2.0)) WHEN shift < 0 THEN -shift * (a1 + b1 * (8 + (1 - shift) / 2.0)) + shift * (a0 + b0 * (8 + (shift + 1) / 2.0)) ELSE 0.0 END AS cost FROM p) "
    "SELECT season, round, driver_id, stint, round(max(cost) FILTER (shift = -3), 6) AS early, round(max(cost) FILTER (shift = 3), 6) AS late, CAST(arg_min(shift, (round(cost, 9), abs(shift), shift)) AS BIGINT) AS best FROM c GROUP BY 1, 2, 3, 4"
)
def ca52_stop_timing(spark: S, d: str) -> DataFrame:
    fits = laps(spark, d).where("track_status = '1'").groupBy(*STINT).agg(F.regr_slope("lap_time_sec", "tyre_life").alias("b"), F.regr_intercept("lap_time_sec", "tyre_life").alias("a"), F.count("*").alias("n")).where("n >= 5 and b is not null")
    c = P.timing_scenarios(fits, DRIVER, "stint", 8, 3)
    shift = F.col("shift")
    return c.groupBy(*STINT).agg(r6(F.max(F.when(shift == -3, F.col("cost")))).alias("early"), r6(F.max(F.when(shift == 3, F.col("cost")))).alias("late"), F.min_by(shift, F.struct(F.round("cost", 9), F.abs(shift), shift)).cast("long").alias("best"))


@query(
    "WITH g AS (SELECT season, driver_id, round, stint, lap_number, lap_time_sec, tyre_life, row_number() OVER (PARTITION BY season, round, driver_id, stint ORDER BY lap_number) - 1 AS k, count(*) OVER (PARTITION BY season, round, driver_id, stint) AS n FROM b_laps WHERE track_status = '1'), "
    "z AS (SELECT season, round, driver_id, stint, r, CAST('0x' || substr(md5(concat_ws('|', '7', r, season || '-' || round || '-' || driver_id || '-' || stint, slot)), 1, 8) AS BIGINT) % n AS k FROM (SELECT *, k AS slot, unnest(range(20)) AS r FROM g WHERE n >= 6)), "
    "f AS (SELECT season, round, driver_id, stint, r, CASE WHEN max(tyre_life) > min(tyre_life) THEN regr_slope(lap_time_sec, tyre_life) END AS b FROM z JOIN g USING (season, round, driver_id, stint, k) GROUP BY 1, 2, 3, 4, 5), v AS (SELECT *, row_number() OVER (PARTITION BY season, round, driver_id, stint ORDER BY r) AS i FROM f WHERE b IS NOT NULL) "
    "SELECT season, round, driver_id, stint, count(*) AS valid, round(quantile_cont(b, 0.25), 9) AS p25, round(quantile_cont(b, 0.75), 9) AS p75, round(avg(CASE WHEN abs(b) <= 1e-9 THEN 0.5 WHEN b > 0 THEN 1.0 ELSE 0.0 END), 6) AS wear_share FROM v WHERE i <= 10 GROUP BY 1, 2, 3, 4"
)
def ca53_scenario_bootstrap(spark: S, d: str) -> DataFrame:
    out = B.refitted(laps(spark, d).where("track_status = '1'"), STINT, "lap_number", "tyre_life", "lap_time_sec", draws=20, kept=10, least=6)
    b = F.col("slope")
    share = F.avg(F.when(F.abs(b) <= 1e-9, 0.5).when(b > 0, 1.0).otherwise(0.0))
    return out.groupBy(*STINT).agg(F.count("*").alias("valid"), F.round(F.percentile("slope", 0.25), 9).alias("p25"), F.round(F.percentile("slope", 0.75), 9).alias("p75"), r6(share).alias("wear_share"))


@query("SELECT season, round, driver_id, CAST(sum(CASE WHEN compound <> pc THEN 1 ELSE 0 END) AS BIGINT) AS changes, max(stint) AS stints FROM (SELECT *, lag(compound) OVER (PARTITION BY season, round, driver_id ORDER BY lap_number) AS pc FROM b_laps) GROUP BY 1, 2, 3")
def ca44_compound_changes(spark: S, d: str) -> DataFrame:
    runs = W.collapse_runs(laps(spark, d), DRIVER, "lap_number", "compound").groupBy(*DRIVER).agg((F.count("*") - 1).alias("changes"))
    return runs.join(timed(spark, d).groupBy(*DRIVER).agg(F.max("stint").alias("stints")), DRIVER).select(*DRIVER, "changes", "stints")
