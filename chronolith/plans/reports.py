"""Evidence operators, rating variants and reconciliation reports as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from chronolith.operators import evidence as E, joins as J, quality as Q, robust as R, windows as W
from chronolith.plans.basics import laps
from chronolith.plans.bindings import table, view
from chronolith.plans.registry import query

S = SparkSession
STINT = ["season", "round", "driver_id", "stint"]


@query(
    "SELECT a.season, a.round, a.driver_id, a.lap_number, count(*) AS matched, round(a.lap_time_sec - median(b.lap_time_sec), 6) AS delta FROM b_laps a JOIN b_laps b ON a.season = b.season AND a.round = b.round AND a.driver_id = b.driver_id AND a.compound = b.compound "
    "AND abs(a.tyre_life - b.tyre_life) <= 2 WHERE a.track_status = '4' AND b.track_status = '1' GROUP BY a.season, a.round, a.driver_id, a.lap_number, a.lap_time_sec"
)
def ca46_matched_comparison(spark: S, d: str) -> DataFrame:
    out = E.matched_baseline(laps(spark, d), ["season", "round", "driver_id", "compound"], F.col("track_status") == "4", "lap_time_sec", "tyre_life", 2, ["season", "round", "driver_id", "lap_number"])
    return out.select("season", "round", "driver_id", "lap_number", "matched", F.round(F.col("lap_time_sec") - F.col("baseline"), 6).alias("delta"))


@query(
    "WITH t AS (SELECT a.season, a.driver_id, a.round, a.lap_number, a.lap_time_sec - median(b.lap_time_sec) AS delta FROM b_laps a JOIN b_laps b ON a.season = b.season AND a.round = b.round AND a.driver_id = b.driver_id AND a.compound = b.compound "
    "AND abs(a.tyre_life - b.tyre_life) <= 2 WHERE a.track_status = '4' AND b.track_status = '1' GROUP BY a.season, a.round, a.driver_id, a.lap_number, a.lap_time_sec) "
    "SELECT season, driver_id, count(*) AS n, CASE WHEN count(*) >= 5 THEN round(median(delta), 6) END AS cost, CASE WHEN count(*) >= 5 THEN round(quantile_cont(delta, 0.25), 6) END AS p25, CASE WHEN count(*) >= 5 THEN round(quantile_cont(delta, 0.75), 6) END AS p75 FROM t GROUP BY season, driver_id"
)
def ca47_traffic_cost(spark: S, d: str) -> DataFrame:
    out = E.matched_baseline(laps(spark, d), ["season", "round", "driver_id", "compound"], F.col("track_status") == "4", "lap_time_sec", "tyre_life", 2, ["season", "round", "driver_id", "lap_number"])
    delta, enough = F.col("lap_time_sec") - F.col("baseline"), F.count("*") >= 5
    return out.groupBy("season", "driver_id").agg(F.count("*").alias("n"), *[F.when(enough, F.round(F.percentile(delta, q), 6)).alias(c) for c, q in (("cost", 0.5), ("p25", 0.25), ("p75", 0.75))])


@query(
    "WITH p AS (SELECT x.season, x.round, x.driver_id, x.stint, median((y.lap_time_sec - x.lap_time_sec) / (y.tyre_life - x.tyre_life)) AS slope FROM b_laps x JOIN b_laps y ON x.season = y.season AND x.round = y.round AND x.driver_id = y.driver_id AND x.stint = y.stint AND x.tyre_life < y.tyre_life GROUP BY 1, 2, 3, 4), "
    "i AS (SELECT season, round, driver_id, stint, any_value(slope) AS slope, median(lap_time_sec - slope * tyre_life) AS a, greatest(0.75, 0.01 * median(lap_time_sec)) AS lim FROM b_laps JOIN p USING (season, round, driver_id, stint) GROUP BY 1, 2, 3, 4 HAVING count(*) >= 5), "
    "r AS (SELECT season, round, driver_id, stint, slope, lim, lap_time_sec - a - slope * tyre_life AS r FROM b_laps JOIN i USING (season, round, driver_id, stint)) "
    "SELECT season, round, driver_id, stint, count(*) AS n, round(any_value(slope), 9) AS slope, round(1.4826 * median(abs(r)), 9) AS sigma, round(quantile_cont(abs(r), 0.9), 9) AS p90, count(*) FILTER (r > lim) AS slow FROM r GROUP BY 1, 2, 3, 4"
)
def ca49_pace_consistency(spark: S, d: str) -> DataFrame:
    out = E.consistency(laps(spark, d), STINT, "tyre_life", "lap_time_sec")
    # nine digits: the data's own ties lie at the seventh, where engines would round apart
    return out.select(*STINT, "n", *[F.round(c, 9).alias(c) for c in ("slope", "sigma", "p90")], "slow")


_Z = "1.6448536269514722"
_SIDE = "FROM b_laps a JOIN b_laps b ON a.season = b.season AND a.round = b.round AND a.team = b.team AND a.lap_number = b.lap_number AND a.driver_id < b.driver_id"


@query(
    f"WITH s AS (SELECT a.driver_id AS entity, b.driver_id AS o, 'attack' AS role, a.lap_time_sec < b.lap_time_sec AS w {_SIDE} UNION ALL SELECT b.driver_id, a.driver_id, 'defence', NOT (a.lap_time_sec < b.lap_time_sec) {_SIDE}), "
    "g AS (SELECT entity, role, count(*) AS n, count(*) FILTER (w) AS wins, count(DISTINCT o) AS opponents FROM s GROUP BY entity, role) SELECT *, "
    f"CASE WHEN n >= 5 THEN round(100 * (wins / n + {_Z} * {_Z} / (2 * n) - {_Z} * sqrt(wins / n * (1 - wins / n) / n + {_Z} * {_Z} / (4 * n * n))) / (1 + {_Z} * {_Z} / n), 6) END AS low, "
    f"CASE WHEN n >= 5 THEN round(100 * (wins / n + {_Z} * {_Z} / (2 * n) + {_Z} * sqrt(wins / n * (1 - wins / n) / n + {_Z} * {_Z} / (4 * n * n))) / (1 + {_Z} * {_Z} / n), 6) END AS high FROM g"
)
def ca40_role_summary(spark: S, d: str) -> DataFrame:
    pairs = J.pairs(laps(spark, d), ["season", "round", "team", "lap_number"], "driver_id", ["lap_time_sec"], F.col("a.driver_id") < F.col("b.driver_id"))
    out = E.roles(pairs, "driver_id", "other_driver_id", F.col("lap_time_sec") < F.col("other_lap_time_sec"))
    return out.select("entity", "role", "n", "wins", "opponents", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@query(
    "SELECT event_id, coalesce(sources, 'none') AS sources, coalesce(n_sources, 0) AS n_sources FROM b_ticks LEFT JOIN (SELECT user_id, day, string_agg(DISTINCT event_type, '+' ORDER BY event_type) AS sources, count(DISTINCT event_type) AS n_sources FROM b_ticks "
    "WHERE event_type IN ('error', 'signup', 'purchase') GROUP BY user_id, day) c USING (user_id, day)"
)
def ca42_context(spark: S, d: str) -> DataFrame:
    t = view(spark, d, "b_ticks")
    context = E.contexts(["user_id", "day"], **{kind: t.where(F.col("event_type") == kind) for kind in ("error", "signup", "purchase")})
    return E.with_context(t, context, ["user_id", "day"]).select("event_id", "sources", "n_sources")


@query(
    "WITH m AS (SELECT user_id, epoch(ts) AS t, event_id, CASE event_type WHEN 'error' THEN 'start' ELSE 'end' END AS e FROM events WHERE event_type IN ('error', 'signup')), k AS (SELECT * FROM m QUALIFY e IS DISTINCT FROM lag(e) OVER (PARTITION BY user_id ORDER BY t, event_id)), "
    "i AS (SELECT *, lead(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS z FROM k) SELECT user_id, CAST(floor(t) AS BIGINT) AS start, CAST(floor(z) AS BIGINT) AS \"end\" FROM i WHERE e = 'start' AND (z IS NULL OR z > t)"
)
def ca54_marker_intervals(spark: S, d: str) -> DataFrame:
    edge = F.when(F.col("event_type") == "error", "start").when(F.col("event_type") == "signup", "end")
    rows = table(spark, d, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"), edge.alias("edge"))
    second = lambda c: F.floor(F.col(c) / 1000000).alias(c)  # noqa: E731  after intervals of no length have left
    return E.marker_intervals(rows, ["user_id"], ["t", "event_id"], "t", "edge").select("user_id", second("start"), second("end"))


@query(
    "WITH s AS (SELECT user_id, day, count(*) AS n, count(*) FILTER (value < 30) / count(*) AS traffic, count(*) FILTER (value >= 30) / count(*) AS clean, (max(t_s) - min(t_s)) / 43200.0 AS coverage FROM b_ticks GROUP BY user_id, day) "
    "SELECT user_id, day, n, CASE WHEN coverage < 0.8 THEN 'unknown' WHEN traffic >= 0.5 THEN 'traffic' WHEN clean >= 0.8 AND traffic <= 0.1 THEN 'clean' ELSE 'mixed' END AS state FROM s"
)
def ca45_air_state(spark: S, d: str) -> DataFrame:
    n = F.count("*")
    state = E.air_state(F.count_if(F.col("value") < 30) / n, F.count_if(F.col("value") >= 30) / n, (F.max("t_s") - F.min("t_s")) / F.lit(43200.0))
    return view(spark, d, "b_ticks").groupBy("user_id", "day").agg(n.alias("n"), state.alias("state"))


@query("SELECT season, round, lap_number, driver_id, CASE WHEN count(p) OVER w = count(*) OVER w THEN row_number() OVER (PARTITION BY season, round, lap_number ORDER BY p DESC, driver_id) END AS place FROM (SELECT *, CASE WHEN speed < 50 THEN speed END AS p FROM b_laps) WINDOW w AS (PARTITION BY season, round, lap_number)")
def ca35_dense_order(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d).withColumn("p", F.when(F.col("speed") < 50, F.col("speed")))
    return E.dense_order(rows, ["season", "round", "lap_number"], "p", ["driver_id"]).select("season", "round", "lap_number", "driver_id", "place")


@query(
    "WITH m AS (SELECT event_type, median(value) AS m FROM events GROUP BY event_type), s AS (SELECT event_type, any_value(m) AS m, 1.4826 * median(abs(value - m)) AS s FROM events JOIN m USING (event_type) GROUP BY event_type) "
    "SELECT event_id, round(CASE WHEN s = 0 THEN 0.0 ELSE (value - m) / s END, 6) AS z FROM events JOIN s USING (event_type)"
)
def ca65_robust_z(spark: S, d: str) -> DataFrame:
    return R.robust_z(table(spark, d, "events"), ["event_type"], "value", "z").select("event_id", F.round("z", 6).alias("z"))


@query(
    "WITH y AS (SELECT DISTINCT season AS y FROM b_laps) SELECT a.y AS first, b.y AS last, driver_id, count(*) AS n, round(avg(speed), 6) AS mean FROM y a JOIN y b ON a.y <= b.y JOIN b_laps ON season BETWEEN a.y AND b.y GROUP BY 1, 2, 3 HAVING count(*) >= 5"
)
def ca66_season_windows(spark: S, d: str) -> DataFrame:
    return E.season_windows(laps(spark, d), "season", ["driver_id"], "speed").withColumn("mean", F.round("mean", 6))


_TOLERANCES = (0, 1, 2, 3)


@query(
    "SELECT CAST(tolerance AS INTEGER) AS tolerance, count(*) AS n, round(avg(a.speed - b.speed), 6) AS mean FROM b_laps a JOIN b_laps b ON a.season = b.season AND a.round = b.round AND a.team = b.team AND a.compound = b.compound AND a.driver_id < b.driver_id "
    "JOIN (SELECT unnest([0, 1, 2, 3]) AS tolerance) ON abs(a.tyre_life - b.tyre_life) <= tolerance GROUP BY tolerance"
)
def ca69_tolerance_sweep(spark: S, d: str) -> DataFrame:
    apart = F.abs(F.col("a.tyre_life") - F.col("b.tyre_life")) <= max(_TOLERANCES)
    pairs = J.pairs(laps(spark, d), ["season", "round", "team", "compound"], "driver_id", ["speed", "tyre_life"], apart & (F.col("a.driver_id") < F.col("b.driver_id")))
    return E.tolerance_sweep(pairs, F.abs(F.col("tyre_life") - F.col("other_tyre_life")), F.col("speed") - F.col("other_speed"), list(_TOLERANCES)).withColumn("mean", F.round("mean", 6))


@query(
    "WITH s AS (SELECT day, user_id, t_s, row_number() OVER (PARTITION BY day, user_id ORDER BY t_s, event_id) AS k FROM b_ticks WHERE event_type = 'signup') "
    "SELECT a.day, a.k, a.user_id AS first, b.user_id AS second, b.t_s - a.t_s AS wait FROM s a JOIN s b ON a.day = b.day AND a.k = b.k AND a.user_id <> b.user_id AND b.t_s - a.t_s > 0 AND b.t_s - a.t_s <= 600"
)
def jn26_event_pairs(spark: S, d: str) -> DataFrame:
    k = F.row_number().over(Window.partitionBy("day", "user_id").orderBy("t_s", "event_id")).cast("long")
    signups = view(spark, d, "b_ticks").where("event_type = 'signup'").select("day", "user_id", "t_s", k.alias("k"))
    return E.event_pairs(signups, ["day"], "user_id", "k", "t_s", 600)


@query(
    "WITH a AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, user_id, CAST(floor(epoch(ts)) AS BIGINT) AS utc, hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS l FROM events), z AS (SELECT day, median(utc - l) AS zero FROM a GROUP BY day) "
    "SELECT day, any_value(zero) AS zero, count(*) AS anchors, count(DISTINCT user_id) AS entities, count(*) FILTER (abs(utc - l - zero) <= 1) / count(*) AS share, "
    "count(*) >= 8 AND count(DISTINCT user_id) >= 4 AND count(*) FILTER (abs(utc - l - zero) <= 1) / count(*) >= 0.9 AS accepted FROM a JOIN z USING (day) GROUP BY day"
)
def jn29_clock_zero(spark: S, d: str) -> DataFrame:
    utc = table(spark, d, "events").select("event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("utc"))
    return E.clock_zero(view(spark, d, "b_ticks").join(utc, "event_id"), ["day"], "user_id", "utc", "t_s")


@query(
    "WITH k AS (SELECT *, row_number() OVER (PARTITION BY season, round, driver_id, stint ORDER BY lap_number) AS k FROM b_laps), f AS (SELECT season, round, driver_id, stint, regr_slope(lap_time_sec, tyre_life) AS b, regr_intercept(lap_time_sec, tyre_life) AS a, median(lap_time_sec) AS m FROM k WHERE k <= 5 GROUP BY 1, 2, 3, 4 HAVING count(*) = 5) "
    "SELECT season, round, driver_id, stint, count(*) AS scored, round(avg(abs(lap_time_sec - a - b * tyre_life)), 6) AS mae, round(avg(abs(lap_time_sec - m)), 6) AS baseline_mae FROM k JOIN f USING (season, round, driver_id, stint) WHERE k > 5 GROUP BY 1, 2, 3, 4"
)
def nr14_holdout(spark: S, d: str) -> DataFrame:
    out = E.holdout(laps(spark, d), STINT, "lap_number", "tyre_life", "lap_time_sec", 5)
    return out.select(*STINT, "scored", F.round("mae", 6).alias("mae"), F.round("baseline_mae", 6).alias("baseline_mae"))


@query("WITH g AS (SELECT season, round, lap_number, count(*) AS peers FROM b_laps GROUP BY 1, 2, 3) SELECT least_peers, count(*) FILTER (peers >= least_peers) AS groups, coalesce(sum(peers) FILTER (peers >= least_peers), 0) AS laps FROM g, (SELECT CAST(unnest([2, 3, 5, 8]) AS INTEGER) AS least_peers) GROUP BY least_peers")
def nr15_threshold_grid(spark: S, d: str) -> DataFrame:
    sizes = laps(spark, d).groupBy("season", "round", "lap_number").agg(F.count("*").alias("peers")).groupBy("peers").agg(F.count("*").alias("n"))
    grid = sizes.withColumn("least_peers", F.explode(F.array(*[F.lit(x) for x in (2, 3, 5, 8)])))
    met = F.when(F.col("peers") >= F.col("least_peers"), F.col("n")).otherwise(0)
    return grid.groupBy("least_peers").agg(F.sum(met).alias("groups"), F.sum(met * F.col("peers")).alias("laps"))


@query("SELECT 'orders' AS name, CAST(count(*) AS DOUBLE) AS value, count(*) >= 100 AS passed FROM orders UNION ALL SELECT 'mean_price', round(avg(o_totalprice), 4), avg(o_totalprice) BETWEEN 1000 AND 500000 FROM orders UNION ALL SELECT 'users', count(DISTINCT user_id), count(DISTINCT user_id) <= 10 FROM events")
def dq03_thresholds(spark: S, d: str) -> DataFrame:
    o, e = table(spark, d, "orders"), table(spark, d, "events")
    out = Q.thresholds(("orders", o, F.count("*"), 100, None), ("mean_price", o, F.avg("o_totalprice"), 1000, 500000), ("users", e, F.count_distinct("user_id"), None, 10))
    return out.withColumn("value", F.round("value", 4))


@query("SELECT count(*) AS compared, CAST(0 AS BIGINT) AS violations FROM (SELECT season, round, lap_number FROM b_laps), (SELECT 1)")
def dq07_recomputed_median(spark: S, d: str) -> DataFrame:
    key, rows = ["season", "round", "lap_number"], laps(spark, d).select("season", "round", "lap_number", "driver_id", "lap_time_sec")
    stored = W.loo_median(rows, key, "lap_time_sec", "peers")
    other = Q.medians_of_others(rows, key, "lap_time_sec", "again", 3)
    on = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in key] + [F.col("l.lap_time_sec").eqNullSafe(F.col("r.lap_time_sec"))]
    both = stored.alias("l").join(other.alias("r"), on, "left")
    same = F.col("peers").eqNullSafe(F.col("again")) | (F.abs(F.col("peers") - F.col("again")) <= 1e-9)
    return both.agg(F.count("*").alias("compared"), F.count_if(~F.coalesce(same, F.lit(False))).alias("violations"))


@query(
    "SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') THEN 'available' WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) THEN 'unavailable' ELSE 'not_attempted' END AS status FROM customer"
)
def dq11_coverage_ledger(spark: S, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return E.coverage_ledger(table(spark, d, "customer"), o.where("o_orderstatus = 'F'"), o, ["c_custkey"])


@query("SELECT DISTINCT season, round FROM b_laps EXCEPT SELECT season, round FROM b_laps WHERE speed >= 50 AND track_status = '4' GROUP BY season, round HAVING count(*) > 3")
def dq12_lost_partitions(spark: S, d: str) -> DataFrame:
    after = laps(spark, d).where("speed >= 50 and track_status = '4'").groupBy("season", "round").agg(F.count("*").alias("n")).where("n > 3")
    return Q.lost_partitions(laps(spark, d), after, ["season", "round"])


@query(
    "SELECT event_type, count(*) AS row_count, CAST(floor((SELECT max(epoch(ts)) FROM events) - max(epoch(ts))) AS BIGINT) AS age, floor((SELECT max(epoch(ts)) FROM events) - max(epoch(ts))) <= 600 AS healthy FROM events GROUP BY event_type"
)
def dq14_freshness(spark: S, d: str) -> DataFrame:
    return Q.freshness(table(spark, d, "events"), "event_type", "ts", 600)
