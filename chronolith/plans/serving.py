"""Marts and page composites: gaps, lap times, stories, strategy, cockpit, profiles, feeds and bundles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from chronolith.functions import columns as C
from chronolith.operators import evidence as E, joins as J, resample as RS, windows as W
from chronolith.plans.basics import laps
from chronolith.plans.bindings import table, view
from chronolith.plans.registry import query
from chronolith.plans.small import _SESSIONS, common_session

S = SparkSession
RACE, DRIVER, LAP = ["season", "round"], ["season", "round", "driver_id"], ["season", "round", "driver_id", "lap_number"]
STINT = ["season", "round", "driver_id", "stint"]
r6 = lambda c: F.round(c, 6)


def timed(spark: S, d: str) -> DataFrame:
    return view(spark, d, "b_timed")


@query(f"WITH {_SESSIONS}, t2 AS (SELECT *, CASE common_session WHEN 'Q3' THEN a3 WHEN 'Q2' THEN a2 WHEN 'Q1' THEN a1 END AS m, CASE common_session WHEN 'Q3' THEN b3 WHEN 'Q2' THEN b2 WHEN 'Q1' THEN b1 END AS o FROM p) SELECT season, round, team, driver_id, other_driver_id, common_session, round(100 * (ln(m) - ln(o)), 6) AS pace_gap FROM t2 WHERE m > 0 AND o > 0")
def ca01_session_gaps(spark: S, d: str) -> DataFrame:
    p = common_session(spark, d).where("mine > 0 and theirs > 0")
    return p.select(*RACE, "team", "driver_id", "other_driver_id", "common_session", r6(C.log_gap(F.col("mine"), F.col("theirs"))).alias("pace_gap"))


@query("SELECT l.season, l.round, l.driver_id, l.lap_number, s_name AS driver, n_name AS country, l.compound, round(l.lap_time_sec, 6) AS lap_time_sec FROM b_laps l LEFT JOIN supplier ON l.driver_id = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey WHERE l.track_status = '1' AND l.lap_time_sec IS NOT NULL")
def ca03_lap_times(spark: S, d: str) -> DataFrame:
    dims = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left").select(F.col("s_suppkey").alias("driver_id"), F.col("s_name").alias("driver"), F.col("n_name").alias("country"))
    return laps(spark, d).where("track_status = '1' and lap_time_sec is not null").join(dims, "driver_id", "left").select(*LAP, "driver", "country", "compound", r6("lap_time_sec").alias("lap_time_sec"))


@query(
    "WITH w AS (SELECT season, round, start_ms AS at, track_status = '4' AS rain, lap_ms >= 84000 AS hot FROM b_timed WHERE driver_id = 0), "
    "j AS (SELECT l.season, l.round, l.compound, l.tyre_life, l.lap_ms / 1000.0 AS y, l.driver_id, l.lap_number, bool_or(rain) AS rain, bool_or(hot) AS hot FROM b_timed l JOIN w ON l.season = w.season AND l.round = w.round AND w.at >= l.start_ms AND w.at < l.end_ms WHERE l.track_status = '1' GROUP BY ALL) "
    "SELECT season, compound, CASE WHEN rain THEN 'wet' WHEN hot THEN 'hot' ELSE 'cool' END AS bucket, count(*) AS n, round(regr_slope(y, tyre_life), 6) AS slope FROM j GROUP BY ALL HAVING count(*) >= 8"
)
def ca07_weather_slope(spark: S, d: str) -> DataFrame:
    t = timed(spark, d)
    samples = t.where("driver_id = 0").select(*RACE, F.col("start_ms").alias("at"), (F.col("track_status") == "4").alias("rain"), (F.col("lap_ms") >= 84000).alias("hot"))
    spans = t.where("track_status = '1'").select(*LAP, "compound", "tyre_life", "lap_ms", "start_ms", "end_ms")
    met = J.interval(F.broadcast(samples), spans, RACE, "at", "start_ms", "end_ms", 90000)  # one driver's laps, whatever the field
    seen = met.groupBy(*LAP, "compound", "tyre_life", (F.col("lap_ms") / 1000).alias("y")).agg(F.bool_or("rain").alias("rain"), F.bool_or("hot").alias("hot"))
    bucket = F.when(F.col("rain"), "wet").when(F.col("hot"), "hot").otherwise("cool")
    return seen.groupBy("season", "compound", bucket.alias("bucket")).agg(F.count("*").alias("n"), r6(F.regr_slope("y", "tyre_life")).alias("slope")).where("n >= 8")


_PLACED = "placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY season, round, lap_number ORDER BY end_ms, driver_id) AS BIGINT) AS position FROM b_timed)"


def placed(spark: S, d: str) -> DataFrame:
    """Laps with the driver's position at their end."""
    w = Window.partitionBy(*RACE, "lap_number").orderBy("end_ms", "driver_id")
    return timed(spark, d).withColumn("position", F.row_number().over(w).cast("long"))


@query(
    f"WITH {_PLACED} SELECT p.season, p.round, p.driver_id, p.lap_number AS pit_lap, b.position AS before, a.position AS after, b.position - a.position AS gained FROM placed p LEFT JOIN placed b ON p.season = b.season AND p.round = b.round AND p.driver_id = b.driver_id AND b.lap_number = p.lap_number - 1 "
    "LEFT JOIN placed a ON p.season = a.season AND p.round = a.round AND p.driver_id = a.driver_id AND a.lap_number = p.lap_number + 2 WHERE p.tyre_life = 8"
)
def ca10_stop_cycles(spark: S, d: str) -> DataFrame:
    rows = placed(spark, d)
    at = lambda shift, name: rows.select(*DRIVER, (F.col("lap_number") - shift).alias("lap_number"), F.col("position").alias(name))
    out = rows.where("tyre_life = 8").select(*LAP).join(at(-1, "before"), LAP, "left").join(at(2, "after"), LAP, "left")
    return out.select(*DRIVER, F.col("lap_number").alias("pit_lap"), "before", "after", (F.col("before") - F.col("after")).alias("gained"))


@query(
    f"WITH {_PLACED}, f AS (SELECT season, round, driver_id, arg_min(position, lap_number) AS grid, arg_max(position, lap_number) AS finish, max(lap_number) AS laps, count(*) FILTER (tyre_life = 8) AS n FROM placed GROUP BY 1, 2, 3), c AS (SELECT season, round, count(*) FILTER (track_status = '4') > 5 AS covered FROM b_laps GROUP BY 1, 2) "
    "SELECT season, round, driver_id, grid, finish, grid - finish AS gain, laps, CASE WHEN covered THEN n END AS stops FROM f LEFT JOIN c USING (season, round)"
)
def ca12_recorded_story(spark: S, d: str) -> DataFrame:
    f = placed(spark, d).groupBy(*DRIVER).agg(F.min_by("position", "lap_number").alias("grid"), F.max_by("position", "lap_number").alias("finish"), F.max("lap_number").alias("laps"), F.count_if(F.col("tyre_life") == 8).alias("n"))
    covered = laps(spark, d).groupBy(*RACE).agg((F.count_if(F.col("track_status") == "4") > 5).alias("covered"))
    return f.join(covered, RACE, "left").select(*DRIVER, "grid", "finish", (F.col("grid") - F.col("finish")).alias("gain"), "laps", F.when(F.col("covered"), F.col("n")).alias("stops"))


@query(
    "WITH m AS (SELECT season, round, driver_id, round(median(lap_time_sec) FILTER (track_status = '1'), 6) AS pace, count(*) FILTER (track_status = '1') AS n FROM b_laps GROUP BY 1, 2, 3), r AS (SELECT *, CASE WHEN n >= 5 THEN rank() OVER (PARTITION BY season, round ORDER BY CASE WHEN n >= 5 THEN pace END NULLS LAST) END AS pace_rank FROM m) "
    "SELECT *, count(pace_rank) OVER w = count(*) OVER w AS complete FROM r WINDOW w AS (PARTITION BY season, round)"
)
def ca13_serving_story(spark: S, d: str) -> DataFrame:
    green = F.when(F.col("track_status") == "1", F.col("lap_time_sec"))
    m = laps(spark, d).groupBy(*DRIVER).agg(r6(F.percentile(green, 0.5)).alias("pace"), F.count(green).alias("n"))
    enough, field = F.col("n") >= 5, Window.partitionBy(*RACE)
    ranks = F.when(enough, F.rank().over(field.orderBy(F.when(enough, F.col("pace")).asc_nulls_last())).cast("long"))
    return m.withColumn("pace_rank", ranks).withColumn("complete", F.count("pace_rank").over(field) == F.count("*").over(field))


@query("SELECT t.season, t.round, t.user_id, day, n, best, s_name AS name, n_name AS country, r_name AS region FROM (SELECT CAST(year(CAST(day AS DATE)) AS BIGINT) AS season, CAST(month(CAST(day AS DATE)) AS BIGINT) AS round, user_id, day, count(*) AS n, max(value) AS best FROM b_ticks GROUP BY ALL) t LEFT JOIN supplier ON s_suppkey = user_id LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def ca14_telemetry_mart(spark: S, d: str) -> DataFrame:
    t = view(spark, d, "b_ticks").groupBy("user_id", "day").agg(F.count("*").alias("n"), F.max("value").alias("best"))
    t = t.select(F.year(F.to_date("day")).cast("long").alias("season"), F.month(F.to_date("day")).cast("long").alias("round"), "user_id", "day", "n", "best")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("user_id"), F.col("s_name").alias("name"), "s_nationkey")
    out = t.join(s, "user_id", "left").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return out.select("season", "round", "user_id", "day", "n", "best", "name", F.col("n_name").alias("country"), F.col("r_name").alias("region"))


@query(
    "WITH s AS (SELECT *, lap_time_sec - median(lap_time_sec) OVER (PARTITION BY season, round) AS loss FROM b_laps WHERE tyre_life = 8), c AS (SELECT DISTINCT season, round, lap_number FROM b_laps WHERE track_status = '4') "
    "SELECT s.season, s.round, s.driver_id, s.lap_number, round(s.loss, 6) AS loss, EXISTS (SELECT 1 FROM c WHERE c.season = s.season AND c.round = s.round AND c.lap_number BETWEEN s.lap_number - 2 AND s.lap_number + 2) AS near FROM s"
)
def ca15_strategy_impact(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d)
    stops = rows.where("tyre_life = 8")
    middle = stops.groupBy(*RACE).agg(F.percentile("lap_time_sec", 0.5).alias("m"))
    near = rows.where("track_status = '4'").select(*RACE, F.explode(F.sequence(F.col("lap_number") - 2, F.col("lap_number") + 2)).alias("lap_number")).distinct().withColumn("near", F.lit(True))
    out = stops.join(middle, RACE).join(near, [*RACE, "lap_number"], "left")
    return out.select(*LAP, r6(F.col("lap_time_sec") - F.col("m")).alias("loss"), F.coalesce("near", F.lit(False)).alias("near"))


@query("SELECT event_id, day, t_s - z AS at FROM b_ticks JOIN (SELECT day, min(t_s) AS z FROM b_ticks WHERE event_type = 'view' GROUP BY day) USING (day) WHERE event_type IN ('error', 'signup') AND t_s - z BETWEEN 0 AND 50000")
def ca16_messages_on_clock(spark: S, d: str) -> DataFrame:
    t = view(spark, d, "b_ticks")
    zero = t.where("event_type = 'view'").groupBy("day").agg(F.min("t_s").alias("z"))
    return t.where(F.col("event_type").isin("error", "signup")).join(F.broadcast(zero), "day").select("event_id", "day", (F.col("t_s") - F.col("z")).alias("at")).where("at between 0 and 50000")  # a row a day


_FAST = "SELECT season, round, driver_id, arg_min(lap_number, (lap_time_sec, lap_number)) AS lap_number FROM b_laps GROUP BY 1, 2, 3"


def fastest(spark: S, d: str) -> DataFrame:
    return laps(spark, d).groupBy(*DRIVER).agg(F.min_by("lap_number", F.struct("lap_time_sec", "lap_number")).alias("lap_number"))


@query(
    f"WITH f AS ({_FAST}), e AS (SELECT a.season, a.round, a.driver_id, a.lap_number FROM b_laps a JOIN b_laps b ON a.season = b.season AND a.round = b.round AND a.team = b.team AND a.driver_id <> b.driver_id AND a.lap_number = b.lap_number AND a.compound = b.compound AND a.track_status = '1' AND b.track_status = '1' WHERE a.tyre_life = 4) "
    "SELECT p.*, speed, compound FROM (SELECT * FROM f UNION SELECT * FROM e) p JOIN b_laps USING (season, round, driver_id, lap_number)"
)
def ca17_pool(spark: S, d: str) -> DataFrame:
    green = laps(spark, d).where("track_status = '1'")
    evidence = J.pairs(green, [*RACE, "team", "lap_number", "compound"], "driver_id", ["tyre_life"]).where("tyre_life = 4").select(*LAP)
    return fastest(spark, d).select(*LAP).union(evidence).distinct().join(laps(spark, d).select(*LAP, "speed", "compound"), LAP)


@query(
    "WITH g AS (SELECT season, round, team, driver_id, lap_number, CAST(sum(lap_ms) OVER (PARTITION BY season, round, driver_id ORDER BY lap_number ROWS UNBOUNDED PRECEDING) AS BIGINT) AS t FROM b_timed) "
    "SELECT a.season, a.round, a.team, a.lap_number, a.t - b.t AS delta_ms FROM g a JOIN g b ON a.season = b.season AND a.round = b.round AND a.team = b.team AND a.lap_number = b.lap_number AND a.driver_id < b.driver_id"
)
def ca18_delta_along(spark: S, d: str) -> DataFrame:
    w = Window.partitionBy(*DRIVER).orderBy("lap_number").rowsBetween(Window.unboundedPreceding, 0)
    run = timed(spark, d).select(*LAP, "team", F.sum("lap_ms").over(w).alias("t"))
    p = J.pairs(run, [*RACE, "team", "lap_number"], "driver_id", ["t"], F.col("a.driver_id") < F.col("b.driver_id"))
    return p.select(*RACE, "team", "lap_number", (F.col("t") - F.col("other_t")).alias("delta_ms"))


_LAST = "(SELECT season, round FROM b_laps ORDER BY season DESC, round DESC LIMIT 1)"


@query(
    f"WITH x AS (SELECT * FROM b_laps SEMI JOIN {_LAST} l USING (season, round)) SELECT season, round, count(*) AS laps, count(DISTINCT driver_id) AS drivers, round(max(speed), 6) AS top, arg_min(driver_id, (lap_time_sec, driver_id, lap_number)) AS fastest, count(*) FILTER (tyre_life = 8) AS stops, count(*) FILTER (track_status = '4') AS marked FROM x GROUP BY ALL"
)
def ca19_cockpit(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d)
    last = rows.select(*RACE).orderBy(F.desc("season"), F.desc("round")).limit(1)
    x = rows.join(F.broadcast(last), RACE, "left_semi")
    by = x.groupBy(*RACE)
    parts = [by.agg(F.count("*").alias("laps"), F.count_distinct("driver_id").alias("drivers")), by.agg(r6(F.max("speed")).alias("top")), by.agg(F.min_by("driver_id", F.struct("lap_time_sec", "driver_id", "lap_number")).alias("fastest")), by.agg(F.count_if(F.col("tyre_life") == 8).alias("stops")), by.agg(F.count_if(F.col("track_status") == "4").alias("marked"))]
    return reduce(lambda a, b: a.join(b, RACE), parts)


_Z = "1.6448536269514722"
_WILSON = f"CASE WHEN n >= 5 THEN round(100 * (wins / n + {_Z} * {_Z} / (2 * n) %s {_Z} * sqrt(wins / n * (1 - wins / n) / n + {_Z} * {_Z} / (4 * n * n))) / (1 + {_Z} * {_Z} / n), 6) END"


@query(
    "WITH s AS (SELECT a.season, a.round, a.driver_id AS entity, 'attack' AS role, a.lap_time_sec < b.lap_time_sec AS w FROM b_laps a JOIN b_laps b ON a.season = b.season AND a.round = b.round AND a.team = b.team AND a.lap_number = b.lap_number AND a.driver_id < b.driver_id "
    "UNION ALL SELECT a.season, a.round, b.driver_id, 'defence', NOT (a.lap_time_sec < b.lap_time_sec) FROM b_laps a JOIN b_laps b ON a.season = b.season AND a.round = b.round AND a.team = b.team AND a.lap_number = b.lap_number AND a.driver_id < b.driver_id), "
    "g AS (SELECT season, CASE WHEN grouping(round) = 1 THEN 0 ELSE round END AS round, entity, role, count(*) AS n, count(*) FILTER (w) AS wins FROM s GROUP BY GROUPING SETS ((season, round, entity, role), (season, entity, role))) "
    f"SELECT *, {_WILSON % '-'} AS low, {_WILSON % '+'} AS high FROM g"
)
def ca20_rate_profiles(spark: S, d: str) -> DataFrame:
    p = J.pairs(laps(spark, d), [*RACE, "team", "lap_number"], "driver_id", ["lap_time_sec"], F.col("a.driver_id") < F.col("b.driver_id")).withColumn("w", F.col("lap_time_sec") < F.col("other_lap_time_sec"))
    sides = p.select(*RACE, F.col("driver_id").alias("entity"), F.lit("attack").alias("role"), "w").unionByName(p.select(*RACE, F.col("other_driver_id").alias("entity"), F.lit("defence").alias("role"), (~F.col("w")).alias("w")))
    keys = ["season", "round", "entity", "role"]
    g = sides.groupingSets([keys, ["season", "entity", "role"]], *keys).agg(F.count("*").alias("n"), F.count_if("w").alias("wins"), F.grouping("round").alias("all"))
    low, high = C.wilson(F.col("wins"), F.col("n"))
    return g.select("season", F.when(F.col("all") == 1, F.lit(0)).otherwise(F.col("round")).cast("long").alias("round"), "entity", "role", "n", "wins", r6(low).alias("low"), r6(high).alias("high"))


_BATTLES = "SELECT season, round, team, min(driver_id) AS attacker, max(driver_id) AS defender, min(lap_number) AS lap_number FROM b_laps WHERE track_status = '1' GROUP BY 1, 2, 3 HAVING count(DISTINCT driver_id) = 2"


@query(
    f"WITH b AS ({_BATTLES}), k AS (SELECT season, round, driver_id, lap_number, CASE WHEN count(*) = 1 THEN max(tyre_life) END AS age FROM (SELECT * FROM b_laps UNION ALL SELECT * FROM b_laps WHERE driver_id % 7 = 3) GROUP BY 1, 2, 3, 4) "
    "SELECT b.*, x.age AS attacker_age, y.age AS defender_age FROM b LEFT JOIN k x ON x.season = b.season AND x.round = b.round AND x.driver_id = b.attacker AND x.lap_number = b.lap_number LEFT JOIN k y ON y.season = b.season AND y.round = b.round AND y.driver_id = b.defender AND y.lap_number = b.lap_number"
)
def ca21_battle_context(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d)
    b = J.exactly(rows.where("track_status = '1'"), [*RACE, "team"], "driver_id", 2).groupBy(*RACE, "team").agg(F.min("driver_id").alias("attacker"), F.max("driver_id").alias("defender"), F.min("lap_number").alias("lap_number"))
    twice = rows.unionByName(rows.where("driver_id % 7 = 3"))  # some keys are ambiguous: their age is unknown
    k = twice.groupBy(*LAP).agg(F.when(F.count("*") == 1, F.max("tyre_life")).alias("age"))
    side = lambda name: k.select(*RACE, F.col("driver_id").alias(name), "lap_number", F.col("age").alias(name + "_age"))
    return b.join(side("attacker"), [*RACE, "attacker", "lap_number"], "left").join(side("defender"), [*RACE, "defender", "lap_number"], "left").select(*RACE, "team", "attacker", "defender", "lap_number", "attacker_age", "defender_age")


@query(
    "WITH c AS (SELECT season, round, count(*) AS laps, count(*) FILTER (track_status = '1') AS green, count(DISTINCT driver_id) AS drivers, count(*) FILTER (tyre_life = 8) AS stops, count(*) FILTER (track_status = '4') AS marked, count(*) FILTER (speed > 48) AS fast FROM b_laps GROUP BY 1, 2) "
    "SELECT season, round, CASE WHEN laps = 0 THEN 'missing' WHEN green = 0 THEN 'no green laps' WHEN drivers < 2 THEN 'one driver' WHEN stops = 0 THEN 'no stops' WHEN marked > green THEN 'neutralised' WHEN fast < 20 THEN 'slow' ELSE 'complete' END AS status FROM c"
)
def ca22_processing_status(spark: S, d: str) -> DataFrame:
    c = laps(spark, d).groupBy(*RACE).agg(F.count("*").alias("laps"), F.count_if(F.col("track_status") == "1").alias("green"), F.count_distinct("driver_id").alias("drivers"), F.count_if(F.col("tyre_life") == 8).alias("stops"), F.count_if(F.col("track_status") == "4").alias("marked"), F.count_if(F.col("speed") > 48).alias("fast"))
    rules = ((F.col("laps") == 0, "missing"), (F.col("green") == 0, "no green laps"), (F.col("drivers") < 2, "one driver"), (F.col("stops") == 0, "no stops"), (F.col("marked") > F.col("green"), "neutralised"), (F.col("fast") < 20, "slow"))
    return c.select(*RACE, F.coalesce(C.first_reason(*rules), F.lit("complete")).alias("status"))


@query(
    f"WITH {_PLACED} SELECT p.season, p.round, p.driver_id, s_name AS name, p.team, ['red', 'blue', 'green', 'grey'][p.team % 4 + 1] AS colour, f.finish FROM (SELECT DISTINCT season, round, driver_id, team FROM b_laps) p LEFT JOIN supplier ON s_suppkey = p.driver_id LEFT JOIN (SELECT season, round, driver_id, arg_max(position, lap_number) AS finish FROM placed GROUP BY 1, 2, 3) f ON f.season = p.season AND f.round = p.round AND f.driver_id = p.driver_id"
)
def ca23_driver_meta(spark: S, d: str) -> DataFrame:
    colours = F.array(*[F.lit(c) for c in ("red", "blue", "green", "grey")])
    names = table(spark, d, "supplier").select(F.col("s_suppkey").alias("driver_id"), F.col("s_name").alias("name"))
    result = placed(spark, d).groupBy(*DRIVER).agg(F.max_by("position", "lap_number").alias("finish"))
    out = laps(spark, d).select(*DRIVER, "team").distinct().join(names, "driver_id", "left").join(result, DRIVER, "left")
    return out.select(*DRIVER, "name", "team", F.element_at(colours, (F.col("team") % 4 + 1).cast("int")).alias("colour"), "finish")


_AXES = "avg(speed) / 10 AS a, avg(lap_time_sec) - 83 AS b, stddev_samp(speed) / 10 AS c, avg(tyre_life) - 4 AS e, avg(CASE WHEN track_status = '1' THEN 1.0 ELSE 0.0 END) AS g"


@query(
    f"WITH r AS (SELECT driver_id, season, round, {_AXES} FROM b_laps GROUP BY 1, 2, 3 HAVING count(*) >= 8), p AS (SELECT driver_id, count(*) AS n, avg(a) AS a, avg(b) AS b, avg(c) AS c, avg(e) AS e, avg(g) AS g FROM r GROUP BY 1), "
    "x AS (SELECT r.driver_id, r.season, r.round, n, r.a - p.a AS a, r.b - p.b AS b, r.c - p.c AS c, r.e - p.e AS e, r.g - p.g AS g FROM r JOIN p USING (driver_id)), y AS (SELECT *, round(sqrt((a * a + b * b + c * c + e * e + g * g) / 5), 6) AS distance, round(sqrt((a * a + b * b + c * c + e * e + g * g) / 5) / (n - 1), 6) AS influence FROM x WHERE n > 1) "
    "SELECT * FROM (SELECT driver_id, season, round, 'typical' AS kind, distance, influence FROM y QUALIFY row_number() OVER (PARTITION BY driver_id ORDER BY distance, season, round) = 1) UNION ALL SELECT * FROM (SELECT driver_id, season, round, 'unusual', distance, influence FROM y QUALIFY row_number() OVER (PARTITION BY driver_id ORDER BY distance DESC, season, round) = 1)"
)
def ca24_profile_distance(spark: S, d: str) -> DataFrame:
    axes = "abceg"
    share = F.avg(F.when(F.col("track_status") == "1", 1.0).otherwise(0.0))
    r = laps(spark, d).groupBy("driver_id", *RACE).agg((F.avg("speed") / 10).alias("a"), (F.avg("lap_time_sec") - 83).alias("b"), (F.stddev_samp("speed") / 10).alias("c"), (F.avg("tyre_life") - 4).alias("e"), share.alias("g"), F.count("*").alias("_n")).where("_n >= 8")
    p = r.groupBy("driver_id").agg(F.count("*").alias("n"), *[F.avg(c).alias("_" + c) for c in axes])
    x = r.join(p, "driver_id").where("n > 1").withColumn("rms", C.rms(*[F.col(c) - F.col("_" + c) for c in axes]))
    # leaving a race out moves the profile by its distance over n - 1
    y = x.select("driver_id", *RACE, r6("rms").alias("distance"), r6(F.col("rms") / (F.col("n") - 1)).alias("influence"))

    def first(kind: str, order: Column) -> DataFrame:
        w = Window.partitionBy("driver_id").orderBy(order, *RACE)
        return y.withColumn("_k", F.row_number().over(w)).where("_k = 1").select("driver_id", *RACE, F.lit(kind).alias("kind"), "distance", "influence")

    return first("typical", F.col("distance").asc()).unionByName(first("unusual", F.col("distance").desc()))


@query("SELECT a.season, a.driver_id, round(a.m - avg(b.m), 6) AS above, count(b.m) AS peers FROM (SELECT season, driver_id, avg(speed) AS m FROM b_laps GROUP BY 1, 2) a JOIN (SELECT season, driver_id, avg(speed) AS m FROM b_laps GROUP BY 1, 2) b ON a.season = b.season AND a.driver_id <> b.driver_id GROUP BY a.season, a.driver_id, a.m")
def ca25_peer_benchmark(spark: S, d: str) -> DataFrame:
    means = laps(spark, d).groupBy("season", "driver_id").agg(F.avg("speed").alias("m"))
    out = W.loo_mean(means, ["season"], "m", "others", least=2).withColumn("peers", F.count("m").over(Window.partitionBy("season")) - 1)
    return out.where("others is not null").select("season", "driver_id", r6(F.col("m") - F.col("others")).alias("above"), "peers")


@query(None)
def ca28_drop_jumps(spark: S, d: str) -> DataFrame:
    t = view(spark, d, "b_ticks").select("event_id", "user_id", "day", F.col("t_s").cast("double").alias("t"), F.when(F.col("event_id") % 11 == 0, 0.0).otherwise(F.col("value")).alias("x"), F.when(F.col("event_id") % 11 == 0, 0.0).otherwise(F.lit(1.0)).alias("y"))
    return RS.drop_jumps(t, ["user_id", "day"], "t", "x", "y", 0.01).select("event_id")


_AT = 1_500_000


@query(
    f"WITH s AS (SELECT *, row_number() OVER (PARTITION BY season, round, driver_id ORDER BY start_ms DESC) AS k FROM b_timed WHERE start_ms <= {_AT}), g AS (SELECT season, round, driver_id, CAST(row_number() OVER (PARTITION BY season, round ORDER BY end_ms, driver_id) AS BIGINT) AS grid FROM b_timed WHERE lap_number = 1), "
    f"p AS (SELECT season, round, driver_id, lap_number, compound, tyre_life, stint - 1 AS stops, CASE WHEN end_ms >= {_AT} THEN 'running' ELSE 'out' END AS status, CAST(row_number() OVER (PARTITION BY season, round ORDER BY lap_number DESC, start_ms, driver_id) AS BIGINT) AS place FROM s WHERE k = 1) SELECT p.*, grid - place AS change FROM p JOIN g USING (season, round, driver_id)"
)
def ca72_timing_tower(spark: S, d: str) -> DataFrame:
    t = timed(spark, d)
    state = F.max_by(F.struct("lap_number", "compound", "tyre_life", "stint", "start_ms", "end_ms"), "start_ms").alias("s")
    now = t.where(F.col("start_ms") <= _AT).groupBy(*DRIVER).agg(state).select(*DRIVER, "s.*")
    grid = t.where("lap_number = 1").select(*DRIVER, F.row_number().over(Window.partitionBy(*RACE).orderBy("end_ms", "driver_id")).cast("long").alias("grid"))
    place = F.row_number().over(Window.partitionBy(*RACE).orderBy(F.desc("lap_number"), "start_ms", "driver_id")).cast("long")
    p = now.select(*LAP, "compound", "tyre_life", (F.col("stint") - 1).alias("stops"), F.when(F.col("end_ms") >= _AT, "running").otherwise("out").alias("status"), place.alias("place"))
    return p.join(grid, DRIVER).withColumn("change", F.col("grid") - F.col("place")).drop("grid")


@query(
    "SELECT season, round, driver_id, t, kind FROM (SELECT season, round, driver_id, start_ms AS t, 'pit' AS kind FROM b_timed WHERE tyre_life = 1 AND stint > 1 UNION ALL SELECT season, round, driver_id, end_ms, 'marked' FROM b_timed WHERE track_status = '4' AND tyre_life = 5 "
    "UNION ALL SELECT season, round, driver_id, end_ms, 'fast' FROM b_timed WHERE speed >= 50 UNION ALL SELECT season, round, driver_id, max(end_ms), 'finish' FROM b_timed GROUP BY ALL) WHERE driver_id % 2 = 1"
)
def ca73_feed(spark: S, d: str) -> DataFrame:
    t = timed(spark, d)
    part = lambda rows, at, kind: rows.select(*DRIVER, F.col(at).alias("t"), F.lit(kind).alias("kind"))
    parts = [part(t.where("tyre_life = 1 and stint > 1"), "start_ms", "pit"), part(t.where("track_status = '4' and tyre_life = 5"), "end_ms", "marked"), part(t.where("speed >= 50"), "end_ms", "fast"), part(t.groupBy(*DRIVER).agg(F.max("end_ms").alias("end_ms")), "end_ms", "finish")]
    return reduce(DataFrame.unionByName, parts).where("driver_id % 2 = 1").orderBy(*RACE, "t", "driver_id", "kind")  # one side's participants


def race_bundle(spark: S, d: str, season: int, round_: int) -> dict[str, DataFrame]:
    """Aligned tables of one race on its clock."""
    inside = (F.col("season") == season) & (F.col("round") == round_)
    t = timed(spark, d).where(inside)
    start = t.where("lap_number = 1").agg(F.min("start_ms").alias("zero"), F.max("end_ms").alias("first_end"))
    phase = F.when(F.col("at") < F.col("zero"), "before").when(F.col("at") > F.col("first_end"), "racing").otherwise("first lap")
    marks = t.where("track_status = '4'").select("driver_id", F.col("start_ms").alias("at")).crossJoin(F.broadcast(start)).select("driver_id", (F.col("at") - F.col("zero")).alias("t"), phase.alias("phase"))  # one row
    return {
        "race": t.groupBy(*RACE).agg(F.max("lap_number").alias("laps")),
        "drivers": t.select("driver_id", "team").distinct(),
        "laps": t.select("driver_id", "lap_number", "start_ms", "end_ms"),
        "marks": marks,
        "stops": t.where("tyre_life = 8").select("driver_id", "end_ms"),
        "weather": t.where("driver_id = 0").select("start_ms", "speed"),
        "passes": t.where("speed >= 45").select("driver_id", "lap_number"),
    }


@query(
    "WITH t AS (SELECT * FROM b_timed WHERE season = 1997 AND round = 2) SELECT 'race' AS name, CAST(1 AS BIGINT) AS rows UNION ALL SELECT 'drivers', count(DISTINCT driver_id) FROM t UNION ALL SELECT 'laps', count(*) FROM t UNION ALL SELECT 'marks', count(*) FILTER (track_status = '4') FROM t UNION ALL SELECT 'stops', count(*) FILTER (tyre_life = 8) FROM t UNION ALL SELECT 'weather', count(*) FILTER (driver_id = 0) FROM t UNION ALL SELECT 'passes', count(*) FILTER (speed >= 45) FROM t"
)
def ca74_bundle(spark: S, d: str) -> DataFrame:
    parts = race_bundle(spark, d, 1997, 2)
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows") for name, df in parts.items()])


@query(
    "WITH s AS (SELECT season, round, driver_id, stint, count(*) AS n, bool_or(track_status = '4') AS marked, min(compound) AS compound, min(lap_time_sec) AS best, max(lap_time_sec) AS worst FROM b_laps GROUP BY 1, 2, 3, 4), o AS (SELECT *, CASE WHEN n < 4 THEN 'incomplete' WHEN marked THEN 'excluded' WHEN n < 8 THEN 'censored' ELSE 'settled' END AS status FROM s) "
    "SELECT status, compound, count(*) AS n, round(median(worst - best), 6) AS loss FROM o GROUP BY ALL"
)
def ca75_outcomes(spark: S, d: str) -> DataFrame:
    s = laps(spark, d).groupBy(*STINT).agg(F.count("*").alias("n"), F.bool_or(F.col("track_status") == "4").alias("marked"), F.min("compound").alias("compound"), F.min("lap_time_sec").alias("best"), F.max("lap_time_sec").alias("worst"))
    status = F.coalesce(C.first_reason((F.col("n") < 4, "incomplete"), (F.col("marked"), "excluded"), (F.col("n") < 8, "censored")), F.lit("settled"))
    return s.groupBy(status.alias("status"), "compound").agg(F.count("*").alias("n"), r6(F.percentile(F.col("worst") - F.col("best"), 0.5)).alias("loss"))


@query(
    f"WITH {_PLACED} SELECT season, driver_id, CAST(sum(first - last) AS BIGINT) AS net, CAST(sum(stops) AS BIGINT) AS stops, round(avg(duration), 6) AS duration FROM (SELECT season, round, driver_id, arg_min(position, lap_number) AS first, arg_max(position, lap_number) AS last, count(*) FILTER (tyre_life = 8) AS stops, avg(lap_ms) FILTER (tyre_life = 8) AS duration FROM placed GROUP BY 1, 2, 3) GROUP BY 1, 2"
)
def ca76_stop_summary(spark: S, d: str) -> DataFrame:
    stop = F.col("tyre_life") == 8
    races = placed(spark, d).groupBy(*DRIVER).agg(F.min_by("position", "lap_number").alias("first"), F.max_by("position", "lap_number").alias("last"), F.count_if(stop).alias("stops"), F.avg(F.when(stop, F.col("lap_ms"))).alias("duration"))
    return races.groupBy("season", "driver_id").agg(F.sum(F.col("first") - F.col("last")).alias("net"), F.sum("stops").alias("stops"), r6(F.avg("duration")).alias("duration"))


@query(
    "WITH x AS (SELECT season, round, driver_id, start_ms AS at FROM b_timed WHERE tyre_life = 1 AND stint > 1), s AS (SELECT x.season, x.round, x.driver_id, l.driver_id AS other, l.end_ms - x.at AS since, CASE WHEN l.track_status = '4' THEN 'stale' WHEN l.speed < 10 THEN 'missing' ELSE 'fresh' END AS status FROM x JOIN b_timed l ON x.season = l.season AND x.round = l.round AND l.end_ms BETWEEN x.at - 1000 AND x.at + 6000) "
    "SELECT season, round, status, count(*) AS samples, count(*) FILTER (since < 0) AS before, count(DISTINCT driver_id) AS transitions FROM s GROUP BY ALL"
)
def ca77_order_audit(spark: S, d: str) -> DataFrame:
    t = timed(spark, d)
    stops = t.where("tyre_life = 1 and stint > 1").select(*DRIVER, F.col("start_ms").alias("at"))
    status = F.when(F.col("track_status") == "4", "stale").when(F.col("speed") < 10, "missing").otherwise("fresh")
    s = E.counted_near(t.select(*RACE, "end_ms", status.alias("status")), stops, RACE, "end_ms", "status", "at", 1000, 6000, ["fresh", "stale", "missing"])
    return s.groupBy(*RACE, "status").agg(F.sum("samples").alias("samples"), F.sum("before").alias("before"), F.count_distinct("driver_id").alias("transitions"))
