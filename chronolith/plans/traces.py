"""Trace queries: technique of representative lap pairs along a distance, microsectors and time deltas. Embeddings stand for channels along a lap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from chronolith.operators import joins as J, traces as T
from chronolith.plans.bindings import view
from chronolith.plans.registry import query

S = SparkSession
KEY, LAP = ["season", "round", "team"], ["season", "round", "team", "driver_id", "lap_number"]
CHANNELS = ["speed", "throttle", "brake"]
LAPS, TYRES, POINTS, COVERAGE, STEP = 5, 5, 55, 95.0, 25
r6 = lambda c: F.round(c, 6)

_POINTS = (
    f"x AS (SELECT season, round, team, driver_id, lap_number, (i - 1) * {STEP}.0::DOUBLE AS x, embedding[i]::DOUBLE AS v FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM b_traces)), "
    "c AS MATERIALIZED (SELECT * EXCLUDE (v), 200 + 700 * v AS speed, least(greatest(50 + 500 * v, 0), 100) AS throttle, CASE WHEN v < -0.02 AND v > -0.25 THEN 1 ELSE 0 END AS brake, CASE WHEN 50 + 500 * v NOT BETWEEN 0 AND 100 THEN 1 ELSE 0 END AS fixed FROM x), "
    "p AS MATERIALIZED (SELECT * FROM c WHERE speed > 0 AND speed <= 400), "
    "u AS (SELECT season, round, team, driver_id, lap_number, count(*) FILTER (speed > 0 AND speed <= 400) AS valid, 100.0 * count(*) FILTER (speed > 0 AND speed <= 400) / count(*) AS coverage, sum(fixed) AS clipped FROM c GROUP BY ALL)"
)
_PAIRS = (
    "f AS (SELECT *, lap_time_sec - min(lap_time_sec) OVER (PARTITION BY season, round, team, driver_id) AS deficit FROM b_traces), "
    "q0 AS (SELECT a.season, a.round, a.team, a.driver_id, b.driver_id AS other_driver_id, a.lap_number, b.lap_number AS other_lap_number, round(a.deficit + b.deficit + 0.03 * abs(a.lap_number - b.lap_number) + 0.03 * abs(a.tyre_life - b.tyre_life), 9) AS score, "
    f"CASE WHEN a.compound <> b.compound THEN 'different compound' WHEN a.track_status <> '1' OR b.track_status <> '1' THEN 'not green' WHEN abs(a.lap_number - b.lap_number) > {LAPS} THEN 'lap gap' WHEN abs(a.tyre_life - b.tyre_life) > {TYRES} THEN 'tyre gap' END AS reason "
    "FROM f a JOIN f b ON a.season = b.season AND a.round = b.round AND a.team = b.team AND a.driver_id < b.driver_id), "
    "q AS MATERIALIZED (SELECT * FROM q0 QUALIFY row_number() OVER (PARTITION BY season, round, team ORDER BY reason IS NOT NULL, score, lap_number, other_lap_number, driver_id, other_driver_id) = 1)"
)
_ON = "a.season = q.season AND a.round = q.round AND a.team = q.team AND a.driver_id = q.driver_id AND a.lap_number = q.lap_number"
_COMMON = (
    f"{_POINTS}, {_PAIRS}, w AS MATERIALIZED (SELECT q.season, q.round, q.team, a.x, a.speed AS a_speed, b.speed AS b_speed, a.throttle AS a_throttle, b.throttle AS b_throttle, a.brake AS a_brake, b.brake AS b_brake FROM q JOIN p a ON {_ON} "
    "JOIN p b ON b.season = q.season AND b.round = q.round AND b.team = q.team AND b.driver_id = q.other_driver_id AND b.lap_number = q.other_lap_number AND b.x = a.x)"
)
_MEASURES = ["flat_out", "coasting", "braking", "onset_speed", "low_speed"]


def _measures_sql(i: str) -> str:
    share = lambda c: f"sum(dx * ({c})::INT) / sum(dx)"
    return (
        f"{share(f'{i}_throttle >= 99')} AS {i}_flat_out, {share(f'{i}_throttle <= 5 AND {i}_brake = 0')} AS {i}_coasting, {share(f'{i}_brake = 1')} AS {i}_braking, "
        f"quantile_cont({i}_speed, 0.5) FILTER ({i}_on) AS {i}_onset_speed, sum(dx * {i}_speed) FILTER ((a_speed + b_speed) / 2 <= 160) / sum(dx) FILTER ((a_speed + b_speed) / 2 <= 160) AS {i}_low_speed"
    )


def _onset_sql(i: str) -> str:
    return f"{i}_brake = 1 AND sum({i}_brake) OVER b4 = 1 AND min({i}_brake) OVER af = 1 AND min(x) OVER b4 <= x - 50 AND max(x) OVER af >= x + 50 AS {i}_on"


def traces(spark: S, d: str) -> DataFrame:
    return view(spark, d, "b_traces")


def points(spark: S, d: str) -> DataFrame:
    v = F.col("_v")
    channels = {"speed": 200 + 700 * v, "throttle": 50 + 500 * v, "brake": F.when((v < -0.02) & (v > -0.25), 1).otherwise(0)}
    rows = T.opened(traces(spark, d), LAP, "embedding", STEP, "x", channels)
    valid = (F.col("x") >= 0) & (F.col("speed") > 0) & (F.col("speed") <= 400) & F.col("throttle").isNotNull() & F.col("brake").isin(0, 1)
    return T.cleaned(rows, LAP, "x", "seq", CHANNELS, {"throttle": (0.0, 100.0)}, valid)


def _reason() -> Column:
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    return (
        F.when(a("compound") != b("compound"), "different compound").when((a("track_status") != "1") | (b("track_status") != "1"), "not green")
        .when(F.abs(a("lap_number") - b("lap_number")) > LAPS, "lap gap").when(F.abs(a("tyre_life") - b("tyre_life")) > TYRES, "tyre gap")
    )


def pairs(spark: S, d: str) -> DataFrame:
    """The fastest comparable pair of laps of each team and race; where no pair is comparable, the fastest one with its reason."""
    rows = traces(spark, d).drop("embedding")
    rows = rows.withColumn("deficit", F.col("lap_time_sec") - F.min("lap_time_sec").over(Window.partitionBy(*KEY, "driver_id")))
    score = F.round(F.col("a.deficit") + F.col("b.deficit") + 0.03 * F.abs(F.col("a.lap_number") - F.col("b.lap_number")) + 0.03 * F.abs(F.col("a.tyre_life") - F.col("b.tyre_life")), 9)
    best = J.best_pair(rows, KEY, "driver_id", "lap_number", 25, F.when(_reason().isNotNull(), 1).otherwise(0), score).drop("bad", "score")
    a, b = rows.alias("a"), rows.alias("b")
    same = lambda s, o: [F.col(f"q.{k}") == F.col(f"{s}.{k}") for k in KEY] + [F.col(f"q.{o}driver_id") == F.col(f"{s}.driver_id"), F.col(f"q.{o}lap_number") == F.col(f"{s}.lap_number")]
    return best.alias("q").join(a, same("a", "")).join(b, same("b", "other_")).select("q.*", _reason().alias("reason"))


@query(
    f"WITH {_COMMON}, o AS (SELECT *, x - lag(x) OVER k AS dx, {_onset_sql('a')}, {_onset_sql('b')} FROM w WINDOW k AS (PARTITION BY season, round, team ORDER BY x), b4 AS (PARTITION BY season, round, team ORDER BY x RANGE BETWEEN 50 PRECEDING AND CURRENT ROW), af AS (PARTITION BY season, round, team ORDER BY x RANGE BETWEEN CURRENT ROW AND 50 FOLLOWING)), "
    f"m AS (SELECT season, round, team, count(*) AS points, {_measures_sql('a')}, {_measures_sql('b')} FROM o GROUP BY ALL), "
    "g AS (SELECT q.*, coalesce(m.points, 0) AS points, least(ua.coverage, ub.coverage, 100.0 * coalesce(m.points, 0) / greatest(1, least(ua.valid, ub.valid))) AS coverage, CAST(ua.clipped + ub.clipped AS BIGINT) AS clipped, " + ", ".join(f"m.{i}_{c}" for i in "ab" for c in _MEASURES) + " FROM q LEFT JOIN m USING (season, round, team) "
    "JOIN u ua ON ua.season = q.season AND ua.round = q.round AND ua.team = q.team AND ua.driver_id = q.driver_id AND ua.lap_number = q.lap_number JOIN u ub ON ub.season = q.season AND ub.round = q.round AND ub.team = q.team AND ub.driver_id = q.other_driver_id AND ub.lap_number = q.other_lap_number), "
    f"h AS (SELECT * REPLACE (coalesce(reason, CASE WHEN points < {POINTS} THEN 'common points' WHEN coverage < {COVERAGE} THEN 'coverage' END) AS reason) FROM g), "
    "e AS (SELECT season, round, team, driver_id, other_driver_id, lap_number, other_lap_number, points, coverage, clipped, reason, " + ", ".join(f"a_{c} AS {c}, a_{c} - b_{c} AS {c}_delta" for c in _MEASURES) + " FROM h UNION ALL SELECT season, round, team, other_driver_id, driver_id, other_lap_number, lap_number, points, coverage, clipped, reason, " + ", ".join(f"b_{c}, b_{c} - a_{c}" for c in _MEASURES) + " FROM h) "
    "SELECT season, round, team, driver_id, other_driver_id, lap_number, other_lap_number, points, round(coverage, 6) AS coverage, clipped, reason, " + ", ".join(f"CASE WHEN reason IS NULL THEN round({c}{t}, 6) END AS {c}{t}" for c in _MEASURES for t in ("", "_delta")) + " FROM e"
)
def ca64_trace_technique(spark: S, d: str) -> DataFrame:
    return evidence(spark, d)


def evidence(spark: S, d: str) -> DataFrame:
    """Both directions of each pair: its audit, the reason that excludes it, and five measures with their deltas where none does."""
    at, q = points(spark, d), pairs(spark, d)
    m = T.technique(T.common(q, at, KEY, "driver_id", "lap_number", "x", CHANNELS), KEY, "x", full=99.0, coast=5.0, low=160.0, quiet=50, held=50)
    u = T.audited(at, LAP)
    two = T.sides(q, KEY, "driver_id", "lap_number").join(u, LAP).groupBy(*KEY).agg(F.min("coverage").alias("_c"), F.min("valid").alias("_v"), F.sum("clipped").alias("clipped"))
    g = q.join(two, KEY).join(m, KEY, "left").withColumn("points", F.coalesce("points", F.lit(0)))
    g = g.withColumn("coverage", F.least("_c", 100.0 * F.col("points") / F.greatest(F.lit(1), F.col("_v"))))
    g = g.withColumn("reason", F.coalesce("reason", F.when(F.col("points") < POINTS, "common points").when(F.col("coverage") < COVERAGE, "coverage")))
    named = {"driver_id": ("driver_id", "other_driver_id"), "lap_number": ("lap_number", "other_lap_number"), **{c: (f"a_{c}", f"b_{c}") for c in _MEASURES}}
    out = T.both_ways(g, [*KEY, "points", "coverage", "clipped", "reason"], named)
    shown = lambda c: F.when(F.col("reason").isNull(), r6(c))
    return out.select(*KEY, "driver_id", "other_driver_id", "lap_number", "other_lap_number", "points", r6("coverage").alias("coverage"), "clipped", "reason", *[f for c in _MEASURES for f in (shown(F.col(c)).alias(c), shown(F.col(c) - F.col(f"other_{c}")).alias(f"{c}_delta"))])


_SECTORS = ["speed", "throttle", "brake"]


@query(
    f"WITH {_COMMON}, v AS (SELECT *, lag(x) OVER k AS x0, lag(a_speed) OVER k AS a0, lag(b_speed) OVER k AS b0 FROM w WINDOW k AS (PARTITION BY season, round, team ORDER BY x)), "
    'g AS (SELECT season, round, team, CAST(floor(x0 / 100) + 1 AS BIGINT) AS segment, min(x0) AS start, max(x) AS "end", sum(7.2 * (x - x0) / (b_speed + b0)) - sum(7.2 * (x - x0) / (a_speed + a0)) AS gained, ' + ", ".join(f"sum((x - x0) * {i}_{c}) / sum(x - x0) AS {i}_{c}" for i in "ab" for c in _SECTORS) + " FROM v WHERE x0 IS NOT NULL GROUP BY 1, 2, 3, 4) "
    'SELECT g.season, g.round, g.team, segment, start, "end", driver_id, round(gained, 6) AS gained, ' + ", ".join(f"round(a_{c}, 6) AS {c}, round(b_{c}, 6) AS other_{c}" for c in _SECTORS) + " FROM g JOIN q USING (season, round, team) "
    'UNION ALL SELECT g.season, g.round, g.team, segment, start, "end", other_driver_id, round(-gained, 6), ' + ", ".join(f"round(b_{c}, 6), round(a_{c}, 6)" for c in _SECTORS) + " FROM g JOIN q USING (season, round, team)"
)
def ca64_microsectors(spark: S, d: str) -> DataFrame:
    q = pairs(spark, d)
    m = T.microsectors(T.common(q, points(spark, d), KEY, "driver_id", "lap_number", "x", CHANNELS), KEY, "x", 100.0, _SECTORS)
    both = m.join(q, KEY)
    named = {"driver_id": ("driver_id", "other_driver_id"), "time": ("a_time", "b_time"), **{c: (f"a_{c}", f"b_{c}") for c in _SECTORS}}
    out = T.both_ways(both, [*KEY, "segment", "start", "end"], named)
    return out.select(*KEY, "segment", "start", "end", "driver_id", r6(F.col("other_time") - F.col("time")).alias("gained"), *[f for c in _SECTORS for f in (r6(c).alias(c), r6(f"other_{c}").alias(f"other_{c}"))])


@query(
    f"WITH {_POINTS}, {_PAIRS}, s AS (SELECT *, coalesce(7.2 * (x - lag(x) OVER k) / (speed + lag(speed) OVER k), 0) AS dt FROM p WINDOW k AS (PARTITION BY season, round, team, driver_id, lap_number ORDER BY x)), "
    "t AS (SELECT *, sum(dt) OVER (PARTITION BY season, round, team, driver_id, lap_number ORDER BY x ROWS UNBOUNDED PRECEDING) AS t FROM s) "
    f"SELECT q.season, q.round, q.team, a.x, round(b.t - a.t, 6) AS delta FROM q JOIN t a ON {_ON} JOIN t b ON b.season = q.season AND b.round = q.round AND b.team = q.team AND b.driver_id = q.other_driver_id AND b.lap_number = q.other_lap_number AND b.x = a.x"
)
def ca18_distance_delta(spark: S, d: str) -> DataFrame:
    """Speed is integrated on each trace's own samples before they meet."""
    run = T.elapsed(points(spark, d).where("ok"), LAP, "x", "speed", "t")
    both = T.common(pairs(spark, d), run, KEY, "driver_id", "lap_number", "x", ["t"])
    return both.select(*KEY, "x", r6(F.col("b_t") - F.col("a_t")).alias("delta"))


@query(
    "WITH p AS (SELECT season, round, driver_id, lap_number, i, embedding[2 * i + 1]::DOUBLE AS x, embedding[2 * i + 2]::DOUBLE AS y FROM (SELECT *, unnest(range(0, len(embedding) // 2)) AS i FROM b_traces)), "
    "s AS (SELECT *, sqrt((x - lag(x) OVER k) ** 2 + (y - lag(y) OVER k) ** 2) AS step FROM p WINDOW k AS (PARTITION BY season, round, driver_id, lap_number ORDER BY i)), "
    "q AS (SELECT season, round, driver_id, lap_number, round(max(step) + sqrt((arg_max(x, i) - arg_min(x, i)) ** 2 + (arg_max(y, i) - arg_min(y, i)) ** 2) + 1 - least(1, count(*) / 32), 9) AS score FROM s GROUP BY season, round, driver_id, lap_number HAVING count(*) > 1), b AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY season, round ORDER BY score, driver_id, lap_number) = 1) "
    "SELECT season, round, driver_id, lap_number, i, round(coalesce(step, 0), 6) AS step, round(sum(coalesce(step, 0)) OVER (PARTITION BY season, round ORDER BY i ROWS UNBOUNDED PRECEDING), 6) AS length FROM s SEMI JOIN b USING (season, round, driver_id, lap_number)"
)
def ca71_loop(spark: S, d: str) -> DataFrame:
    """Neighbouring elements of an embedding stand for the x and y of a point."""
    rows = T.opened(traces(spark, d), LAP, "embedding", 1, "x", {"v": F.col("_v")}).withColumn("i", F.floor(F.col("seq") / 2))
    side = lambda k: F.max(F.when(F.col("seq") % 2 == k, F.col("v")))
    points = rows.groupBy("season", "round", "driver_id", "lap_number", "i").agg(side(0).alias("x"), side(1).alias("y"))
    best = T.best_loop(points, ["season", "round"], ["driver_id", "lap_number"], "i", "x", "y", 32)
    return best.select("season", "round", "driver_id", "lap_number", "i", r6("step").alias("step"), r6("length").alias("length"))
