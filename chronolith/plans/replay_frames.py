"""The whole replay as a query: fixes, laps, and recorded orders and gaps that come as a feed of changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from chronolith.operators import replay_frame as RF
from chronolith.plans.bindings import view
from chronolith.plans.registry import query
from chronolith.plans.serving import timed

S = SparkSession
RACE, CAR = ["season", "round"], ["season", "round", "driver_id"]
STEP, LEAST, MAX_GAP, BUFFER, LINGER, MAX_AGE = 60_000, 0.6, 90_000, 60_000, 120_000, 180_000
# the whole order every ten minutes, a third of the cars four minutes later; gaps every two minutes, a fifth of them lost
_ORDER, _GAP = "t % 600000 = 0 OR (t % 600000 = 240000 AND driver_id % 3 = 0)", f"t % 120000 = 0 AND (driver_id * 7 + floor(t / {STEP})) % 5 <> 0"
r6 = lambda c: F.round(c, 6)

_STATE = (
    "ga AS (SELECT season, round FROM (SELECT season, round, median(a) AS a, median(z) AS z FROM (SELECT season, round, driver_id, min(t) AS a, max(t) AS z FROM b_fixes GROUP BY ALL) GROUP BY ALL) JOIN (SELECT season, round, min(start_ms) AS s, max(end_ms) AS e FROM b_timed GROUP BY ALL) USING (season, round) "
    f"WHERE greatest(least(z, e) - greatest(a, s), 0) / (e - s) >= {LEAST}), "
    "fx AS MATERIALIZED (SELECT * FROM b_fixes SEMI JOIN ga USING (season, round)), la AS MATERIALIZED (SELECT * FROM b_timed SEMI JOIN ga USING (season, round)), ro AS (SELECT DISTINCT season, round, driver_id FROM fx), "
    "en AS (SELECT season, round, driver_id, max(end_ms) AS finish, max(lap_number) AS l FROM la GROUP BY ALL), zz AS (SELECT season, round, max(end_ms) AS z FROM la GROUP BY ALL), "
    f"l0 AS (SELECT la.*, finish, unnest(range(CAST(ceil(start_ms / {STEP}) AS BIGINT), CASE WHEN lap_number = l THEN CAST(floor(z / {STEP}) AS BIGINT) + 1 ELSE CAST(ceil(end_ms / {STEP}) AS BIGINT) END)) * {STEP} AS t FROM la JOIN en USING (season, round, driver_id) JOIN zz USING (season, round)), "
    "ls AS MATERIALIZED (SELECT season, round, driver_id, t, lap_number AS lap, least(1, (t - start_ms) / lap_ms) AS inside, lap_number - 1 + least(1, (t - start_ms) / lap_ms) AS progress, finish, stint, compound, tyre_life FROM l0), "
    "rk AS MATERIALIZED (SELECT season, round, driver_id, t, row_number() OVER w AS position, round((max(progress) OVER (PARTITION BY season, round, t) - progress) * 90, 3) AS gl, round(coalesce(lag(progress) OVER w - progress, 0) * 90, 3) AS ga FROM ls SEMI JOIN ro USING (season, round, driver_id) WINDOW w AS (PARTITION BY season, round, t ORDER BY round(progress, 9) DESC, finish, driver_id)), "
    f"re AS MATERIALIZED (SELECT season, round, driver_id, t, position FROM rk WHERE {_ORDER}), iv AS (SELECT season, round, driver_id, t, gl, ga FROM rk WHERE {_GAP}), "
)
_C = "PARTITION BY season, round, driver_id"
_TICKS = (
    f"a1 AS (SELECT *, CASE WHEN lag(x) OVER k IS NULL OR sqrt((x - lag(x) OVER k) ** 2 + (y - lag(y) OVER k) ** 2) > 1 THEN 1 ELSE 0 END AS f FROM fx WINDOW k AS ({_C} ORDER BY t)), a2 AS (SELECT *, sum(f) OVER ({_C} ORDER BY t) AS run FROM a1), "
    "a3 AS (SELECT season, round, driver_id, run, min(t) AS a, max(t) AS z, arg_min(x, t) AS x, arg_min(y, t) AS y FROM a2 GROUP BY ALL), "
    f"a4 AS (SELECT *, run = max(run) OVER ({_C}) AS last, min(a) OVER ({_C}) AS raw_a, max(z) OVER ({_C}) AS raw_z, max(a) OVER ({_C}) AS moved FROM a3), "
    f"a5 AS (SELECT *, CASE WHEN last THEN a ELSE (a + z) / 2 END AS p FROM a4), a6 AS (SELECT a5.*, finish, lead(p) OVER k AS n, lead(x) OVER k AS nx, lead(y) OVER k AS ny, row_number() OVER k = 1 AS fst FROM a5 JOIN en USING (season, round, driver_id) WINDOW k AS ({_C} ORDER BY p)), "
    f"a7 AS (SELECT *, unnest(range(CAST(ceil(CASE WHEN fst THEN raw_a ELSE p END / {STEP}) AS BIGINT), CAST(least(CASE WHEN last THEN floor(raw_z / {STEP}) ELSE ceil(n / {STEP}) - 1 END, floor(least(raw_z, moved + {BUFFER}, finish + {LINGER}) / {STEP})) AS BIGINT) + 1)) * {STEP} AS t FROM a6), "
    f"tx AS MATERIALIZED (SELECT season, round, driver_id, t, CASE WHEN last OR t <= p THEN x ELSE x + (t - p) / (n - p) * (nx - x) END AS x, CASE WHEN last OR t <= p THEN y ELSE y + (t - p) / (n - p) * (ny - y) END AS y FROM a7 WHERE last OR t <= p OR n - p <= {MAX_GAP}), "
)
_ESTIMATE = (
    "g AS MATERIALIZED (SELECT a.season, a.round, a.driver_id, a.t, a.x, a.y, l.lap, l.inside, l.progress, l.finish, l.stint, l.compound, l.tyre_life FROM tx a LEFT JOIN ls l ON a.season = l.season AND a.round = l.round AND a.driver_id = l.driver_id AND a.t = l.t), "
    "m AS (SELECT season, round, t, max(p) OVER (PARTITION BY season, round ORDER BY t) AS p FROM (SELECT season, round, t, max(progress) AS p FROM g WHERE progress IS NOT NULL GROUP BY 1, 2, 3)), v AS MATERIALIZED (SELECT season, round, p, min(t) AS f FROM m GROUP BY 1, 2, 3), t0 AS (SELECT season, round, min(t) AS t0 FROM m GROUP BY ALL), "
    "e1 AS (SELECT g.*, CASE WHEN g.progress IS NOT NULL THEN coalesce(greatest(g.t - CASE WHEN b1.p = g.progress THEN b1.f ELSE b1.f + (g.progress - b1.p) / (b2.p - b1.p) * (b2.f - b1.f) END, 0), g.t - t0) END AS gap FROM g LEFT JOIN t0 USING (season, round) ASOF LEFT JOIN v b1 ON g.season = b1.season AND g.round = b1.round AND g.progress >= b1.p ASOF LEFT JOIN v b2 ON g.season = b2.season AND g.round = b2.round AND g.progress <= b2.p), "
    f"e2 AS (SELECT * REPLACE (CASE WHEN t >= finish THEN arg_min(gap, t) FILTER (t >= finish) OVER ({_C}) ELSE gap END AS gap), count(progress) OVER (PARTITION BY season, round, t) = count(*) OVER (PARTITION BY season, round, t) AS whole FROM e1), "
    "e3 AS (SELECT *, row_number() OVER w AS rk, lag(gap) OVER w AS g0 FROM e2 WINDOW w AS (PARTITION BY season, round, t ORDER BY round(progress, 9) DESC, finish, driver_id)), "
    "e4 AS (SELECT * EXCLUDE (rk, g0, whole, gap), CASE WHEN whole THEN rk END AS place, CASE WHEN whole THEN gap END AS gap, CASE WHEN whole THEN CASE WHEN rk = 1 THEN 0 ELSE greatest(gap - g0, 0) END END AS ahead FROM e3), "
)
# the recorded order by what each car of the roster holds at each tick
_RECORDED = (
    "tk AS (SELECT DISTINCT season, round, t FROM g), rt AS (SELECT tk.season, tk.round, tk.t, ro.driver_id FROM tk JOIN ro ON ro.season = tk.season AND ro.round = tk.round), "
    "rp AS (SELECT rt.*, re.position, re.t AS seen FROM rt ASOF LEFT JOIN re ON rt.season = re.season AND rt.round = re.round AND rt.driver_id = re.driver_id AND rt.t >= re.t), "
    "co AS (SELECT season, round, t, count(position) = count(*) AND count(DISTINCT position) = count(*) AND max(position) = count(*) AS coherent FROM rp GROUP BY ALL), "
    f"ch AS (SELECT DISTINCT season, round, t FROM (SELECT *, lag(position) OVER ({_C} ORDER BY t) AS old FROM re) WHERE position IS DISTINCT FROM old), ep AS (SELECT tk.*, ch.t AS epoch FROM tk ASOF LEFT JOIN ch ON tk.season = ch.season AND tk.round = ch.round AND tk.t >= ch.t), "
    "f1 AS (SELECT e4.*, rp.position, rp.seen, co.coherent, ep.epoch FROM e4 JOIN rp USING (season, round, driver_id, t) JOIN co USING (season, round, t) JOIN ep USING (season, round, t)), "
    "f2 AS (SELECT f1.*, iv.t AS it, iv.gl, iv.ga FROM f1 ASOF LEFT JOIN iv ON f1.season = iv.season AND f1.round = iv.round AND f1.driver_id = iv.driver_id AND f1.t >= iv.t), "
    "f3 AS (SELECT *, row_number() OVER w AS dense, lag(position) OVER w AS before FROM f2 WINDOW w AS (PARTITION BY season, round, t ORDER BY position)), "
    f"f4 AS (SELECT *, coherent AND (position = 1 OR coalesce(before = position - 1 AND it >= epoch AND t - it <= {MAX_AGE} AND gl >= 0 AND ga >= 0, false)) AS fresh FROM f3) "
)


@query(
    f"WITH {_STATE}{_TICKS}{_ESTIMATE}{_RECORDED} SELECT season, round, driver_id, t, round(x, 3) AS x, round(y, 3) AS y, lap, round(inside, 6) AS inside, stint, compound, tyre_life, CASE WHEN coherent THEN dense ELSE place END AS place, "
    "round(CASE WHEN fresh THEN CASE WHEN position = 1 THEN 0 ELSE gl END ELSE gap / 1000 END, 3) AS gap, round(CASE WHEN fresh THEN CASE WHEN position = 1 THEN 0 ELSE ga END ELSE ahead / 1000 END, 3) AS ahead, "
    "CASE WHEN coherent THEN 'recorded' WHEN place IS NOT NULL THEN 'estimate' END AS place_source, CASE WHEN coherent THEN seen END AS place_seen, CASE WHEN fresh THEN 'recorded' WHEN gap IS NOT NULL THEN 'estimate' END AS gap_source, CASE WHEN fresh THEN CASE WHEN position = 1 THEN seen ELSE it END END AS gap_seen FROM f4"
)
def ca37_replay_frame(spark: S, d: str) -> DataFrame:
    """Gate, supported positions, lap state, estimated order and gaps, recorded order and gaps with their sources."""
    laps, fixes = timed(spark, d).checkpoint(), view(spark, d, "b_fixes").checkpoint()
    state = RF.lap_state(laps, RACE, "driver_id", STEP, []).join(RF.gate(fixes, laps, RACE, "driver_id", LEAST), RACE, "left_semi").join(fixes.select(*CAR).distinct(), CAR, "left_semi")
    tick = Window.partitionBy(*RACE, "t")
    order = tick.orderBy(F.round("progress", 9).desc(), "finish", "driver_id")
    to = lambda c: F.round(c * 90, 3) * 1000
    feed = state.select(*CAR, "t", F.row_number().over(order).cast("long").alias("position"), to(F.max("progress").over(tick) - F.col("progress")).alias("gap_leader"), to(F.coalesce(F.lag("progress").over(order) - F.col("progress"), F.lit(0.0))).alias("gap_ahead")).checkpoint()
    out = RF.frame(fixes, laps, feed.where(F.expr(_ORDER)).select(*CAR, "t", "position"), feed.where(F.expr(_GAP)).select(*CAR, "t", "gap_leader", "gap_ahead"), RACE, "driver_id", STEP, ["stint", "compound", "tyre_life"], least=LEAST, max_gap=MAX_GAP, buffer=BUFFER, linger=LINGER, max_age=MAX_AGE)
    second = lambda c: F.round(F.col(c) / 1000, 3).alias(c)
    return out.select(*CAR, "t", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), "lap", r6("inside").alias("inside"), "stint", "compound", "tyre_life", "place", second("gap"), second("ahead"), "place_source", "place_seen", "gap_source", "gap_seen")
