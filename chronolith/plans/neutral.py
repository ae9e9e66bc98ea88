"""Neutralisation queries: intervals, transitions, checkpoints, recovery, losses, savings and impact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from chronolith.operators import bootstrap as B, evidence as E, neutral as N, windows as W
from chronolith.plans.bindings import table
from chronolith.plans.pits import _BOUNDS, bounds
from chronolith.plans.registry import query
from chronolith.plans.serving import timed

S = SparkSession
RACE, DRIVER, LAP = ["season", "round"], ["season", "round", "driver_id"], ["season", "round", "driver_id", "lap_number"]
r6 = lambda c: F.round(c, 6)

_KINDS = "k AS (SELECT user_id, event_id, epoch_us(ts) // 1000000 AS t, CASE WHEN event_type IN ('error', 'signup') THEN 'SC' WHEN event_type = 'view' THEN 'VSC' ELSE 'RED' END AS kind, CASE WHEN event_type IN ('error', 'purchase', 'view') THEN 'start' ELSE 'end' END AS edge FROM events), i AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS i FROM k)"


@query(
    f"WITH {_KINDS}, o AS (SELECT *, lead(i) OVER w AS oi, lead(t) OVER w AS ot, lead(edge) OVER w AS oe FROM i WINDOW w AS (PARTITION BY user_id, kind ORDER BY i)), s AS (SELECT o.*, (SELECT min(x.i) FROM i x WHERE x.user_id = o.user_id AND x.edge = 'start' AND x.i > o.i AND (o.kind = 'SC' AND x.kind IN ('RED', 'VSC') OR o.kind = 'VSC' AND x.kind IN ('RED', 'SC'))) AS si FROM o WHERE edge = 'start'), "
    "q AS (SELECT s.*, x.t AS st FROM s LEFT JOIN i x ON x.user_id = s.user_id AND x.i = s.si), z AS (SELECT user_id, kind, t AS start, CASE WHEN oi IS NOT NULL AND (si IS NULL OR oi < si) THEN ot ELSE st END AS \"end\", CASE WHEN oi IS NOT NULL AND (si IS NULL OR oi < si) THEN CASE WHEN oe = 'end' THEN 'complete' ELSE 'interrupted' END WHEN si IS NOT NULL THEN 'interrupted' ELSE 'unclosed' END AS status FROM q) "
    "SELECT * FROM z WHERE NOT (status = 'complete' AND \"end\" = start)"
)
def ca54_neutralisations(spark: S, d: str) -> DataFrame:
    e = F.col("event_type")
    kind = F.when(e.isin("error", "signup"), "SC").when(e == "view", "VSC").otherwise("RED")
    edge = F.when(e.isin("error", "purchase", "view"), "start").otherwise("end")
    marks = table(spark, d, "events").select("user_id", "event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"), kind.alias("kind"), edge.alias("edge"))
    return N.neutralisations(marks, ["user_id"], ["t", "event_id"], "t", "kind", "edge", {"SC": ["RED", "VSC"], "VSC": ["RED", "SC"]})


@query(f"WITH {_BOUNDS} SELECT user_id, t AS entered, (SELECT min(o.t) FROM b o WHERE o.user_id = b.user_id AND o.edge = 'out' AND o.t > b.t AND o.t - b.t <= 172800) AS \"left\" FROM b WHERE edge = 'in'")
def ca55_transitions(spark: S, d: str) -> DataFrame:
    b = bounds(spark, d)
    out = N.first_later(b.where("edge = 'in'").select("user_id", "t"), b.where("edge = 'out'").select("user_id", "t"), ["user_id"], "t", 172800, "left")
    return out.select("user_id", F.col("t").alias("entered"), "left")


_EVENTS = (
    "ev AS (SELECT season, round, CAST(row_number() OVER (PARTITION BY season, round ORDER BY a) AS BIGINT) AS event, a, z FROM (SELECT season, round, min(start_ms) AS a, max(end_ms) AS z FROM (SELECT *, sum(f) OVER (PARTITION BY season, round ORDER BY lap_number) AS run FROM "
    "(SELECT *, CASE WHEN track_status IS DISTINCT FROM lag(track_status) OVER (PARTITION BY season, round ORDER BY lap_number) THEN 1 ELSE 0 END AS f FROM b_timed WHERE driver_id = 0)) WHERE track_status = '4' GROUP BY season, round, run))"
)


def race_events(spark: S, d: str) -> DataFrame:
    """Stretches of marked laps of the reference car: the events of a race."""
    ref = timed(spark, d).where("driver_id = 0")
    w = Window.partitionBy(*RACE).orderBy("lap_number")
    runs = W.islands(ref, RACE, ["lap_number"], ~F.col("track_status").eqNullSafe(F.lag("track_status").over(w)), "run").where("track_status = '4'").groupBy(*RACE, "run").agg(F.min("start_ms").alias("a"), F.max("end_ms").alias("z"))
    return runs.select(*RACE, F.row_number().over(Window.partitionBy(*RACE).orderBy("a")).cast("long").alias("event"), "a", "z")


_CURVE = "cu AS (SELECT season, round, driver_id, CAST(0 AS DOUBLE) AS t, CAST(0 AS DOUBLE) AS p FROM b_timed WHERE lap_number = 1 UNION ALL SELECT season, round, driver_id, CAST(end_ms AS DOUBLE), CAST(lap_number AS DOUBLE) FROM b_timed)"
_POINTS = (
    f"{_EVENTS}, {_CURVE}, ti AS (SELECT season, round, event, 'start' AS kind, CAST(a AS DOUBLE) AS t FROM ev UNION ALL SELECT season, round, event, 'end', z FROM ev UNION ALL SELECT season, round, event, 'after', z + 30000 FROM ev), ask AS (SELECT ti.*, driver_id FROM ti JOIN (SELECT DISTINCT season, round, driver_id FROM b_timed) USING (season, round)), "
    "v AS (SELECT ask.*, CASE WHEN x.t = ask.t THEN x.p ELSE x.p + (ask.t - x.t) / (y.t - x.t) * (y.p - x.p) END AS p FROM ask ASOF LEFT JOIN cu x ON x.season = ask.season AND x.round = ask.round AND x.driver_id = ask.driver_id AND ask.t >= x.t ASOF LEFT JOIN cu y ON y.season = ask.season AND y.round = ask.round AND y.driver_id = ask.driver_id AND ask.t <= y.t), "
    "pt AS MATERIALIZED (SELECT season, round, event, kind, driver_id, t, CASE WHEN count(p) OVER w = count(*) OVER w THEN p END AS progress FROM v WINDOW w AS (PARTITION BY season, round, event, kind))"
)


def points(spark: S, d: str) -> DataFrame:
    t = timed(spark, d)
    curve = t.where("lap_number = 1").select(*DRIVER, F.lit(0.0).alias("t"), F.lit(0.0).alias("progress")).unionByName(t.select(*DRIVER, F.col("end_ms").cast("double").alias("t"), F.col("lap_number").cast("double").alias("progress")))
    return N.checkpoints(race_events(spark, d), curve, RACE, "event", "driver_id", {"start": F.col("a"), "end": F.col("z"), "after": F.col("z") + 30000})


@query(f"WITH {_POINTS} SELECT season, round, event, kind, driver_id, round(progress, 6) AS progress FROM pt")
def ca56_checkpoints(spark: S, d: str) -> DataFrame:
    return points(spark, d).select(*RACE, "event", "kind", "driver_id", r6("progress").alias("progress"))


@query(
    f"WITH {_EVENTS}, r AS (SELECT *, track_status = '1' AND lead(track_status) OVER w = '1' AS ok, lead(end_ms) OVER w AS until FROM b_timed WHERE driver_id = 0 WINDOW w AS (PARTITION BY season, round ORDER BY start_ms)) "
    "SELECT season, round, event, (SELECT arg_min(until, start_ms) FROM r WHERE r.season = ev.season AND r.round = ev.round AND ok AND r.start_ms >= ev.z) AS recovery FROM ev"
)
def ca57_recovery(spark: S, d: str) -> DataFrame:
    ref = timed(spark, d).where("driver_id = 0")
    return N.recovered(ref, race_events(spark, d), RACE, "z", F.col("track_status") == "1").select(*RACE, "event", "recovery")


@query(
    f"WITH {_POINTS}, l AS (SELECT season, round, event, driver_id, max(progress) OVER (PARTITION BY season, round, event) - progress AS behind FROM pt WHERE kind = 'start') "
    "SELECT season, round, event, driver_id, CASE WHEN round(behind, 9) - floor(round(behind, 9)) BETWEEN 0.02 AND 0.98 THEN CAST(floor(round(behind, 9)) AS BIGINT) END AS deficit FROM l"
)
def ca58_lap_deficit(spark: S, d: str) -> DataFrame:
    lead = F.max("progress").over(Window.partitionBy(*RACE, "event"))
    start = points(spark, d).where("kind = 'start'").withColumn("behind", F.round(lead - F.col("progress"), 9))
    return start.select(*RACE, "event", "driver_id", N.lap_deficit(F.col("behind"), F.lit(0.0)).alias("deficit"))


_LOSS = "lo AS (SELECT s.season, s.round, s.driver_id, s.lap_number, s.track_status, s.lap_ms - m AS loss, peers FROM b_timed s JOIN (SELECT season, round, lap_number, median(lap_ms) AS m, count(*) AS peers FROM b_timed WHERE speed >= 10 AND track_status = '1' GROUP BY 1, 2, 3) USING (season, round, lap_number) WHERE speed < 5)"


def losses(spark: S, d: str) -> DataFrame:
    """Slow laps stand for stops; their peers are the green laps of the same number that are not slow."""
    return N.pit_loss(timed(spark, d), RACE, "lap_number", "driver_id", F.col("speed") < 5, (F.col("speed") >= 10) & (F.col("track_status") == "1"), F.col("lap_ms"))


@query(f"WITH {_LOSS} SELECT season, round, driver_id, lap_number, round(loss, 3) AS loss, peers FROM lo")
def ca59_pit_loss(spark: S, d: str) -> DataFrame:
    return losses(spark, d).select(*LAP, F.round("loss", 3).alias("loss"), "peers")


@query(
    f"WITH {_LOSS}, n AS (SELECT season, median(loss) AS m FROM lo WHERE track_status = '1' GROUP BY 1), a AS (SELECT lo.season, round, m - loss AS saving FROM lo JOIN n USING (season) WHERE track_status = '4'), g AS (SELECT season, median(saving) AS saving, count(*) AS n FROM a GROUP BY 1), d AS (SELECT season, median(abs(a.saving - g.saving)) AS mad FROM a JOIN g USING (season) GROUP BY 1), "
    "c AS (SELECT season, round, median(saving) AS m, row_number() OVER (PARTITION BY season ORDER BY round) - 1 AS k, count(*) OVER (PARTITION BY season) AS n FROM a GROUP BY 1, 2), i AS (SELECT season, r, CAST('0x' || substr(md5(concat_ws('|', '7', r, season, slot)), 1, 8) AS BIGINT) % n AS k FROM (SELECT season, k AS slot, n, unnest(range(1000)) AS r FROM c)), "
    "b AS (SELECT i.season, i.r, median(m) AS m FROM i JOIN c USING (season, k) GROUP BY 1, 2) SELECT b.season, any_value(g.n) AS n, round(any_value(g.saving), 4) AS saving, any_value(mad) <= 4000 AS accepted, round(quantile_cont(b.m, 0.05) - 1000, 4) AS low, round(quantile_cont(b.m, 0.95) + 1000, 4) AS high FROM b JOIN g USING (season) JOIN d USING (season) GROUP BY b.season"
)
def ca60_pit_saving(spark: S, d: str) -> DataFrame:
    lo = losses(spark, d)
    normal = lo.where("track_status = '1'").groupBy("season").agg(F.percentile("loss", 0.5).alias("m"))
    a = lo.where("track_status = '4'").join(normal, "season").withColumn("saving", F.col("m") - F.col("loss"))
    spread = a.join(a.groupBy("season").agg(F.percentile("saving", 0.5).alias("_s")), "season").groupBy("season").agg(F.percentile(F.abs(F.col("saving") - F.col("_s")), 0.5).alias("mad"))
    drawn = B.cluster_bootstrap_median(a, "season", ["round"], "saving")
    # a second of resolution on either side
    return drawn.join(spread, "season").select("season", "n", F.round("median", 4).alias("saving"), (F.col("mad") <= 4000).alias("accepted"), F.round(F.col("low") - 1000, 4).alias("low"), F.round(F.col("high") + 1000, 4).alias("high"))


_IMPACT = (
    f"{_POINTS}, w AS (SELECT season, round, event, driver_id, max(progress) FILTER (kind = 'start') AS s, max(progress) FILTER (kind = 'after') AS f FROM pt GROUP BY 1, 2, 3, 4), ch AS (SELECT *, f - s AS moved FROM w), "
    "im AS (SELECT *, CASE WHEN moved IS NOT NULL THEN moved - median(moved) OVER (PARTITION BY season, round, event) END AS gained, CASE WHEN s IS NULL THEN 'no start' WHEN f IS NULL THEN 'no end' ELSE 'eligible' END AS eligibility FROM ch)"
)


def impact(spark: S, d: str) -> DataFrame:
    """Progress before and after each event, the change against the field's median, and why a component is missing."""
    w = points(spark, d).groupBy(*RACE, "event", "driver_id").agg(F.max(F.when(F.col("kind") == "start", F.col("progress"))).alias("s"), F.max(F.when(F.col("kind") == "after", F.col("progress"))).alias("f"))
    w = w.withColumn("moved", F.col("f") - F.col("s"))
    out = E.centred(w, [*RACE, "event"], "moved", F.col("moved").isNotNull(), "gained")
    return out.withColumn("eligibility", F.when(F.col("s").isNull(), "no start").when(F.col("f").isNull(), "no end").otherwise("eligible"))


@query(f"WITH {_IMPACT} SELECT season, round, event, driver_id, round(moved, 6) AS moved, round(gained, 6) AS gained, eligibility FROM im")
def ca61_impact(spark: S, d: str) -> DataFrame:
    return impact(spark, d).select(*RACE, "event", "driver_id", r6("moved").alias("moved"), r6("gained").alias("gained"), "eligibility")


_EFFECTS = (
    f"{_IMPACT}, ef AS (SELECT season, round, event, driver_id, 'moved' AS effect, round(moved, 9) AS value, abs(round(moved, 9)) >= 2.0 AS material FROM im WHERE moved IS NOT NULL UNION ALL SELECT season, round, event, driver_id, 'gained', round(gained, 9), abs(round(gained, 9)) >= 0.05 FROM im WHERE gained IS NOT NULL), "
    "st AS (SELECT season, round, event, driver_id, CASE WHEN count(*) FILTER (material) = 2 THEN 'decisive' WHEN count(*) FILTER (material) = 1 THEN 'notable' ELSE 'minor' END AS story, count(*) FILTER (material) AS m, max(abs(value)) FILTER (effect = 'gained') AS g FROM ef GROUP BY 1, 2, 3, 4)"
)


def stories(spark: S, d: str) -> DataFrame:
    ident = [*RACE, "event", "driver_id"]
    rows = impact(spark, d).select(*ident, F.round("moved", 9).alias("moved"), F.round("gained", 9).alias("gained"))
    ef = N.effects(rows, ident, {"moved": 2.0, "gained": 0.05})
    m = F.count_if("material")
    st = ef.groupBy(*ident).agg(m.alias("m"), F.when(m == 2, "decisive").when(m == 1, "notable").otherwise("minor").alias("story"), F.max(F.when(F.col("effect") == "gained", F.abs("value"))).alias("g"))
    w = Window.partitionBy(*RACE, "event").orderBy(F.desc("m"), F.desc_nulls_last("g"), "driver_id")
    return st.withColumn("focus", F.row_number().over(w).cast("long"))


@query(f"WITH {_EFFECTS} SELECT season, round, event, driver_id, story, CAST(row_number() OVER (PARTITION BY season, round, event ORDER BY m DESC, g DESC NULLS LAST, driver_id) AS BIGINT) AS focus FROM st")
def ca62_effects(spark: S, d: str) -> DataFrame:
    return stories(spark, d).select(*RACE, "event", "driver_id", "story", "focus")


@query(f"WITH {_EFFECTS} SELECT 'events' AS output, count(*) AS rows FROM ev UNION ALL SELECT 'checkpoints', count(*) FROM pt UNION ALL SELECT 'impact', count(*) FILTER (eligibility = 'eligible') FROM im UNION ALL SELECT 'stories', count(*) FILTER (story <> 'minor') FROM st")
def ca63_end_to_end(spark: S, d: str) -> DataFrame:
    n = lambda df, name: df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("output"), "rows")
    return n(race_events(spark, d), "events").unionByName(n(points(spark, d), "checkpoints")).unionByName(n(impact(spark, d).where("eligibility = 'eligible'"), "impact")).unionByName(n(stories(spark, d).where("story <> 'minor'"), "stories"))
