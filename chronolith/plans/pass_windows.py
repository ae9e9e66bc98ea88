"""Scored windows of passes: what laps say against what ticks show, where a pair's ticks cover the window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronolith.operators import joins as J, replay as R, replicates as M, sequences as SQ
from chronolith.plans.bindings import dealt
from chronolith.plans.registry import query
from chronolith.plans.replays import _GRID, RACE, STEP
from chronolith.plans.serving import timed

S = SparkSession
PAIR = ["season", "round", "team"]
WINDOW = [*PAIR, "stint"]
LAPS = 8  # of a stint, which is the window of its pair's first driver

# a tick of a car stands for 2 * STEP; every 23rd such stretch of a car is lost
_KEPT = f"(driver_id * 31 + floor(t / {2 * STEP})) % 23 <> 0"
_WINDOWS = (
    f"k AS MATERIALIZED (SELECT season, round, CAST(floor(driver_id / 2) AS BIGINT) AS team, driver_id, driver_id % 2 = 0 AS anchor, t, lap, progress, CAST(floor((lap - 1) / {LAPS}) + 1 AS BIGINT) AS stint FROM g WHERE {_KEPT}), "
    "wi AS (SELECT season, round, team, stint FROM b_timed WHERE driver_id % 2 = 0 GROUP BY ALL), "
    f"sp AS (SELECT season, round, team, stint, min(t) AS start, max(t) AS stop, {LAPS} - count(DISTINCT lap) AS missing FROM k WHERE anchor GROUP BY ALL), "
    "ti AS (SELECT sp.*, k.driver_id, k.t, k.t - lag(k.t) OVER (PARTITION BY sp.season, sp.round, sp.team, sp.stint, k.driver_id ORDER BY k.t) AS gap FROM sp JOIN k ON k.season = sp.season AND k.round = sp.round AND k.team = sp.team AND k.t BETWEEN start AND stop), "
    f"co AS (SELECT season, round, team, stint, driver_id, count(*) >= 2 AND max(gap) <= {2 * STEP} AND min(t) <= any_value(start) + {STEP} AND max(t) >= any_value(stop) - {STEP} AS ok FROM ti GROUP BY ALL), "
    "cv AS (SELECT season, round, team, stint, count(*) FILTER (ok) AS cars FROM co GROUP BY ALL), "
    "ex AS (SELECT season, round, team, lap_number AS lp, up AS label FROM (SELECT a.season, a.round, a.team, a.lap_number, a.end_ms < b.end_ms AS up, lag(a.end_ms < b.end_ms) OVER (PARTITION BY a.season, a.round, a.team ORDER BY a.lap_number) AS was "
    "FROM b_timed a JOIN b_timed b ON a.season = b.season AND a.round = b.round AND a.team = b.team AND a.lap_number = b.lap_number AND a.driver_id % 2 = 0 AND b.driver_id % 2 = 1) WHERE up <> was), "
    "ob AS (SELECT season, round, team, t, lap AS lp, up AS label FROM (SELECT a.season, a.round, a.team, a.t, a.lap, a.progress > b.progress AS up, lag(a.progress > b.progress) OVER (PARTITION BY a.season, a.round, a.team ORDER BY a.t) AS was "
    "FROM k a JOIN k b ON a.season = b.season AND a.round = b.round AND a.team = b.team AND a.t = b.t AND a.anchor AND NOT b.anchor) WHERE up <> was), "
)
_MISSING = f"CASE WHEN sp.season IS NULL THEN {LAPS} ELSE missing END"


@query(
    f"WITH RECURSIVE {_GRID}, {_WINDOWS} "
    f"e2 AS (SELECT *, CAST(floor((lp - 1) / {LAPS}) + 1 AS BIGINT) AS stint FROM ex), o2 AS (SELECT *, CAST(floor((lp - 1) / {LAPS}) + 1 AS BIGINT) AS stint FROM ob), "
    "ca AS MATERIALIZED (SELECT e2.season, e2.round, e2.team, e2.stint, e2.lp AS i, o2.t AS j FROM e2 JOIN o2 ON e2.season = o2.season AND e2.round = o2.round AND e2.team = o2.team AND e2.stint = o2.stint AND e2.label = o2.label AND abs(e2.lp - o2.lp) <= 1), "
    "lv AS (SELECT *, 1 AS k FROM ca UNION ALL SELECT DISTINCT c.*, lv.k + 1 FROM lv JOIN ca c ON c.season = lv.season AND c.round = lv.round AND c.team = lv.team AND c.stint = lv.stint AND c.i > lv.i AND c.j > lv.j), "
    "m AS (SELECT season, round, team, stint, max(k) AS matched FROM lv GROUP BY ALL), ne AS (SELECT season, round, team, stint, count(*) AS n FROM e2 GROUP BY ALL), no AS (SELECT season, round, team, stint, count(*) AS n FROM o2 GROUP BY ALL) "
    f"SELECT wi.season, wi.round, wi.team, wi.stint, CAST({_MISSING} AS BIGINT) AS missing_laps, coalesce(cars, 0) = 2 AS covered_ticks, coalesce(ne.n, 0) AS expected, coalesce(no.n, 0) AS observed, "
    f"CASE WHEN {_MISSING} > 0 THEN 'missing anchor laps' WHEN coalesce(cars, 0) < 2 THEN 'incomplete pair ticks' END AS unscored, CASE WHEN {_MISSING} = 0 AND cars = 2 THEN CAST(coalesce(matched, 0) AS BIGINT) END AS matched "
    "FROM wi LEFT JOIN sp USING (season, round, team, stint) LEFT JOIN cv USING (season, round, team, stint) LEFT JOIN ne USING (season, round, team, stint) LEFT JOIN no USING (season, round, team, stint) LEFT JOIN m USING (season, round, team, stint)"
)
def dq18_scored_windows(spark: S, d: str) -> DataFrame:
    """A row a window: laps that the anchor's ticks lack, whether both cars' ticks cover it, expected and observed passes, and the matched ones where it is covered."""
    # laps are made once and dealt by their pair, which all windows and groups below keep to
    laps = dealt(spark, d, M.kept(timed(spark, d).select(*PAIR, "driver_id", "lap_number", "stint", "lap_ms", "start_ms", "end_ms"), "laps"), *PAIR)
    stint = lambda lap: (F.floor((F.col(lap) - 1) / LAPS) + 1).alias("stint")
    ticks = R.grid(laps, RACE, "driver_id", STEP, ["team"]).where(F.expr(_KEPT)).select(*PAIR, "driver_id", "t", "lap", "progress", stint("lap"))
    anchor, other = F.col("driver_id") % 2 == 0, F.col("driver_id") % 2 == 1
    windows = laps.where(anchor).select(*WINDOW).distinct()
    spans = ticks.where(anchor).groupBy(*WINDOW).agg(F.min("t").alias("start"), F.max("t").alias("stop"), (LAPS - F.count_distinct("lap")).alias("missing_laps"))
    # an anchor's stints follow each other, so a tick lies in the last one that has begun, or in none
    pair = J.asof(ticks.select(*PAIR, "driver_id", "t"), spans.select(*WINDOW, F.col("start").alias("t"), "start", "stop"), PAIR, "t", ["stint", "start", "stop"])
    cars = SQ.covered(pair, [*WINDOW, "driver_id"], "t", "start", "stop", STEP, 2 * STEP).groupBy(*WINDOW).agg(F.count_if("covered").alias("_cars"))

    side = lambda mine, c: F.max(F.when(mine, F.col(c)))  # noqa: E731  a pair has one car of each side
    ends = laps.groupBy(*PAIR, F.col("lap_number").alias("at")).agg(side(anchor, "end_ms").alias("_a"), side(other, "end_ms").alias("_b")).where("_a is not null and _b is not null")
    truth = SQ.exchanges(ends, PAIR, "at", F.col("_a") < F.col("_b"), "label").select(*PAIR, stint("at"), "label", "at", F.col("at").alias("t"))
    both = ticks.groupBy(*PAIR, "t").agg(side(anchor, "lap").alias("at"), side(anchor, "progress").alias("_a"), side(other, "progress").alias("_b")).where("_a is not null and _b is not null")
    found = SQ.exchanges(both, PAIR, "t", F.col("_a") > F.col("_b"), "label").select(*PAIR, stint("at"), "label", "at", "t")
    scored = SQ.sequence_matches(truth, found, WINDOW, "label", "at", 1, ties=["t"])

    out = windows.join(spans, WINDOW, "left").join(cars, WINDOW, "left").join(scored, WINDOW, "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    out = out.select(*WINDOW, F.coalesce("missing_laps", F.lit(LAPS).cast("long")).alias("missing_laps"), (zero("_cars") == 2).alias("covered_ticks"), zero("truth").alias("expected"), zero("found").alias("observed"), zero("matched").alias("_m"))
    reason = F.when(F.col("missing_laps") > 0, "missing anchor laps").when(~F.col("covered_ticks"), "incomplete pair ticks")
    return out.withColumn("unscored", reason).withColumn("matched", F.when(reason.isNull(), F.col("_m"))).drop("_m")
