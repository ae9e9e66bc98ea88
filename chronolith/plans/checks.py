"""Data-quality queries: coverage, invariants, contracts, receipts, reconciliation and validation reports."""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from chronolith.functions import columns as C
from chronolith.operators import evidence as E, joins as J, quality as Q, replicates as M, robust as R, sequences as SQ, windows as W
from chronolith.plans.basics import laps
from chronolith.plans.bindings import dealt, table, view
from chronolith.plans.registry import query
from chronolith.plans.replays import _BATTLES, _GRID, battles, grid
from chronolith.plans.serving import timed
from chronolith.sources import partitions as P

S = SparkSession
RACE, DRIVER, LAP = ["season", "round"], ["season", "round", "driver_id"], ["season", "round", "driver_id", "lap_number"]
STINT = ["season", "round", "driver_id", "stint"]
r6 = lambda c: F.round(c, 6)


def rules(spark: S, *named: tuple[str, DataFrame]) -> DataFrame:
    """One row a rule with the number of rows that break it."""
    return Q.report(*[df.agg(F.count("*").alias("violations")).select(F.lit(name).alias("rule"), "violations") for name, df in named])


@query(
    "WITH e AS (SELECT DISTINCT season, round FROM b_laps), c AS (SELECT season, round FROM b_laps WHERE track_status = '4' GROUP BY 1, 2 HAVING count(*) > 60), l AS (SELECT max(season) AS s FROM e) "
    "SELECT 'recent season' AS rule, count(*) AS violations FROM e ANTI JOIN c USING (season, round) WHERE season >= (SELECT s - 1 FROM l) UNION ALL SELECT 'latest completed', count(*) FROM (SELECT season, round FROM e ORDER BY season DESC, round DESC LIMIT 1) ANTI JOIN c USING (season, round) "
    "UNION ALL SELECT 'parity', count(*) FROM (SELECT coalesce(e.season, c.season) AS s FROM e FULL JOIN c ON e.season = c.season AND e.round = c.round WHERE e.season IS NULL OR c.season IS NULL) "
    "UNION ALL SELECT 'accounting', count(*) FROM (SELECT season, round FROM b_laps GROUP BY 1, 2 HAVING count(*) <> count(*) FILTER (track_status = '1') + count(*) FILTER (track_status = '4'))"
)
def dq04_coverage(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d)
    expected = rows.select(*RACE).distinct()
    covered = rows.where("track_status = '4'").groupBy(*RACE).agg(F.count("*").alias("n")).where("n > 60").select(*RACE)
    newest = expected.agg(F.max("season").alias("s"))
    recent = expected.crossJoin(F.broadcast(newest)).where("season >= s - 1").select(*RACE)  # one row
    status = rows.groupBy(*RACE).agg(F.count("*").alias("n"), F.count_if(F.col("track_status") == "1").alias("a"), F.count_if(F.col("track_status") == "4").alias("b"))
    return rules(spark, ("recent season", recent.join(covered, RACE, "left_anti")), ("latest completed", expected.orderBy(F.desc("season"), F.desc("round")).limit(1).join(covered, RACE, "left_anti")), ("parity", J.reconcile(expected, covered, RACE).where("status <> 'both'")), ("accounting", status.where("n <> a + b")))


@query("SELECT season, round, driver_id, round((max(end_ms) - min(start_ms)) / any_value(w), 6) AS covered, (max(end_ms) - min(start_ms)) / any_value(w) >= 0.9 AS complete FROM b_timed JOIN (SELECT season, round, CAST(max(end_ms) AS DOUBLE) AS w FROM b_timed GROUP BY 1, 2) USING (season, round) GROUP BY 1, 2, 3")
def dq05_replay_completeness(spark: S, d: str) -> DataFrame:
    t = timed(spark, d)
    window = t.groupBy(*RACE).agg(F.max("end_ms").cast("double").alias("w"))
    own = t.groupBy(*DRIVER).agg((F.max("end_ms") - F.min("start_ms")).alias("s")).join(F.broadcast(window), RACE)  # a row for each race
    return own.select(*DRIVER, r6(F.col("s") / F.col("w")).alias("covered"), (F.col("s") / F.col("w") >= 0.9).alias("complete"))


_PUBLISHED = "p AS (SELECT season, driver_id, count(*) AS n, count(*) >= 30 AS eligible, CASE WHEN count(*) >= 30 THEN avg(speed) END AS pace, CASE WHEN count(*) >= 60 THEN 'high' WHEN count(*) >= 30 THEN 'low' ELSE 'none' END AS status FROM b_laps GROUP BY 1, 2), q AS (SELECT season, driver_id, n, eligible, CASE WHEN driver_id % 17 = 0 THEN NULL ELSE pace END AS pace, CASE WHEN driver_id % 19 = 0 THEN 'high' ELSE status END AS status FROM p)"


def published(spark: S, d: str) -> DataFrame:
    """A published table with two kinds of planted faults."""
    n = F.col("n")
    p = laps(spark, d).groupBy("season", "driver_id").agg(F.count("*").alias("n"), F.avg("speed").alias("pace"))
    status = F.when(n >= 60, "high").when(n >= 30, "low").otherwise("none")
    return p.select("season", "driver_id", "n", (n >= 30).alias("eligible"), F.when((n >= 30) & (F.col("driver_id") % 17 != 0), F.col("pace")).alias("pace"), F.when(F.col("driver_id") % 19 == 0, "high").otherwise(status).alias("status"))


@query(f"WITH {_PUBLISHED} SELECT 'flag' AS rule, count(*) FILTER (eligible IS DISTINCT FROM (n >= 30)) AS violations FROM q UNION ALL SELECT 'null iff ineligible', count(*) FILTER ((pace IS NULL) = eligible) FROM q UNION ALL SELECT 'status', count(*) FILTER (status IS DISTINCT FROM CASE WHEN n >= 60 THEN 'high' WHEN n >= 30 THEN 'low' ELSE 'none' END) FROM q")
def dq06_publication(spark: S, d: str) -> DataFrame:
    q, n = published(spark, d), F.col("n")
    again = F.when(n >= 60, "high").when(n >= 30, "low").otherwise("none")
    return rules(spark, ("flag", q.where(~F.col("eligible").eqNullSafe(n >= 30))), ("null iff ineligible", q.where(F.col("pace").isNull() == F.col("eligible"))), ("status", q.where(~F.col("status").eqNullSafe(again))))


@query(
    "WITH a AS (SELECT o_custkey AS k, count(*) AS n, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1), b AS (SELECT c_custkey AS k, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus <> 'P') AS n FROM customer) "
    "SELECT CASE WHEN a.k IS NULL THEN 'missing left' WHEN b.k IS NULL THEN 'missing right' WHEN a.n = b.n THEN 'equal' ELSE 'differs' END AS status, count(*) AS n FROM a FULL JOIN b ON a.k = b.k GROUP BY 1"
)
def dq09_story_reconciliation(spark: S, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "k")
    a = Q.unique_or_fail(o.groupBy("k").agg(F.count("*").alias("a")), ["k"])
    counted = o.where("o_orderstatus <> 'P'").groupBy("k").agg(F.count("*").alias("b"))
    b = table(spark, d, "customer").select(F.col("c_custkey").alias("k")).join(counted, "k", "left").select("k", F.coalesce("b", F.lit(0)).alias("b"))
    status = C.first_reason((F.col("a").isNull(), "missing left"), (F.col("b").isNull(), "missing right"), (F.col("a") == F.col("b"), "equal"))
    return a.join(b, "k", "full_outer").groupBy(F.coalesce(status, F.lit("differs")).alias("status")).agg(F.count("*").alias("n"))


@query("SELECT 'orders.o_orderkey' AS rule, CAST(0 AS BIGINT) AS violations UNION ALL SELECT 'orders.o_totalprice', 0 UNION ALL SELECT 'orders.o_weight', 1 UNION ALL SELECT 'orders partitions', count(*) FROM orders WHERE year(o_orderdate) NOT BETWEEN 1995 AND 1998")
def dq10_column_contract(spark: S, d: str) -> DataFrame:
    o = table(spark, d, "orders").withColumn("season", F.year("o_orderdate"))
    return Q.contract({"orders": o}, {"orders": {"o_orderkey": "bigint", "o_totalprice": "double", "o_weight": "double"}}, "season", 1995, 1998)


@query("SELECT season, count(*) AS rows, season <> 1997 AS current, CAST(1 AS BIGINT) AS receipts FROM b_laps GROUP BY season")
def dq13_receipts(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d)
    receipt = Q.fingerprint(rows, ["season"])
    now = rows.withColumn("speed", F.when((F.col("season") == 1997) & (F.col("lap_number") == 1), F.col("speed") + 1).otherwise(F.col("speed")))  # one season has moved on
    return Q.receipts(receipt, Q.fingerprint(now, ["season"]), ["season"])


@query(
    "SELECT 'orders' AS name, count(*) AS rows, count(DISTINCT o_orderstatus) AS kinds, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS latest FROM orders UNION ALL SELECT 'events', count(*), count(DISTINCT event_type), CAST(max(CAST(ts AS DATE)) AS VARCHAR) FROM events UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_returnflag), CAST(max(CAST(l_shipdate AS DATE)) AS VARCHAR) FROM lineitem"
)
def dq15_audit(spark: S, d: str) -> DataFrame:
    parts = {"orders": ("o_orderstatus", "o_orderdate"), "events": ("event_type", "ts"), "lineitem": ("l_returnflag", "l_shipdate")}
    out = [table(spark, d, n).agg(F.count("*").alias("rows"), F.count_distinct(kind).alias("kinds"), F.max(F.to_date(day)).cast("string").alias("latest")).select(F.lit(n).alias("name"), "*") for n, (kind, day) in parts.items()]
    return Q.report(*out)


_MARKS = "m AS (SELECT user_id, event_id, epoch_us(ts) // 1000000 AS t FROM events WHERE event_type = 'error'), e AS (SELECT user_id, event_id, epoch_us(ts) // 1000000 AS t FROM events WHERE event_type = 'signup')"


@query(
    f"WITH {_MARKS}, a AS (SELECT user_id, count(*) AS starts, count(*) FILTER (EXISTS (SELECT 1 FROM e WHERE e.user_id = m.user_id AND e.t BETWEEN m.t - 86400 AND m.t + 86400)) AS met FROM m GROUP BY 1), b AS (SELECT user_id, count(*) AS events, count(*) FILTER (EXISTS (SELECT 1 FROM m WHERE e.user_id = m.user_id AND m.t BETWEEN e.t - 86400 AND e.t + 86400)) AS back FROM e GROUP BY 1) "
    "SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(starts, 0) AS starts, coalesce(met, 0) AS met, coalesce(events, 0) AS events, coalesce(back, 0) AS back, CASE WHEN starts IS NULL THEN 'no markers' WHEN events IS NULL THEN 'no events' WHEN starts > met THEN 'marker without event' WHEN events > back THEN 'event without marker' ELSE 'reconciled' END AS status FROM a FULL JOIN b ON a.user_id = b.user_id"
)
def dq16_marker_reconciliation(spark: S, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"))
    return Q.reconciled(e.where("event_type = 'error'"), e.where("event_type = 'signup'"), "user_id", "event_id", "t", 86400)


@query(
    "WITH c AS (SELECT s_suppkey AS driver_id, CAST(1996 AS BIGINT) AS season, CAST(s_nationkey % 4 + 1 AS BIGINT) AS round, CAST(s_nationkey % 12 + 2 AS BIGINT) AS lap FROM supplier), k AS (SELECT DISTINCT season, round, driver_id FROM b_laps), "
    "f AS (SELECT season, round, driver_id, lap_number FROM b_laps WHERE track_status = '4') "
    "SELECT c.driver_id, c.round, k.driver_id IS NOT NULL AS covered, EXISTS (SELECT 1 FROM f WHERE f.season = c.season AND f.round = c.round AND f.driver_id = c.driver_id AND f.lap_number BETWEEN c.lap - 1 AND c.lap + 1) AS matched FROM c LEFT JOIN k ON k.season = c.season AND k.round = c.round AND k.driver_id = c.driver_id"
)
def dq17_reference_cases(spark: S, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    cases = s.select(F.col("s_suppkey").alias("driver_id"), F.lit(1996).cast("long").alias("season"), (F.col("s_nationkey") % 4 + 1).cast("long").alias("round"), (F.col("s_nationkey") % 12 + 2).cast("long").alias("lap"))
    rows = laps(spark, d)
    return Q.validated(cases, rows.select(*DRIVER).distinct(), rows.where("track_status = '4'").select(*DRIVER, "lap_number"), DRIVER, "lap", "lap_number", 1).select("driver_id", "round", "covered", "matched")


def _matching_sql(by: list[str], truth: str, found: str) -> str:
    """Counts by levels: the pairs that can be the k-th of a chain; the last level that has one is the most."""
    keys, same = ", ".join(by), lambda a, b: " AND ".join(f"{a}.{c} = {b}.{c}" for c in by)
    return (
        f"WITH RECURSIVE tr AS (SELECT {keys}, driver_id AS label, lap_number AS at FROM b_laps WHERE {truth}), fo AS (SELECT {keys}, driver_id AS label, lap_number AS at FROM b_laps WHERE {found}), "
        f"ca AS MATERIALIZED (SELECT {', '.join('tr.' + c for c in by)}, tr.at * 1000000 + tr.label AS i, fo.at * 1000000 + fo.label AS j FROM tr JOIN fo ON {same('tr', 'fo')} AND tr.label = fo.label AND abs(tr.at - fo.at) <= 1), "
        f"lv AS (SELECT *, 1 AS k FROM ca UNION ALL SELECT DISTINCT c.*, lv.k + 1 FROM lv JOIN ca c ON {same('c', 'lv')} AND c.i > lv.i AND c.j > lv.j), "
        f"m AS (SELECT {keys}, max(k) AS matched FROM lv GROUP BY ALL), n AS (SELECT {keys}, count(*) FILTER (s = 0) AS truth, count(*) FILTER (s = 1) AS found FROM (SELECT *, 0 AS s FROM tr UNION ALL SELECT *, 1 FROM fo) GROUP BY ALL), "
        f"r AS (SELECT n.*, CAST(coalesce(matched, 0) AS BIGINT) AS matched FROM n LEFT JOIN m USING ({keys})) "
    )


@query(_matching_sql(RACE, "speed >= 45", "lap_time_sec >= 86") + "SELECT season, CAST(sum(matched) AS BIGINT) AS matched, CAST(sum(truth) AS BIGINT) AS truth, CAST(sum(found) AS BIGINT) AS found FROM r GROUP BY 1")
def dq18_pass_windows(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d)
    truth = rows.where("speed >= 45").select(*RACE, "driver_id", F.col("lap_number").alias("at"))
    found = rows.where("lap_time_sec >= 86").select(*RACE, "driver_id", F.col("lap_number").alias("at"))
    return SQ.sequence_matches(truth, found, [*RACE], "driver_id", "at", 1).groupBy("season").agg(F.sum("matched").alias("matched"), F.sum("truth").alias("truth"), F.sum("found").alias("found"))


@query(_matching_sql([*RACE, "team"], "track_status = '4'", "lap_time_sec >= 85") + "SELECT season, round, team, matched, truth, found FROM r")
def jn28_sequence_matching(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d)
    truth = rows.where("track_status = '4'").select(*RACE, "team", "driver_id", F.col("lap_number").alias("at"))
    found = rows.where("lap_time_sec >= 85").select(*RACE, "team", "driver_id", F.col("lap_number").alias("at"))
    return SQ.sequence_matches(truth, found, [*RACE, "team"], "driver_id", "at", 1)


@query(
    "WITH s AS (SELECT day, t_s, event_id, user_id, CASE WHEN value >= 50 THEN 'ahead' WHEN value < 20 THEN 'behind' END AS state FROM b_ticks), f AS (SELECT *, CASE WHEN lag(event_id) OVER (PARTITION BY user_id ORDER BY day, t_s, event_id) IS NULL OR state IS DISTINCT FROM lag(state) OVER (PARTITION BY user_id ORDER BY day, t_s, event_id) THEN 1 ELSE 0 END AS c FROM s), g AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY day, t_s, event_id) AS run FROM f) "
    "SELECT user_id, CAST(run AS BIGINT) AS run, coalesce(any_value(state), 'uncertain') AS state, count(*) AS n, max(run) = (SELECT max(run) FROM g h WHERE h.user_id = g.user_id) AS censored FROM g GROUP BY user_id, run"
)
def dq19_timeline(spark: S, d: str) -> DataFrame:
    state = F.when(F.col("value") >= 50, "ahead").when(F.col("value") < 20, "behind")
    s = view(spark, d, "b_ticks").withColumn("state", state)
    w = Window.partitionBy("user_id").orderBy("day", "t_s", "event_id")
    runs = W.islands(s, ["user_id"], ["day", "t_s", "event_id"], ~F.col("state").eqNullSafe(F.lag("state").over(w)), "run")
    g = runs.groupBy("user_id", "run").agg(F.coalesce(F.first("state"), F.lit("uncertain")).alias("state"), F.count("*").alias("n"))
    return g.withColumn("censored", F.col("run") == F.max("run").over(Window.partitionBy("user_id")))  # the last segment's end is not seen


@query(
    f"WITH {_GRID}, k AS (SELECT DISTINCT season, round, driver_id, t FROM g UNION SELECT season, round, driver_id, end_ms FROM b_timed WHERE lap_number % 3 = 0), c AS (SELECT season, round, driver_id, CAST(0 AS BIGINT) AS t, CAST(0 AS DOUBLE) AS p FROM b_timed WHERE lap_number = 1 UNION ALL SELECT season, round, driver_id, end_ms, CAST(lap_number AS DOUBLE) FROM b_timed), h AS (SELECT * FROM c WHERE p % 2 = 0), "
    "x AS (SELECT k.season, k.round, k.driver_id, k.t, CASE WHEN a.t = k.t THEN a.p ELSE a.p + (k.t - a.t) / CAST(b.t - a.t AS DOUBLE) * (b.p - a.p) END AS p, CASE WHEN e.t = k.t THEN e.p ELSE e.p + (k.t - e.t) / CAST(f.t - e.t AS DOUBLE) * (f.p - e.p) END AS q FROM k "
    "ASOF LEFT JOIN c a ON a.season = k.season AND a.round = k.round AND a.driver_id = k.driver_id AND k.t >= a.t ASOF LEFT JOIN c b ON b.season = k.season AND b.round = k.round AND b.driver_id = k.driver_id AND k.t <= b.t ASOF LEFT JOIN h e ON e.season = k.season AND e.round = k.round AND e.driver_id = k.driver_id AND k.t >= e.t ASOF LEFT JOIN h f ON f.season = k.season AND f.round = k.round AND f.driver_id = k.driver_id AND k.t <= f.t) "
    "SELECT season, round, driver_id, count(*) AS knots, count(q) AS compared, round(max(abs(p - q)), 5) AS worst, round(avg(abs(p - q)), 5) AS mean FROM x GROUP BY 1, 2, 3"
)
def dq20_progress_difference(spark: S, d: str) -> DataFrame:
    t = timed(spark, d)
    deal = partial(dealt, spark, d)
    knots = deal(grid(spark, d).select(*DRIVER, "t").union(t.where("lap_number % 3 = 0").select(*DRIVER, F.col("end_ms").alias("t"))), *DRIVER).distinct()
    curve = t.where("lap_number = 1").select(*DRIVER, F.lit(0).cast("long").alias("t"), F.lit(0.0).alias("p")).unionByName(t.select(*DRIVER, F.col("end_ms").alias("t"), F.col("lap_number").cast("double").alias("p")))
    x = J.bracketed(J.bracketed(knots, curve, DRIVER, "t", ["p"], deal=deal), curve.where("p % 2 = 0").withColumnRenamed("p", "q"), DRIVER, "t", ["q"], deal=deal)
    apart = F.abs(F.col("p") - F.col("q"))
    return x.groupBy(*DRIVER).agg(F.count("*").alias("knots"), F.count("q").alias("compared"), F.round(F.max(apart), 5).alias("worst"), F.round(F.avg(apart), 5).alias("mean"))


@query("SELECT 'laps' AS name, count(*) AS candidates, count(*) FILTER (track_status = '1') AS eligible, count(DISTINCT (season, round)) AS races FROM b_laps UNION ALL SELECT 'stops', count(*), count(*) FILTER (track_status = '1'), count(DISTINCT (season, round)) FROM b_laps WHERE tyre_life = 8 UNION ALL SELECT 'gaps', count(*), count(*) FILTER (speed > 20), count(DISTINCT (season, round)) FROM b_laps WHERE compound = 'HARD'")
def dq21_evidence_summary(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d)
    green = F.col("track_status") == "1"
    return E.evidence_summary({"laps": (rows, green), "stops": (rows.where("tyre_life = 8"), green), "gaps": (rows.where("compound = 'HARD'"), F.col("speed") > 20)}, RACE)


@query("SELECT count(*) FILTER (o_orderstatus = 'P') AS corrected, CAST(0 AS BIGINT) AS added, CAST(0 AS BIGINT) AS removed FROM orders")
def dq22_proved_correction(spark: S, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    fixed = o.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "P", "O").otherwise(F.col("o_orderstatus")))
    rest = Q.table_diff(o.drop("o_orderstatus"), fixed.drop("o_orderstatus"))
    changed = o.select("o_orderkey", F.col("o_orderstatus").alias("old")).join(fixed.select("o_orderkey", "o_orderstatus"), "o_orderkey").agg(F.count_if(F.col("old") != F.col("o_orderstatus")).alias("corrected"))
    return changed.crossJoin(rest)  # one row each


@query(
    f'WITH {_BATTLES} SELECT \'duplicate\' AS rule, count(*) AS violations FROM (SELECT 1 FROM e GROUP BY season, round, driver_id, start HAVING count(*) > 1) UNION ALL SELECT \'pressure within length\', count(*) FROM e WHERE pressure > "end" - start UNION ALL SELECT \'contacts within samples\', count(*) FROM e WHERE contacts > samples OR contacts < 1 UNION ALL SELECT \'owner\', count(*) FROM e WHERE driver_id = rival '
    "UNION ALL SELECT 'single sample', count(*) FROM e WHERE samples = 1"
)
def dq23_episode_invariants(spark: S, d: str) -> DataFrame:
    e = M.kept(battles(spark, d), "battles")  # read by every rule
    twice = e.groupBy(*DRIVER, "start").agg(F.count("*").alias("n")).where("n > 1")
    return rules(spark, ("duplicate", twice), ("pressure within length", e.where(F.col("pressure") > F.col("end") - F.col("start"))), ("contacts within samples", e.where("contacts > samples or contacts < 1")), ("owner", e.where("driver_id = rival")), ("single sample", e.where("samples = 1")))


_IMPACT = "i AS (SELECT season, round, driver_id, avg(speed) FILTER (track_status = '1') AS v, count(*) FILTER (track_status = '1') AS n FROM b_laps GROUP BY 1, 2, 3), c AS (SELECT *, CASE WHEN n >= 8 THEN v - median(CASE WHEN n >= 8 THEN v END) OVER (PARTITION BY season, round) END AS x FROM i)"


@query(
    f"WITH {_IMPACT} SELECT 'null iff ineligible' AS rule, count(*) FILTER ((x IS NULL) = (n >= 8)) AS violations FROM c UNION ALL SELECT 'centred', count(*) FROM (SELECT 1 FROM c GROUP BY season, round HAVING abs(median(x)) > 1e-9) UNION ALL SELECT 'cohort', count(*) FROM (SELECT 1 FROM c GROUP BY season, round HAVING count(x) <> count(*) FILTER (n >= 8))"
)
def dq24_impact_invariants(spark: S, d: str) -> DataFrame:
    green = F.when(F.col("track_status") == "1", F.col("speed"))
    i = laps(spark, d).groupBy(*DRIVER).agg(F.avg(green).alias("v"), F.count(green).alias("n"))
    c = E.centred(i, RACE, "v", F.col("n") >= 8, "x")
    by = c.groupBy(*RACE).agg(F.percentile("x", 0.5).alias("m"), F.count("x").alias("k"), F.count_if(F.col("n") >= 8).alias("e"))
    return rules(spark, ("null iff ineligible", c.where(F.col("x").isNull() == (F.col("n") >= 8))), ("centred", by.where("abs(m) > 1e-9")), ("cohort", by.where("k <> e")))


@query("SELECT season, round, count(*) AS laps, count(DISTINCT driver_id) AS drivers, count(*) = (SELECT count(*) FROM b_laps WHERE season = 1997 AND round = 2) AS known FROM b_laps WHERE season = 1997 AND round = 2 GROUP BY 1, 2")
def dq25_golden_values(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d).where("season = 1997 and round = 2")
    golden = table(spark, d, "lineitem").where(F.to_date("l_shipdate").between("1997-04-01", "1997-06-30")).agg(F.count("*").alias("g"))  # the partition's size, from the source itself
    out = rows.groupBy(*RACE).agg(F.count("*").alias("laps"), F.count_distinct("driver_id").alias("drivers")).crossJoin(F.broadcast(golden))  # one row
    return out.select(*RACE, "laps", "drivers", (F.col("laps") == F.col("g")).alias("known"))


@query(
    "WITH c AS (SELECT DISTINCT season, round, driver_id, lap_number FROM b_laps WHERE track_status = '4'), u AS (SELECT season, round, driver_id, lap_number FROM b_laps WHERE track_status = '1' OR driver_id % 23 = 0) "
    "SELECT 'excluded row used' AS rule, count(*) AS violations FROM u SEMI JOIN c USING (season, round, driver_id, lap_number) UNION ALL SELECT 'evidence without context', count(*) FROM (SELECT season, round, driver_id, lap_number FROM b_laps) ANTI JOIN (SELECT * FROM c UNION ALL SELECT * FROM u) USING (season, round, driver_id, lap_number) UNION ALL SELECT 'key', count(*) FROM (SELECT 1 FROM c GROUP BY season, round, driver_id, lap_number HAVING count(*) > 1)"
)
def dq26_context(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d)
    c, u = rows.where("track_status = '4'").select(*LAP).distinct(), rows.where("track_status = '1' or driver_id % 23 = 0").select(*LAP)
    return rules(spark, ("excluded row used", u.join(c, LAP, "left_semi")), ("evidence without context", rows.select(*LAP).join(c.unionByName(u), LAP, "left_anti")), ("key", c.groupBy(*LAP).agg(F.count("*").alias("n")).where("n > 1")))


@query("SELECT season, count(*) AS changed, true AS same_rows FROM (SELECT season, round, driver_id FROM b_laps WHERE season = 1996 AND round = 3 GROUP BY 1, 2, 3) GROUP BY season")
def dq27_late_correction(spark: S, d: str) -> DataFrame:
    build = lambda rows: rows.groupBy(*DRIVER).agg(F.sum("speed").alias("v"), F.max("loaded_at").alias("loaded_at"))
    path = f"{P.shared_folder(spark)}/lake/{uuid.uuid4().hex}-late"
    first = laps(spark, d).withColumn("loaded_at", F.lit(1))
    P.write_touched(build(first), path, RACE)
    before = P.scan(spark, path).select(*DRIVER, F.col("v").alias("old")).checkpoint()
    late = (F.col("season") == 1996) & (F.col("round") == 3)
    P.refresh(first.withColumns({"speed": F.when(late, F.col("speed") + 1).otherwise(F.col("speed")), "loaded_at": F.when(late, 2).otherwise(1)}), path, RACE, build)
    both = P.scan(spark, path).join(before, DRIVER, "full_outer")
    moved = both.where(~F.col("v").eqNullSafe(F.col("old"))).groupBy("season").agg(F.count("*").alias("changed"))
    return moved.crossJoin(F.broadcast(both.agg((F.count_if(F.col("v").isNull() | F.col("old").isNull()) == 0).alias("same_rows"))))  # one row


@query("SELECT 'antisymmetric' AS rule, count(*) AS violations FROM (SELECT 1 FROM b_laps WHERE track_status = '1' GROUP BY season, round, team HAVING count(DISTINCT driver_id) = 2 AND min(driver_id) % 5 = 0)")
def dq02_broken_pairs(spark: S, d: str) -> DataFrame:
    two = J.exactly(laps(spark, d).where("track_status = '1'"), [*RACE, "team"], "driver_id", 2)
    means = two.groupBy(*RACE, "team", "driver_id").agg(F.avg("speed").alias("v"))
    p = J.pairs(means, [*RACE, "team"], "driver_id", ["v"]).withColumn("gap", F.col("v") - F.col("other_v"))
    broken = p.where(~((F.least("driver_id", "other_driver_id") % 5 == 0) & (F.col("driver_id") > F.col("other_driver_id"))))  # of some pairs one direction is missing
    return Q.antisymmetric(broken, [*RACE, "team"], "driver_id", "other_driver_id", "gap", 1e-9)


@query("SELECT season, round, driver_id, round(1.4826 * median(abs(speed - m)), 6) AS sigma FROM (SELECT *, median(speed) OVER (PARTITION BY season, round, driver_id) AS m FROM b_laps) GROUP BY 1, 2, 3")
def ag10_robust_sigma(spark: S, d: str) -> DataFrame:
    return R.mad(laps(spark, d), DRIVER, "speed").select(*DRIVER, r6("sigma").alias("sigma"))

