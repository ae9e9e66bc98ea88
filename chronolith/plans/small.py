"""Queries of single operators: filters and parsers, joins, aggregates, windows, sets and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.window import Window

from chronolith.functions import columns as C
from chronolith.operators import evidence as E, joins as J, quality as Q, windows as W
from chronolith.plans.basics import laps
from chronolith.plans.bindings import table, view
from chronolith.plans.registry import query
from chronolith.sources import partitions as P

S = SparkSession
RACE, LAP = ["season", "round"], ["season", "round", "driver_id", "lap_number"]
STINT = ["season", "round", "driver_id", "stint"]
_ON_RACE = "a.season = b.season AND a.round = b.round"


# projections and predicates
@query(
    "WITH m AS (SELECT *, min(lap_number) OVER s AS lo, max(lap_number) OVER s AS hi, max(stint) OVER r AS last FROM b_laps WINDOW s AS (PARTITION BY season, round, driver_id, stint), r AS (PARTITION BY season, round, driver_id)) "
    "SELECT season, round, driver_id, lap_number FROM m WHERE lap_number > 1 AND NOT (stint > 1 AND lap_number = lo) AND NOT (stint < last AND lap_number = hi) AND track_status = '1' AND compound IN ('SOFT', 'MEDIUM', 'HARD') AND tyre_life >= 2"
)
def pr08_representative(spark: S, d: str) -> DataFrame:
    s, r = Window.partitionBy(*STINT), Window.partitionBy("season", "round", "driver_id")
    m = laps(spark, d).withColumns({"lo": F.min("lap_number").over(s), "hi": F.max("lap_number").over(s), "last": F.max("stint").over(r)})
    keep = (F.col("lap_number") > 1) & ~((F.col("stint") > 1) & (F.col("lap_number") == F.col("lo"))) & ~((F.col("stint") < F.col("last")) & (F.col("lap_number") == F.col("hi")))
    return m.where(keep & (F.col("track_status") == "1") & F.col("compound").isin("SOFT", "MEDIUM", "HARD") & (F.col("tyre_life") >= 2)).select(*LAP)


_SESSIONS = (
    "q AS (SELECT season, round, team, driver_id, min(lap_time_sec) FILTER (stint = 1) AS q1, min(lap_time_sec) FILTER (stint = 2) AS q2, min(lap_time_sec) FILTER (stint = 3) AS q3 FROM b_laps GROUP BY 1, 2, 3, 4), "
    "t AS (SELECT season, round, team FROM q GROUP BY 1, 2, 3 HAVING count(*) = 2), "
    "p AS (SELECT a.season, a.round, a.team, a.driver_id, b.driver_id AS other_driver_id, CASE WHEN a.q3 IS NOT NULL AND b.q3 IS NOT NULL THEN 'Q3' WHEN a.q2 IS NOT NULL AND b.q2 IS NOT NULL THEN 'Q2' WHEN a.q1 IS NOT NULL AND b.q1 IS NOT NULL THEN 'Q1' END AS common_session, "
    f"a.q1 AS a1, a.q2 AS a2, a.q3 AS a3, b.q1 AS b1, b.q2 AS b2, b.q3 AS b3 FROM q a JOIN q b ON {_ON_RACE} AND a.team = b.team AND a.driver_id <> b.driver_id JOIN t ON t.season = a.season AND t.round = a.round AND t.team = a.team)"
)


def sessions(spark: S, d: str) -> DataFrame:
    """Each driver's best time in up to three sessions (stints) of a round."""
    best = [F.min(F.when(F.col("stint") == k, F.col("lap_time_sec"))).alias(f"q{k}") for k in (1, 2, 3)]
    return laps(spark, d).groupBy(*RACE, "team", "driver_id").agg(*best)


def common_session(spark: S, d: str) -> DataFrame:
    """Pairs of exactly two teammates with the best session that both reached, and their times in it."""
    two = J.exactly(sessions(spark, d), [*RACE, "team"], "driver_id", 2)
    p = J.pairs(two, [*RACE, "team"], "driver_id", ["q1", "q2", "q3"])
    both = lambda k: F.col(f"q{k}").isNotNull() & F.col(f"other_q{k}").isNotNull()
    pick = lambda side: F.when(both(3), F.col(side + "q3")).when(both(2), F.col(side + "q2")).when(both(1), F.col(side + "q1"))
    return p.select(*RACE, "team", "driver_id", "other_driver_id", C.first_reason((both(3), "Q3"), (both(2), "Q2"), (both(1), "Q1")).alias("common_session"), pick("").alias("mine"), pick("other_").alias("theirs"))


@query(f"WITH {_SESSIONS} SELECT season, round, driver_id, other_driver_id, common_session, CASE common_session WHEN 'Q3' THEN a3 WHEN 'Q2' THEN a2 WHEN 'Q1' THEN a1 END AS mine, CASE common_session WHEN 'Q3' THEN b3 WHEN 'Q2' THEN b2 WHEN 'Q1' THEN b1 END AS theirs FROM p")
def pr11_first_applicable(spark: S, d: str) -> DataFrame:
    return common_session(spark, d).drop("team")


@query(
    "SELECT page_id, CASE WHEN upper(html) LIKE '%<TABLE%' THEN 'table' WHEN upper(html) LIKE '%<IMG%' THEN 'image' WHEN upper(url) LIKE '%FORUM%' THEN 'forum' WHEN length(html) > 4000 THEN 'long' ELSE 'other' END AS kind FROM pages"
)
def pr18_subtype(spark: S, d: str) -> DataFrame:
    text = F.upper("html")
    kind = C.first_reason((text.contains("<TABLE"), "table"), (text.contains("<IMG"), "image"), (F.upper("url").contains("FORUM"), "forum"), (F.char_length("html") > 4000, "long"))
    return table(spark, d, "pages").select("page_id", F.coalesce(kind, F.lit("other")).alias("kind"))


_MESSAGE = "CASE event_type WHEN 'error' THEN '  safety car   deployed' WHEN 'signup' THEN 'SAFETY CAR IN THIS LAP' WHEN 'purchase' THEN 'VSC DEPLOYED' WHEN 'click' THEN 'vsc ending' ELSE 'CAR 4 PIT' END"


def messages(spark: S, d: str) -> DataFrame:
    """Events with the race-control message that stands for their type."""
    text = {"error": "  safety car   deployed", "signup": "SAFETY CAR IN THIS LAP", "purchase": "VSC DEPLOYED", "click": "vsc ending"}
    message = C.first_reason(*[(F.col("event_type") == k, v) for k, v in text.items()])
    return view(spark, d, "b_ticks").withColumn("message", F.coalesce(message, F.lit("CAR 4 PIT")))


@query(
    f"WITH m AS (SELECT event_id, regexp_replace(upper(trim({_MESSAGE})), '\\s+', ' ', 'g') AS m FROM b_ticks) SELECT event_id, CASE WHEN regexp_matches(m, '\\bVSC\\b') THEN 'VSC' WHEN contains(m, 'SAFETY CAR') THEN 'SC' END AS kind, "
    "CASE WHEN contains(m, 'DEPLOYED') THEN 'start' WHEN regexp_matches(m, 'ENDING|IN THIS LAP') THEN 'end' END AS edge FROM m"
)
def pr19_markers(spark: S, d: str) -> DataFrame:
    return messages(spark, d).select("event_id", C.marker(F.col("message")).alias("m")).select("event_id", "m.kind", "m.edge")


_GAP = "CASE WHEN event_id % 5 = 0 THEN '+' || CAST(event_id % 4 + 1 AS VARCHAR) || ' laps' WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(event_id % 900 AS VARCHAR) || '.25' END"


@query(f"SELECT event_id, TRY_CAST({_GAP} AS DOUBLE) AS seconds, CASE WHEN event_id % 5 = 0 THEN CAST(event_id % 4 + 1 AS INTEGER) END AS laps FROM events")
def pr20_structured_gap(spark: S, d: str) -> DataFrame:
    i = F.col("event_id")
    text = F.when(i % 5 == 0, F.concat(F.lit("+"), (i % 4 + 1).cast("string"), F.lit(" laps"))).when(i % 7 == 0, "n/a").otherwise(F.concat((i % 900).cast("string"), F.lit(".25")))
    seconds, lapped = C.structured_gap(text)
    return table(spark, d, "events").select("event_id", seconds.alias("seconds"), lapped.alias("laps"))


@query(
    "WITH w AS (SELECT user_id, day, min(t_s) AS a, max(t_s) AS z FROM b_ticks WHERE event_type IN ('signup', 'purchase') GROUP BY 1, 2) "
    "SELECT event_id, CASE WHEN a IS NULL THEN 'none' WHEN t_s < a THEN 'before' WHEN t_s > z THEN 'after' ELSE 'inside' END AS phase FROM b_ticks LEFT JOIN w USING (user_id, day)"
)
def pr21_window_phase(spark: S, d: str) -> DataFrame:
    t = view(spark, d, "b_ticks")
    bounds = t.where(F.col("event_type").isin("signup", "purchase")).groupBy("user_id", "day").agg(F.min("t_s").alias("a"), F.max("t_s").alias("z"))
    phase = C.first_reason((F.col("a").isNull(), "none"), (F.col("t_s") < F.col("a"), "before"), (F.col("t_s") > F.col("z"), "after"))
    return t.join(bounds, ["user_id", "day"], "left").select("event_id", F.coalesce(phase, F.lit("inside")).alias("phase"))


@query("SELECT o_orderkey, o_orderpriority, CAST(NULL AS VARCHAR) AS o_comment, CAST(NULL AS DOUBLE) AS o_weight FROM orders")
def pr22_optional_columns(spark: S, d: str) -> DataFrame:
    wanted = T.StructType.fromDDL("o_orderkey long, o_orderpriority string, o_comment string, o_weight double")
    return P.with_columns(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), wanted)


# joins
@query(
    "WITH c AS (SELECT season, 'D' || CAST(driver_id % 500 AS VARCHAR) AS code, max(driver_id) AS id FROM b_laps GROUP BY 1, 2) "
    "SELECT season, round, code, c.id, count(*) AS n FROM (SELECT season, round, 'D' || CAST(driver_id % 500 AS VARCHAR) AS code FROM b_laps) l JOIN c USING (season, code) GROUP BY 1, 2, 3, 4"
)
def jn03_code_bridge(spark: S, d: str) -> DataFrame:
    coded = laps(spark, d).withColumn("code", F.concat(F.lit("D"), (F.col("driver_id") % 500).cast("string")))
    bridge = coded.groupBy("season", "code").agg(F.max("driver_id").alias("id"))
    return coded.join(bridge, ["season", "code"]).groupBy("season", "round", "code", "id").agg(F.count("*").alias("n"))


@query(
    f"WITH p AS (SELECT a.season, a.round, a.team, a.driver_id AS x, b.driver_id AS y, min(a.lap_number) AS lx, max(b.lap_number) AS ly FROM b_laps a JOIN b_laps b ON {_ON_RACE} AND a.team = b.team AND a.driver_id < b.driver_id AND a.lap_number = b.lap_number GROUP BY ALL) "
    "SELECT p.season, p.round, p.team, l.driver_id, l.lap_number, l.speed FROM p JOIN b_laps l ON l.season = p.season AND l.round = p.round AND (l.driver_id = p.x AND l.lap_number = p.lx OR l.driver_id = p.y AND l.lap_number = p.ly)"
)
def jn12_disjunctive(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d)
    p = J.pairs(rows.select(*RACE, "team", "driver_id", "lap_number"), [*RACE, "team", "lap_number"], "driver_id", [], F.col("a.driver_id") < F.col("b.driver_id"))
    p = p.groupBy(*RACE, "team", "driver_id", "other_driver_id").agg(F.min("lap_number").alias("lx"), F.max("lap_number").alias("ly"))
    # either side of the pair is a row of its own, so that the join has equal keys
    return J.either(p, rows.select(*LAP, "team", "speed"), [*RACE, "team"], [("driver_id", "lx"), ("other_driver_id", "ly")], ["driver_id", "lap_number"]).select(*RACE, "team", "driver_id", "lap_number", "speed")


_SNAP = "FROM (SELECT event_id, day, t_s AS at FROM b_ticks WHERE event_type = 'signup') e JOIN b_ticks s ON s.day = e.day AND abs(s.t_s - e.at) <= 900"


@query(
    f"SELECT e.event_id, s.user_id, last(s.value ORDER BY s.t_s, s.value NULLS FIRST) FILTER (s.t_s <= e.at) AS before, first(s.value ORDER BY s.t_s, s.value NULLS FIRST) FILTER (s.t_s >= e.at) AS after {_SNAP} GROUP BY e.event_id, s.user_id"
)
def jn17_snapshot(spark: S, d: str) -> DataFrame:
    t = view(spark, d, "b_ticks")
    events = t.where("event_type = 'signup'").select("event_id", "day", F.col("t_s").alias("at"))
    return J.snapshot(events, t.select("day", "user_id", "t_s", "value"), ["day"], "user_id", "t_s", "value", 900).select("event_id", "user_id", "before", "after")


@query(
    "WITH c AS (SELECT user_id, day, t_s, avg(value) AS value FROM b_ticks WHERE event_type = 'click' GROUP BY ALL), v AS (SELECT * FROM b_ticks WHERE event_type = 'view') "
    "SELECT v.event_id, round(CASE WHEN a.t_s = v.t_s THEN a.value WHEN b.t_s - a.t_s <= 14400 THEN a.value + (v.t_s - a.t_s) / (b.t_s - a.t_s) * (b.value - a.value) END, 6) AS value "
    "FROM v ASOF LEFT JOIN c a ON v.user_id = a.user_id AND v.day = a.day AND v.t_s >= a.t_s ASOF LEFT JOIN c b ON v.user_id = b.user_id AND v.day = b.day AND v.t_s <= b.t_s"
)
def jn19_interpolation(spark: S, d: str) -> DataFrame:
    t = view(spark, d, "b_ticks")
    clicks = t.where("event_type = 'click'").groupBy("user_id", "day", "t_s").agg(F.avg("value").alias("value"))
    return J.bracketed(t.where("event_type = 'view'").select("event_id", "user_id", "day", "t_s"), clicks, ["user_id", "day"], "t_s", ["value"], widest=14400).select("event_id", F.round("value", 6).alias("value"))


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def jn23_many_to_one(spark: S, d: str) -> DataFrame:
    one = J.require_unique(table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name"), ["o_custkey"])
    return table(spark, d, "orders").join(one, "o_custkey").select("o_orderkey", "c_name")


@query(
    "WITH g AS (SELECT season, round, team, driver_id, CAST(floor(lap_number / 4) AS BIGINT) AS cell, avg(speed) AS v FROM b_laps GROUP BY ALL) "
    f"SELECT a.season, a.round, a.team, a.cell, round(a.v - b.v, 6) AS gap FROM g a JOIN g b ON {_ON_RACE} AND a.team = b.team AND a.cell = b.cell AND a.driver_id < b.driver_id"
)
def jn24_grid_pairs(spark: S, d: str) -> DataFrame:
    grid = laps(spark, d).groupBy(*RACE, "team", "driver_id", F.floor(F.col("lap_number") / 4).alias("cell")).agg(F.avg("speed").alias("v"))
    return J.pairs(grid, [*RACE, "team", "cell"], "driver_id", ["v"], F.col("a.driver_id") < F.col("b.driver_id")).select(*RACE, "team", "cell", F.round(F.col("v") - F.col("other_v"), 6).alias("gap"))


@query(
    "SELECT * EXCLUDE (n) FROM (SELECT a.season, a.round, a.team, a.driver_id AS x, b.driver_id AS y, a.lap_number AS lap_x, b.lap_number AS lap_y, row_number() OVER (PARTITION BY a.season, a.round, a.team ORDER BY CASE WHEN a.track_status = '1' AND b.track_status = '1' THEN 0 ELSE 1 END, "
    "abs(a.tyre_life - b.tyre_life) + 2 * abs(a.lap_number - b.lap_number) + CASE WHEN a.compound = b.compound THEN 0 ELSE 5 END, a.lap_number, b.lap_number, a.driver_id) AS n "
    f"FROM b_laps a JOIN b_laps b ON {_ON_RACE} AND a.team = b.team AND a.driver_id < b.driver_id AND abs(a.lap_number - b.lap_number) <= 3) WHERE n = 1"
)
def jn25_best_pair(spark: S, d: str) -> DataFrame:
    bad = F.when((F.col("a.track_status") == "1") & (F.col("b.track_status") == "1"), 0).otherwise(1)
    score = F.abs(F.col("a.tyre_life") - F.col("b.tyre_life")) + 2 * F.abs(F.col("a.lap_number") - F.col("b.lap_number")) + F.when(F.col("a.compound") == F.col("b.compound"), 0).otherwise(5)
    out = J.best_pair(laps(spark, d), [*RACE, "team"], "driver_id", "lap_number", 3, bad, score)
    return out.select(*RACE, "team", F.col("driver_id").alias("x"), F.col("other_driver_id").alias("y"), F.col("lap_number").alias("lap_x"), F.col("other_lap_number").alias("lap_y"))


@query(
    "SELECT a.season, a.round, a.driver_id, count(*) AS pits, count(*) FILTER (c.season IS NOT NULL) AS covered, CASE WHEN count(*) FILTER (c.season IS NOT NULL) > 0 THEN coalesce(max(n), 0) END AS stops FROM (SELECT DISTINCT season, round, driver_id FROM b_laps) a "
    "LEFT JOIN (SELECT DISTINCT season, round FROM b_laps WHERE track_status = '4') c USING (season, round) LEFT JOIN (SELECT season, round, driver_id, count(*) AS n FROM b_laps WHERE track_status = '4' GROUP BY ALL) s ON s.season = a.season AND s.round = a.round AND s.driver_id = a.driver_id GROUP BY 1, 2, 3"
)
def jn30_coverage_gate(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d)
    marked = rows.where("track_status = '4'")
    out = rows.select(*RACE, "driver_id").distinct().join(marked.select(*RACE).distinct().withColumn("seen", F.lit(True)), RACE, "left")
    out = out.join(marked.groupBy(*RACE, "driver_id").agg(F.count("*").alias("n")), [*RACE, "driver_id"], "left")
    return out.select(*RACE, "driver_id", F.lit(1).cast("long").alias("pits"), F.when(F.col("seen"), 1).otherwise(0).cast("long").alias("covered"), F.when(F.col("seen"), F.coalesce("n", F.lit(0))).alias("stops"))


_PAIRED = "p AS (SELECT event_id, day, user_id AS x, user_id + 1 AS y, t_s FROM b_ticks WHERE event_type = 'purchase'), s AS (SELECT day, user_id, t_s AS a, t_s + 3600 AS z FROM b_ticks WHERE event_type = 'signup')"


@query(f"WITH {_PAIRED} SELECT event_id FROM p WHERE EXISTS (SELECT 1 FROM s WHERE s.day = p.day AND s.user_id IN (p.x, p.y) AND p.t_s >= s.a AND p.t_s < s.z)")
def jn32_pair_members(spark: S, d: str) -> DataFrame:
    t = view(spark, d, "b_ticks")
    spans = t.where("event_type = 'signup'").select("day", "user_id", F.col("t_s").alias("a"), (F.col("t_s") + 3600).alias("z"))
    either = t.where("event_type = 'purchase'").select("event_id", "day", "t_s", F.explode(F.array("user_id", F.col("user_id") + 1)).alias("user_id"))
    return J.interval(either, spans, ["day", "user_id"], "t_s", "a", "z", 1800, how="left_semi").select("event_id").distinct()


# aggregates
@query("SELECT season, count(DISTINCT driver_id) AS drivers, count(DISTINCT team) AS teams FROM b_laps GROUP BY season")
def ag02_count_distinct(spark: S, d: str) -> DataFrame:
    return laps(spark, d).groupBy("season").agg(F.count_distinct("driver_id").alias("drivers"), F.count_distinct("team").alias("teams"))


@query("SELECT season, round, driver_id, count(*) AS n FROM b_laps WHERE track_status = '1' GROUP BY ALL HAVING count(*) >= 8")
def ag05_having(spark: S, d: str) -> DataFrame:
    return laps(spark, d).where("track_status = '1'").groupBy(*RACE, "driver_id").agg(F.count("*").alias("n")).where("n >= 8")


@query("SELECT season, driver_id, round(regr_slope(lap_time_sec, lap_number), 6) AS slope, round(regr_slope(speed, CASE WHEN lap_number > 0 THEN 1 END), 6) AS flat FROM b_laps GROUP BY ALL")
def ag07_slopes(spark: S, d: str) -> DataFrame:
    one = F.when(F.col("lap_number") > 0, F.lit(1))  # no variance: no slope
    return laps(spark, d).groupBy("season", "driver_id").agg(F.round(C.slope(F.col("lap_time_sec"), F.col("lap_number")), 6).alias("slope"), F.round(C.slope(F.col("speed"), one), 6).alias("flat"))


@query("SELECT season, round, driver_id, round(stddev_samp(lap_time_sec), 6) AS sd FROM b_laps GROUP BY ALL")
def ag08_stddev(spark: S, d: str) -> DataFrame:
    return laps(spark, d).groupBy(*RACE, "driver_id").agg(F.round(F.stddev_samp("lap_time_sec"), 6).alias("sd"))


@query("SELECT driver_id, max(team) AS team, count(*) AS n FROM b_laps GROUP BY driver_id")
def ag13_any_value(spark: S, d: str) -> DataFrame:
    return laps(spark, d).groupBy("driver_id").agg(F.any_value("team").alias("team"), F.count("*").alias("n"))  # one team a driver: any is the same


@query("SELECT n_name, c_mktsegment, count(*) AS n, round(avg(c_acctbal), 6) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def ag16_group_by_all(spark: S, d: str) -> DataFrame:
    return spark.sql(
        "SELECT n_name, c_mktsegment, count(*) AS n, round(avg(c_acctbal), 6) AS balance FROM {c} JOIN {n} ON c_nationkey = n_nationkey GROUP BY ALL", c=table(spark, d, "customer"), n=table(spark, d, "nation")
    )


@query("SELECT season, round, driver_id, stint, coalesce(max(CASE WHEN track_status = '1' THEN compound END), 'UNKNOWN') AS compound FROM b_laps GROUP BY ALL")
def ag17_preferred_known(spark: S, d: str) -> DataFrame:
    known = F.when(F.col("track_status") == "1", F.col("compound")).otherwise("UNKNOWN")
    return laps(spark, d).groupBy(*STINT).agg(C.preferred(known).alias("compound"))


@query(
    "WITH x AS (SELECT user_id, day, value, t_s - lag(t_s) OVER (PARTITION BY user_id, day ORDER BY t_s, event_id) AS dx FROM b_ticks) "
    "SELECT user_id, day, round(sum(CASE WHEN value > 30 THEN dx ELSE 0 END) / nullif(sum(dx), 0), 6) AS share FROM x WHERE dx IS NOT NULL GROUP BY user_id, day"
)
def ag19_weighted_share(spark: S, d: str) -> DataFrame:
    return W.weighted_share(view(spark, d, "b_ticks"), ["user_id", "day"], ["t_s", "event_id"], F.col("value") > 30).withColumn("share", F.round("share", 6))


@query(
    "WITH t AS (SELECT season, round, driver_id, lap_number, t, start_ms, lap_ms, speed FROM (SELECT *, unnest(range(CAST(ceil(start_ms / 15000) AS BIGINT), CAST(ceil(end_ms / 15000) AS BIGINT))) * 15000 AS t FROM b_timed)) "
    "SELECT season, round, driver_id, lap_number, count(*) AS samples, count(*) FILTER (speed > 5) AS valid, round(count(*) FILTER (speed < 20) / count(*), 6) AS traffic, round(100.0 * least(count(*) * 15000, max(lap_ms)) / max(lap_ms), 6) AS coverage FROM t GROUP BY ALL"
)
def ag22_tick_collapse(spark: S, d: str) -> DataFrame:
    step = 15000
    ticks = view(spark, d, "b_timed").withColumn("_t", F.sequence(F.ceil(F.col("start_ms") / step), F.ceil(F.col("end_ms") / step) - 1)).where(F.ceil(F.col("end_ms") / step) > F.ceil(F.col("start_ms") / step))
    ticks = ticks.withColumn("t", F.explode("_t"))
    n = F.count("*")
    return ticks.groupBy(*LAP).agg(n.alias("samples"), F.count_if(F.col("speed") > 5).alias("valid"), F.round(F.count_if(F.col("speed") < 20) / n, 6).alias("traffic"), F.round(100.0 * F.least(n * step, F.max("lap_ms")) / F.max("lap_ms"), 6).alias("coverage"))


@query(
    "WITH m AS (SELECT *, median(delta) OVER (PARTITION BY season, driver_id) AS m FROM (SELECT season, driver_id, lap_time_sec - 83 AS delta FROM b_laps)) SELECT season, driver_id, round(100.0 * count(*) FILTER (sign(delta) = sign(m)) / count(*), 6) AS agreement FROM m GROUP BY ALL"
)
def ag25_sign_agreement(spark: S, d: str) -> DataFrame:
    return E.sign_agreement(laps(spark, d).select("season", "driver_id", (F.col("lap_time_sec") - 83).alias("delta")), ["season", "driver_id"], "delta").withColumn("agreement", F.round("agreement", 6))


@query(
    "WITH f AS (SELECT season, round, avg(speed) AS v, avg(lap_time_sec) AS t FROM b_laps GROUP BY ALL), q AS (SELECT quantile_cont(v, 0.67) AS qv, quantile_cont(t, 0.67) AS qt FROM f) "
    "SELECT season, round, CASE WHEN v >= qv THEN 'fast' WHEN t >= qt THEN 'long' ELSE 'plain' END AS kind FROM f, q"
)
def ag26_global_thresholds(spark: S, d: str) -> DataFrame:
    f = laps(spark, d).groupBy(*RACE).agg(F.avg("speed").alias("v"), F.avg("lap_time_sec").alias("t"))
    return E.classified(f, {"v": (0.67, "fast"), "t": (0.67, "long")}, "plain", "kind").select(*RACE, "kind")


@query(
    "SELECT a.season, a.driver_id, b.driver_id AS other_driver_id, count(*) AS n, round(100.0 * count(*) FILTER (a.lap_time_sec < b.lap_time_sec) / count(*), 6) AS win_pct "
    f"FROM b_laps a JOIN b_laps b ON {_ON_RACE} AND a.team = b.team AND a.lap_number = b.lap_number AND a.driver_id <> b.driver_id GROUP BY 1, 2, 3"
)
def ag27_record(spark: S, d: str) -> DataFrame:
    p = J.pairs(laps(spark, d), [*RACE, "team", "lap_number"], "driver_id", ["lap_time_sec"])
    return p.groupBy("season", "driver_id", "other_driver_id").agg(F.count("*").alias("n"), F.round(100.0 * F.count_if(F.col("lap_time_sec") < F.col("other_lap_time_sec")) / F.count("*"), 6).alias("win_pct"))


_SECTIONS = "SELECT 'laps' AS section, count(*) AS n, count(DISTINCT driver_id) AS entities, count(DISTINCT (season, round)) AS races, count(*) FILTER (track_status = '1') AS usable, max(season) AS latest FROM b_laps UNION ALL SELECT 'green', count(*), count(DISTINCT driver_id), count(DISTINCT (season, round)), count(*) FILTER (tyre_life >= 2), max(season) FROM b_laps WHERE track_status = '1' UNION ALL SELECT 'marked', count(*), count(DISTINCT driver_id), count(DISTINCT (season, round)), count(*) FILTER (tyre_life >= 2), max(season) FROM b_laps WHERE track_status = '4'"


def sections(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d)
    parts = {"laps": (rows, F.col("track_status") == "1"), "green": (rows.where("track_status = '1'"), F.col("tyre_life") >= 2), "marked": (rows.where("track_status = '4'"), F.col("tyre_life") >= 2)}
    return E.section_coverage(parts, "driver_id", RACE, "season")


@query(_SECTIONS)
def ag29_sections(spark: S, d: str) -> DataFrame:
    return sections(spark, d)


@query("SELECT season, count(*) AS rows, true AS same, (SELECT count(*) FROM b_laps) - count(*) <> 0 AS others_differ FROM b_laps GROUP BY season")
def ag30_fingerprint(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d)
    a = Q.fingerprint(rows, ["season"])
    again = rows.select(*reversed(rows.columns)).withColumn("lap_number", F.col("lap_number").cast("double"))  # other column order and number storage
    other = Q.fingerprint(rows.withColumn("speed", F.col("speed") + 1), ["season"]).select("season", F.col("xor").alias("x2"))
    both = a.join(Q.fingerprint(again, ["season"]).select("season", F.col("xor").alias("x1"), F.col("sum").alias("s1")), "season").join(other, "season")
    return both.select("season", "rows", ((F.col("xor") == F.col("x1")) & (F.col("sum") == F.col("s1"))).alias("same"), (F.col("xor") != F.col("x2")).alias("others_differ"))


@query(
    "WITH p AS (SELECT season, lap_time_sec - 83 AS y, 0.05 * tyre_life AS p, 3.0 AS w FROM b_laps) SELECT season, count(*) AS n, round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(avg(CASE WHEN sign(y) = sign(p) THEN 1.0 ELSE 0.0 END), 6) AS sign_accuracy, "
    "round(corr(y, p), 6) AS r, round(1 - avg(abs(y - p)) / avg(abs(y)), 6) AS skill, round(avg(CASE WHEN abs(y - p) <= w THEN 1.0 ELSE 0.0 END), 6) AS covered, round(avg(2 * w), 6) AS width FROM p GROUP BY season"
)
def ag31_error_metrics(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d).select("season", (F.col("lap_time_sec") - 83).alias("y"), (0.05 * F.col("tyre_life")).alias("p"), F.lit(3.0).alias("w"))
    out = E.error_metrics(rows, ["season"], "y", "p", "w")
    return out.select("season", "n", *[F.round(c, 6).alias(c) for c in ("mae", "rmse", "sign_accuracy", "r", "skill", "covered", "width")])


@query(
    "WITH c AS (SELECT season, round, driver_id FROM b_laps GROUP BY ALL HAVING count(*) = max(lap_number) AND count(*) >= 10), f AS (SELECT season, round, driver_id, bool_or(track_status = '4') AS truth, bool_or(l_flag) AS found FROM (SELECT *, lap_time_sec > 86.5 AS l_flag FROM b_laps) JOIN c USING (season, round, driver_id) GROUP BY ALL) "
    "SELECT season, count(*) FILTER (truth AND found) AS tp, count(*) FILTER (NOT truth AND found) AS fp, count(*) FILTER (truth AND NOT found) AS fn, round(count(*) FILTER (truth AND found) / nullif(count(*) FILTER (found), 0), 6) AS precision, round(count(*) FILTER (truth AND found) / nullif(count(*) FILTER (truth), 0), 6) AS recall FROM f GROUP BY season"
)
def ag32_confusion(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d)
    covered = rows.groupBy(*RACE, "driver_id").agg(F.bool_or(F.col("track_status") == "4").alias("truth"), F.bool_or(F.col("lap_time_sec") > 86.5).alias("found"), F.count("*").alias("n"), F.max("lap_number").alias("m")).where("n = m and n >= 10")
    out = E.confusion(covered, ["season"], "truth", "found")
    return out.select("season", "tp", "fp", "fn", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query("SELECT season, round(stddev_pop(m), 6) AS spread FROM (SELECT season, driver_id, median(lap_time_sec) AS m FROM b_laps GROUP BY ALL) GROUP BY season")
def ag34_spread(spark: S, d: str) -> DataFrame:
    return E.between_spread(laps(spark, d), ["season"], "driver_id", "lap_time_sec").withColumn("spread", F.round("spread", 6))


@query("SELECT season, compound, count(DISTINCT round) AS races, round(avg(slope), 6) AS slope FROM (SELECT season, round, compound, driver_id, regr_slope(lap_time_sec, tyre_life) AS slope FROM b_laps GROUP BY ALL HAVING count(*) >= 8) WHERE slope IS NOT NULL GROUP BY ALL HAVING count(DISTINCT round) >= 3")
def ag35_mean_slopes(spark: S, d: str) -> DataFrame:
    fits = laps(spark, d).groupBy(*RACE, "compound", "driver_id").agg(F.regr_slope("lap_time_sec", "tyre_life").alias("slope"), F.count("*").alias("n")).where("n >= 8 and slope is not null")
    return fits.groupBy("season", "compound").agg(F.count_distinct("round").alias("races"), F.round(F.avg("slope"), 6).alias("slope")).where("races >= 3")


@query("SELECT round(max(abs(c_acctbal)) FILTER (c_mktsegment = 'BUILDING'), 6) AS most FROM customer HAVING count(*) FILTER (c_acctbal > 1000000) > 0")
def ag36_having_no_group(spark: S, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.agg(F.round(F.max(F.when(F.col("c_mktsegment") == "BUILDING", F.abs("c_acctbal"))), 6).alias("most"), F.count_if(F.col("c_acctbal") > 1000000).alias("n")).where("n > 0").select("most")


@query(f"WITH s AS ({_SECTIONS}) SELECT CAST(sum(n) AS BIGINT) AS n, min(usable) AS least, max(races) AS races, max(latest) AS latest, (SELECT count(DISTINCT driver_id) FROM b_laps) AS entities FROM s")
def ag37_coverage_rollup(spark: S, d: str) -> DataFrame:
    top = sections(spark, d).agg(F.sum("n").alias("n"), F.min("usable").alias("least"), F.max("races").alias("races"), F.max("latest").alias("latest"))
    return top.crossJoin(F.broadcast(laps(spark, d).agg(F.count_distinct("driver_id").alias("entities"))))  # one row each


@query("SELECT reason, count(*) AS n FROM (SELECT CASE WHEN track_status = '4' THEN 'marked' WHEN tyre_life < 2 THEN 'new' WHEN compound = 'HARD' THEN 'hard' END AS reason FROM b_laps) WHERE reason IS NOT NULL GROUP BY reason ORDER BY n DESC, reason")
def ag38_reasons(spark: S, d: str) -> DataFrame:
    reason = C.first_reason((F.col("track_status") == "4", "marked"), (F.col("tyre_life") < 2, "new"), (F.col("compound") == "HARD", "hard"))
    return laps(spark, d).select(reason.alias("reason")).where("reason is not null").groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")


# windows
@query("SELECT user_id, event_type, day, count(*) AS n FROM (SELECT DISTINCT user_id, event_type, day FROM b_ticks) GROUP BY ALL")
def wn01_dedupe(spark: S, d: str) -> DataFrame:
    w = Window.partitionBy("user_id", "event_type", "day").orderBy("t_s", "event_id")
    return view(spark, d, "b_ticks").withColumn("k", F.row_number().over(w)).where("k = 1").groupBy("user_id", "event_type", "day").agg(F.count("*").alias("n"))


@query("SELECT season, round, driver_id, lap_number, lag(speed, 2) OVER w AS before, lead(compound) OVER w AS next FROM b_laps WINDOW w AS (PARTITION BY season, round, driver_id ORDER BY lap_number)")
def wn07_lag_lead(spark: S, d: str) -> DataFrame:
    w = Window.partitionBy(*RACE, "driver_id").orderBy("lap_number")
    return laps(spark, d).select(*LAP, F.lag("speed", 2).over(w).alias("before"), F.lead("compound").over(w).alias("next"))


@query("SELECT season, round, driver_id, lap_number, min(lap_number) OVER s AS lo, max(lap_number) OVER s AS hi, count(*) OVER s AS n FROM b_laps WINDOW s AS (PARTITION BY season, round, driver_id, stint)")
def wn10_named_window(spark: S, d: str) -> DataFrame:
    return spark.sql("SELECT season, round, driver_id, lap_number, min(lap_number) OVER s AS lo, max(lap_number) OVER s AS hi, count(*) OVER s AS n FROM {l} WINDOW s AS (PARTITION BY season, round, driver_id, stint)", l=laps(spark, d))


@query("SELECT season, round, driver_id, lap_number, round(lap_time_sec - median(lap_time_sec) OVER (PARTITION BY season, round, driver_id), 6) AS above FROM b_laps")
def wn11_partition_median(spark: S, d: str) -> DataFrame:
    return laps(spark, d).select(*LAP, F.round(F.col("lap_time_sec") - F.percentile("lap_time_sec", 0.5).over(Window.partitionBy(*RACE, "driver_id")), 6).alias("above"))


@query("SELECT season, round, lap_number, driver_id, count(CASE WHEN speed < 50 THEN speed END) OVER w = count(*) OVER w AS complete FROM b_laps WINDOW w AS (PARTITION BY season, round, lap_number)")
def wn12_field_complete(spark: S, d: str) -> DataFrame:
    w = Window.partitionBy(*RACE, "lap_number")
    return laps(spark, d).select(*RACE, "lap_number", "driver_id", (F.count(F.when(F.col("speed") < 50, F.col("speed"))).over(w) == F.count("*").over(w)).alias("complete"))


@query("SELECT season, driver_id, round(m - lag(m) OVER (PARTITION BY driver_id ORDER BY season), 6) AS change FROM (SELECT season, driver_id, avg(speed) AS m FROM b_laps GROUP BY ALL)")
def wn13_season_change(spark: S, d: str) -> DataFrame:
    means = laps(spark, d).groupBy("season", "driver_id").agg(F.avg("speed").alias("m"))
    return means.select("season", "driver_id", F.round(F.col("m") - F.lag("m").over(Window.partitionBy("driver_id").orderBy("season")), 6).alias("change"))


@query("SELECT season, round, driver_id, lap_number, lap_number = min(lap_number) OVER s AS first_in, lap_number = max(lap_number) OVER s AS last_in, stint = max(stint) OVER (PARTITION BY season, round, driver_id) AS last_stint FROM b_laps WINDOW s AS (PARTITION BY season, round, driver_id, stint)")
def wn14_segment_bounds(spark: S, d: str) -> DataFrame:
    s, r = Window.partitionBy(*STINT), Window.partitionBy(*RACE, "driver_id")
    n = F.col("lap_number")
    return laps(spark, d).select(*LAP, (n == F.min(n).over(s)).alias("first_in"), (n == F.max(n).over(s)).alias("last_in"), (F.col("stint") == F.max("stint").over(r)).alias("last_stint"))


@query(
    "WITH f AS (SELECT *, CASE WHEN speed < 25 THEN 1 ELSE 0 END AS f FROM b_laps), e AS (SELECT *, max(f) OVER (w RANGE BETWEEN 2 PRECEDING AND 1 PRECEDING) AS b, min(f) OVER (w RANGE BETWEEN CURRENT ROW AND 1 FOLLOWING) AS a, min(lap_number) OVER p AS lo, max(lap_number) OVER p AS hi FROM f "
    "WINDOW w AS (PARTITION BY season, round, driver_id ORDER BY lap_number), p AS (PARTITION BY season, round, driver_id)) SELECT season, round, driver_id, lap_number FROM e WHERE f = 1 AND b = 0 AND a = 1 AND lo <= lap_number - 2 AND hi >= lap_number + 1"
)
def wn18_onsets(spark: S, d: str) -> DataFrame:
    flagged = laps(spark, d).withColumn("f", F.when(F.col("speed") < 25, 1).otherwise(0))
    return W.onsets(flagged, [*RACE, "driver_id"], "lap_number", "f", 2, 1).select(*LAP)


@query(
    "WITH g AS (SELECT *, t_s - lag(t_s) OVER w AS g FROM b_ticks WINDOW w AS (PARTITION BY user_id, day ORDER BY t_s)), f AS (SELECT *, min(CASE WHEN value > 3 THEN 1 ELSE 0 END) OVER r AS h, max(CASE WHEN g > 7200 THEN t_s END) OVER r AS wide, max(t_s) OVER (PARTITION BY user_id, day) AS z, max(t_s) OVER r AS e "
    "FROM g WINDOW r AS (PARTITION BY user_id, day ORDER BY t_s RANGE BETWEEN CURRENT ROW AND 10800 FOLLOWING)) SELECT event_id, h = 1 AND (wide IS NULL OR wide <= t_s) AND z >= t_s + 10800 AND t_s + 10800 - e <= 7200 AS stays FROM f"
)
def wn19_persistence(spark: S, d: str) -> DataFrame:
    return W.persists(view(spark, d, "b_ticks"), ["user_id", "day"], "t_s", F.col("value") > 3, 10800, 7200, "stays").select("event_id", "stays")


@query(
    "WITH f AS (SELECT *, abs(lap_time_sec - 83.5) <= 1.5 AS h, lead(abs(lap_time_sec - 83.5) <= 1.5) OVER w AS h1, lead(lap_number) OVER w AS l1 FROM b_laps WINDOW w AS (PARTITION BY season, round, driver_id, stint ORDER BY lap_number)) "
    "SELECT season, round, driver_id, stint, min(tyre_life) FILTER (h AND h1 AND l1 = lap_number + 1) AS first FROM f GROUP BY ALL"
)
def wn20_first_pair(spark: S, d: str) -> DataFrame:
    return W.first_pair(laps(spark, d), STINT, "lap_number", F.abs(F.col("lap_time_sec") - 83.5) <= 1.5, "tyre_life")


@query("SELECT season, round, driver_id, lap_number FROM b_laps QUALIFY row_number() OVER (PARTITION BY season, round, driver_id ORDER BY speed DESC, lap_number) = 1")
def wn23_qualify(spark: S, d: str) -> DataFrame:
    w = Window.partitionBy(*RACE, "driver_id").orderBy(F.desc("speed"), "lap_number")
    return laps(spark, d).withColumn("k", F.row_number().over(w)).where("k = 1").select(*LAP)


# order and sets
@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS price FROM orders ORDER BY price NULLS LAST, o_orderkey")
def st01_nulls_last(spark: S, d: str) -> DataFrame:
    price = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("price")
    return table(spark, d, "orders").select("o_orderkey", price).orderBy(F.col("price").asc_nulls_last(), "o_orderkey")


@query(
    "WITH s AS (SELECT driver_id, avg(speed) AS v, count(*) AS n, stddev_samp(speed) AS sd FROM b_laps GROUP BY 1) SELECT * FROM (SELECT 'fastest' AS kind, driver_id FROM s ORDER BY v DESC, driver_id LIMIT 1) UNION ALL SELECT * FROM (SELECT 'busiest', driver_id FROM s ORDER BY n DESC, driver_id LIMIT 1) "
    "UNION ALL SELECT * FROM (SELECT 'steadiest', driver_id FROM s ORDER BY sd, driver_id LIMIT 1)"
)
def st04_top_of_each(spark: S, d: str) -> DataFrame:
    s = laps(spark, d).groupBy("driver_id").agg(F.avg("speed").alias("v"), F.count("*").alias("n"), F.stddev_samp("speed").alias("sd"))
    top = lambda kind, *order: s.orderBy(*order, "driver_id").limit(1).select(F.lit(kind).alias("kind"), "driver_id")
    return top("fastest", F.desc("v")).unionByName(top("busiest", F.desc("n"))).unionByName(top("steadiest", F.asc_nulls_last("sd")))


@query(
    "SELECT season, round, driver_id, CAST(row_number() OVER (PARTITION BY season, round ORDER BY CASE WHEN marked > 0 THEN 0 ELSE 1 END, marked DESC, best, driver_id) AS BIGINT) AS priority FROM (SELECT season, round, driver_id, count(*) FILTER (track_status = '4') AS marked, min(lap_time_sec) AS best FROM b_laps GROUP BY 1, 2, 3)"
)
def st05_priority(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d).groupBy(*RACE, "driver_id").agg(F.count_if(F.col("track_status") == "4").alias("marked"), F.min("lap_time_sec").alias("best"))
    w = Window.partitionBy(*RACE).orderBy(F.when(F.col("marked") > 0, 0).otherwise(1), F.desc("marked"), "best", "driver_id")
    return rows.select(*RACE, "driver_id", F.row_number().over(w).cast("long").alias("priority"))


@query("SELECT s_nationkey AS k, 'supplier' AS side FROM supplier UNION ALL SELECT c_nationkey, 'customer' FROM customer")
def st06_union_all(spark: S, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"), F.lit("supplier").alias("side")).unionByName(table(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.lit("customer").alias("side")))


@query("SELECT s_nationkey AS k FROM supplier UNION SELECT c_nationkey FROM customer")
def st07_union(spark: S, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")).union(table(spark, d, "customer").select("c_nationkey")).distinct()


@query("SELECT k FROM (SELECT o_orderpriority AS k FROM orders WHERE o_orderstatus = 'F' EXCEPT ALL SELECT o_orderpriority FROM orders WHERE o_orderstatus = 'P')")
def st10_except_all(spark: S, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.where("o_orderstatus = 'F'").select(F.col("o_orderpriority").alias("k")).exceptAll(o.where("o_orderstatus = 'P'").select("o_orderpriority"))


# scalar functions
@query("SELECT season, round, CAST(floor(ms / 60000) AS BIGINT) || ':' || lpad(CAST(CAST(floor(ms % 60000 / 1000) AS BIGINT) AS VARCHAR), 2, '0') || '.' || lpad(CAST(ms % 1000 AS VARCHAR), 3, '0') AS shown FROM (SELECT season, round, sum(lap_ms)::BIGINT AS ms FROM b_timed GROUP BY 1, 2)")
def sc02_format_duration(spark: S, d: str) -> DataFrame:
    return view(spark, d, "b_timed").groupBy(*RACE).agg(F.sum("lap_ms").alias("ms")).select(*RACE, C.format_duration(F.col("ms") / 1000).alias("shown"))


@query("SELECT p_partkey, split_part(p_type, ' ', 1) AS head, strpos(p_name, 'a') AS at, upper(trim(p_brand)) AS brand, lower(replace(p_type, ' ', '_')) AS slug, lpad(CAST(p_size AS VARCHAR), 4, '0') AS size, concat(p_brand, '/', p_type) AS label FROM part")
def sc03_strings(spark: S, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        "p_partkey", F.split_part("p_type", F.lit(" "), F.lit(1)).alias("head"), F.instr("p_name", "a").cast("long").alias("at"), F.upper(F.trim("p_brand")).alias("brand"), F.lower(F.replace("p_type", F.lit(" "), F.lit("_"))).alias("slug"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("size"), F.concat("p_brand", F.lit("/"), "p_type").alias("label"),
    )


@query("SELECT count(*) FILTER (p_type LIKE 'S%') AS s, count(*) FILTER (p_type LIKE '%E%' OR p_type LIKE '%O_') AS eo, count(*) FILTER (p_name NOT LIKE '%1%') AS plain FROM part")
def sc04_like(spark: S, d: str) -> DataFrame:
    t, n = F.col("p_type"), F.col("p_name")
    return table(spark, d, "part").agg(F.count_if(t.like("S%")).alias("s"), F.count_if(t.like("%E%") | t.like("%O_")).alias("eo"), F.count_if(~n.like("%1%")).alias("plain"))


@query("SELECT count(*) FILTER (substr(CAST(o_orderdate AS VARCHAR), 1, 10) <= '1998-01-01') AS done, max(substr(CAST(o_orderdate AS VARCHAR), 1, 10)) FILTER (substr(CAST(o_orderdate AS VARCHAR), 1, 10) < '1998-01-01') AS latest FROM orders")
def sc06_date_prefix(spark: S, d: str) -> DataFrame:
    day = F.to_date(F.substring(F.col("o_orderdate").cast("string"), 1, 10))
    return table(spark, d, "orders").agg(F.count_if(day <= F.lit("1998-01-01").cast("date")).alias("done"), F.max(F.when(day < F.lit("1998-01-01").cast("date"), day)).cast("string").alias("latest"))


@query("SELECT event_id, round(epoch(ts) - (SELECT min(epoch(ts)) FROM events), 3) AS since FROM events")
def sc07_iso_time(spark: S, d: str) -> DataFrame:
    iso = table(spark, d, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("iso"))
    seconds = iso.select("event_id", (F.unix_micros(F.to_timestamp("iso", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX")) / 1_000_000).alias("s"))
    return seconds.crossJoin(F.broadcast(seconds.agg(F.min("s").alias("zero")))).select("event_id", F.round(F.col("s") - F.col("zero"), 3).alias("since"))  # one row


@query(
    "WITH m AS (SELECT max(CAST(o_orderdate AS DATE)) AS now FROM orders) SELECT o_custkey, CAST(date_diff('day', max(CAST(o_orderdate AS DATE)), max(now)) AS INTEGER) AS age, CASE WHEN date_diff('day', max(CAST(o_orderdate AS DATE)), max(now)) <= 30 THEN 'fresh' WHEN date_diff('day', max(CAST(o_orderdate AS DATE)), max(now)) <= 180 THEN 'ageing' ELSE 'stale' END AS label, "
    "max(CAST(o_orderdate AS DATE)) < current_date AS in_the_past FROM orders, m GROUP BY o_custkey"
)
def sc08_freshness(spark: S, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    last = o.groupBy("o_custkey").agg(F.max("day").alias("day")).crossJoin(F.broadcast(o.agg(F.max("day").alias("now"))))  # one row
    age = F.datediff("now", "day")
    return last.select("o_custkey", age.alias("age"), C.freshness(age, 30, 180).alias("label"), (F.col("day") < F.current_date()).alias("in_the_past"))


@query(
    "SELECT c_custkey, round(ln(abs(c_acctbal) + 1), 6) AS a, round(sqrt(abs(c_acctbal)), 6) AS b, round(pow(c_nationkey, 2), 6) AS c, CAST(floor(c_acctbal) AS BIGINT) AS d, CAST(sign(c_acctbal) AS DOUBLE) AS e, greatest(c_acctbal, 0) AS f, least(c_acctbal, 0) AS g, nullif(c_nationkey, 3) AS h, coalesce(nullif(c_nationkey, 3), -1) AS i, least(greatest(c_acctbal, -100), 100) AS j FROM customer"
)
def sc09_arithmetic(spark: S, d: str) -> DataFrame:
    v, n = F.col("c_acctbal"), F.col("c_nationkey")
    none = F.nullif(n, F.lit(3))
    return table(spark, d, "customer").select(
        "c_custkey", F.round(F.ln(F.abs(v) + 1), 6).alias("a"), F.round(F.sqrt(F.abs(v)), 6).alias("b"), F.round(F.pow(n, F.lit(2)), 6).alias("c"), F.floor(v).alias("d"), F.signum(v).alias("e"), F.greatest(v, F.lit(0.0)).alias("f"), F.least(v, F.lit(0.0)).alias("g"),
        none.alias("h"), F.coalesce(none, F.lit(-1)).alias("i"), F.least(F.greatest(v, F.lit(-100.0)), F.lit(100.0)).alias("j"),
    )


@query("SELECT season, round, round(sqrt(pow(max(speed) - min(speed), 2) + pow(max(lap_time_sec) - min(lap_time_sec), 2)), 6) AS diagonal FROM b_laps GROUP BY 1, 2")
def sc10_hypot(spark: S, d: str) -> DataFrame:
    return laps(spark, d).groupBy(*RACE).agg(F.round(F.hypot(F.max("speed") - F.min("speed"), F.max("lap_time_sec") - F.min("lap_time_sec")), 6).alias("diagonal"))


@query("SELECT count(*) AS n, count(*) FILTER (event_id % 10 NOT IN (0, 1)) AS finite FROM events")
def sc11_isfinite(spark: S, d: str) -> DataFrame:
    v = F.when(F.col("event_id") % 10 == 0, F.lit(float("nan"))).when(F.col("event_id") % 10 == 1, F.lit(float("inf"))).otherwise(F.col("value"))
    return table(spark, d, "events").select(v.alias("v")).agg(F.count("*").alias("n"), F.count(C.finite(F.col("v"))).alias("finite"))


@query("SELECT event_id, TRY_CAST(CASE WHEN event_id % 3 = 0 THEN event_type ELSE CAST(event_id AS VARCHAR) END AS BIGINT) AS n FROM events")
def sc12_try_cast(spark: S, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("event_id").cast("string")).try_cast("long").alias("n"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def sc14_raise_if_stale(spark: S, d: str) -> DataFrame:
    e = table(spark, d, "events")
    newest = e.agg(F.max("ts").alias("newest"))
    counts = e.groupBy("event_type").agg(F.count("*").alias("n")).crossJoin(F.broadcast(newest))  # one row
    return Q.must(counts, F.col("newest") >= F.lit("1990-01-01").cast("timestamp"), "events are stale").select("event_type", "n")


@query("SELECT driver_id, round(sqrt((pow(avg(speed) - 25, 2) + pow(avg(lap_time_sec) - 83, 2) + pow(avg(tyre_life) - 4, 2)) / 3), 6) AS distance FROM b_laps GROUP BY driver_id")
def sc16_rms(spark: S, d: str) -> DataFrame:
    return laps(spark, d).groupBy("driver_id").agg(F.round(C.rms(F.avg("speed") - 25, F.avg("lap_time_sec") - 83, F.avg("tyre_life") - 4), 6).alias("distance"))


@query("SELECT s_suppkey, round(least(greatest(0.5 * s_acctbal / 10000 + 0.3 * (s_nationkey / 25) + 0.2 * CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END, 0), 1), 9) AS confidence FROM supplier")
def sc18_score(spark: S, d: str) -> DataFrame:
    score = C.score((0.5, F.col("s_acctbal") / 10000), (0.3, F.col("s_nationkey") / 25), (0.2, F.when(F.col("s_acctbal") > 0, 1).otherwise(0)))
    return table(spark, d, "supplier").select("s_suppkey", F.round(score, 9).alias("confidence"))


@query("SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, round(100 * (ln(l_extendedprice) - ln(l_quantity)), 6) AS gap FROM lineitem")
def sc19_log_gap(spark: S, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.round(C.log_gap(F.col("l_extendedprice"), F.col("l_quantity")), 6).alias("gap"))
