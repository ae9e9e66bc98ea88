"""Queries of projections, joins, aggregates, windows, sorts and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from chronolith.functions import columns as C
from chronolith.operators import joins as J, robust as R, windows as W
from chronolith.plans.bindings import table, view
from chronolith.plans.registry import query

S = SparkSession


def laps(spark: S, d: str) -> DataFrame:
    return view(spark, d, "b_laps")


@query("SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CAST(o_totalprice AS DOUBLE) AS price FROM orders")
def pr01_typed_projection(spark: S, d: str) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("date").cast("string").alias("day"), F.col("o_totalprice").cast("double").alias("price"))


@query("SELECT md5(CAST(o_orderkey AS VARCHAR) || '-' || coalesce(o_orderstatus, '_null_')) AS key, o_orderkey FROM orders")
def pr02_surrogate_key(spark: S, d: str) -> DataFrame:
    return table(spark, d, "orders").select(C.surrogate_key("o_orderkey", "o_orderstatus").alias("key"), "o_orderkey")


@query("SELECT season, count(*) AS n FROM b_laps WHERE season BETWEEN 1996 AND 1998 GROUP BY season")
def pr03_scope_filter(spark: S, d: str) -> DataFrame:
    return laps(spark, d).where("season between 1996 and 1998").groupBy("season").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN trim(o_orderpriority) IN ('', 'none', 'nan') OR o_orderpriority IS NULL THEN 'UNKNOWN' ELSE upper(trim(o_orderpriority)) END AS category, count(*) AS n FROM orders GROUP BY 1")
def pr04_category(spark: S, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy(C.category(F.col("o_orderpriority")).alias("category")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN true WHEN o_orderstatus = 'O' THEN false END AS is_final FROM orders")
def pr05_three_valued_flag(spark: S, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False).alias("is_final"))


@query(
    "SELECT user_id, count(*) FILTER (value > 100) AS high, count(*) FILTER (value < 5) AS low, round(avg(least(greatest(value, 5), 100)), 6) AS clipped, "
    "round(100.0 * count(*) FILTER (value BETWEEN 5 AND 100) / count(*), 6) AS coverage FROM events GROUP BY user_id"
)
def pr06_range_cleaning(spark: S, d: str) -> DataFrame:
    v = F.col("value")
    return table(spark, d, "events").groupBy("user_id").agg(
        F.count_if(v > 100).alias("high"), F.count_if(v < 5).alias("low"), F.round(F.avg(F.least(F.greatest(v, F.lit(5)), F.lit(100))), 6).alias("clipped"), F.round(100 * F.count_if(v.between(5, 100)) / F.count("*"), 6).alias("coverage")
    )


@query("SELECT count(*) AS n FROM events WHERE isfinite(value) AND value > 0 AND value % 1 = 0")
def pr07_integer_guards(spark: S, d: str) -> DataFrame:
    return table(spark, d, "events").where(C.finite(F.col("value")).isNotNull() & (F.col("value") > 0) & (F.col("value") % 1 == 0)).agg(F.count("*").alias("n"))


_MID = "SELECT *, min(lap_number) OVER w AS lo, max(lap_number) OVER w AS hi FROM b_laps WHERE track_status = '1' WINDOW w AS (PARTITION BY season, round, driver_id, stint)"


@query(f"SELECT season, round, count(*) AS n FROM ({_MID}) WHERE lap_number > lo AND lap_number < hi GROUP BY season, round")
def pr09_mid_segment(spark: S, d: str) -> DataFrame:
    return mid_stint(laps(spark, d)).groupBy("season", "round").agg(F.count("*").alias("n"))


def mid_stint(rows: DataFrame) -> DataFrame:
    w = Window.partitionBy("season", "round", "driver_id", "stint")
    green = rows.where("track_status = '1'").withColumns({"lo": F.min("lap_number").over(w), "hi": F.max("lap_number").over(w)})
    return green.where("lap_number > lo and lap_number < hi").drop("lo", "hi")


@query("SELECT c_custkey, c_name FROM customer c WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def pr10_exists(spark: S, d: str) -> DataFrame:
    big = table(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(big, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("SELECT o_orderkey, CASE WHEN o_totalprice < 1000 THEN 'small' WHEN o_orderstatus = 'P' THEN 'pending' WHEN o_orderpriority LIKE '1%' THEN 'urgent' END AS exclusion_reason FROM orders")
def pr12_first_reason(spark: S, d: str) -> DataFrame:
    rules = ((F.col("o_totalprice") < 1000, "small"), (F.col("o_orderstatus") == "P", "pending"), (F.col("o_orderpriority").startswith("1"), "urgent"))
    return table(spark, d, "orders").select("o_orderkey", C.first_reason(*rules).alias("exclusion_reason"))


@query("SELECT s_suppkey, CASE WHEN s_acctbal >= 7000 THEN 'high' WHEN s_acctbal >= 2000 THEN 'medium' ELSE 'low' END AS confidence FROM supplier")
def pr13_confidence(spark: S, d: str) -> DataFrame:
    return table(spark, d, "supplier").select("s_suppkey", C.tier(F.col("s_acctbal"), (7000, "high"), (2000, "medium"), other="low").alias("confidence"))


@query("SELECT o_orderkey FROM orders WHERE o_totalprice < 0 UNION ALL SELECT -1 WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_totalprice < 0)")
def pr14_sentinel(spark: S, d: str) -> DataFrame:
    rows = table(spark, d, "orders").where("o_totalprice < 0").select("o_orderkey")
    return rows.unionByName(rows.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(-1).cast("long").alias("o_orderkey")))


@query(
    "SELECT season, round, driver_id, lap_number, CASE WHEN lap_number <= 0.25 * m THEN 'Opening' WHEN lap_number <= 0.70 * m THEN 'Middle' ELSE 'Closing' END AS phase "
    "FROM (SELECT *, max(lap_number) OVER (PARTITION BY season, round) AS m FROM b_laps)"
)
def pr15_phase(spark: S, d: str) -> DataFrame:
    last = F.max("lap_number").over(Window.partitionBy("season", "round"))
    return laps(spark, d).select("season", "round", "driver_id", "lap_number", C.phase(F.col("lap_number"), last).alias("phase"))


@query("SELECT DISTINCT 'R' || lpad(CAST(round AS VARCHAR), 2, '0') || ' · ' || CAST(season AS VARCHAR) AS label FROM b_laps")
def pr16_labels(spark: S, d: str) -> DataFrame:
    return laps(spark, d).select(F.concat(F.lit("R"), F.lpad(F.col("round").cast("string"), 2, "0"), F.lit(" · "), F.col("season").cast("string")).alias("label")).distinct()


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS price FROM orders")
def pr17_mask(spark: S, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("price"))


@query("SELECT n_name, r_name, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def jn01_inner(spark: S, d: str) -> DataFrame:
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select("n_name", "r_name", "s_suppkey")


@query(
    "SELECT o_orderkey, c_name, n_name, r_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"
)
def jn02_left_enrichment(spark: S, d: str) -> DataFrame:
    out = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    out = out.join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return out.select("o_orderkey", "c_name", "n_name", "r_name")


@query("SELECT a.season, a.round, a.team, a.lap_number, a.driver_id, b.driver_id AS other_driver_id, a.speed, b.speed AS other_speed FROM b_laps a JOIN b_laps b ON a.season = b.season AND a.round = b.round AND a.team = b.team AND a.lap_number = b.lap_number AND a.driver_id <> b.driver_id")
def jn04_pairs(spark: S, d: str) -> DataFrame:
    return J.pairs(laps(spark, d), ["season", "round", "team", "lap_number"], "driver_id", ["speed"])


@query("SELECT season, round, team, count(*) AS n FROM b_laps GROUP BY season, round, team HAVING count(DISTINCT driver_id) = 2")
def jn05_exactly_two(spark: S, d: str) -> DataFrame:
    return J.exactly(laps(spark, d), ["season", "round", "team"], "driver_id", 2).groupBy("season", "round", "team").agg(F.count("*").alias("n"))


@query(
    "SELECT p.season, p.round, p.driver_id, p.lap_number, b.speed AS before, a.speed AS after FROM b_laps p JOIN b_laps b ON p.season = b.season AND p.round = b.round AND p.driver_id = b.driver_id AND b.lap_number = p.lap_number - 1 "
    "JOIN b_laps a ON p.season = a.season AND p.round = a.round AND p.driver_id = a.driver_id AND a.lap_number = p.lap_number + 2 WHERE p.tyre_life = 8"
)
def jn06_offset(spark: S, d: str) -> DataFrame:
    rows, key = laps(spark, d), ["season", "round", "driver_id", "lap_number"]
    at = lambda shift, name: rows.select("season", "round", "driver_id", (F.col("lap_number") - shift).alias("lap_number"), F.col("speed").alias(name))
    return rows.where("tyre_life = 8").select(*key).join(at(-1, "before"), key).join(at(2, "after"), key)


_STAYS = "SELECT user_id, day, event_id AS stay, t_s AS start_s, t_s + 7200 AS end_s FROM b_ticks WHERE event_type = 'signup'"


@query(f"SELECT t.event_id, s.stay FROM b_ticks t JOIN ({_STAYS}) s ON t.user_id = s.user_id AND t.day = s.day AND t.t_s >= s.start_s AND t.t_s < s.end_s")
def jn07_interval(spark: S, d: str) -> DataFrame:
    t = view(spark, d, "b_ticks")
    return J.interval(t, stays(t), ["user_id", "day"], "t_s", "start_s", "end_s", 3600).select("event_id", "stay")


def stays(t: DataFrame) -> DataFrame:
    return t.where("event_type = 'signup'").select("user_id", "day", F.col("event_id").alias("stay"), F.col("t_s").alias("start_s"), (F.col("t_s") + 7200).alias("end_s"))


@query("SELECT a.season, a.round, a.driver_id, a.lap_number, count(b.lap_number) AS near FROM b_laps a LEFT JOIN b_laps b ON a.season = b.season AND a.round = b.round AND a.driver_id = b.driver_id AND b.track_status = '4' AND b.lap_number BETWEEN a.lap_number - 2 AND a.lap_number + 2 GROUP BY ALL")
def jn08_band(spark: S, d: str) -> DataFrame:
    a, b = laps(spark, d), laps(spark, d).where("track_status = '4'")
    key = ["season", "round", "driver_id"]
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key] + [F.col("b.lap_number").between(F.col("a.lap_number") - 2, F.col("a.lap_number") + 2)]
    return a.alias("a").join(b.alias("b"), on, "left").groupBy(*[F.col(f"a.{k}") for k in key], F.col("a.lap_number")).agg(F.count("b.lap_number").alias("near"))


@query("SELECT a.season, a.round, a.team, count(*) AS n, round(avg(a.speed - b.speed), 6) AS gap FROM b_laps a JOIN b_laps b ON a.season = b.season AND a.round = b.round AND a.team = b.team AND a.compound = b.compound AND a.driver_id < b.driver_id AND abs(a.tyre_life - b.tyre_life) <= 3 GROUP BY a.season, a.round, a.team")
def jn09_similarity_band(spark: S, d: str) -> DataFrame:
    out = J.pairs(laps(spark, d), ["season", "round", "team", "compound"], "driver_id", ["speed", "tyre_life"], F.abs(F.col("a.tyre_life") - F.col("b.tyre_life")) <= 3)
    return out.where("driver_id < other_driver_id").groupBy("season", "round", "team").agg(F.count("*").alias("n"), F.round(F.avg(F.col("speed") - F.col("other_speed")), 6).alias("gap"))


@query("SELECT a.season, a.round, round(avg(b.m), 6) AS others FROM (SELECT season, round, avg(speed) AS m FROM b_laps GROUP BY ALL) a JOIN (SELECT season, round, avg(speed) AS m FROM b_laps GROUP BY ALL) b ON a.season = b.season AND a.round <> b.round GROUP BY a.season, a.round")
def jn10_leave_one_out(spark: S, d: str) -> DataFrame:
    means = laps(spark, d).groupBy("season", "round").agg(F.avg("speed").alias("m"))
    return W.loo_mean(means, ["season"], "m", "others", least=2).where("others is not null").select("season", "round", F.round("others", 6).alias("others"))


@query("SELECT s_suppkey, round(s_acctbal - m, 6) AS above FROM supplier CROSS JOIN (SELECT avg(s_acctbal) AS m FROM supplier)")
def jn11_one_row_cross(spark: S, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    return s.crossJoin(F.broadcast(s.agg(F.avg("s_acctbal").alias("m")))).select("s_suppkey", F.round(F.col("s_acctbal") - F.col("m"), 6).alias("above"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def jn13_anti(spark: S, d: str) -> DataFrame:
    return table(spark, d, "customer").join(table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("SELECT status, count(*) AS n FROM (SELECT CASE WHEN b.k IS NULL THEN 'left_only' WHEN a.k IS NULL THEN 'right_only' ELSE 'both' END AS status FROM (SELECT DISTINCT o_custkey AS k FROM orders) a FULL JOIN (SELECT c_custkey AS k FROM customer) b ON a.k = b.k) GROUP BY status")
def jn14_reconcile(spark: S, d: str) -> DataFrame:
    return J.reconcile(table(spark, d, "orders").select(F.col("o_custkey").alias("k")), table(spark, d, "customer").select(F.col("c_custkey").alias("k")), ["k"]).groupBy("status").agg(F.count("*").alias("n"))


@query(
    "SELECT event_id, near_t_s, near_id FROM (SELECT v.event_id, p.t_s AS near_t_s, p.event_id AS near_id, row_number() OVER (PARTITION BY v.event_id ORDER BY abs(v.t_s - p.t_s), p.t_s) AS n "
    "FROM b_ticks v JOIN b_ticks p ON v.user_id = p.user_id AND v.day = p.day AND abs(v.t_s - p.t_s) <= 3600 WHERE v.event_type = 'view' AND p.event_type = 'click') WHERE n = 1"
)
def jn15_nearest(spark: S, d: str) -> DataFrame:
    t = view(spark, d, "b_ticks")
    right = t.where("event_type = 'click'").select("user_id", "day", "t_s", F.col("event_id").alias("near_id"))
    return J.nearest(t.where("event_type = 'view'").select("event_id", "user_id", "day", "t_s"), right, ["user_id", "day"], "t_s", ["near_id"], 3600, ["event_id"]).select("event_id", "near_t_s", "near_id")


_ASOF = "FROM (SELECT * FROM b_ticks WHERE event_type = 'view') v ASOF LEFT JOIN (SELECT user_id, day, t_s, last(value ORDER BY value NULLS FIRST) AS value FROM b_ticks WHERE event_type = 'click' GROUP BY user_id, day, t_s) c ON v.user_id = c.user_id AND v.t_s"


@query(f"SELECT v.event_id, c.value AS clicked {_ASOF.replace('AND v.t_s', 'AND v.day = c.day AND v.t_s')} >= c.t_s")
def jn16_asof(spark: S, d: str) -> DataFrame:
    t = view(spark, d, "b_ticks")
    right = t.where("event_type = 'click'").select("user_id", "day", "t_s", F.col("value").alias("clicked"))
    return J.asof(t.where("event_type = 'view'").select("event_id", "user_id", "day", "t_s"), right, ["user_id", "day"], "t_s", ["clicked"]).select("event_id", "clicked")


@query(f"SELECT v.event_id, CASE WHEN v.t_s - c.t_s <= 7200 THEN c.value END AS held {_ASOF.replace('AND v.t_s', 'AND v.day = c.day AND v.t_s')} >= c.t_s")
def jn18_hold(spark: S, d: str) -> DataFrame:
    t = view(spark, d, "b_ticks")
    right = t.where("event_type = 'click'").select("user_id", "day", "t_s", F.col("value").alias("held"))
    return J.asof(t.where("event_type = 'view'").select("event_id", "user_id", "day", "t_s"), right, ["user_id", "day"], "t_s", ["held"], max_age=7200).select("event_id", "held")


@query(
    "SELECT v.event_id, CASE WHEN c.t_s IS NOT NULL THEN c.value ELSE f.value END AS clicked FROM (SELECT * FROM b_ticks WHERE event_type = 'view') v ASOF LEFT JOIN (SELECT user_id, day, t_s, last(value ORDER BY value NULLS FIRST) AS value FROM b_ticks WHERE event_type = 'click' GROUP BY user_id, day, t_s) c ON v.user_id = c.user_id AND v.day = c.day AND v.t_s >= c.t_s "
    "LEFT JOIN (SELECT user_id, day, first(value ORDER BY t_s, value NULLS FIRST) AS value FROM b_ticks WHERE event_type = 'click' GROUP BY user_id, day) f ON f.user_id = v.user_id AND f.day = v.day"
)
def jn31_asof_or_first(spark: S, d: str) -> DataFrame:
    t = view(spark, d, "b_ticks")
    right = t.where("event_type = 'click'").select("user_id", "day", "t_s", F.col("value").alias("clicked"))
    return J.asof(t.where("event_type = 'view'").select("event_id", "user_id", "day", "t_s"), right, ["user_id", "day"], "t_s", ["clicked"], or_first=True).select("event_id", "clicked")


@query(f"SELECT count(DISTINCT a.stay) AS n FROM ({_STAYS}) a JOIN ({_STAYS}) b ON a.user_id = b.user_id AND a.day = b.day AND a.stay <> b.stay AND a.start_s <= b.end_s AND a.end_s >= b.start_s")
def jn20_overlap(spark: S, d: str) -> DataFrame:
    s = stays(view(spark, d, "b_ticks"))
    out = J.pairs(s, ["user_id", "day"], "stay", ["start_s", "end_s"], (F.col("a.start_s") <= F.col("b.end_s")) & (F.col("a.end_s") >= F.col("b.start_s")))
    return out.agg(F.count_distinct("stay").alias("n"))


@query(f"SELECT t.event_id FROM b_ticks t WHERE NOT EXISTS (SELECT 1 FROM ({_STAYS}) s WHERE t.user_id = s.user_id AND t.day = s.day AND t.t_s BETWEEN s.start_s AND s.end_s)")
def jn21_outside_all(spark: S, d: str) -> DataFrame:
    t = view(spark, d, "b_ticks")
    return J.interval(t, stays(t), ["user_id", "day"], "t_s", "start_s", "end_s", 3600, how="left_anti", closed=True).select("event_id")


@query("SELECT season, round, lap_number, driver_id, lag(driver_id) OVER w AS ahead FROM b_laps WINDOW w AS (PARTITION BY season, round, lap_number ORDER BY speed DESC, driver_id)")
def jn22_adjacency(spark: S, d: str) -> DataFrame:
    w = Window.partitionBy("season", "round", "lap_number").orderBy(F.desc("speed"), "driver_id")
    return laps(spark, d).select("season", "round", "lap_number", "driver_id", F.lag("driver_id").over(w).alias("ahead"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty, round(avg(l_extendedprice), 4) AS price, min(l_discount) AS lo, max(l_discount) AS hi FROM lineitem GROUP BY 1, 2")
def ag01_groups(spark: S, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"), F.round(F.avg("l_extendedprice"), 4).alias("price"), F.min("l_discount").alias("lo"), F.max("l_discount").alias("hi"))


@query("SELECT count(DISTINCT (season, round)) AS races, count(DISTINCT driver_id) AS drivers FROM b_laps")
def ag03_distinct_tuples(spark: S, d: str) -> DataFrame:
    return laps(spark, d).agg(F.count_distinct(F.struct("season", "round")).alias("races"), F.count_distinct("driver_id").alias("drivers"))


@query("SELECT DISTINCT team, driver_id FROM b_laps")
def ag04_distinct_rows(spark: S, d: str) -> DataFrame:
    return laps(spark, d).select("team", "driver_id").distinct()


@query("SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY user_id HAVING count(*) >= 60")
def ag06_conditional(spark: S, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors")).where("n >= 60")


@query("SELECT user_id, round(stddev_samp(value), 6) AS sd, round(median(value), 6) AS med, round(quantile_cont(value, 0.9), 6) AS p90 FROM events GROUP BY user_id")
def ag09_quantiles(spark: S, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("user_id").agg(F.round(F.stddev_samp("value"), 6).alias("sd"), F.round(F.percentile("value", 0.5), 6).alias("med"), F.round(F.percentile("value", 0.9), 6).alias("p90"))


@query("SELECT user_id, count(*) AS n, round(max(m), 6) AS median, round(median(abs(value - m)), 6) AS mad FROM (SELECT *, median(value) OVER (PARTITION BY user_id) AS m FROM events) GROUP BY user_id")
def ag10_mad(spark: S, d: str) -> DataFrame:
    return R.mad(table(spark, d, "events"), ["user_id"], "value").select("user_id", "n", F.round("median", 6).alias("median"), F.round("mad", 6).alias("mad"))


@query("SELECT season, round, arg_min(driver_id, (lap_time_sec, driver_id, lap_number)) AS driver_id, round(min(lap_time_sec), 6) AS best FROM b_laps GROUP BY season, round")
def ag11_arg_min(spark: S, d: str) -> DataFrame:
    return laps(spark, d).groupBy("season", "round").agg(F.min_by("driver_id", F.struct("lap_time_sec", "driver_id", "lap_number")).alias("driver_id"), F.round(F.min("lap_time_sec"), 6).alias("best"))


@query("SELECT season, round, driver_id, stint, bool_or(track_status = '4') AS neutralised, coalesce(max(CASE WHEN compound <> 'HARD' THEN compound END), 'UNKNOWN') AS compound FROM b_laps GROUP BY 1, 2, 3, 4")
def ag12_bool_or(spark: S, d: str) -> DataFrame:
    return laps(spark, d).groupBy("season", "round", "driver_id", "stint").agg(F.bool_or(F.col("track_status") == "4").alias("neutralised"), F.coalesce(F.max(F.when(F.col("compound") != "HARD", F.col("compound"))), F.lit("UNKNOWN")).alias("compound"))


@query("SELECT user_id, string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS kinds FROM events GROUP BY user_id")
def ag14_listagg(spark: S, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_set("event_type")), ", ").alias("kinds"))


@query("SELECT season, CASE WHEN grouping(round) = 1 THEN 0 ELSE round END AS round, driver_id, count(*) AS n FROM b_laps GROUP BY GROUPING SETS ((season, round, driver_id), (season, driver_id))")
def ag15_grouping_sets(spark: S, d: str) -> DataFrame:
    g = laps(spark, d).groupingSets([["season", "round", "driver_id"], ["season", "driver_id"]], "season", "round", "driver_id")
    return g.agg(F.count("*").alias("n"), F.grouping("round").alias("all")).select("season", F.when(F.col("all") == 1, F.lit(0)).otherwise(F.col("round")).cast("long").alias("round"), "driver_id", "n")


@query("SELECT l_suppkey, round(sum(l_extendedprice * l_quantity) / nullif(sum(l_quantity), 0), 6) AS mean FROM lineitem WHERE l_quantity > 0 GROUP BY l_suppkey")
def ag18_weighted_mean(spark: S, d: str) -> DataFrame:
    return table(spark, d, "lineitem").where("l_quantity > 0").groupBy("l_suppkey").agg(F.round(C.ratio(F.sum(F.col("l_extendedprice") * F.col("l_quantity")), F.sum("l_quantity")), 6).alias("mean"))


_W = "1.6448536269514722"


@query(
    f"SELECT user_id, n, hits, CASE WHEN n >= 5 THEN round(100 * (hits / n + {_W} * {_W} / (2 * n) - {_W} * sqrt(hits / n * (1 - hits / n) / n + {_W} * {_W} / (4 * n * n))) / (1 + {_W} * {_W} / n), 6) END AS low, "
    f"CASE WHEN n >= 5 THEN round(100 * (hits / n + {_W} * {_W} / (2 * n) + {_W} * sqrt(hits / n * (1 - hits / n) / n + {_W} * {_W} / (4 * n * n))) / (1 + {_W} * {_W} / n), 6) END AS high "
    "FROM (SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS hits FROM events GROUP BY user_id)"
)
def ag20_wilson(spark: S, d: str) -> DataFrame:
    rows = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "purchase").alias("hits"))
    low, high = C.wilson(F.col("hits"), F.col("n"))
    return rows.select("user_id", "n", "hits", F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))


@query("SELECT day, median(gap) AS cadence FROM (SELECT day, t_s - lag(t_s) OVER (PARTITION BY day ORDER BY t_s) AS gap FROM (SELECT DISTINCT day, t_s FROM b_ticks)) WHERE gap > 0 GROUP BY day")
def ag21_cadence(spark: S, d: str) -> DataFrame:
    clock = view(spark, d, "b_ticks").select("day", "t_s").distinct()
    gaps = clock.select("day", (F.col("t_s") - F.lag("t_s").over(Window.partitionBy("day").orderBy("t_s"))).alias("gap"))
    return gaps.where("gap > 0").groupBy("day").agg(F.percentile("gap", 0.5).alias("cadence"))


@query("SELECT user_id, day, CAST(floor(t_s / 3600) + 1 AS BIGINT) AS bin, count(*) AS n, round(sum(value), 6) AS total FROM b_ticks GROUP BY 1, 2, 3")
def ag23_bins(spark: S, d: str) -> DataFrame:
    return view(spark, d, "b_ticks").groupBy("user_id", "day", (F.floor(F.col("t_s") / 3600) + 1).alias("bin")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))


@query("SELECT user_id, day, round(sum(2 * (t_s - t0) / nullif(value + v0, 0)), 6) AS travel FROM (SELECT *, lag(t_s) OVER w AS t0, lag(value) OVER w AS v0 FROM b_ticks WINDOW w AS (PARTITION BY user_id, day ORDER BY t_s, event_id)) GROUP BY user_id, day")
def ag24_trapezoid(spark: S, d: str) -> DataFrame:
    w = Window.partitionBy("user_id", "day").orderBy("t_s", "event_id")
    part = view(spark, d, "b_ticks").withColumn("part", F.try_divide(2 * (F.col("t_s") - F.lag("t_s").over(w)), F.col("value") + F.lag("value").over(w)))
    return part.groupBy("user_id", "day").agg(F.round(F.sum("part"), 6).alias("travel"))


@query("SELECT season, round, concat(least(driver_id, other), ' / ', greatest(driver_id, other)) AS pair, count(*) AS n FROM (SELECT a.season, a.round, a.driver_id, b.driver_id AS other FROM b_laps a JOIN b_laps b ON a.season = b.season AND a.round = b.round AND a.team = b.team AND a.lap_number = b.lap_number AND a.driver_id <> b.driver_id) GROUP BY 1, 2, 3")
def ag28_undirected(spark: S, d: str) -> DataFrame:
    p = J.pairs(laps(spark, d), ["season", "round", "team", "lap_number"], "driver_id", [])
    pair = F.concat(F.least("driver_id", "other_driver_id").cast("string"), F.lit(" / "), F.greatest("driver_id", "other_driver_id").cast("string"))
    return p.groupBy("season", "round", pair.alias("pair")).agg(F.count("*").alias("n"))


@query(
    "SELECT round(corr(ra, rb), 6) AS spearman FROM (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb "
    "FROM (SELECT l_suppkey, avg(l_extendedprice) AS a, avg(l_quantity) AS b FROM lineitem GROUP BY l_suppkey))"
)
def ag33_spearman(spark: S, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.avg("l_extendedprice").alias("a"), F.avg("l_quantity").alias("b"))
    places = W.ranked(W.ranked(rows, "a").withColumnRenamed("mean_rank", "ra").drop("rank", "dense_rank"), "b")
    return places.agg(F.round(F.corr("ra", "mean_rank"), 6).alias("spearman"))


@query("SELECT * EXCLUDE (n) FROM (SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_suppkey, l_partkey) AS n FROM lineitem) WHERE n = 1")
def wn02_keep_last(spark: S, d: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(F.desc("l_shipdate"), "l_suppkey", "l_partkey")
    return table(spark, d, "lineitem").withColumn("n", F.row_number().over(w)).where("n = 1").select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT user_id, CAST(rank() OVER (ORDER BY n DESC NULLS LAST) AS BIGINT) AS r, CAST(dense_rank() OVER (ORDER BY n DESC NULLS LAST) AS BIGINT) AS dr FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)")
def wn03_ranks(spark: S, d: str) -> DataFrame:
    counts = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    return W.ranked(counts, "n", descending=True).select("user_id", F.col("rank").alias("r"), F.col("dense_rank").alias("dr"))


@query(
    "SELECT season, round, driver_id, stint, round(avg(lap_time_sec) FILTER (a <= 3), 6) AS early, round(avg(lap_time_sec) FILTER (z <= 3), 6) AS late FROM (SELECT *, row_number() OVER (PARTITION BY season, round, driver_id, stint ORDER BY lap_number) AS a, "
    "row_number() OVER (PARTITION BY season, round, driver_id, stint ORDER BY lap_number DESC) AS z FROM b_laps) GROUP BY 1, 2, 3, 4"
)
def wn04_early_late(spark: S, d: str) -> DataFrame:
    by = Window.partitionBy("season", "round", "driver_id", "stint")
    rows = laps(spark, d).withColumns({"a": F.row_number().over(by.orderBy("lap_number")), "z": F.row_number().over(by.orderBy(F.desc("lap_number")))})
    return rows.groupBy("season", "round", "driver_id", "stint").agg(F.round(F.avg(F.when(F.col("a") <= 3, F.col("lap_time_sec"))), 6).alias("early"), F.round(F.avg(F.when(F.col("z") <= 3, F.col("lap_time_sec"))), 6).alias("late"))


@query("SELECT season, round, driver_id, lap_number, CASE WHEN n >= 3 THEN round((s - speed) / (n - 1), 6) END AS peers FROM (SELECT *, count(speed) OVER w AS n, sum(speed) OVER w AS s FROM b_laps WINDOW w AS (PARTITION BY season, round, lap_number))")
def wn05_loo_mean(spark: S, d: str) -> DataFrame:
    out = W.loo_mean(laps(spark, d), ["season", "round", "lap_number"], "speed", "peers")
    return out.select("season", "round", "driver_id", "lap_number", F.round("peers", 6).alias("peers"))


@query("SELECT a.season, a.round, a.driver_id, a.lap_number, CASE WHEN count(*) >= 3 THEN round(median(b.lap_time_sec), 6) END AS peers FROM b_laps a JOIN b_laps b ON a.season = b.season AND a.round = b.round AND a.lap_number = b.lap_number AND a.driver_id <> b.driver_id GROUP BY 1, 2, 3, 4")
def wn06_loo_median(spark: S, d: str) -> DataFrame:
    rows = laps(spark, d)
    several = rows.join(rows.groupBy("season", "round", "lap_number").agg(F.count("*").alias("n")).where("n > 1"), ["season", "round", "lap_number"])
    return W.loo_median(several, ["season", "round", "lap_number"], "lap_time_sec", "peers").select("season", "round", "driver_id", "lap_number", F.round("peers", 6).alias("peers"))


@query("SELECT event_id, t_s - lag(t_s) OVER w AS since, lead(value) OVER w AS next_value, round(sum(value) OVER (w ROWS UNBOUNDED PRECEDING), 6) AS running FROM b_ticks WINDOW w AS (PARTITION BY user_id, day ORDER BY t_s, event_id)")
def wn08_lag_running(spark: S, d: str) -> DataFrame:
    w = Window.partitionBy("user_id", "day").orderBy("t_s", "event_id")
    return view(spark, d, "b_ticks").select("event_id", (F.col("t_s") - F.lag("t_s").over(w)).alias("since"), F.lead("value").over(w).alias("next_value"), F.round(F.sum("value").over(w.rowsBetween(Window.unboundedPreceding, 0)), 6).alias("running"))


@query("SELECT event_id, CASE WHEN count(value) OVER w >= 3 THEN round(median(value) OVER w, 6) END AS smooth FROM b_ticks WINDOW w AS (PARTITION BY user_id ORDER BY day, t_s, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)")
def wn09_trailing_median(spark: S, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("day", "t_s", "event_id").rowsBetween(-4, 0)
    return view(spark, d, "b_ticks").select("event_id", F.when(F.count("value").over(w) >= 3, F.round(F.percentile("value", 0.5).over(w), 6)).alias("smooth"))


@query("SELECT season, round, driver_id, lap_number, CAST(row_number() OVER (PARTITION BY season, round, driver_id ORDER BY lap_number) AS BIGINT) AS ordinal FROM (SELECT *, lag(stint) OVER w AS s0, lag(lap_number) OVER w AS l0 FROM b_laps WINDOW w AS (PARTITION BY season, round, driver_id ORDER BY lap_number)) WHERE lap_number - l0 = 1 AND stint > s0")
def wn15_transitions(spark: S, d: str) -> DataFrame:
    return W.transitions(laps(spark, d), ["season", "round", "driver_id"], "lap_number", "stint").select("season", "round", "driver_id", "lap_number", F.col("ordinal").cast("long").alias("ordinal"))


@query(
    "SELECT season, round, driver_id, CAST(run AS BIGINT) AS run, min(lap_number) AS start, max(lap_number) AS \"end\", count(*) AS n, any_value(track_status) AS track_status FROM (SELECT *, sum(f) OVER (PARTITION BY season, round, driver_id ORDER BY lap_number) AS run "
    "FROM (SELECT *, CASE WHEN track_status IS DISTINCT FROM lag(track_status) OVER (PARTITION BY season, round, driver_id ORDER BY lap_number) THEN 1 ELSE 0 END AS f FROM b_laps)) GROUP BY 1, 2, 3, 4"
)
def wn16_run_collapse(spark: S, d: str) -> DataFrame:
    return W.collapse_runs(laps(spark, d), ["season", "round", "driver_id"], "lap_number", "track_status").drop("anchor")


@query("SELECT event_id, max(value) OVER (PARTITION BY user_id, day ORDER BY t_s, event_id ROWS UNBOUNDED PRECEDING) AS leading FROM b_ticks")
def wn17_running_max(spark: S, d: str) -> DataFrame:
    w = Window.partitionBy("user_id", "day").orderBy("t_s", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return view(spark, d, "b_ticks").select("event_id", F.max("value").over(w).alias("leading"))


@query(
    "SELECT user_id, episode, count(*) AS n, min(t) AS start, max(t) AS \"end\" FROM (SELECT user_id, t, CAST(sum(f) OVER (PARTITION BY user_id ORDER BY t, event_id) AS BIGINT) AS episode FROM (SELECT *, CASE WHEN lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) IS NULL OR t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) > 21600 "
    "THEN 1 ELSE 0 END AS f FROM (SELECT user_id, event_id, CAST(floor(epoch(ts)) AS BIGINT) AS t FROM events))) GROUP BY user_id, episode"
)
def wn21_islands(spark: S, d: str) -> DataFrame:
    t = table(spark, d, "events").select("user_id", "event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("t"))
    w = Window.partitionBy("user_id").orderBy("t", "event_id")
    runs = W.islands(t, ["user_id"], ["t", "event_id"], F.col("t") - F.lag("t").over(w) > 21600, "episode")
    return runs.groupBy("user_id", "episode").agg(F.count("*").alias("n"), F.min("t").alias("start"), F.max("t").alias("end"))


@query(
    "WITH r AS (SELECT season, round, driver_id, lap_number, track_status = '1' AS h, lap_number - row_number() OVER (PARTITION BY season, round, driver_id, track_status = '1' ORDER BY lap_number) AS g FROM b_laps), "
    "m AS (SELECT season, round, driver_id, max(x) AS longest FROM (SELECT season, round, driver_id, g, max(lap_number) - min(lap_number) AS x FROM r WHERE h GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3) "
    "SELECT DISTINCT b_laps.season, b_laps.round, b_laps.driver_id, coalesce(longest, 0) AS longest FROM b_laps LEFT JOIN m ON m.season = b_laps.season AND m.round = b_laps.round AND m.driver_id = b_laps.driver_id"
)
def wn22_longest_run(spark: S, d: str) -> DataFrame:
    return W.longest_run(laps(spark, d), ["season", "round", "driver_id"], "lap_number", F.col("track_status") == "1", 1)


@query("SELECT * EXCLUDE (n) FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS n FROM events) WHERE n <= 6")
def st03_top_n_each(spark: S, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy(F.desc("value"), "event_id")
    return table(spark, d, "events").withColumn("n", F.row_number().over(w)).where("n <= 6").select("user_id", "event_id")


@query("SELECT season, round FROM b_laps ORDER BY season DESC, round DESC LIMIT 1")
def st02_latest(spark: S, d: str) -> DataFrame:
    return laps(spark, d).select("season", "round").orderBy(F.desc("season"), F.desc("round")).limit(1)


@query("SELECT user_id FROM events WHERE event_type = 'purchase' INTERSECT SELECT user_id FROM events WHERE event_type = 'error'")
def st08_intersect(spark: S, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.where("event_type = 'purchase'").select("user_id").intersect(e.where("event_type = 'error'").select("user_id"))


@query("SELECT s_nationkey AS k FROM supplier EXCEPT SELECT c_nationkey FROM customer WHERE c_acctbal > 9900")
def st09_except(spark: S, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")).subtract(table(spark, d, "customer").where("c_acctbal > 9900").select(F.col("c_nationkey").alias("k")))


@query("SELECT s_suppkey, metric, value FROM (UNPIVOT (SELECT s_suppkey, CAST(s_nationkey AS DOUBLE) AS nation, s_acctbal AS balance FROM supplier) ON nation, balance INTO NAME metric VALUE value)")
def st11_unpivot(spark: S, d: str) -> DataFrame:
    return table(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").cast("double").alias("nation"), F.col("s_acctbal").alias("balance")).unpivot("s_suppkey", ["nation", "balance"], "metric", "value")


@query("SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'view') AS view FROM events WHERE event_type IN ('click', 'view') GROUP BY user_id")
def st12_pivot(spark: S, d: str) -> DataFrame:
    return table(spark, d, "events").where(F.col("event_type").isin("click", "view")).groupBy("user_id").pivot("event_type", ["click", "view"]).agg(F.count(F.lit(1))).na.fill(0)


@query("SELECT season, round, driver_id, lap_number, CAST(floor(ms / 60000) AS BIGINT) || ':' || lpad(CAST(CAST(floor(ms % 60000 / 1000) AS BIGINT) AS VARCHAR), 2, '0') || '.' || lpad(CAST(ms % 1000 AS VARCHAR), 3, '0') AS shown, ms / 1000.0 AS parsed FROM (SELECT *, CAST(round(lap_time_sec * 1000) AS BIGINT) AS ms FROM b_laps)")
def sc01_durations(spark: S, d: str) -> DataFrame:
    shown = laps(spark, d).select("season", "round", "driver_id", "lap_number", C.format_duration(F.col("lap_time_sec")).alias("shown"))
    return shown.withColumn("parsed", F.round(C.parse_duration(F.col("shown")), 3))


@query("SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM pages")
def sc05_regexp(spark: S, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def sc13_from_json(spark: S, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("SELECT c_custkey, CASE WHEN abs(c_acctbal / 1000) >= abs(c_nationkey - 12) THEN 'balance' ELSE 'nation' END AS name FROM customer")
def sc15_dominant(spark: S, d: str) -> DataFrame:
    best = C.dominant(("balance", F.col("c_acctbal") / 1000), ("nation", (F.col("c_nationkey") - 12).cast("double")))
    return table(spark, d, "customer").select("c_custkey", best["name"].alias("name"))


@query("SELECT DISTINCT season || '-R' || lpad(CAST(round AS VARCHAR), 2, '0') || '-B' || lpad(CAST(driver_id AS VARCHAR), CAST(greatest(4, length(CAST(driver_id AS VARCHAR))) AS INTEGER), '0') AS id FROM b_laps")
def sc17_ids(spark: S, d: str) -> DataFrame:
    return laps(spark, d).select(C.composite_id(F.col("season"), F.col("round"), "B", F.col("driver_id")).alias("id")).distinct()


@query("SELECT c_custkey, ['N', 'NE', 'E', 'SE', 'S', 'SW', 'W', 'NW'][CAST(floor((c_custkey % 360 + 22.5) / 45) AS BIGINT) % 8 + 1] AS wind FROM customer")
def sc20_compass(spark: S, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", C.compass(F.col("c_custkey") % 360).alias("wind"))
