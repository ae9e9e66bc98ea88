"""Composite operators as queries: pairwise gaps, degradation, robust fits, resampling, ratings, bootstrap and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronolith.functions import columns as C
from chronolith.operators import joins as J, quality as Q, resample as RS, robust as R, windows as W
from chronolith.plans.basics import laps, mid_stint
from chronolith.plans.bindings import table, view
from chronolith.plans.registry import ORACLE, query
from chronolith.sources import partitions as P

S = SparkSession


@query(
    "WITH m AS (SELECT *, min(lap_number) OVER w AS lo, max(lap_number) OVER w AS hi FROM b_laps WHERE track_status = '1' WINDOW w AS (PARTITION BY season, round, driver_id, stint)), "
    "g AS (SELECT * FROM m WHERE lap_number > lo AND lap_number < hi), two AS (SELECT season, round, team FROM g GROUP BY 1, 2, 3 HAVING count(DISTINCT driver_id) = 2), h AS (SELECT g.* FROM g SEMI JOIN two USING (season, round, team)), "
    "p AS (SELECT a.season, a.round, a.team, a.driver_id, b.driver_id AS other_driver_id, 100 * (ln(a.lap_time_sec) - ln(b.lap_time_sec)) AS gap FROM h a JOIN h b ON a.season = b.season AND a.round = b.round AND a.team = b.team AND a.lap_number = b.lap_number AND a.compound = b.compound "
    "AND a.driver_id <> b.driver_id AND abs(a.tyre_life - b.tyre_life) <= 3) SELECT season, round, team, driver_id, other_driver_id, count(*) AS n_laps, round(avg(gap), 6) AS pace_gap FROM p WHERE abs(gap) <= 5 GROUP BY ALL HAVING count(*) >= 5"
)
def ca02_race_gaps(spark: S, d: str) -> DataFrame:
    key = ["season", "round", "team"]
    green = J.exactly(mid_stint(laps(spark, d)), key, "driver_id", 2)
    both = J.pairs(green, [*key, "lap_number", "compound"], "driver_id", ["lap_time_sec", "tyre_life"], F.abs(F.col("a.tyre_life") - F.col("b.tyre_life")) <= 3)
    gaps = both.withColumn("gap", C.log_gap(F.col("lap_time_sec"), F.col("other_lap_time_sec"))).where("abs(gap) <= 5")
    return gaps.groupBy(*key, "driver_id", "other_driver_id").agg(F.count("*").alias("n_laps"), F.round(F.avg("gap"), 6).alias("pace_gap")).where("n_laps >= 5")


@query("SELECT season, round, compound, count(*) AS n, round(regr_slope(lap_time_sec, tyre_life), 6) AS slope FROM b_laps WHERE track_status = '1' GROUP BY 1, 2, 3 HAVING count(*) >= 8")
def ca04_pooled_slope(spark: S, d: str) -> DataFrame:
    return laps(spark, d).where("track_status = '1'").groupBy("season", "round", "compound").agg(F.count("*").alias("n"), F.round(F.regr_slope("lap_time_sec", "tyre_life"), 6).alias("slope")).where("n >= 8")


@query("SELECT season, round, driver_id, stint, count(*) AS n, round(regr_slope(lap_time_sec, tyre_life), 6) AS slope FROM b_laps WHERE track_status = '1' GROUP BY 1, 2, 3, 4 HAVING count(*) >= 5")
def ca05_stint_slope(spark: S, d: str) -> DataFrame:
    return laps(spark, d).where("track_status = '1'").groupBy("season", "round", "driver_id", "stint").agg(F.count("*").alias("n"), F.round(F.regr_slope("lap_time_sec", "tyre_life"), 6).alias("slope")).where("n >= 5")


@query(
    "WITH p AS (SELECT *, count(*) OVER w AS n, sum(lap_time_sec) OVER w AS s FROM b_laps WHERE track_status = '1' WINDOW w AS (PARTITION BY season, round, lap_number)), r AS (SELECT *, lap_time_sec - (s - lap_time_sec) / (n - 1) AS residual FROM p WHERE n >= 3) "
    "SELECT season, round, driver_id, stint, count(*) AS laps, round(regr_slope(residual, tyre_life), 6) AS slope FROM r GROUP BY 1, 2, 3, 4 HAVING count(*) >= 5"
)
def ca06_adjusted_slope(spark: S, d: str) -> DataFrame:
    peers = W.loo_mean(laps(spark, d).where("track_status = '1'"), ["season", "round", "lap_number"], "lap_time_sec", "peers")
    residual = peers.where("peers is not null").withColumn("residual", F.col("lap_time_sec") - F.col("peers"))
    return residual.groupBy("season", "round", "driver_id", "stint").agg(F.count("*").alias("laps"), F.round(F.regr_slope("residual", "tyre_life"), 6).alias("slope")).where("laps >= 5")


@query("SELECT season, round, driver_id, max(speed) AS top, round(avg(speed), 6) AS mean, count(*) AS n FROM b_laps WHERE speed > 0 GROUP BY 1, 2, 3")
def ca08_speed_summary(spark: S, d: str) -> DataFrame:
    return laps(spark, d).where("speed > 0").groupBy("season", "round", "driver_id").agg(F.max("speed").alias("top"), F.round(F.avg("speed"), 6).alias("mean"), F.count("*").alias("n"))


@query("SELECT season, round, driver_id, stint, max(compound) AS compound, min(lap_number) AS first_lap, max(lap_number) AS last_lap, max(tyre_life) AS age, count(*) AS n FROM b_laps GROUP BY 1, 2, 3, 4")
def ca09_stints(spark: S, d: str) -> DataFrame:
    return laps(spark, d).groupBy("season", "round", "driver_id", "stint").agg(F.max("compound").alias("compound"), F.min("lap_number").alias("first_lap"), F.max("lap_number").alias("last_lap"), F.max("tyre_life").alias("age"), F.count("*").alias("n"))


@query(
    "SELECT a.season, a.driver_id, b.driver_id AS other_driver_id, count(*) AS laps, count(*) FILTER (a.lap_time_sec < b.lap_time_sec) AS wins, round(avg(a.lap_time_sec - b.lap_time_sec), 6) AS gap, round(stddev_samp(a.lap_time_sec - b.lap_time_sec), 6) AS sd "
    "FROM b_laps a JOIN b_laps b ON a.season = b.season AND a.round = b.round AND a.team = b.team AND a.lap_number = b.lap_number AND a.driver_id <> b.driver_id GROUP BY 1, 2, 3"
)
def ca11_head_to_head(spark: S, d: str) -> DataFrame:
    p = J.pairs(laps(spark, d), ["season", "round", "team", "lap_number"], "driver_id", ["lap_time_sec"]).withColumn("gap_", F.col("lap_time_sec") - F.col("other_lap_time_sec"))
    return p.groupBy("season", "driver_id", "other_driver_id").agg(F.count("*").alias("laps"), F.count_if(F.col("lap_time_sec") < F.col("other_lap_time_sec")).alias("wins"), F.round(F.avg("gap_"), 6).alias("gap"), F.round(F.stddev_samp("gap_"), 6).alias("sd"))


@query(
    "SELECT a.season, a.round, a.driver_id, a.stint, a.n, round(b.slope, 6) AS slope FROM (SELECT season, round, driver_id, stint, count(*) AS n FROM b_laps GROUP BY 1, 2, 3, 4 HAVING count(*) >= 5) a JOIN "
    "(SELECT x.season, x.round, x.driver_id, x.stint, median((y.lap_time_sec - x.lap_time_sec) / (y.tyre_life - x.tyre_life)) AS slope FROM b_laps x JOIN b_laps y ON x.season = y.season AND x.round = y.round AND x.driver_id = y.driver_id AND x.stint = y.stint AND x.tyre_life < y.tyre_life GROUP BY 1, 2, 3, 4) b "
    "ON a.season = b.season AND a.round = b.round AND a.driver_id = b.driver_id AND a.stint = b.stint"
)
def ca48_theil_sen(spark: S, d: str) -> DataFrame:
    return R.theil_sen(laps(spark, d), ["season", "round", "driver_id", "stint"], "tyre_life", "lap_time_sec", least=5).select("season", "round", "driver_id", "stint", "n", F.round("slope", 6).alias("slope"))


@query(
    "WITH s AS (SELECT user_id, day, t_s, avg(value) AS value FROM b_ticks GROUP BY 1, 2, 3), n AS (SELECT *, lead(t_s) OVER w AS t1, lead(value) OVER w AS v1 FROM s WINDOW w AS (PARTITION BY user_id, day ORDER BY t_s)), "
    "g AS (SELECT *, unnest(range(CAST(ceil(t_s / 600) AS BIGINT), CAST(CASE WHEN t1 IS NULL THEN floor(t_s / 600) ELSE ceil(t1 / 600) - 1 END AS BIGINT) + 1)) * 600 AS g FROM n) "
    "SELECT user_id, day, g AS t_s, round(CASE WHEN t1 IS NULL OR g = t_s THEN value WHEN t1 - t_s <= 14400 THEN value + (g - t_s) / (t1 - t_s) * (v1 - value) END, 6) AS value FROM g"
)
def ca26_grid(spark: S, d: str) -> DataFrame:
    samples = view(spark, d, "b_ticks").groupBy("user_id", "day", "t_s").agg(F.avg("value").alias("value"))
    return RS.grid(samples, ["user_id", "day"], "t_s", ["value"], 600, max_gap=14400).withColumn("value", F.round("value", 6))


@query("SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id, day, floor(t_s / 7200) ORDER BY t_s, event_id) AS n FROM b_ticks) WHERE n = 1")
def ca27_thin(spark: S, d: str) -> DataFrame:
    return RS.thin(view(spark, d, "b_ticks"), ["user_id", "day"], "t_s", 7200, ["event_id"]).select("event_id")


@query("SELECT user_id, round((max(t_s) - min(t_s)) / 86400.0, 6) AS covered, (max(t_s) - min(t_s)) / 86400.0 >= 0.9 AS accepted FROM b_ticks GROUP BY user_id")
def ca29_coverage(spark: S, d: str) -> DataFrame:
    return RS.coverage(view(spark, d, "b_ticks"), ["user_id"], "t_s", 86400).withColumn("covered", F.round("covered", 6))


@query(
    "SELECT 'accepted:o_orderstatus' AS rule, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS violations FROM orders UNION ALL SELECT 'not_null:o_custkey', count(*) FILTER (o_custkey IS NULL) FROM orders UNION ALL "
    "SELECT 'range:o_totalprice', count(*) FILTER (o_totalprice < 1000 OR o_totalprice > 400000) FROM orders UNION ALL SELECT 'unique:l_orderkey+l_linenumber', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) UNION ALL "
    "SELECT 'related:o_custkey', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"
)
def dq01_rules(spark: S, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return Q.report(
        Q.accepted(o, "o_orderstatus", ["F", "O"]), Q.not_null(o, "o_custkey"), Q.within(o, "o_totalprice", 1000, 400000), Q.unique(table(spark, d, "lineitem"), "l_orderkey", "l_linenumber"), Q.related(o, "o_custkey", table(spark, d, "customer"), "c_custkey")
    )


@query(
    "SELECT 'antisymmetric' AS rule, count(*) AS violations FROM (SELECT season, round, team, least(driver_id, other_driver_id) AS x, greatest(driver_id, other_driver_id) AS y, sum(pace_gap) AS s, count(DISTINCT driver_id) AS n "
    f"FROM ({ORACLE['ca02_race_gaps']}) GROUP BY ALL) WHERE abs(s) > 1e-5 OR n <> 2"
)
def dq02_antisymmetry(spark: S, d: str) -> DataFrame:
    return Q.antisymmetric(ca02_race_gaps(spark, d), ["season", "round", "team"], "driver_id", "other_driver_id", "pace_gap", 1e-5)


@query(
    "WITH r AS (SELECT * FROM orders WHERE o_orderstatus <> 'P') SELECT (SELECT count(*) FROM (SELECT * FROM orders EXCEPT ALL SELECT * FROM r)) AS removed, (SELECT count(*) FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM orders)) AS added"
)
def dq08_table_diff(spark: S, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return Q.table_diff(o, o.where("o_orderstatus <> 'P'"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE year(o_orderdate) <> 1996 UNION ALL SELECT o_orderkey, o_custkey, 'X' FROM orders WHERE year(o_orderdate) = 1996")
def io09_delete_insert(spark: S, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    return P.replaced(o, o.where("y = 1996").withColumn("o_orderstatus", F.lit("X")), ["y"]).drop("y")


@query("SELECT season, count(*) AS row_count, 'laps' AS resource FROM b_laps GROUP BY season")
def io11_ledger(spark: S, d: str) -> DataFrame:
    return P.ledger(laps(spark, d), "laps", ["season"], "load").select("season", "row_count", "resource")


@query("SELECT season, max(round) AS last_round FROM b_laps GROUP BY season")
def io12_watermark(spark: S, d: str) -> DataFrame:
    return P.high_watermark(laps(spark, d), "season", "round")


@query("SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS transcript FROM conversations GROUP BY conv_id")
def io21_transcripts(spark: S, d: str) -> DataFrame:
    parts = F.sort_array(F.collect_list(F.struct("turn", "text")))
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda x: x["text"]), " ").alias("transcript"))


@query("SELECT o_orderkey, CASE WHEN c_acctbal < 0 THEN 'HOLD' ELSE o_orderstatus END AS o_orderstatus FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def io23_update(spark: S, d: str) -> DataFrame:
    bad = table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"), F.lit("HOLD").alias("o_orderstatus"))
    return P.updated(table(spark, d, "orders"), bad, ["o_custkey"], ["o_orderstatus"]).select("o_orderkey", "o_orderstatus")
