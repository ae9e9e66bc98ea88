"""Views of the given tables that stand for laps, comparison edges, ticks and markers. The SQL is the same for Spark and the oracle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")

_LAPS0 = """
SELECT CAST(year(l_shipdate) AS BIGINT) AS season, CAST(quarter(l_shipdate) AS BIGINT) AS round, l_suppkey AS driver_id,
  CAST(floor(l_suppkey / 2) AS BIGINT) AS team, l_tax, l_discount, l_orderkey, l_quantity, l_extendedprice,
  row_number() OVER (PARTITION BY year(l_shipdate), quarter(l_shipdate), l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS lap_number
FROM lineitem"""
_LAPS1 = "SELECT *, CAST(floor((lap_number - 1) / 8) + 1 AS BIGINT) AS stint, CAST((lap_number - 1) % 8 + 1 AS BIGINT) AS tyre_life FROM b_laps0"
LAPS = """
SELECT season, round, driver_id, team, CAST(lap_number AS BIGINT) AS lap_number, stint, tyre_life, l_quantity AS speed,
  CASE (stint + CASE WHEN (driver_id + stint) % 4 = 0 THEN 1 ELSE 0 END) % 3 WHEN 0 THEN 'SOFT' WHEN 1 THEN 'MEDIUM' ELSE 'HARD' END AS compound,
  CASE WHEN l_tax <= 0.07 THEN '1' ELSE '4' END AS track_status, 80 + 60 * l_discount + 10 * l_tax + 0.05 * tyre_life AS lap_time_sec
FROM b_laps1"""
TICKS = """
SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS STRING) AS day, CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) AS t_s, event_type, value FROM events"""
TIMED = """
SELECT season, round, driver_id, team, lap_number, stint, tyre_life, compound, track_status, speed, lap_ms, end_ms - lap_ms AS start_ms, end_ms
FROM (SELECT *, CAST(sum(lap_ms) OVER (PARTITION BY season, round, driver_id ORDER BY lap_number ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS end_ms FROM (SELECT *, CAST(round(lap_time_sec * 1000) AS BIGINT) AS lap_ms FROM b_laps))"""
EDGES = """
SELECT a.l_suppkey AS driver_id, b.l_suppkey AS teammate_id, CAST(year(a.l_shipdate) AS BIGINT) AS season,
  100 * (ln(a.l_extendedprice / a.l_quantity) - ln(b.l_extendedprice / b.l_quantity)) AS pace_gap
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey <> b.l_suppkey"""

SEASON_EDGES = """
SELECT a.l_suppkey AS driver_id, b.l_suppkey AS teammate_id, CAST(year(a.l_shipdate) AS BIGINT) AS season, CAST(quarter(a.l_shipdate) AS BIGINT) AS round,
  100 * (ln(a.l_extendedprice / a.l_quantity) - ln(b.l_extendedprice / b.l_quantity)) AS pace_gap, 100 * (ln(a.l_quantity) - ln(b.l_quantity)) AS quali_gap
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey <> b.l_suppkey AND year(a.l_shipdate) = year(b.l_shipdate) AND quarter(a.l_shipdate) = quarter(b.l_shipdate)"""

#: An embedding stands for a channel along a lap; 500 ids are a season, so groups stay as they are when the table grows.
TRACES = """
SELECT CAST(floor(vec_id / 500) AS BIGINT) AS season, CAST(label AS BIGINT) AS round, CAST(floor((vec_id % 20) / 2) AS BIGINT) AS team, vec_id % 20 AS driver_id, CAST(floor((vec_id % 500) / 20) + 1 AS BIGINT) AS lap_number,
  CAST(floor((vec_id % 500) / 20) % 8 + 1 AS BIGINT) AS tyre_life, CASE WHEN vec_id % 7 = 0 THEN 'HARD' ELSE 'SOFT' END AS compound, CASE WHEN vec_id % 11 = 0 THEN '4' ELSE '1' END AS track_status, 80 + (vec_id * 37) % 101 / 10.0 AS lap_time_sec, embedding
FROM embeddings"""
#: Four fixes a lap on a square; some repeat the one before, some are lost, and so are whole laps of them.
FIXES = """
SELECT season, round, driver_id, start_ms + CAST(floor(k * lap_ms / 4) AS BIGINT) AS t, CASE q WHEN 0 THEN 1000.0 WHEN 2 THEN -1000.0 ELSE 0.0 END AS x, CASE q WHEN 1 THEN 1000.0 WHEN 3 THEN -1000.0 ELSE 0.0 END AS y
FROM (SELECT season, round, driver_id, lap_number, start_ms, lap_ms, k, CASE WHEN k = 1 AND (driver_id + lap_number) % 5 = 0 THEN 0 ELSE k END AS q FROM b_timed CROSS JOIN (VALUES (0), (1), (2), (3)) AS v(k))
WHERE (driver_id * 13 + lap_number * 4 + k) % 9 <> 0 AND (driver_id + lap_number) % 11 <> 0"""

VIEWS = {"b_laps0": _LAPS0, "b_laps1": _LAPS1, "b_laps": LAPS, "b_timed": TIMED, "b_ticks": TICKS, "b_edges": EDGES, "b_season_edges": SEASON_EDGES, "b_traces": TRACES, "b_fixes": FIXES}
_NEEDS = {"b_laps": ("b_laps0", "b_laps1", "b_laps"), "b_timed": ("b_laps0", "b_laps1", "b_laps", "b_timed"), "b_ticks": ("b_ticks",), "b_edges": ("b_edges",), "b_season_edges": ("b_season_edges",), "b_traces": ("b_traces",), "b_fixes": ("b_laps0", "b_laps1", "b_laps", "b_timed", "b_fixes")}


def with_views(sql: str) -> str:
    """``sql`` for the oracle, with the views that it names in front."""
    names = list(dict.fromkeys(n for v, own in _NEEDS.items() if re.search(rf"\b{v}\b", sql) for n in own))
    if not names:
        return sql
    head = ", ".join(f"{n} AS ({VIEWS[n]})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {head}, {body[15:]}"
    return f"WITH {head}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {head} {body}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a table that a task of a shuffle should get; more of them make more tasks, not larger ones.
TASK_ROWS = 400_000
_ROWS: dict[str, int] = {}


def dealt(spark: SparkSession, sf_dir: str, df: DataFrame, *keys: str, becomes: int = 1) -> DataFrame:
    """``df`` dealt by ``keys``; where lineitem is large, to as many tasks as its rows (a file's own count, read once) ask for.

    A row that ``becomes`` many in its task counts as so many; such tasks are not merged, however few rows they read.
    """
    path = f"{sf_dir}/lineitem.parquet"
    if path not in _ROWS:
        _ROWS[path] = table(spark, sf_dir, "lineitem").count()
    tasks, usual = -(-_ROWS[path] * becomes // TASK_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(tasks, usual), *keys) if tasks > usual or becomes > 1 else df.repartition(*keys)


def _laps0(spark: SparkSession, sf_dir: str, lineitem: DataFrame) -> DataFrame:
    """``_LAPS0``, dealt by its driver's race once: what is windowed, grouped or joined by that later stays where it is."""
    driver = ["season", "round", "driver_id"]
    rows = lineitem.withColumns({"season": F.year("l_shipdate").cast("long"), "round": F.quarter("l_shipdate").cast("long"), "driver_id": F.col("l_suppkey")})
    order = Window.partitionBy(*driver).orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    numbered = dealt(spark, sf_dir, rows, *driver).withColumn("lap_number", F.row_number().over(order))
    return numbered.select(*driver, F.floor(F.col("driver_id") / 2).cast("long").alias("team"), "l_tax", "l_discount", "l_orderkey", "l_quantity", "l_extendedprice", "lap_number")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the views as a DataFrame over the tables of ``sf_dir``."""
    at: dict[str, DataFrame] = {}
    for t in TABLES:
        if any(f" {t}" in VIEWS[n] for n in _NEEDS[name]):
            at[t] = table(spark, sf_dir, t)
    for n in _NEEDS[name]:
        if n == "b_laps0":
            at[n] = _laps0(spark, sf_dir, at["lineitem"])
            continue
        body = VIEWS[n]
        used = {t: df for t, df in at.items() if f" {t}" in body}
        for t in used:
            body = body.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
        at[n] = spark.sql(body, **used)
    return at[name]
