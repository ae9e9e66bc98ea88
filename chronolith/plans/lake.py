"""Queries of scans, writes and partition maintenance: each writes to a new place in the shared folder and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from chronolith.operators import quality as Q
from chronolith.plans.basics import laps
from chronolith.plans.bindings import table
from chronolith.plans.registry import query
from chronolith.sources import bundles as B, partitions as P

S = SparkSession


def place(spark: S, name: str) -> str:
    return f"{P.shared_folder(spark)}/lake/{uuid.uuid4().hex}-{name}"


def orders(spark: S, d: str) -> DataFrame:
    """Orders with their year and quarter as partition keys."""
    o = table(spark, d, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("day"), F.year("o_orderdate").alias("season"), F.quarter("o_orderdate").alias("round"))


_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS day, year(o_orderdate) AS season, quarter(o_orderdate) AS round FROM orders"


@query(f"SELECT o_orderkey, o_totalprice FROM ({_ORDERS}) WHERE season = 1997 AND round = 2")
def io01_partitioned_scan(spark: S, d: str) -> DataFrame:
    path = place(spark, "orders")
    P.write_touched(orders(spark, d), path, ["season", "round"])
    return P.scan(spark, path, season=1997, round=2).select("o_orderkey", "o_totalprice")


@query(f"SELECT season, round, count(*) AS n, count(*) FILTER (o_orderstatus = 'X') AS changed FROM (SELECT season, round, CASE WHEN season = 1996 AND round = 1 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM ({_ORDERS}) WHERE NOT (season = 1996 AND round = 1) OR o_totalprice > 100000) GROUP BY ALL")
def io02_replace_touched(spark: S, d: str) -> DataFrame:
    path, rows = place(spark, "orders"), orders(spark, d)
    P.write_touched(rows, path, ["season", "round"])
    P.write_touched(rows.where("season = 1996 and round = 1 and o_totalprice > 100000").withColumn("o_orderstatus", F.lit("X")), path, ["season", "round"])
    return P.scan(spark, path).groupBy("season", "round").agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "X").alias("changed"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def io03_pinned_csv(spark: S, d: str) -> DataFrame:
    path = place(spark, "csv")
    table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal").write.option("header", True).csv(path)
    return P.read_csv(spark, path, T.StructType.fromDDL("c_custkey long, c_name string, c_acctbal double"))


@query("SELECT conv_id, CAST(turn AS BIGINT) AS turn, length(text) AS size FROM conversations")
def io04_flatten(spark: S, d: str) -> DataFrame:
    turn = F.struct(F.col("turn").cast("string").alias("turn"), "role", "text")
    nested = table(spark, d, "conversations").groupBy("conv_id", F.floor(F.col("turn") / 16).alias("part")).agg(F.to_json(F.struct(F.collect_list(turn).alias("turns"))).alias("doc"))  # documents of bounded size
    flat = P.flatten(nested, "doc", "turns array<struct<turn string, role string, text string, absent string>>", "turns")
    return flat.select("conv_id", F.col("item.turn").try_cast("long").alias("turn"), F.char_length("item.text").cast("long").alias("size"))


@query(f"SELECT season, count(*) AS n, sum(CASE WHEN season = 1998 THEN 1 ELSE 0 END)::BIGINT AS reloaded FROM ({_ORDERS}) GROUP BY season")
def io05_reload_keys(spark: S, d: str) -> DataFrame:
    path, rows = place(spark, "orders"), orders(spark, d).withColumn("load", F.lit(1))
    P.write_touched(rows, path, ["season", "round"])  # a whole season, then by round: what is loaded again replaces its own keys only
    for r in (1, 2, 3, 4):
        P.write_touched(rows.where(f"season = 1998 and round = {r}").withColumn("load", F.lit(2)).select(*reversed(rows.columns)), path, ["season", "round"])
    return P.scan(spark, path).groupBy("season").agg(F.count("*").alias("n"), F.count_if(F.col("load") == 2).alias("reloaded"))


@query(f"SELECT season, count(*) AS n FROM ({_ORDERS}) WHERE season <> 1995 AND NOT (season = 1997 AND o_orderstatus = 'F') GROUP BY season")
def io06_replace_partition(spark: S, d: str) -> DataFrame:
    rows = orders(spark, d)
    less = P.replaced_partition(rows, rows.where("season = 1997 and o_orderstatus <> 'F'"), season=1997)
    return P.replaced_partition(less, rows.limit(0), season=1995).groupBy("season").agg(F.count("*").alias("n"))  # an empty frame clears it


@query(f"SELECT season, n, revenue FROM (SELECT season, count(*) AS n FROM ({_ORDERS}) GROUP BY season) JOIN (SELECT season, round(sum(o_totalprice), 2) AS revenue FROM ({_ORDERS}) WHERE o_orderstatus = 'F' GROUP BY season) USING (season)")
def io07_bundle(spark: S, d: str) -> DataFrame:
    tables = B.read(spark, _published(spark, d))
    return tables["counts"].join(tables["revenue"], "season")


def _published(spark: S, d: str) -> str:
    """A bundle of two marts in its second version, which replaces both at once."""
    root, rows = place(spark, "bundle"), orders(spark, d)
    for base, part in enumerate((rows.where("o_orderstatus = 'O'"), rows)):
        done = part.where("o_orderstatus = 'F'").groupBy("season").agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"))
        B.write({"counts": part.groupBy("season").agg(F.count("*").alias("n")), "revenue": done}, root, base)
    return root


@query(f"SELECT 'counts' AS name, count(DISTINCT season) AS rows, TRUE AS valid FROM ({_ORDERS}) UNION ALL SELECT 'revenue', count(DISTINCT season), TRUE FROM ({_ORDERS}) WHERE o_orderstatus = 'F'")
def io07_receipts(spark: S, d: str) -> DataFrame:
    return B.checked(spark, _published(spark, d)).select("name", "rows", "valid")


@query("SELECT s_suppkey, s_name FROM supplier")
def io08_full_replace(spark: S, d: str) -> DataFrame:
    path, rows = place(spark, "supplier"), table(spark, d, "supplier").select("s_suppkey", "s_name")
    P.write_touched(rows.limit(3), path, [])
    P.write_touched(rows, path, [])
    return spark.read.parquet(path)


def _mart(rows: DataFrame) -> DataFrame:
    """The mart that a change has to reach: laps and best lap of a driver and race."""
    return rows.groupBy("season", "round", "driver_id").agg(F.count("*").alias("laps"), F.round(F.min("lap_time_sec"), 6).alias("best"), F.max("loaded_at").alias("loaded_at"))


_CHANGED = "CASE WHEN season = 1997 AND round = 3 THEN lap_time_sec + 1 ELSE lap_time_sec END"


@query(f"SELECT season, round, driver_id, count(*) AS laps, round(min({_CHANGED}), 6) AS best, CASE WHEN season = 1997 AND round = 3 THEN 2 ELSE 1 END AS loaded_at FROM b_laps GROUP BY season, round, driver_id")
def io10_incremental(spark: S, d: str) -> DataFrame:
    first = laps(spark, d).withColumn("loaded_at", F.lit(1))
    path = place(spark, "mart")
    P.write_touched(_mart(first), path, ["season", "round"])
    late = (F.col("season") == 1997) & (F.col("round") == 3)
    second = first.withColumns({"loaded_at": F.when(late, 2).otherwise(1), "lap_time_sec": F.when(late, F.col("lap_time_sec") + 1).otherwise(F.col("lap_time_sec"))})
    P.refresh(second, path, ["season", "round"], _mart)
    return P.scan(spark, path).select("season", "round", "driver_id", "laps", "best", "loaded_at")


@query(f"WITH r AS (SELECT DISTINCT season, round, max(day) OVER (PARTITION BY season, round) AS day FROM ({_ORDERS})) SELECT season, round, day < DATE '1998-01-01' AND day = (SELECT max(day) FROM r WHERE day < DATE '1998-01-01') AS latest FROM r WHERE day <= DATE '1998-01-01'")
def io13_completed(spark: S, d: str) -> DataFrame:
    races = orders(spark, d).groupBy("season", "round").agg(F.max("day").alias("day"))
    last = P.latest_completed(races, "day", "1998-01-01").select("season", "round", F.lit(True).alias("latest"))
    return P.completed(races, "day", "1998-01-01").join(last, ["season", "round"], "left").select("season", "round", F.coalesce("latest", F.lit(False)).alias("latest"))


@query("SELECT s_suppkey, s_name, CAST(NULL AS DOUBLE) AS rating, s_nationkey FROM supplier WHERE s_nationkey < 12 UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier WHERE s_nationkey >= 12")
def io14_additive_schema(spark: S, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    schema = T.StructType.fromDDL("s_suppkey long, s_name string, rating double, s_nationkey int")
    old = s.where("s_nationkey < 12").select("s_suppkey", "s_name", "s_nationkey")
    new = s.where("s_nationkey >= 12").select("s_name", F.col("s_acctbal").alias("rating"), "s_suppkey")
    return P.with_columns(old, schema).unionByName(P.with_columns(new, schema))


@query(f"SELECT season, round, count(*) AS n FROM ({_ORDERS}) GROUP BY ALL")
def io15_restore(spark: S, d: str) -> DataFrame:
    path, rows = place(spark, "orders"), orders(spark, d)
    P.write_touched(rows.where("not (season = 1997 and round = 4)"), path, ["season", "round"])
    P.restore(rows.where("season = 1997 and round = 4"), path, season=1997, round=4)
    return P.scan(spark, path).groupBy("season", "round").agg(F.count("*").alias("n"))


@query(
    "SELECT s_suppkey, s_acctbal AS balance, '1995-01-01' AS valid_from, CASE WHEN s_nationkey % 3 = 0 THEN '1996-01-01' END AS valid_to FROM supplier UNION ALL SELECT s_suppkey, s_acctbal + 1, '1996-01-01', NULL FROM supplier WHERE s_nationkey % 3 = 0"
)
def io16_history(spark: S, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_acctbal").alias("balance"), "s_nationkey")
    empty = spark.createDataFrame([], "s_suppkey long, balance double, valid_from timestamp, valid_to timestamp")
    first = P.scd2(empty, s.select("s_suppkey", "balance"), "s_suppkey", ["balance"], "1995-01-01")
    changed = s.select("s_suppkey", F.when(F.col("s_nationkey") % 3 == 0, F.col("balance") + 1).otherwise(F.col("balance")).alias("balance"))
    day = lambda c: F.date_format(c, "yyyy-MM-dd").alias(c)
    return P.scd2(first, changed, "s_suppkey", ["balance"], "1996-01-01").select("s_suppkey", "balance", day("valid_from"), day("valid_to"))


@query(f"SELECT season, count(*) AS n, min(source) AS source FROM (SELECT season, 'own' AS source FROM ({_ORDERS}) WHERE season < 1997 AND o_orderstatus = 'F' UNION ALL SELECT season, 'other' FROM ({_ORDERS}) WHERE season NOT IN (SELECT season FROM ({_ORDERS}) WHERE season < 1997 AND o_orderstatus = 'F')) GROUP BY season")
def io17_fill_partitions(spark: S, d: str) -> DataFrame:
    rows = orders(spark, d)
    own = rows.where("season < 1997 and o_orderstatus = 'F'").withColumn("source", F.lit("own"))
    return P.fill_partitions(own, rows.withColumn("source", F.lit("other")), ["season"]).groupBy("season").agg(F.count("*").alias("n"), F.min("source").alias("source"))


@query("SELECT c_custkey, c_acctbal, coalesce(CASE WHEN c_nationkey < 12 THEN c_mktsegment END, lower(c_mktsegment)) AS segment FROM customer")
def io18_fill_columns(spark: S, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    own = c.select("c_custkey", "c_acctbal", F.when(F.col("c_nationkey") < 12, F.col("c_mktsegment")).alias("segment"))
    donor = c.select("c_custkey", (F.col("c_acctbal") + 1e-9).alias("c_acctbal"), F.when(F.col("c_nationkey") >= 12, F.lower("c_mktsegment")).alias("segment"))
    return P.fill_columns(own, donor, ["c_custkey"], unchanged=["c_acctbal"], fill=["segment"])


@query(f"SELECT 'counts' AS name, count(*) AS rows FROM (SELECT 1 FROM ({_ORDERS}) WHERE season BETWEEN 1996 AND 1997) UNION ALL SELECT 'customer', count(*) FROM customer")
def io19_snapshot(spark: S, d: str) -> DataFrame:
    tables = {"counts": orders(spark, d), "customer": table(spark, d, "customer"), "secret": table(spark, d, "supplier")}
    return P.snapshot(tables, place(spark, "snapshot"), allowed=["counts", "customer"], season="season", first=1996, last=1997)


@query("SELECT season, round, driver_id, count(*) AS n, max(CASE WHEN lap_number = 1 THEN lap_time_sec END) AS first FROM b_laps GROUP BY ALL")
def io20_sorted_export(spark: S, d: str) -> DataFrame:
    path = place(spark, "export")
    P.export_sorted(laps(spark, d), path, ["season", "round"], ["driver_id", "lap_number"], "season long, round long, driver_id long, lap_number int, lap_time_sec double")
    return spark.read.parquet(path).groupBy("season", "round", "driver_id").agg(F.count("*").alias("n"), F.max(F.when(F.col("lap_number") == 1, F.col("lap_time_sec"))).alias("first"))


@query(f"SELECT 'laps' AS name, count(*) AS rows FROM b_laps WHERE season = 1997 AND round = 2 UNION ALL SELECT 'orders', count(*) FROM ({_ORDERS}) WHERE season = 1997 AND round = 2 UNION ALL SELECT 'nation', 25")
def io22_fixture(spark: S, d: str) -> DataFrame:
    path = place(spark, "fixture")
    sizes = P.subset({"laps": laps(spark, d), "orders": orders(spark, d), "nation": table(spark, d, "nation")}, path, season=1997, round=2)
    return Q.must(sizes, F.col("rows") > 0, "an empty fixture")


@query(f"SELECT season, round, count(*) AS row_count FROM ({_ORDERS}) GROUP BY ALL")
def io11_ledger_by_partition(spark: S, d: str) -> DataFrame:
    path, rows = place(spark, "ledger"), orders(spark, d)
    for load in ("first", "second"):  # a reload replaces the partition's row
        P.write_touched(P.ledger(rows, "orders", ["season", "round"], load), path, ["season", "round"])
    return P.scan(spark, path).where("load_id = 'second'").select("season", "round", "row_count")
