"""Streaming queries: the twins of batch operators on a closed stream of the events, whose files come out of order."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronolith.plans.bindings import table
from chronolith.plans.registry import query
from chronolith.sources.partitions import shared_folder
from chronolith.streaming import twins as T

S = SparkSession


def stream(spark: S, d: str, rows: DataFrame, files: int = 3) -> DataFrame:
    """``rows`` (with user_id and ts) as a stream of files that each span the whole time, then a row far ahead that moves the watermark past all."""
    folder = f"{shared_folder(spark)}/streams/{uuid.uuid4().hex}-in"
    for i in range(files):
        rows.where(F.pmod(F.xxhash64("event_id"), F.lit(files)) == i).coalesce(1).write.mode("append").parquet(folder)
    last = rows.agg(F.max("ts").alias("ts")).select(*[(F.col("ts") + F.expr("interval 400 days")).alias("ts") if f.name == "ts" else F.lit(-1 if f.name == "user_id" else None).cast(f.dataType).alias(f.name) for f in rows.schema])
    last.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def drained(out: DataFrame) -> DataFrame:
    """The stream's whole output, written by one run over what is there and read back."""
    spark, folder = out.sparkSession, f"{shared_folder(out.sparkSession)}/streams/{uuid.uuid4().hex}"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    out.writeStream.format("parquet").option("checkpointLocation", folder + "-state").trigger(availableNow=True).start(folder + "-out").awaitTermination()
    return spark.read.schema(out.schema).parquet(folder + "-out")


def events(spark: S, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")


@query("SELECT DISTINCT user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def ss01_dedupe(spark: S, d: str) -> DataFrame:
    rows = stream(spark, d, events(spark, d)).withColumn("day", F.to_date("ts").cast("string"))
    return drained(T.deduplicated(rows, "ts", ["user_id", "event_type", "day"], "60 days").select("user_id", "event_type", "day")).where("user_id >= 0")


@query("SELECT user_id, CAST(date_trunc('hour', ts) AS VARCHAR) AS start, count(*) AS samples, count(*) FILTER (value > 10) AS valid FROM events GROUP BY 1, 2")
def ss02_tick_counts(spark: S, d: str) -> DataFrame:
    rows = stream(spark, d, events(spark, d)).withColumn("ok", F.col("value") > 10)
    out = drained(T.tick_counts(rows, "ts", ["user_id"], "ok", "1 hour", "60 days")).where("user_id >= 0")
    return out.select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "samples", "valid")


@query(
    "WITH m AS (SELECT user_id, epoch_us(ts) AS t, event_id, CASE event_type WHEN 'error' THEN 'start' ELSE 'end' END AS e FROM events WHERE event_type IN ('error', 'signup')), k AS (SELECT * FROM m QUALIFY e IS DISTINCT FROM lag(e) OVER (PARTITION BY user_id ORDER BY t, event_id)), "
    "i AS (SELECT *, lead(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS z FROM k) SELECT user_id, t // 1000000 AS start, z // 1000000 AS \"end\" FROM i WHERE e = 'start'"
)
def ss03_intervals(spark: S, d: str) -> DataFrame:
    edge = F.when(F.col("event_type") == "error", "start").when(F.col("event_type") == "signup", "end")
    rows = stream(spark, d, events(spark, d)).withColumn("edge", F.coalesce(edge, F.when(F.col("user_id") < 0, "end")))
    out = drained(T.intervals(rows, "user_id", "60 days", longest=86400.0 * 90)).where("key >= 0")
    return out.select(F.col("key").alias("user_id"), F.floor("start").alias("start"), F.floor("end").alias("end"))


@query(
    "WITH u AS (SELECT user_id, epoch_us(ts) AS t, value FROM events WHERE event_type = 'click'), k AS (SELECT event_id, user_id, epoch_us(ts) AS t FROM events WHERE event_type = 'view') "
    "SELECT k.user_id, k.t // 1000000 AS t, CASE WHEN k.t - u.t <= 7200000000 THEN u.value END AS held FROM k ASOF LEFT JOIN u ON u.user_id = k.user_id AND k.t >= u.t"
)
def ss04_hold(spark: S, d: str) -> DataFrame:
    rows = events(spark, d).where(F.col("event_type").isin("click", "view")).withColumn("v", F.when(F.col("event_type") == "click", F.col("value")))
    out = drained(T.held(stream(spark, d, rows), "user_id", "60 days", 7200.0)).where("key >= 0")
    return out.select(F.col("key").alias("user_id"), F.floor("t").alias("t"), "held")
