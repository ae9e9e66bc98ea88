"""Partitioned tables: scans, replacing writes, incremental refresh, ledgers and slowly changing dimensions."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else the context's. Without one nothing can be kept."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return at


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None, **keys) -> DataFrame:
    """Rows of a partitioned Parquet table, pruned to the given partition values."""
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    for k, v in keys.items():
        df = df.where(F.col(k) == v)
    return df


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a pinned schema: nothing is inferred."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def flatten(records: DataFrame, column: str, schema: str, path: str) -> DataFrame:
    """JSON texts of ``column`` to one row for each element of the list at ``path``; missing keys are null, an empty list keeps its record."""
    parsed = records.withColumn("_d", F.from_json(column, schema))
    return parsed.withColumn("item", F.explode_outer(F.col("_d." + path))).drop(column)


def write_touched(df: DataFrame, path: str, keys: list[str]) -> None:
    """Replace exactly the partitions that occur in ``df``; null keys are refused."""
    if not keys:
        df.write.mode("overwrite").parquet(path)
        return
    bad = F.lit(False)
    for k in keys:
        bad = bad | F.col(k).isNull()
    checked = df.where(F.assert_true(~bad, F.lit("null partition key")).isNull())
    checked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def replaced(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Delete+insert by distinct keys: existing rows of other keys, then all incoming ones, columns by name."""
    stay = existing.join(incoming.select(*keys).distinct(), keys, "left_anti").select(*existing.columns)
    return stay.unionByName(incoming, allowMissingColumns=True)


def replaced_partition(existing: DataFrame, incoming: DataFrame, **key) -> DataFrame:
    """Replace one partition; rows outside it raise an error, an empty frame clears it."""
    inside = F.lit(True)
    for k, v in key.items():
        inside = inside & F.col(k).eqNullSafe(F.lit(v))
    return existing.where(~inside).unionByName(incoming.where(F.assert_true(inside, F.lit("row outside the partition")).isNull()), allowMissingColumns=True)


def ledger(df: DataFrame, resource: str, keys: list[str], load_id: str) -> DataFrame:
    """One audit row for each partition: rows, load and time."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).withColumns({"resource": F.lit(resource), "load_id": F.lit(load_id), "loaded_at": F.current_timestamp()})


def high_watermark(ledger_: DataFrame, season: str, round_: str) -> DataFrame:
    return ledger_.groupBy(season).agg(F.coalesce(F.max(round_), F.lit(0)).alias("last_round"))


def completed(races: DataFrame, day: str, as_of: date | str) -> DataFrame:
    """Partitions on or before a day."""
    return races.where(F.col(day) <= F.lit(as_of).cast("date"))


def stale_keys(source: DataFrame, target: DataFrame, keys: list[str], loaded_at: str = "loaded_at") -> DataFrame:
    """Keys whose source load is newer than the target's or that the target lacks."""
    s = source.groupBy(*keys).agg(F.max(loaded_at).alias("_s"))
    t = target.groupBy(*keys).agg(F.max(loaded_at).alias("_t"))
    return s.join(t, keys, "left").where(F.col("_t").isNull() | (F.col("_s") > F.col("_t"))).select(*keys)


def latest_completed(races: DataFrame, day: str, as_of: date | str) -> DataFrame:
    """The last partition before a day."""
    return races.where(F.col(day) < F.lit(as_of).cast("date")).orderBy(F.desc(day)).limit(1)


def refresh(source: DataFrame, path: str, keys: list[str], build: Callable[[DataFrame], DataFrame], loaded_at: str = "loaded_at") -> None:
    """Recompute and replace only the mart partitions whose source was loaded after them. The mart then equals a full rebuild."""
    stale = stale_keys(source, source.sparkSession.read.parquet(path), keys, loaded_at).checkpoint()  # the mart is replaced below
    write_touched(build(source.join(F.broadcast(stale), keys, "left_semi")), path, keys)  # a row for each partition


def restore(rows: DataFrame, path: str, **key) -> None:
    """Write one partition back; rows of another one, or none at all, are refused before anything is written."""
    inside = F.lit(True)
    for k, v in key.items():
        inside = inside & F.col(k).eqNullSafe(F.lit(v))
    n, bad = rows.agg(F.count("*"), F.count_if(~inside)).first()
    if not n or bad:
        raise ValueError(f"{n} rows to restore, of which {bad} are not of {key}")
    write_touched(rows, path, list(key))


def fill_columns(own: DataFrame, donor: DataFrame, keys: list[str], unchanged: list[str], fill: list[str], tolerance: float = 1e-6) -> DataFrame:
    """Nulls of ``fill`` from a donor of the same keys; an error if a key is missing on either side, an ``unchanged`` value differs or filled values conflict."""
    both = own.withColumn("_l", F.lit(True)).alias("a").join(donor.withColumn("_r", F.lit(True)).alias("b"), [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys], "full_outer")
    ok = F.coalesce(F.col("_l") & F.col("_r"), F.lit(False))
    for c in unchanged:
        ok = ok & (F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) | F.coalesce(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) <= tolerance, F.lit(False)))
    for c in fill:
        ok = ok & (F.col(f"a.{c}").isNull() | F.col(f"b.{c}").isNull() | (F.col(f"a.{c}") == F.col(f"b.{c}")))
    checked = both.where(F.assert_true(ok, F.lit("the donor does not fit")).isNull())
    return checked.select(*[F.coalesce(f"a.{c}", f"b.{c}").alias(c) if c in fill else F.col(f"a.{c}") for c in own.columns])


def _counted(spark: SparkSession, counts: dict[str, str]) -> DataFrame:
    out = None
    for name, path in counts.items():
        one = spark.read.parquet(path).agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def snapshot(tables: dict[str, DataFrame], path: str, allowed: list[str], season: str, first: int, last: int) -> DataFrame:
    """Write the allowed tables, without seasons out of range, and give name and rows of what was written."""
    for name in allowed:
        df = tables[name]
        (df.where(F.col(season).between(first, last)) if season in df.columns else df).write.parquet(f"{path}/{name}")
    return _counted(tables[allowed[0]].sparkSession, {n: f"{path}/{n}" for n in allowed})


def export_sorted(df: DataFrame, path: str, keys: list[str], order: list[str], schema: str) -> None:
    """Typed, narrowed columns, one directory for each partition, sorted inside its files."""
    rows = with_columns(df, T.StructType.fromDDL(schema)).select(*T.StructType.fromDDL(schema).names)
    rows.repartition(*keys).sortWithinPartitions(*keys, *order).write.partitionBy(*keys).parquet(path)


def subset(tables: dict[str, DataFrame], path: str, **key) -> DataFrame:
    """Write each table, cut to one partition where it has the keys, and give name and rows of what was written."""
    for name, df in tables.items():
        for k, v in key.items():
            df = df.where(F.col(k) == v) if k in df.columns else df
        df.write.parquet(f"{path}/{name}")
    return _counted(next(iter(tables.values())).sparkSession, {n: f"{path}/{n}" for n in tables})


def with_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Additive evolution: missing columns as typed nulls, in the schema's order; further columns stay behind them."""
    have = set(df.columns)
    own = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return df.select(*own, *[c for c in df.columns if c not in schema.names])


def fill_partitions(present: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Whole partitions that are absent come from the other source; rows are never merged."""
    return present.unionByName(other.join(present.select(*keys).distinct(), keys, "left_anti").select(*other.columns), allowMissingColumns=True)


def scd2(current: DataFrame, incoming: DataFrame, key: str, checks: list[str], at: str) -> DataFrame:
    """Type-2 history (key, checks, valid_from, valid_to): a new version where a check column differs."""
    now = F.lit(at).cast("timestamp")
    open_ = current.where("valid_to is null")
    same = F.lit(True)
    for c in checks:
        same = same & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
    both = open_.alias("o").join(incoming.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    kept = both.where(F.col(f"o.{key}").isNotNull()).select("o.*", F.when(F.col(f"n.{key}").isNotNull() & ~same, now).alias("_end"))
    kept = kept.select(key, *checks, "valid_from", F.col("_end").alias("valid_to"))
    new = both.where(F.col(f"n.{key}").isNotNull() & (F.col(f"o.{key}").isNull() | ~same)).select(*[F.col(f"n.{c}").alias(c) for c in (key, *checks)], now.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"))
    return current.where("valid_to is not null").select(key, *checks, "valid_from", "valid_to").unionByName(kept).unionByName(new)


def updated(df: DataFrame, changes: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Columns set where all keys match; other rows and columns as they were."""
    c = changes.select(*keys, *[F.col(x).alias(f"_{x}") for x in columns], F.lit(True).alias("_hit"))
    out = df.join(c, keys, "left")
    return out.select(*[F.when(F.col("_hit"), F.col(f"_{x}")).otherwise(F.col(x)).alias(x) if x in columns else F.col(x) for x in df.columns])
