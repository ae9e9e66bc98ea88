"""Marts that are published together: versions with a receipt, and turns that one writer alone can take.

A version is written to a folder of its own; its receipt holds each member's rows and fingerprint. A writer then claims the
next turn by creating its file, which the file system lets only one do, and adds the pointer that publishes the version. So a
load that fails before its pointer changes nothing, and of two loads that began from one turn only one is published.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

_POINTER = "turn long, version string"
_RECEIPT = "name string, rows long, fingerprint string"


class TurnTakenError(RuntimeError):
    """Another writer has published from the same turn."""


def fingerprint(name: str, df: DataFrame) -> DataFrame:
    """name, rows and fingerprint of a frame: a sum of its rows' hashes, whatever the order of rows and columns. Repeated rows count as often as they are there."""
    row = F.xxhash64(*[F.lit(x) if isinstance(x, str) else x for c in sorted(df.columns) for x in (c, F.to_json(F.struct(F.col(f"`{c}`").alias("v"))))])
    total = F.sum(row.cast("decimal(38,0)"))
    return df.agg(F.count("*").alias("rows"), F.coalesce(total.cast("string"), F.lit("0")).alias("fingerprint")).select(F.lit(name).alias("name"), "rows", "fingerprint")


def _created(spark: SparkSession, path: str) -> bool:
    """Creates an empty file; False if there is one."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        fs.create(at, False).close()
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName() or fs.exists(at):
            return False
        raise
    return True


def _pointers(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(_POINTER).parquet(f"{root}/pointers")
    except AnalysisException:  # nothing published yet
        return spark.createDataFrame([], _POINTER)


def current(spark: SparkSession, root: str) -> tuple[int, str | None]:
    """The turn and version that readers see; (0, None) before the first."""
    found = _pointers(spark, root).orderBy(F.desc("turn")).first()
    return (found["turn"], found["version"]) if found else (0, None)


def write(frames: dict[str, DataFrame], root: str, base: int | None = None, tries: int = 20) -> int:
    """Publish frames as the turn after ``base``, the turn that they were made from, and give the new turn.

    If another writer has taken that turn, ``TurnTakenError``; without a base the next free one of ``tries`` is taken, for loads
    that replace whatever is there. A claimed turn whose writer died is passed over.
    """
    spark, version = next(iter(frames.values())).sparkSession, uuid.uuid4().hex
    receipt = None
    for name, df in frames.items():
        df.write.parquet(f"{root}/{version}/{name}")
        one = fingerprint(name, spark.read.parquet(f"{root}/{version}/{name}"))
        receipt = one if receipt is None else receipt.unionByName(one)
    receipt.coalesce(1).write.parquet(f"{root}/{version}/_receipt")
    if base is not None and current(spark, root)[0] != base:
        raise TurnTakenError(f"turn {base} is not the last one")
    first = (current(spark, root)[0] if base is None else base) + 1
    for turn in range(first, first + (tries if base is None else 1)):
        if _created(spark, f"{root}/turns/{turn:012d}"):
            spark.createDataFrame([(turn, version)], _POINTER).coalesce(1).write.mode("append").parquet(f"{root}/pointers")
            return turn
    raise TurnTakenError(f"turn {turn} is taken")


def receipts(spark: SparkSession, root: str) -> DataFrame:
    """name, rows and fingerprint of the members of the published version."""
    turn, version = current(spark, root)
    if not turn:
        raise ValueError(f"nothing is published in {root}")
    return spark.read.schema(_RECEIPT).parquet(f"{root}/{version}/_receipt")


def checked(spark: SparkSession, root: str) -> DataFrame:
    """The receipt with ``valid``: whether the member that is there has its rows and fingerprint."""
    said, (_, version) = receipts(spark, root), current(spark, root)
    now = None
    for name in [r["name"] for r in said.select("name").collect()]:  # a bundle's members
        one = fingerprint(name, spark.read.parquet(f"{root}/{version}/{name}")).select("name", F.col("rows").alias("_n"), F.col("fingerprint").alias("_f"))
        now = one if now is None else now.unionByName(one)
    return said.join(now, "name", "left").select("name", "rows", "fingerprint", (F.col("rows").eqNullSafe(F.col("_n")) & F.col("fingerprint").eqNullSafe(F.col("_f"))).alias("valid"))


def read(spark: SparkSession, root: str, verify: bool = True) -> dict[str, DataFrame]:
    """The published members, all of one version; with ``verify`` an error if one isn't what its receipt says."""
    if verify and (bad := [r["name"] for r in checked(spark, root).where("not valid").collect()]):
        raise ValueError(f"{root}: {', '.join(sorted(bad))} differ from the receipt")
    version = current(spark, root)[1]
    return {r["name"]: spark.read.parquet(f"{root}/{version}/{r['name']}") for r in receipts(spark, root).select("name").collect()}
