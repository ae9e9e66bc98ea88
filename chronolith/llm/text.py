"""Helpers that the text operators share: words, hashes, Arrow batches and tables kept in the shared folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructType

#: Bytes of text that one step inside a task holds as Python objects.
STEP_BYTES = 4 << 20
#: Bytes of word hashes that a worker remembers before it starts afresh, and the longest word that it remembers.
WORD_BYTES, WORD_LONG = 12 << 20, 64

_M = np.uint64(0x9E3779B97F4A7C15)
_C1 = np.uint64(0xFF51AFD7ED558CCD)
_C2 = np.uint64(0xC4CEB9FE1A85EC53)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else the context's. Without one nothing can be kept."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return at


def keep(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the rest of a job does not depend on lost executors."""
    return Tables(df.sparkSession).keep(df, tag)


class Tables:
    """The tables that one job keeps in the shared folder; those that nothing reads any more can be dropped."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.made = spark, f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}", 0

    def keep(self, df: DataFrame, tag: str) -> DataFrame:
        self.made += 1
        path = f"{self.root}-{tag}-{self.made}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.kept_at = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(df.kept_at)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fold_ascii(text: str | None) -> bytes:
    """UTF-8 of ``text`` with A-Z in lower case; None is empty."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


class Memo(dict):
    """``make(key)`` of short keys, remembered within a budget of bytes: what is full starts afresh. Long keys are never kept."""

    def __init__(self, make: Callable, budget: int, cost: int = 130, longest: int = WORD_LONG):
        self.make, self.budget, self.cost, self.longest, self.room = make, budget, cost, longest, budget

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= self.longest:
            self.room -= len(key) + self.cost
            if self.room < 0:
                self.clear()
                self.room = self.budget - len(key) - self.cost
            self[key] = value
        return value


#: Hashes of words (bytes); one memory for each Python worker.
HASHES = Memo(xxhash.xxh3_64_intdigest, WORD_BYTES)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def mixed(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> np.uint64(33))) * _C1
    a = (a ^ (a >> np.uint64(33))) * _C2
    return a ^ (a >> np.uint64(33))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, in order; the size is part of the hash."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    a = hashes[:n] + np.uint64(size)
    for i in range(1, size):
        a = a * _M + hashes[i : i + n]
    return mixed(a)


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; a shorter text is one shingle, an empty one has none."""
    words = fold_ascii(text).split()  # bytes.split() cuts at 0x20 and 0x09-0x0D
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(windows(word_hashes(words), min(size, len(words))))


def steps(batches: Iterable[pa.RecordBatch], text: str = "text", size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text, so that memory does not follow the batch's longest rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes.astype(np.int64)) // size
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


#: Bytes of an Arrow batch between Spark and a task's Python: Spark's own bound of 64 MB, held on both sides, is much for an executor.
ARROW_BYTES = 8 << 20


def map_in_arrow(df: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """``df.mapInArrow`` in a session whose Arrow batches hold at most ``ARROW_BYTES``, or less if it is set so."""
    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def small_batches(spark: SparkSession) -> None:
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(re.sub(r"\D", "", spark.conf.get(name)) or 0)
    if not 0 < now <= ARROW_BYTES:
        spark.conf.set(name, str(ARROW_BYTES))


def with_text(df: DataFrame) -> DataFrame:
    """``df`` with ``text`` as a string; a column that is one stays as it is."""
    return df if df.schema["text"].dataType == StringType() else df.withColumn("text", F.col("text").cast("string"))


def map_rows(df: DataFrame, change: Callable[[pa.RecordBatch], pa.RecordBatch], more: str = "", drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with each step's rows changed by ``change``: columns pass through but for ``drop``, those of the schema ``more`` are added."""
    df = with_text(df)
    schema = StructType([*[f for f in df.schema if f.name not in drop], *(StructType.fromDDL(more) if more else [])])
    names = schema.names

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            yield change(batch).select(names)

    return map_in_arrow(df, run, schema)


def map_texts(df: DataFrame, row: Callable[..., tuple], schema: str, *columns: str) -> DataFrame:
    """``row(*values)`` of each row's ``columns`` (a text is the last one) as a frame of ``schema``, through Arrow batches."""
    text = columns[-1]
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            out = list(zip(*map(row, *(batch.column(c).to_pylist() for c in columns)), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, arrow, strict=True)], schema=arrow)

    return map_in_arrow(df.select(*columns), run, schema)
