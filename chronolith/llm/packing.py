"""Harmonic packing of token sequences.

A piece of length n belongs to class k = capacity // n: k pieces of the class always fit into one sequence. Documents
are cut into whole sequences, then into pieces of just under the largest class size that fits, so that each class fills
its sequences with k pieces and little padding. Workers fill the sequences of their share of a class independently. The
fewer than k pieces that a share leaves over are dealt to shares again, until one share holds a class's; the fewer than k
of each class that are left then, whose number is bounded by the capacity alone, are packed best-fit.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from chronolith.llm.text import keep, map_in_arrow, steps
from chronolith.llm.vocab import encoder

CAPACITY = 2048
#: A piece may be shorter than its class's size by this part of it; pieces of at most capacity / 32 are not cut further.
SLACK, SMALL = 64, 32
#: Pieces of a class that one worker fills sequences from.
SHARE = 20_000


def cuts(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of n tokens, in order."""
    out = [capacity] * (n // capacity)
    left = n % capacity
    while left:
        slot = capacity // (capacity // left)
        if left <= capacity // SMALL or (slot - left) * SLACK <= slot:
            out.append(left)
            break
        out.append(capacity // -(-capacity // left))
        left -= out[-1]
    return out


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, k for each piece of each text."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "k"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary), np.array([end_id], "<u2").tobytes()
        for batch in steps(batches):
            out: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.frombuffer(encode.ids(text) + end, "<u2").astype("<u4")
                at = 0
                for n in cuts(len(ids), capacity):
                    out.append((doc_id, at, n, zlib.crc32(ids[at : at + n].tobytes()), len(ids), capacity // n))
                    at += n
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_in_arrow(rows, run, ", ".join(f"{n} long" for n in names))


def _filled(rows: DataFrame, round_: int) -> tuple[DataFrame, DataFrame]:
    """Pieces in whole sequences of (k, share), and those left over."""
    by = Window.partitionBy("k", "share")
    order = by.orderBy("doc_id", "start", "row")
    bins = rows.withColumns({"bin": F.floor((F.row_number().over(order) - 1) / F.col("k")), "rows": F.count("*").over(by)})
    # a bin's window has (k, share) in its keys and follows their partitioning: no further shuffle
    inside = Window.partitionBy("k", "share", "bin").orderBy("doc_id", "start", "row").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    whole = (F.col("bin") + 1) * F.col("k") <= F.col("rows")
    sequence = F.shiftleft("k", 51) + F.shiftleft(F.lit(round_).cast("long"), 48) + F.shiftleft("share", 17) + F.col("bin")
    return bins.where(whole).withColumn("sequence_id", sequence), bins.where(~whole)


def packed(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = CAPACITY, share: int = SHARE) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset for each piece of ``docs`` (doc_id, text).

    A null or empty text is the end id alone. Ids may be null; pieces are dealt by a number of their row, so that repeated
    rows and rows without an id are packed as rows of their own. An empty table gives no rows. Columns other than doc_id
    and text are not read. Sequences are padded to the capacity.
    """
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = keep(pieces(docs, vocabulary, end_id, capacity).withColumn("row", F.monotonically_increasing_id()), "pieces")
    done, left, round_ = [], rows, 0
    while True:
        many = {r["k"]: r["n"] for r in left.groupBy("k").agg(F.count("*").alias("n")).collect()}  # a row for each class
        if not many:
            break
        shares = {k: -(-n // max(share, 2 * k)) for k, n in many.items()}
        deal = F.create_map(*[F.lit(x) for item in shares.items() for x in item])[F.col("k")]
        full, left = _filled(left.withColumn("share", F.pmod(F.xxhash64("row", F.lit(round_)), deal).cast("long")), round_)
        done.append(full.select(*out))
        if max(shares.values()) == 1:
            break
        left, round_ = keep(left.select(*rows.columns), "left"), round_ + 1
    if not done:
        return rows.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).select(*out)

    def best_fit(rest: pa.Table) -> pa.Table:
        rest = rest.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        free, number, offset = np.zeros(0, np.int64), [], []
        for n in rest.column("length").to_pylist():
            room = np.where(free >= n, free, capacity + 1)
            i = int(room.argmin()) if len(room) else 0
            if not len(room) or room[i] > capacity:
                i, free = len(free), np.append(free, capacity)
            number.append(i)
            offset.append(capacity - int(free[i]))
            free[i] -= n
        return rest.append_column("sequence_id", pa.array(number, pa.int64())).append_column("offset", pa.array(offset, pa.int64())).select(out)

    schema = ", ".join(f"{n} long" for n in out)
    rest = left.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", F.lit(0).alias("all")).groupBy("all").applyInArrow(best_fit, schema)  # bounded by the capacity
    return reduce(DataFrame.unionByName, [*done, rest])
