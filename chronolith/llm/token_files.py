"""Token ids in files: canonical length-limited Huffman codes in independent blocks.

A file set is a folder with ``code`` (id, code length), ``parts`` (part, first id's place) and ``blocks/part=N`` (rows of
whole documents in ascending doc_id order). A block holds the documents' ids and token counts, the bit stream and the
bit offset of every 256th id, so that blocks, and stretches within a block, are decoded on their own by table look-up.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from chronolith.llm.text import keep, map_in_arrow, shared_folder, steps
from chronolith.llm.vocab import encoder

LIMIT, STEP, BLOCK = 16, 256, 1 << 16
_BLOCKS = "part int, at long, doc_ids array<long>, n_tokens array<long>, offsets array<long>, bits binary"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths (uint8, 0 for unused ids) of an optimal prefix code of at most ``limit`` bits, by package-merge."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << limit:
        raise ValueError("more ids than codes of that length")
    if len(used) < 2:
        out[used] = 1
        return out
    order = used[np.argsort(counts[used], kind="stable")]
    leaves, n = counts[order].astype(np.float64), len(used)
    level, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, pairs])
        at = np.argsort(both, kind="stable")
        level = both[at]
        is_leaf.append(at < n)
    take, size = 2 * n - 2, np.zeros(n, np.int64)
    for flags in reversed(is_leaf):
        own = int(flags[:take].sum())
        size[:own] += 1
        take = 2 * (take - own)
    out[order] = size
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes (uint32) in order of length, then id."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes, code, last = np.zeros(len(lengths), np.uint32), 0, 0
    for i in order.tolist():
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def encode(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bit stream of ids and the bit offset of every ``STEP``-th one."""
    if not len(ids):
        return b"", np.empty(0, np.int64)
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    at = ends - size
    value = codes[ids].astype(np.uint64) << (64 - size).astype(np.uint64)
    word, off = at >> 6, (at & 63).astype(np.uint64)
    out = np.zeros((int(ends[-1]) + 63) // 64 + 1, np.uint64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
    out[word[first]] = np.bitwise_or.reduceat(value >> off, first)
    over = np.flatnonzero(off.astype(np.int64) + size > 64)
    out[word[over] + 1] |= value[over] << (np.uint64(64) - off[over])
    return out.byteswap().tobytes()[: (int(ends[-1]) + 7) // 8], at[::STEP]


def tables(lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value of the next ``LIMIT`` bits: the id and its code's length."""
    ids, size = np.zeros(1 << LIMIT, np.uint16), np.zeros(1 << LIMIT, np.uint8)
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    span = 1 << (LIMIT - lengths[used].astype(np.int64))
    end = int(span.sum())
    ids[:end], size[:end] = np.repeat(used, span), np.repeat(lengths[used], span)
    return ids, size


def decode(streams: list[bytes], offsets: list[np.ndarray], counts: list[int], ids: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """Ids of each block. All stretches between offsets are decoded side by side, one id a step."""
    data = np.frombuffer(b"".join(s + b"\0\0\0\0" for s in streams), np.uint8)
    base = np.cumsum([0, *(len(s) + 4 for s in streams)])[:-1] * 8
    lanes = [len(o) for o in offsets]
    pos = np.concatenate([o + b for o, b in zip(offsets, base, strict=True)]).astype(np.int64)
    left = np.concatenate([np.minimum(STEP, n - STEP * np.arange(k)) for n, k in zip(counts, lanes, strict=True)]).astype(np.int64)
    out = np.zeros((len(pos), STEP), np.uint16)
    for step in range(int(left.max(initial=0))):
        live = slice(None) if step < left.min() else np.flatnonzero(left > step)
        p = pos[live]
        i = p >> 3
        bits = (data[i].astype(np.uint32) << 16 | data[i + 1].astype(np.uint32) << 8 | data[i + 2]) >> (8 - (p & 7)).astype(np.uint32) & 0xFFFF
        out[live, step] = ids[bits]
        pos[live] = p + size[bits]
    cut = np.cumsum([0, *lanes])
    return [out[a:b].reshape(-1)[:n] for a, b, n in zip(cut, cut[1:], counts, strict=False)]


def _tokens(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """part, at (ids before it in its part), doc_id, ids; parts and rows ascend with doc_id."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, encode_, end = TaskContext.get().partitionId(), 0, encoder(vocabulary), np.array([end_id], "<u2").tobytes()
        for batch in steps(batches):
            ids = [encode_.ids(t) + end for t in batch.column("text").to_pylist()]
            starts = at + np.cumsum([0, *(len(x) // 2 for x in ids)])
            at = int(starts[-1])
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(ids), pa.int32()), pa.array(starts[:-1]), batch.column("doc_id"), pa.array(ids, pa.binary())], names=["part", "at", "doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_in_arrow(rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"), run, "part int, at long, doc_id long, ids binary")


def _counts(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs: at most 65,536 sums reach the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                total += np.bincount(np.frombuffer(ids.as_buffer(), "<u2"), minlength=1 << 16) if len(ids.as_buffer()) > 4096 else 0
            small = b"".join(x for x in batch.column("ids").to_pylist() if len(x) <= 4096)
            total += np.bincount(np.frombuffer(small, "<u2"), minlength=1 << 16)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["id", "n"])

    out = np.zeros(1 << 16, np.int64)
    for r in map_in_arrow(tokens.select("ids"), run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r["id"]] = r["n"]
    return out


def write_tokens(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 2) -> None:
    """Encode every text of ``docs`` (doc_id, text; null: empty), append ``end_id`` and write a file set to ``folder``.

    Rows ascend with doc_id, null ids first; rows of one id follow their texts. An empty table gives a set without blocks.
    """
    spark = docs.sparkSession
    tokens = keep(_tokens(docs, vocabulary, end_id), "tokens")
    lengths = code_lengths(_counts(tokens))
    book = spark.sparkContext.broadcast(lengths)  # 64 kB, whatever the corpus

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = canonical(book.value)

        def block(rows: list[tuple[int, int, int | None, bytes]]) -> pa.RecordBatch:
            bits, offsets = encode(np.frombuffer(b"".join(r[3] for r in rows), "<u2"), codes, book.value)
            values = [[rows[0][0]], [rows[0][1]], [[r[2] for r in rows]], [[len(r[3]) // 2 for r in rows]], [offsets], [bits]]
            types = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=["part", "at", "doc_ids", "n_tokens", "offsets", "bits"])

        rows, held = [], 0
        for batch in batches:
            for part, at, doc_id, ids in zip(*(batch.column(c).to_pylist() for c in ("part", "at", "doc_id", "ids")), strict=True):
                # a new block where it is full, and where a row doesn't follow the one before
                if rows and (held >= BLOCK or (part, at) != (rows[0][0], rows[0][1] + held)):
                    yield block(rows)
                    rows, held = [], 0
                rows.append((part, at, doc_id, ids))
                held += len(ids) // 2
        if rows:
            yield block(rows)

    spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths) if n], "id int, length int").coalesce(1).write.parquet(f"{folder}/code")
    sums = tokens.groupBy("part").agg(F.sum(F.octet_length("ids") / 2).cast("long").alias("n"))
    sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start")).write.parquet(f"{folder}/parts")  # a row for each part
    map_in_arrow(tokens, run, _BLOCKS).write.partitionBy("part").option("compression", "uncompressed").parquet(f"{folder}/blocks")


def read_tokens(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian uint16), or with ``digest`` ids_crc32 (of uint32) instead."""
    lengths = np.zeros(1 << 16, np.uint8)
    for r in spark.read.schema("id int, length int").parquet(f"{folder}/code").collect():
        lengths[r["id"]] = r["length"]
    book = spark.sparkContext.broadcast(lengths)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, size = tables(book.value, canonical(book.value))
        for batch in batches:
            for i in range(0, batch.num_rows, 16):
                rows = batch.slice(i, 16).to_pylist()
                found = decode([r["bits"] for r in rows], [np.array(r["offsets"], np.int64) for r in rows], [sum(r["n_tokens"]) for r in rows], ids, size)
                out = [[], [], [], [], []]
                for r, block in zip(rows, found, strict=True):
                    at = 0
                    for doc_id, n in zip(r["doc_ids"], r["n_tokens"], strict=True):
                        own = block[at : at + n]
                        for to, x in zip(out, (r["part"], r["at"] + at, doc_id, n, zlib.crc32(own.astype("<u4").tobytes()) if digest else own.tobytes()), strict=True):
                            to.append(x)
                        at += n
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64() if digest else pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], names=["part", "at", "doc_id", "n_tokens", last])

    last = "ids_crc32" if digest else "ids"
    blocks = spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks")
    rows = map_in_arrow(blocks.select("part", "at", "doc_ids", "n_tokens", "offsets", "bits"), run, f"part int, at long, doc_id long, n_tokens long, {last} {'long' if digest else 'binary'}")
    starts = spark.read.schema("part int, start long").parquet(f"{folder}/parts").withColumnRenamed("start", "before")
    return rows.join(starts, "part").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", last)


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tokens/{uuid.uuid4().hex}"
