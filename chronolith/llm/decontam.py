"""Benchmark decontamination: a broadcast hash set of normalised test n-grams against every training token window.

A window whose hash is in the set is verified on its words. The set is broadcast only while its measured size is at
most ``broadcast_bytes``; a larger benchmark goes through a shuffle join on the window hash, with the same result.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from chronolith.llm.text import keep, map_in_arrow, map_rows, map_texts, steps, windows, word_hashes

SIZE = 13
_WORD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_FILTER_BITS = 20


def item_words(text: str | None) -> list[bytes]:
    """Words of a text: runs of digits, letters and characters from U+0080, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD).split()


def benchmark_windows(benchmark: DataFrame, size: int = SIZE) -> DataFrame:
    """One row for each distinct window (n, words) with the sorted ids of the items that hold it; an item of fewer words is one window."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            n, joined, ids = [], [], []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = item_words(text)
                k = min(size, len(words))
                for w in {b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)} if k else ():
                    n.append(k), joined.append(w), ids.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int32()), pa.array(joined, pa.binary()), pa.array(ids, pa.string())], names=["n", "words", "item_id"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return map_in_arrow(items, run, "n int, words binary, item_id string").groupBy("n", "words").agg(F.sort_array(F.collect_set("item_id")).alias("items"))


class Finder:
    """Finds occurrences of a table of windows in a text's words."""

    def __init__(self, rows: list[tuple[int, bytes, list[str]]]):
        self.items = {w: items for _, w, items in rows}
        self.filters: dict[int, np.ndarray] = {}
        for n, w, _ in rows:
            mask = self.filters.setdefault(n, np.zeros(1 << _FILTER_BITS, bool))
            mask[windows(word_hashes(w.split()), n) & np.uint64((1 << _FILTER_BITS) - 1)] = True

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """(start, length, items) of each window that occurs, in words."""
        hashes = word_hashes(words)
        for n, mask in self.filters.items():
            for i in np.flatnonzero(mask[windows(hashes, n) & np.uint64((1 << _FILTER_BITS) - 1)]).tolist():
                if (items := self.items.get(b" ".join(words[i : i + n]))) is not None:
                    yield i, n, items


def result(n_words: int, found: Iterable[tuple[int, int, list[str]]]) -> tuple:
    """n_words, n_hit, n_items, items_sha256, contaminated, spans (start and end of runs of hit words) of one text."""
    edge, items, any_hit = None, set(), False
    for i, n, ids in found:
        edge = np.zeros(n_words + 1, np.int32) if edge is None else edge
        edge[i] += 1
        edge[i + n] -= 1
        items.update(ids)
        any_hit = True
    spans: list[int] = []
    if any_hit:
        hit = np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8), [0]])
        spans = np.flatnonzero(np.diff(hit)).tolist()
    n_hit = sum(spans[1::2]) - sum(spans[::2])
    return n_words, n_hit, len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), n_hit > 0 and 20 * n_hit >= n_words, spans


_RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<long>"


def _table(docs: DataFrame, benchmark: DataFrame, size: int, broadcast_bytes: int) -> tuple[DataFrame, Callable[[], Finder] | None]:
    """The benchmark's windows and, if their measured size allows a broadcast, what gives a worker its finder."""
    table = keep(benchmark_windows(benchmark, size), "windows")
    # what a worker holds: a row's tuple, words, list, texts of ids and dictionary entry, and a filter for each length
    cost = table.agg(F.sum(F.octet_length("words") + 320 + F.aggregate("items", F.lit(0), lambda a, x: a + F.octet_length(x) + 72))).first()[0] or 0
    if cost > broadcast_bytes:
        return table, None
    rows = docs.sparkSession.sparkContext.broadcast([(r.n, bytes(r.words), list(r["items"])) for r in table.collect()])
    name = uuid.uuid4().hex
    return table, lambda: _finder(name, rows)


_made: dict[str, Finder] = {}


def _finder(name: str, rows: Broadcast) -> Finder:
    """One finder for each Python worker: that of the latest broadcast table."""
    if name not in _made:
        _made.clear()
        _made[name] = Finder(rows.value)
    return _made[name]


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (word offsets) for each row of ``docs``.

    Null or blank text: no words, not contaminated, the digest of no items. Null or blank items add no windows; an item
    without an id marks words as hit but is no item. Repeated rows give repeated results; ids may be null; an empty
    benchmark leaves every document clean. Columns other than doc_id and text (item_id and text) are not read.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    table, finder = _table(docs, benchmark, size, broadcast_bytes)
    if finder is None:
        keyed = docs.withColumn("key", F.sha2(F.coalesce("text", F.lit("")), 256))
        return keyed.join(_joined(docs, table, size), "key", "left").drop("key", "text").select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans")

    def row(doc_id, text: str | None) -> tuple:
        words = item_words(text)
        return doc_id, *result(len(words), finder().occurrences(words))

    return map_texts(docs, row, f"doc_id {kind}, {_RESULT}", "doc_id", "text")


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", size: int = SIZE, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """``docs`` without contaminated documents, or (``remove="spans"``) with their runs of hit words cut out.

    All other rows and all columns stay as they were, n_chars too. Nulls, repeats and empty tables as in ``contamination``.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    own = "contamination" + "_" * (1 + max(map(len, docs.columns)))
    table, finder = _table(docs, benchmark, size, broadcast_bytes)
    if finder is None:
        found = _joined(docs.select("doc_id", F.col("text").cast("string").alias("text")), table, size).select(F.col("key").alias(own + "key"), F.struct("contaminated", "spans").alias(own))
        marked = docs.join(found, F.sha2(F.coalesce(docs["text"], F.lit("")), 256) == F.col(own + "key"), "left").drop(own + "key")
    else:

        def change(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = []
            for text in batch.column("text").to_pylist():
                words = item_words(text)
                found.append(result(len(words), finder().occurrences(words))[-2:])
            if remove == "documents":
                return batch.filter(pa.array([not hit for hit, _ in found]))
            at = batch.schema.names.index("text")
            texts = [without_spans(t, s) if hit else t for t, (hit, s) in zip(batch.column(at).to_pylist(), found, strict=True)]
            return batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

        return map_rows(docs, change)
    if remove == "documents":
        return marked.where(~F.col(own)["contaminated"]).drop(own)
    cut = F.udf(lambda t, s: without_spans(t, list(s)) if t and s else t, "string", useArrow=True)
    return marked.withColumn("text", F.when(F.col(own)["contaminated"], cut("text", F.col(own)["spans"])).otherwise(F.col("text"))).drop(own)


#: Bits of the filter that drops windows before the shuffle.
JOIN_FILTER_BITS = 1 << 24


def _joined(docs: DataFrame, table: DataFrame, size: int) -> DataFrame:
    """Results by text (key: its sha2) through a shuffle join on window hashes, for a benchmark that is too large to broadcast."""

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [int(windows(word_hashes(w.split()), n).view(np.int64)[0]) for n, w in zip(batch.column("n").to_pylist(), batch.column("words").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=["n", "words", "items", "h"])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(JOIN_FILTER_BITS // 64, np.uint64)
        at, word = np.array(rows.value, np.int64).reshape(-1, 2).T
        bits[at] = word.view(np.uint64)
        for batch in steps(batches):
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                hashes = word_hashes(item_words(text))
                for n in lengths:
                    w = windows(hashes, n)
                    place = w % np.uint64(JOIN_FILTER_BITS)
                    hit = np.flatnonzero(bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1))
                    yield pa.RecordBatch.from_arrays([pa.array([key] * len(hit), pa.string()), pa.array([n] * len(hit), pa.int32()), pa.array(hit, pa.int64()), pa.array(w[hit].view(np.int64))], names=["key", "n", "at", "h"])

    def check(key: str, hits: list | None, text: str | None) -> tuple:
        words = item_words(text)
        return key, *result(len(words), ((x["at"], x["n"], x["items"]) for x in hits or () if b" ".join(words[x["at"] : x["at"] + x["n"]]) == x["words"]))

    keyed = docs.withColumn("key", F.sha2(F.coalesce("text", F.lit("")), 256))
    items = keep(map_in_arrow(table, hashed, "n int, words binary, items array<string>, h long"), "hashed")
    lengths = sorted(r["n"] for r in items.select("n").distinct().collect())  # at most ``size``
    place = F.pmod("h", F.lit(JOIN_FILTER_BITS))  # 2 ** 64 is a multiple: signed and unsigned hashes have one place
    bits = items.groupBy(F.shiftright(place, 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(pmod(h, 64) as int)))").alias("word"))
    rows = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in bits.collect()])  # at most JOIN_FILTER_BITS / 64 rows
    texts = keyed.select("key", F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["key"])
    hits = map_in_arrow(texts, scan, "key string, n int, at long, h long").join(items, ["n", "h"]).groupBy("key").agg(F.collect_list(F.struct("at", "n", "words", "items")).alias("hits"))
    return map_texts(texts.join(hits, "key", "left"), check, f"key string, {_RESULT}", "key", "hits", "text")


def without_spans(text: str, spans: list[int]) -> str:
    """``text`` without the runs of words in ``spans`` (starts and ends in turn)."""
    data = text.encode("utf-8", "surrogatepass")
    at = [m.span() for m in re.finditer(rb"[0-9a-z\x80-\xff]+", data.translate(_WORD))]
    out, last = [], 0
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        out.append(data[last : at[a][0]])
        last = at[b - 1][1]
    return b"".join([*out, data[last:]]).decode("utf-8", "surrogatepass")
