"""Removal of byte strings that an earlier document holds too, by refined q-gram buckets.

A position's bucket is first its 8-gram. Buckets are refined by identifiers of later offsets: the 20-gram at i is
(8-gram at i, at i + 8, at i + 12), the 50-byte string at i is (20-gram at i, at i + 20, at i + 30); each depth reuses the
identifiers of the one before. Positions whose buckets hold one document need no more refinement, so they are not sent
anywhere: each 50-byte string lies in the bucket of the least 20-gram inside it, and neighbouring strings of one bucket are
one run, whose identifier is refined by the strings at its first and last offset.

Round 1 settles runs: one with the same bucket and identifier in a smaller document is removed whole; a bucket with one
identifier needs no more. Only runs of buckets that hold several identifiers go to round 2, which settles single strings by
their own identifiers. Both rounds send what a step has found once for each bucket, not once for each document, to the
bucket's task as packed arrays; what a step can settle alone goes past it. So a passage that a third of all documents share
is a few entries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from chronolith.llm.text import keep, map_in_arrow, mixed, steps, with_text

SIZE, GRAM = 50, 20
WIDTH = SIZE - GRAM + 1
#: Offsets of the identifiers that refine 8-grams to GRAM bytes, and those to SIZE bytes.
SHORT, LONG = (0, 8, 12), (0, 20, 30)
#: A run holds at most so many strings, so that its first and last one cover it.
RUN = 48
#: Bytes of text that are looked at at once, that a step gathers before it sends its buckets, and for each bucket task.
BLOCK, STEP, TASK = 256 << 10, 24 << 20, 16 << 20
#: Bytes of text that an entry counts for, as strings are more than runs.
ENTRY = 8

_ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))
#: Identifier of a bucket that a step has found with several: it refines whatever else is there.
_SEVERAL = np.uint64(0)


def _grams(data: np.ndarray) -> np.ndarray:
    """Identifiers of all GRAM-byte strings of ``data``."""
    word = data.astype(np.uint64)
    for k in (1, 2, 4):
        word = word[:-k] | word[k:] << np.uint64(8 * k)
    word = mixed(word)  # of 8 bytes
    n = len(data) - GRAM + 1
    return mixed(sum(word[o : o + n] * c for o, c in zip(SHORT, _ODD, strict=False)))


def _strings(grams: np.ndarray, at: np.ndarray, other: bool = False) -> np.ndarray:
    """Identifiers of the SIZE-byte strings at offsets; ``other`` gives a second, independent one."""
    return mixed(sum(grams[at + o] * c for o, c in zip(LONG, _ODD[3:] if other else _ODD, strict=False)))


def _least(a: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    k = 1
    while 2 * k <= width:
        a, k = np.minimum(a[:-k], a[k:]), 2 * k
    return np.minimum(a[: len(a) - width + k], a[width - k :])


class Runs:
    """The runs of some documents: doc (index), start (offset in the document), many (strings), bucket, own (identifier)."""

    def __init__(self, data: np.ndarray, cuts: np.ndarray):
        """data: the documents' bytes; cuts: their bounds."""
        parts: list[tuple] = []
        for first, low, high, ends in _blocks(cuts):
            grams = _grams(data[low:high])
            least = _least(grams, WIDTH)
            n = len(least)
            fits = np.zeros(n + 2, bool)
            for a, b in ends:  # strings that lie inside a document
                fits[max(a, 0) + 1 : max(b - SIZE + 1, a, 0) + 1] = True
            new = fits[1:-1] & ~(fits[:-2] & np.concatenate(([False], least[1:] == least[:-1])))
            start = np.flatnonzero(new)
            if not len(start):
                continue
            gone = np.flatnonzero(fits[1:-1] & ~fits[2:])  # the last string of a stretch
            stop = np.minimum(np.concatenate((start[1:] - 1, [n])), gone[np.searchsorted(gone, start)])
            many = stop - start + 1
            pieces = -(-many // RUN)
            start = np.repeat(start, pieces) + RUN * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
            stop = np.minimum(start + RUN - 1, np.repeat(stop, pieces))
            own = mixed(_strings(grams, start) * _ODD[0] + _strings(grams, stop) * _ODD[1] + (stop - start).astype(np.uint64))
            doc = first + np.searchsorted(np.array([a for a, _ in ends]), start, side="right") - 1
            parts.append((doc, low + start - cuts[doc], stop - start + 1, least[start], own, low + start))
        self.data, self.cuts = data, cuts
        kinds = (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.int64)
        self.doc, self.start, self.many, self.bucket, self.own, self.at = (np.concatenate([p[i] for p in parts]) if parts else np.empty(0, k) for i, k in enumerate(kinds))

    def strings(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """doc, start and two identifiers of each string of the chosen runs."""
        which = np.flatnonzero(chosen)
        run = np.repeat(which, self.many[which])
        step = np.arange(len(run)) - np.repeat(np.cumsum(self.many[which]) - self.many[which], self.many[which])
        out = [np.empty(len(run), np.uint64), np.empty(len(run), np.uint64)]
        ends = np.cumsum(self.many[which])
        for a in range(0, len(which), 1 << 12):  # bounded copies of the runs' bytes
            runs = which[a : a + (1 << 12)]
            lens = self.many[runs] + SIZE - 1
            bounds = np.cumsum(lens) - lens
            bytes_ = self.data[np.repeat(self.at[runs] - bounds, lens) + np.arange(lens.sum())]
            grams = _grams(bytes_)
            lo, hi = ends[a - 1] if a else 0, ends[min(a + (1 << 12), len(which)) - 1]
            at = np.repeat(bounds, self.many[runs]) + step[lo:hi]
            out[0][lo:hi], out[1][lo:hi] = _strings(grams, at), _strings(grams, at, other=True)
        return self.doc[run], self.start[run] + step, out[0], out[1]


def _blocks(cuts: np.ndarray) -> Iterator[tuple[int, int, int, list[tuple[int, int]]]]:
    """(first document, low, high, documents' bounds from low) of stretches of about BLOCK bytes; a long document is cut into overlapping ones."""
    doc, many = 0, len(cuts) - 1
    while doc < many:
        low, last = int(cuts[doc]), doc + 1
        while last < many and cuts[last + 1] - low <= BLOCK:
            last += 1
        high = int(cuts[last])
        if last == doc + 1 and high - low > BLOCK:
            for a in range(low, high - SIZE + 1, BLOCK):
                b = min(a + BLOCK + SIZE - 1, high)
                yield doc, a, b, [(0, b - a)]
        elif high - low >= SIZE:
            yield doc, low, high, [(int(cuts[i]) - low, int(cuts[i + 1]) - low) for i in range(doc, last)]
        doc = last


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the batch's texts and their bounds; a null is empty."""
    column = batch.column("text")
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.concatenate(([0], np.cumsum(size)))
    if not cuts[-1]:
        return np.empty(0, np.uint8), cuts
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if pa.types.is_large_string(column.type) else np.int32)[column.offset :]
    if column.null_count:
        whole = b"".join(x.as_buffer().to_pybytes() for x in column if x.is_valid)
        return np.frombuffer(whole, np.uint8), cuts
    return np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[len(column)]], cuts


def _binary(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary values of ``counts`` items each."""
    offsets = np.concatenate(([0], np.cumsum(counts))) * flat.itemsize
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat).view(np.uint8))])


_SENT = "bucket int, doc_id long, docs binary, groups binary, ids binary"
_VERDICT = "doc_id long, gone binary, several binary"


def _low5(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :5]).reshape(-1).view("V5")


class Groups:
    """Entries (group, id, doc), of which each (group, id) keeps its smallest document: ``gone`` have a smaller one, ``several`` are first in a group of several ids."""

    def __init__(self, group: np.ndarray, own: np.ndarray, doc: np.ndarray):
        order = np.lexsort((doc, own, group))
        group, own, doc = group[order], own[order], doc[order]
        new = lambda a: np.concatenate(([True], a[1:] != a[:-1])) if len(a) else np.empty(0, bool)
        each = new(group) | new(own) | new(doc)
        self.group, self.own, self.doc = group[each], own[each], doc[each]
        self.new_group = new(self.group)
        self.new_id = self.new_group | new(self.own)
        first = self.doc[self.new_id][np.cumsum(self.new_id) - 1]
        number = np.cumsum(self.new_group) - 1
        self.many = np.bincount(number, self.new_id)[number] > 1
        self.gone = (self.doc > first) & (self.own != _SEVERAL)
        self.several = self.many & ~self.gone & (self.own != _SEVERAL)


def _verdicts(g: Groups) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """Documents, how many entries each has, and its ids that are gone or in groups of several."""
    said = np.flatnonzero(g.gone | g.several)
    said = said[np.lexsort((g.gone[said], g.doc[said]))]
    doc, gone, own = g.doc[said], g.gone[said], g.own[said]
    docs, index = np.unique(doc, return_inverse=True)
    a, b = np.bincount(index, gone, len(docs)).astype(np.int64), np.bincount(index, ~gone, len(docs)).astype(np.int64)
    return docs, a + b, _binary(own[gone], a), _binary(own[~gone], b)


def _sent(group: np.ndarray, own: np.ndarray, doc: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """What one step sends: an entry for each group, and the verdicts that it can give alone."""
    g = Groups(group, own, doc)
    names = ["bucket", "doc_id", "docs", "groups", "ids"]
    docs, _, gone, several = _verdicts(g)
    if len(docs):
        dealt = (mixed(docs.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(dealt), pa.array(docs), pa.nulls(len(docs), pa.binary()), gone, several], names=names)
    head = np.flatnonzero(g.new_group)
    ids = np.where(g.many[head], _SEVERAL, g.own[head])
    to = mixed(g.group[head]) % np.uint64(buckets)
    order = np.lexsort((g.doc[head], to))
    head, ids, to = head[order], ids[order], to[order].astype(np.int32)
    if len(head):
        each, counts = np.unique(to, return_counts=True)
        gap = np.diff(g.doc[head], prepend=0)  # small numbers inside a bucket
        starts = np.cumsum(counts) - counts
        gap[starts] = g.doc[head][starts]
        yield pa.RecordBatch.from_arrays([pa.array(each), pa.nulls(len(each), pa.int64()), _binary(gap, counts), _binary(_low5(g.group[head]), counts), _binary(ids, counts)], names=names)


def _settled(table: pa.Table) -> pa.Table:
    """One bucket's verdicts, and those that steps have given."""
    own = pc.is_valid(table.column("docs"))
    passed = table.filter(pc.invert(own)).select(["doc_id", "groups", "ids"]).rename_columns(["doc_id", "gone", "several"])
    entries = table.filter(own)
    docs, groups, ids = [], [], []
    for d, g, i in zip(*(entries.column(c) for c in ("docs", "groups", "ids")), strict=True):
        docs.append(np.cumsum(np.frombuffer(d.as_buffer(), np.int64)))
        ids.append(np.frombuffer(i.as_buffer(), np.uint64))
        wide = np.zeros((len(ids[-1]), 8), np.uint8)
        wide[:, :5] = np.frombuffer(g.as_buffer(), np.uint8).reshape(-1, 5)
        groups.append(wide.reshape(-1).view(np.uint64))
    if not docs:
        return passed
    docs, _, gone, several = _verdicts(Groups(np.concatenate(groups), np.concatenate(ids), np.concatenate(docs)))
    return pa.concat_tables([passed.cast(_SCHEMA), pa.table([pa.array(docs), gone, several], schema=_SCHEMA)])


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("gone", pa.binary()), ("several", pa.binary())])


def _round(rows: DataFrame, entries: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray]], buckets: int, tag: str) -> DataFrame:
    """The verdicts (doc_id, gone, several) on the entries (group, id, doc_id) of all rows, as packed ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in steps(batches):
            held.append(entries(batch))
            size += max(pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0, ENTRY * len(held[-1][0]))
            if size >= STEP:
                yield from _sent(*map(np.concatenate, zip(*held, strict=True)), buckets)
                held, size = [], 0
        if held:
            yield from _sent(*map(np.concatenate, zip(*held, strict=True)), buckets)

    return keep(map_in_arrow(rows, run, _SENT).groupBy("bucket").applyInArrow(_settled, _VERDICT), tag)


def _of_document(verdicts: DataFrame, *columns: str) -> DataFrame:
    """doc_id and each column's packed ids, gathered: as many as the document has entries."""
    return verdicts.groupBy("doc_id").agg(*[F.collect_list(c).alias(c) for c in columns])


def _ids(values: list[bytes] | None) -> np.ndarray:
    return np.frombuffer(b"".join(values or ()), np.uint64)


def _marked(keys: np.ndarray, docs: np.ndarray, lists: list) -> np.ndarray:
    """Whether each key is in its document's list. docs ascend."""
    out = np.zeros(len(keys), bool)
    bounds = np.searchsorted(docs, np.arange(len(lists) + 1))
    for i, values in enumerate(lists):
        a, b = bounds[i], bounds[i + 1]
        if values and a < b:
            out[a:b] = np.isin(keys[a:b], _ids(values))
    return out


def _runs_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    runs, ids = Runs(*_texts(batch)), batch.column("doc_id").to_numpy()
    return runs.bucket, np.maximum(runs.own, 1), ids[runs.doc]


def _strings_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    runs, ids = Runs(*_texts(batch)), batch.column("doc_id").to_numpy()
    doc, _, group, own = runs.strings(_marked(np.maximum(runs.own, 1), runs.doc, batch.column("several").to_pylist()))
    return group, np.maximum(own, 1), ids[doc]


def _removed(batch: pa.RecordBatch) -> tuple[list[int], list[int], list[int], list[str]]:
    """n_bytes, n_removed, n_spans, kept_sha256 of each row."""
    data, cuts = _texts(batch)
    gone, several, single = (batch.column(c).to_pylist() for c in ("gone", "several", "single"))
    runs, out = Runs(data, cuts), ([], [], [], [])
    key = np.maximum(runs.own, 1)
    whole = _marked(key, runs.doc, gone)
    doc, start, _, own = runs.strings(_marked(key, runs.doc, several) & ~whole)
    alone = _marked(np.maximum(own, 1), doc, single)
    docs = np.concatenate((runs.doc[whole], doc[alone]))
    low = np.concatenate((runs.start[whole], start[alone]))
    high = np.concatenate((runs.start[whole] + runs.many[whole], start[alone] + 1)) + SIZE - 1
    order = np.lexsort((low, docs))
    docs, low, high = docs[order], low[order], high[order]
    bounds, view = np.searchsorted(docs, np.arange(len(cuts))), memoryview(data)
    for i in range(len(cuts) - 1):
        text, a, b = view[cuts[i] : cuts[i + 1]], bounds[i], bounds[i + 1]
        digest, at, removed, spans = hashlib.sha256(), 0, 0, 0
        if a < b:
            reach = np.maximum.accumulate(high[a:b])
            heads = np.flatnonzero(np.concatenate(([True], low[a + 1 : b] > reach[:-1])))
            tails = np.append(reach[heads[1:] - 1], reach[-1])
            for x, y in zip(low[a:b][heads].tolist(), tails.tolist(), strict=True):
                digest.update(text[at:x])
                at, removed, spans = y, removed + y - x, spans + 1
        digest.update(text[at:])
        for column, value in zip(out, (len(text), removed, spans, digest.hexdigest()), strict=True):
            column.append(value)
    return out


@contextmanager
def _files_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go when it has ended, as each round's result is written; the setting is restored."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row of ``docs`` (doc_id, text).

    Texts are taken as UTF-8 bytes, a null as an empty one. A byte goes if it lies in a string of 50 bytes that also starts in a
    document with a smaller doc_id; strings are judged on the input. Texts of fewer bytes stay. Copies of one text lose all but
    the one with the smallest id; rows that share an id are one document to others and take nothing from each other, so
    repeated rows have equal results. Rows without an id take nothing from others and lose nothing. Long texts are looked at
    whole, in overlapping blocks. Columns besides the two, whatever their names, take no part. An empty table gives no rows.
    Strings are told apart by 104 bits or more of identifiers.
    """
    rows = with_text(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    known = rows.where("doc_id is not null")
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, -(-size // TASK))
    with _files_dropped(docs.sparkSession):
        first = _round(known, _runs_of, buckets, "runs")
        pending = _of_document(first.where("octet_length(several) > 0"), "several")
        second = _round(known.join(pending.hint("shuffle_hash"), "doc_id"), _strings_of, buckets, "strings")
        said = _of_document(first.select("doc_id", "gone", "several", F.lit(None).cast("binary").alias("single")).unionByName(second.select("doc_id", F.lit(None).cast("binary").alias("gone"), F.lit(None).cast("binary").alias("several"), F.col("gone").alias("single"))), "gone", "several", "single")
        lists = [F.lit(None).cast("array<binary>").alias(c) for c in ("gone", "several", "single")]
        whole = known.join(said.hint("shuffle_hash"), "doc_id", "left").unionByName(rows.where("doc_id is null").select("*", *lists))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    found = [pa.array(x, t) for x, t in zip(_removed(batch), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *found], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

        return keep(map_in_arrow(whole, run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"), "removed")
