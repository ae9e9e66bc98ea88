"""Groups of sorted rows as a stream of batches: small groups share a batch, so that a group costs no call of its own."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def starts(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Where a key differs from the row before; nulls (and NaNs) are equal."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for k in keys:
        column = batch.column(k)
        none = column.is_null(nan_is_null=True).to_numpy(zero_copy_only=False)
        other = pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)), False).to_numpy(zero_copy_only=False)
        new[1:] |= (other & ~(none[1:] & none[:-1])) | (none[1:] != none[:-1])
    return np.flatnonzero(new)


def whole(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows, which are sorted by ``keys``, in batches that end where a key ends."""
    held: list[pa.RecordBatch] = []  # of the last key
    joined = lambda parts: pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
    for batch in batches:
        if not batch.num_rows:
            continue
        if held:
            tail = held[-1].slice(held[-1].num_rows - 1)
            batch = batch.cast(tail.schema)
            at = starts(joined([tail, batch]), keys)[1:] - 1
        else:
            at = starts(batch, keys)
        if held and not len(at):
            held.append(batch)
            continue
        cut = int(at[-1])
        done = [*held, batch.slice(0, cut)] if cut else held
        if done:
            yield joined(done)
        held = [batch.slice(cut)]
    if held:
        yield joined(held)


def applied(df: DataFrame, keys: list[str], run: Callable[[pa.RecordBatch, np.ndarray], np.ndarray]) -> DataFrame:
    """The rows that ``run`` picks of each batch of whole groups, by number; it gets the batch and the rows where groups start."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole(batches, keys):
            rows = run(batch, starts(batch, keys))
            if len(rows):
                yield batch.take(pa.array(rows, pa.int64()))

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(each, df.schema)
