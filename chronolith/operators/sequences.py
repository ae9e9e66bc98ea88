"""Ordered one-to-one matching of two event sequences, in pieces that no candidate pair crosses."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from chronolith.operators import runs


def _numbered(events: DataFrame, group: list[str], label: str, at: str, ties: list[str]) -> DataFrame:
    """group, _l, _at and _k: an event's number among those of its group and place."""
    w = Window.partitionBy(*group, at).orderBy(*ties)
    return events.where(F.col(at).isNotNull()).select(*group, F.col(label).alias("_l"), F.col(at).cast("double").alias("_at"), F.row_number().over(w).alias("_k"))


def candidates(truth: DataFrame, found: DataFrame, group: list[str], label: str, at: str, within: float, ties: list[str] | None = None) -> DataFrame:
    """Pairs of equal labels at most ``within`` apart: group, _l, _at, _k, _found_at, _found_k. They meet by label and bucket of ``at``."""
    width = F.lit(float(within) if within > 0 else 1.0)
    a = _numbered(truth, group, label, at, ties or [label]).withColumn("_b", F.floor(F.col("_at") / width))
    b = _numbered(found, group, label, at, ties or [label]).withColumnsRenamed({"_at": "_found_at", "_k": "_found_k"})
    b = b.withColumn("_b", F.explode(F.array(*[F.floor(F.col("_found_at") / width) + i for i in (-1, 0, 1)])))
    return a.join(b, [*group, "_l", "_b"]).where(F.abs(F.col("_at") - F.col("_found_at")) <= within).drop("_b")


def pieces(pairs: DataFrame, group: list[str]) -> DataFrame:
    """Adds _piece: the stretches that pairs span are merged where they share a place, so every chain of one piece can follow every chain of the one before.

    Only distinct stretches are ordered: a group has at most one a place and reach.
    """
    lo, hi = F.least("_at", "_found_at"), F.greatest("_at", "_found_at")
    spans = pairs.select(*group, lo.alias("_lo"), hi.alias("_hi")).distinct()
    w = Window.partitionBy(*group).orderBy("_lo", "_hi")
    cut = F.coalesce(F.col("_lo") > F.max("_hi").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    spans = spans.withColumn("_cut", cut.cast("int")).withColumn("_piece", F.sum("_cut").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_cut")
    return pairs.withColumns({"_lo": lo, "_hi": hi}).join(spans, [*group, "_lo", "_hi"]).drop("_lo", "_hi")


def _longest(group: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Indices of the pairs of a longest chain of each group that rises in both; the earliest column and then the earliest row at each step."""
    g, r, c = group.tolist(), rows.tolist(), cols.tolist()
    rest = [1] * len(g)  # pairs of the longest chain that starts at a pair
    most: dict[int, int] = {}
    tails: list[int] = []
    last = None
    for i in np.lexsort((cols, -rows, group)).tolist():
        if g[i] != last:
            tails, last = [], g[i]
        at = bisect_left(tails, -c[i])
        tails[at : at + 1] = [-c[i]]
        rest[i] = at + 1
        most[last] = len(tails)
    out: list[int] = []
    left, row, col, last = 0, -1, -1, None
    for i in np.lexsort((rows, cols, group)).tolist():
        if g[i] != last:
            last = g[i]
            left, row, col = most[last], -1, -1
        if rest[i] == left and r[i] > row and c[i] > col:
            out.append(i)
            left, row, col = left - 1, r[i], c[i]
    return np.array(out, np.int64)


def _places(group: np.ndarray, at: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Numbers that rise with group, at and k, and are equal only where all of these are."""
    order = np.lexsort((k, at, group))
    new = np.zeros(len(order), bool)
    for x in (group[order], at[order], k[order]):
        new[1:] |= x[1:] != x[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def matched(truth: DataFrame, found: DataFrame, group: list[str], label: str, at: str, within: float, ties: list[str] | None = None) -> DataFrame:
    """group, ``label``, ``at``, found_at: the most pairs of equal labels, at most ``within`` apart, that keep both orders and use an event once.

    Both sides are ordered by ``at`` and then ``ties`` (the label, unless given). Of several largest sets the one with the
    earliest found event, then the earliest true event, at each pair is taken. Events without a group, label or place match
    nothing. A task holds the pairs of one piece (events between two places that no pair crosses), in time n log n; small
    pieces, most of which are one pair, are settled a batch at a time.
    """
    pairs = pieces(candidates(truth, found, group, label, at, within, ties), group)

    def run(batch: pa.RecordBatch, starts: np.ndarray) -> np.ndarray:
        size = np.diff(np.append(starts, batch.num_rows))
        piece = np.repeat(np.arange(len(starts)), size)
        many = np.flatnonzero(np.repeat(size > 1, size))
        values = lambda name: batch.column(name).to_numpy(zero_copy_only=False)[many]
        picked = _longest(piece[many], _places(piece[many], values("_at"), values("_k")), _places(piece[many], values("_found_at"), values("_found_k")))
        return np.concatenate([starts[size == 1], many[picked]])

    out = runs.applied(pairs, [*group, "_piece"], run)
    return out.select(*group, F.col("_l").alias(label), F.col("_at").cast(truth.schema[at].dataType).alias(at), F.col("_found_at").cast(found.schema[at].dataType).alias("found_at"))


def sequence_matches(truth: DataFrame, found: DataFrame, group: list[str], label: str, at: str, within: float, ties: list[str] | None = None) -> DataFrame:
    """matched, truth and found: the counts of each group that has an event."""
    one = lambda df, name: df.select(*group, *[F.lit(int(n == name)).alias(n) for n in ("matched", "truth", "found")])
    rows = one(truth, "truth").unionByName(one(found, "found")).unionByName(one(matched(truth, found, group, label, at, within, ties), "matched"))
    return rows.groupBy(*group).agg(*[F.sum(n).alias(n) for n in ("matched", "truth", "found")])


def exchanges(rows: DataFrame, by: list[str], t: str, ahead: Column, label: str) -> DataFrame:
    """Rows at which ``ahead`` differs from the row before in ``t``, with ``label``: True where it turned true."""
    w = Window.partitionBy(*by).orderBy(t)
    return rows.withColumn(label, ahead).withColumn("_was", F.lag(label).over(w)).where(F.col(label) != F.col("_was")).drop("_was")


def covered(ticks: DataFrame, by: list[str], t: str, start: str, end: str, edge: float, gap: float) -> DataFrame:
    """``by`` and covered: at least two ticks between ``start`` and ``end``, none twice, within ``edge`` of both and never more than ``gap`` apart."""
    w = Window.partitionBy(*by).orderBy(t)
    inside = ticks.where((F.col(t) >= F.col(start)) & (F.col(t) <= F.col(end))).withColumn("_g", F.col(t) - F.lag(t).over(w))
    ok = (F.count("*") >= 2) & (F.min("_g") > 0) & (F.max("_g") <= gap) & (F.min(t) <= F.first(start) + edge) & (F.max(t) >= F.first(end) - edge)
    return inside.groupBy(*by).agg(F.coalesce(ok, F.lit(False)).alias("covered"))
