"""Resampling of irregular series: grids, linear and step interpolation, thinning, coverage and jump removal."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from chronolith.operators import runs


def grid(samples: DataFrame, by: list[str], t: str, values: list[str], step: int, max_gap: float | None = None) -> DataFrame:
    """Values on the grid of multiples of ``step`` between each entity's first and last sample, linear between neighbours.

    Each pair of neighbouring samples yields its own grid points, so a series is never held as a whole. With ``max_gap``
    values inside a longer gap are null.
    """
    w = Window.partitionBy(*by).orderBy(t)
    nxt = samples.withColumns({"_t1": F.lead(t).over(w), **{f"_n_{v}": F.lead(v).over(w) for v in values}})
    first, last = F.ceil(F.col(t) / step), F.when(F.col("_t1").isNull(), F.floor(F.col(t) / step)).otherwise(F.ceil(F.col("_t1") / step) - 1)
    points = nxt.where(last >= first).withColumn("_g", F.explode(F.sequence(first, last)))
    share = F.when(F.col("_t1").isNull() | (F.col("_g") * step == F.col(t)), F.lit(0.0)).otherwise((F.col("_g") * step - F.col(t)) / (F.col("_t1") - F.col(t)))
    ok = F.lit(True) if max_gap is None else (share == 0) | (F.col("_t1") - F.col(t) <= max_gap)
    return points.select(*by, (F.col("_g") * step).cast("long").alias(t), *[F.when(ok, F.col(v) + share * (F.coalesce(f"_n_{v}", v) - F.col(v))).alias(v) for v in values])


def thin(samples: DataFrame, by: list[str], t: str, seconds: float, ties: list[str] | None = None) -> DataFrame:
    """The first sample of each bucket of ``seconds``."""
    w = Window.partitionBy(*by, F.floor(F.col(t) / seconds)).orderBy(t, *(ties or []))
    return samples.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def coverage(samples: DataFrame, by: list[str], t: str, window: float, least: float = 0.9) -> DataFrame:
    """Span of each entity's samples over the window, and whether it passes the gate."""
    return samples.groupBy(*by).agg(((F.max(t) - F.min(t)) / F.lit(float(window))).alias("covered")).withColumn("accepted", F.col("covered") >= least)


def drop_jumps(samples: DataFrame, by: list[str], t: str, x: str, y: str, max_speed: float) -> DataFrame:
    """Without (0, 0) sentinels and points that are too fast from the last point kept; a point whose time does not advance stays.

    The comparison with the last *kept* point is sequential, so each group (an entity's session) is in one task: it has to be
    bounded by nature. Small groups share a batch. Points that are near enough to the point before them need no search, so only
    jumps are walked.
    """

    def run(batch: pa.RecordBatch, starts: np.ndarray) -> np.ndarray:
        px, py, at = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in (x, y, t))
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, batch.num_rows)))
        rows = np.flatnonzero(~((px == 0) & (py == 0)))
        rows = rows[np.lexsort((at[rows], group[rows]))]
        px, py, at, group = px[rows], py[rows], at[rows], group[rows]
        stay = np.ones(len(rows), bool)
        fast = lambda i, j: at[j] > at[i] and np.hypot(px[j] - px[i], py[j] - py[i]) > max_speed * (at[j] - at[i])
        with np.errstate(invalid="ignore"):
            jumps = np.flatnonzero((np.diff(group) == 0) & (np.diff(at) > 0) & (np.hypot(np.diff(px), np.diff(py)) > max_speed * np.diff(at))) + 1
        done = 0
        for j in jumps.tolist():
            if j < done:
                continue
            last = j - 1  # kept: the points since the jump before it are near to one another
            while j < len(rows) and group[j] == group[last] and fast(last, j):
                stay[j] = False
                j += 1
            done = j + 1
        return rows[stay]

    return runs.applied(samples, by, run)
