"""Window operators: leave-one-out, islands, runs, transitions, onsets and persistence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window


def loo_mean(df: DataFrame, group: list[str], value: str, out: str, least: int = 3) -> DataFrame:
    """Mean of the group's other values, from its total; null in groups of fewer than ``least``."""
    w = Window.partitionBy(*group)
    n, total = F.count(value).over(w), F.sum(value).over(w)
    return df.withColumn(out, F.when(n >= least, F.try_divide(total - F.col(value), n - 1)))


def loo_median(df: DataFrame, group: list[str], value: str, out: str, peers: int = 3, few: bool = False) -> DataFrame:
    """Median of the group's other values; null with fewer than ``peers`` of them.

    ``few`` groups are broadcast, a row each, so that the rows stay where they are.

    The k-th of the others is the k-th of all, or the next one for a value not above it. So a group gives its three
    middle values, which are joined back to its rows. For a row without a value the others are the whole group.
    """
    if peers < 2:
        raise ValueError("peers must be at least 2")
    w = Window.partitionBy(*group)
    sorted_ = df.where(F.col(value).isNotNull()).select(*group, F.col(value).alias("_v"), F.row_number().over(w.orderBy(value)).alias("_r"), F.count("*").over(w).alias("_n"))
    k = F.floor(F.col("_n") / 2)
    at = lambda d: F.max(F.when(F.col("_r") == k + d, F.col("_v")))
    middle = sorted_.where(F.col("_r").between(k, k + 2)).groupBy(*group).agg(F.max("_n").alias("_n"), at(0).alias("_a"), at(1).alias("_b"), at(2).alias("_c"))
    both = df.alias("l").join((F.broadcast(middle) if few else middle).alias("r"), [F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in group], "left").select("l.*", *[F.col(f"r.{c}") for c in ("_n", "_a", "_b", "_c")])
    v, even = F.col(value), F.col("_n") % 2 == 0
    pick = lambda low, high: F.when(v > F.col(low), F.col(low)).otherwise(F.col(high))
    others = F.when(even, pick("_a", "_b")).otherwise((F.when(F.col("_n") == 1, None).otherwise(pick("_a", "_b")) + pick("_b", "_c")) / 2)
    whole = F.when(even, (F.col("_a") + F.col("_b")) / 2).otherwise(F.col("_b"))
    median = F.when(v.isNull(), F.when(F.col("_n") >= peers, whole)).when(F.col("_n") - 1 >= peers, others)
    return both.withColumn(out, median.cast("double")).drop("_n", "_a", "_b", "_c")


def running_counts(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """group, value, times, before, total, distinct_before: for each distinct value its rows, the group's rows below it and in all.

    Distinct values are parted by range and numbered inside their part; the parts' offsets come from one row for each
    part and group. So neither the whole table nor a hot group is sorted in one task. Nulls are left out.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("times"))
    parts = counts.repartitionByRange(*group, value).withColumn("_p", F.spark_partition_id()).checkpoint()  # parts must not change when they are read again
    inside = Window.partitionBy(*group, "_p").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy(*group, "_p").agg(F.sum("times").alias("_s"), F.count("*").alias("_d"))
    upto = Window.partitionBy(*group).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*group, "_p", F.coalesce(F.sum("_s").over(upto), F.lit(0)).alias("_o"), F.coalesce(F.sum("_d").over(upto), F.lit(0)).alias("_do"), F.sum("_s").over(Window.partitionBy(*group)).alias("total"))
    numbered = parts.withColumns({"_i": F.coalesce(F.sum("times").over(inside), F.lit(0)), "_di": F.count("*").over(inside)})
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*group, "_p")]
    out = numbered.alias("a").join(F.broadcast(offsets).alias("b"), on)
    return out.select(*[F.col(f"a.{c}") for c in (*group, value, "times")], (F.col("_o") + F.col("_i")).alias("before"), "total", (F.col("_do") + F.col("_di")).alias("distinct_before"))


def ranked(df: DataFrame, value: str, descending: bool = False, group: list[str] | None = None) -> DataFrame:
    """Rows with rank, dense_rank and mean_rank (ties share the mean of their places) of ``value``; rows without a value have none."""
    group = group or []
    c = running_counts(df, group, value)
    total = F.col("total")
    if descending:
        kinds = c.groupBy(*group).agg((F.max("distinct_before") + 1).alias("_kinds"))
        c = c.join(F.broadcast(kinds), group) if group else c.crossJoin(F.broadcast(kinds))  # one row a group
        places = {"rank": total - F.col("before") - F.col("times") + 1, "dense_rank": F.col("_kinds") - F.col("distinct_before")}
    else:
        places = {"rank": F.col("before") + 1, "dense_rank": F.col("distinct_before") + 1}
    c = c.select(*group, value, *[x.cast("long").alias(k) for k, x in places.items()], (places["rank"] + (F.col("times") - 1) / 2).alias("mean_rank"))
    on = [F.col(f"l.{g}").eqNullSafe(F.col(f"r.{g}")) for g in group] + [F.col(f"l.{value}") == F.col(f"r.{value}")]
    return df.alias("l").join(c.alias("r"), on, "left").select("l.*", "r.rank", "r.dense_rank", "r.mean_rank")


def islands(df: DataFrame, by: list[str], order: list[str], broken: Column, out: str) -> DataFrame:
    """Numbers runs from 1: a new one starts at each group's first row and where ``broken`` holds."""
    w = Window.partitionBy(*by).orderBy(*order)
    first = F.row_number().over(w) == 1
    flagged = df.withColumn("_f", F.when(first | F.coalesce(broken, F.lit(False)), 1).otherwise(0))
    return flagged.withColumn(out, F.sum("_f").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_f")


def transitions(df: DataFrame, by: list[str], order: str, state: str) -> DataFrame:
    """Rows where the state rises against the row before, if that one is the order's predecessor; ``ordinal`` counts them."""
    w = Window.partitionBy(*by).orderBy(order)
    moved = df.withColumns({"_o": F.lag(order).over(w), "_s": F.lag(state).over(w)}).where((F.col(order) - F.col("_o") == 1) & (F.col(state) > F.col("_s")))
    return moved.withColumn("ordinal", F.row_number().over(w)).drop("_o", "_s")


def collapse_runs(df: DataFrame, by: list[str], t: str, value: str) -> DataFrame:
    """One row for each run of equal values: start, end, n and anchor (the middle; of the last run its start)."""
    w = Window.partitionBy(*by).orderBy(t)
    runs = islands(df, by, [t], ~F.col(value).eqNullSafe(F.lag(value).over(w)), "run").groupBy(*by, "run").agg(F.min(t).alias("start"), F.max(t).alias("end"), F.count("*").alias("n"), F.first(value).alias(value))
    last = F.lead("run").over(Window.partitionBy(*by).orderBy("run")).isNull()
    return runs.withColumn("anchor", F.when(last, F.col("start")).otherwise((F.col("start") + F.col("end")) / 2))


def longest_run(df: DataFrame, by: list[str], t: str, holds: Column, step: float) -> DataFrame:
    """Longest time that a condition holds without a break or a gap of more than ``step``."""
    w = Window.partitionBy(*by).orderBy(t)
    flagged = df.withColumn("_h", F.coalesce(holds, F.lit(False)))
    broken = (F.col("_h") != F.lag("_h").over(w)) | (F.col(t) - F.lag(t).over(w) > step)
    runs = islands(flagged, by, [t], broken, "_i").where("_h").groupBy(*by, "_i").agg((F.max(t) - F.min(t)).alias("_d"))
    return df.select(*by).distinct().join(runs.groupBy(*by).agg(F.max("_d").alias("longest")), by, "left").withColumn("longest", F.coalesce("longest", F.lit(0)))


def onsets(df: DataFrame, by: list[str], x: str, on: str, quiet: int, sustained: int) -> DataFrame:
    """Rows where a 0/1 flag starts after ``quiet`` without it and stays for ``sustained``, both observed in full."""
    w = Window.partitionBy(*by).orderBy(x)
    before, after = w.rangeBetween(-quiet, -1), w.rangeBetween(0, sustained)
    edge = df.withColumns({"_b": F.max(on).over(before), "_a": F.min(on).over(after), "_l": F.min(x).over(Window.partitionBy(*by)), "_h": F.max(x).over(Window.partitionBy(*by))})
    return edge.where((F.col(on) == 1) & (F.col("_b") == 0) & (F.col("_a") == 1) & (F.col("_l") <= F.col(x) - quiet) & (F.col("_h") >= F.col(x) + sustained)).drop("_b", "_a", "_l", "_h")


def persists(df: DataFrame, by: list[str], t: str, holds: Column, span: int, gap: float, out: str) -> DataFrame:
    """Adds True where a condition holds at every sample up to ``span`` later, no gap there exceeds ``gap`` and the end is observed."""
    w = Window.partitionBy(*by).orderBy(t)
    frame = w.rangeBetween(0, span)
    steps = df.withColumns({"_h": holds.cast("int"), "_g": F.col(t) - F.lag(t).over(w)})
    widest = F.max(F.when(F.col("_g") > gap, F.col(t))).over(frame)  # the last sample after a wide gap
    seen = F.max(t).over(Window.partitionBy(*by)) >= F.col(t) + span
    ok = (F.min("_h").over(frame) == 1) & (widest.isNull() | (widest <= F.col(t))) & seen & (F.col(t) + span - F.max(t).over(frame) <= gap)
    return steps.withColumn(out, F.coalesce(ok, F.lit(False))).drop("_h", "_g")


def weighted_share(df: DataFrame, by: list[str], order: list[str], holds: Column) -> DataFrame:
    """share of each group's length (``order[0]``) on which a condition holds; an interval takes the condition at its end."""
    dx = F.col(order[0]) - F.lag(order[0]).over(Window.partitionBy(*by).orderBy(*order))
    steps = df.withColumn("_dx", dx).where(F.col("_dx").isNotNull())
    return steps.groupBy(*by).agg(F.try_divide(F.sum(F.when(holds, F.col("_dx")).otherwise(0)), F.sum("_dx")).alias("share"))


def first_pair(df: DataFrame, by: list[str], order: str, holds: Column, value: str) -> DataFrame:
    """first: the least ``value`` of a group where a condition holds at a row and at the next one, which has to follow without a gap."""
    w = Window.partitionBy(*by).orderBy(order)
    seen = df.withColumn("_h", holds).withColumns({"_h1": F.lead("_h").over(w), "_o1": F.lead(order).over(w)})
    return seen.groupBy(*by).agg(F.min(F.when(F.col("_h") & F.col("_h1") & (F.col("_o1") == F.col(order) + 1), F.col(value))).alias("first"))
