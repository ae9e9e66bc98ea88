"""Replays: laps on a clock grid, gaps to the leader, recorded orders, passes and battles; all as windows and equi-joins.

Laps carry ``lap_number``, ``lap_ms``, ``start_ms``, ``end_ms``; ``race`` are the columns of one race, ``entity`` is the car.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from chronolith.operators import joins as J, windows as W


def grid(laps: DataFrame, race: list[str], entity: str, step: int, state: list[str]) -> DataFrame:
    """race, entity, t, lap, progress (completed laps, linear inside a lap) and ``state`` for each multiple of ``step`` from a car's start to its end.

    Each lap yields its own ticks, so no series is held and nothing is joined.
    """
    first, last = F.ceil(F.col("start_ms") / step), F.ceil(F.col("end_ms") / step) - 1
    ticks = laps.where(last >= first).withColumn("_k", F.explode(F.sequence(first, last))).withColumn("t", F.col("_k") * step)
    progress = F.col("lap_number") - 1 + (F.col("t") - F.col("start_ms")) / F.col("lap_ms")
    return ticks.select(*race, entity, "t", F.col("lap_number").alias("lap"), progress.alias("progress"), *state)


def frozen(laps: DataFrame, ticks: DataFrame, race: list[str], entity: str, step: int) -> DataFrame:
    """race, entity, t, progress: the ticks, and after a car's end its completed laps until the race's last end."""
    ends = laps.groupBy(*race, entity).agg(F.max("lap_number").cast("double").alias("progress"), F.max("end_ms").alias("_e"))
    over = laps.groupBy(*race).agg(F.max("end_ms").alias("_z"))
    rest = ends.join(F.broadcast(over), race)  # a row for each race
    first, last = F.ceil(F.col("_e") / step), F.floor(F.col("_z") / step)
    rest = rest.where(last >= first).withColumn("_k", F.explode(F.sequence(first, last))).withColumn("t", F.col("_k") * step)
    return ticks.select(*race, entity, "t", "progress").unionByName(rest.select(*race, entity, "t", "progress"))


def activity(laps: DataFrame, race: list[str], entity: str, buffer: int, linger: int) -> DataFrame:
    """until (last movement and ``buffer``, at most ``linger`` after the winner's end) and retired (fewer laps than the winner and ended before it)."""
    ends = laps.groupBy(*race, entity).agg(F.max("end_ms").alias("_e"), F.max("lap_number").alias("_l"))
    best = ends.groupBy(*race).agg(F.max(F.struct("_l", (-F.col("_e")).alias("m"))).alias("_w"))
    both = ends.join(F.broadcast(best), race)  # a row for each race
    finish = -F.col("_w.m")
    return both.select(*race, entity, F.least(F.col("_e") + buffer, finish + linger).alias("until"), ((F.col("_l") < F.col("_w._l")) & (F.col("_e") < finish)).alias("retired"))


def leader_gap(ticks: DataFrame, race: list[str], t: str = "t", progress: str = "progress") -> DataFrame:
    """Adds gap: time since the leading edge of the field first reached the row's progress, linear between the edge's ticks.

    The edge has at most a row a tick of a race, whatever the field: it is broadcast, as its stretches between levels, to
    the laps that a stretch meets. So no race is sorted, and rows stay where they are.
    """
    edge = ticks.groupBy(*race, t).agg(F.max(progress).cast("double").alias("_p"))
    clock = Window.partitionBy(*race).orderBy(t).rowsBetween(Window.unboundedPreceding, 0)
    levels = edge.withColumn("_a", F.max("_p").over(clock)).where("_a is not null").groupBy(*race, "_a").agg(F.min(t).cast("double").alias("_first"))
    by_level = Window.partitionBy(*race).orderBy("_a")
    spans = levels.withColumns({"_b": F.lead("_a").over(by_level), "_next": F.lead("_first").over(by_level)})
    spans = spans.withColumn("_bucket", F.explode(F.sequence(F.floor("_a"), F.floor(F.coalesce("_b", "_a")))))
    x = F.col(f"l.{progress}").cast("double")
    on = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in race] + [F.floor(x) == F.col("r._bucket"), (x == F.col("r._a")) | ((x > F.col("r._a")) & (x < F.col("r._b")))]
    met = ticks.alias("l").join(F.broadcast(spans).alias("r"), on, "left")
    reached = F.when(x == F.col("r._a"), F.col("r._first")).otherwise(F.col("r._first") + F.try_divide(x - F.col("r._a"), F.col("r._b") - F.col("r._a")) * (F.col("r._next") - F.col("r._first")))
    return met.select("l.*", (F.col(f"l.{t}") - reached).alias("gap"))


def overlaid(ticks: DataFrame, recorded: DataFrame, race: list[str], entity: str, t: str, estimate: str, position: str, age: float) -> DataFrame:
    """Adds place and source: the recorded positions where every car of a tick has one that is fresh and they are 1..N, else the estimate."""
    held = J.asof(ticks, recorded.select(*race, entity, t, position), [*race, entity], t, [position], max_age=age)
    # positions are counted by tick and position first, so a tick's set is never held, in its rows or anywhere
    counts = held.groupBy(*race, t, position).agg(F.count("*").alias("_n")).groupBy(*race, t).agg(F.sum("_n").alias("_n"), F.count(position).alias("_kinds"), F.max(position).alias("_most"))
    wholes = counts.where((F.col("_kinds") == F.col("_n")) & (F.col("_most") == F.col("_n"))).select(*race, t, F.lit(True).alias("_whole"))  # at most a row a tick
    out = held.join(F.broadcast(wholes), [*race, t], "left")
    whole = F.col("_whole").isNotNull()
    return out.withColumns({"place": F.when(whole, F.col(position)).otherwise(F.col(estimate)), "source": F.when(whole, "recorded").otherwise("estimate")}).select(*held.columns, "place", "source")


def passes(ticks: DataFrame, race: list[str], entity: str, place: str, step: int, near: float, boundary: str, deal: Callable[..., DataFrame] = lambda rows, *_: rows) -> DataFrame:
    """race, t, attacker, defender: the car right behind another at t and nearer than ``near`` laps is ahead of it at the next tick and at the one after.

    Neither may change its ``boundary`` (stint) meanwhile. A car's ticks lie ``step`` apart, or farther where some are lost. Its
    next two are read in a window of the car, and the car ahead in one of the tick, so nothing is joined. ``deal`` may deal rows
    by the keys of a window before it.
    """
    mine, field = Window.partitionBy(*race, entity).orderBy("t"), Window.partitionBy(*race, "t").orderBy(place)
    after = lambda k, c: F.when(F.lead("t", k).over(mine) == F.col("t") + k * step, F.lead(c, k).over(mine))
    rows = deal(ticks, *race, entity).select(*race, entity, "t", place, "progress", after(1, place).alias("_p1"), after(2, place).alias("_p2"), ((F.col(boundary) == after(1, boundary)) & (after(1, boundary) == after(2, boundary))).alias("_steady"))
    pairs = deal(rows, *race, "t").withColumn("_d", F.lag(F.struct(F.col(entity).alias("who"), "progress", "_p1", "_p2", "_steady")).over(field)).where(F.col("_d._steady") & F.col("_steady"))
    found = pairs.where((F.col("_d.progress") - F.col("progress") < near) & (F.col("_p1") < F.col("_d._p1")) & (F.col("_p2") < F.col("_d._p2")))
    return found.select(*race, "t", F.col(entity).alias("attacker"), F.col("_d.who").alias("defender"))


def battles(rows: DataFrame, race: list[str], entity: str, rival: str, t: str, gap: str, tick: int, contact: float, release: float, patience: int) -> DataFrame:
    """Episodes of a car behind a rival: race, entity, rival, start, end, samples, contacts, closest, pressure, closed.

    An island breaks where a tick is missing or the rival changes; leave out rows that must break it (not green, boundary).
    Inside it a gap above ``release`` for ``patience`` closes the episode; one starts at the first gap of at most
    ``contact``. pressure is the longest unbroken stretch of contact.
    """
    by = [*race, entity]
    w = Window.partitionBy(*by).orderBy(t)
    broken = (F.col(t) - F.lag(t).over(w) > tick) | (F.col(rival) != F.lag(rival).over(w))
    x = W.islands(rows, by, [t], broken, "_island")
    inner = Window.partitionBy(*by, "_island").orderBy(t)
    x = x.withColumns({"_far": F.col(gap) > release, "_near": F.col(gap) <= contact})
    turned = F.coalesce(F.col("_far") != F.lag("_far").over(inner), F.lit(False))
    x = W.islands(x, [*by, "_island"], [t], turned, "_run")
    x = x.withColumn("_since", F.col(t) - F.min(t).over(Window.partitionBy(*by, "_island", "_run")))
    x = x.withColumn("_closes", F.col("_far") & (F.col("_since") >= patience) & (F.coalesce(F.lag("_since").over(Window.partitionBy(*by, "_island", "_run").orderBy(t)), F.lit(-1)) < patience))
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("_sub", F.coalesce(F.sum(F.col("_closes").cast("int")).over(before), F.lit(0)))
    part = Window.partitionBy(*by, "_island", "_sub").orderBy(t)
    x = x.withColumn("_open", F.sum(F.col("_near").cast("int")).over(part.rowsBetween(Window.unboundedPreceding, 0))).where("_open > 0")
    x = W.islands(x, [*by, "_island", "_sub"], [t], F.col("_near") != F.lag("_near").over(part), "_press")
    runs = x.groupBy(*by, "_island", "_sub", "_press").agg(
        F.first(rival).alias(rival), F.min(t).alias("_a"), F.max(t).alias("_z"), F.count("*").alias("_n"), F.count_if("_near").alias("_c"), F.min(F.when(F.col("_near"), F.col(gap))).alias("_g"), F.max(F.when(F.col("_near"), 1).otherwise(0)).alias("_hot"), F.bool_or("_closes").alias("_closed")
    )
    return runs.groupBy(*by, "_island", "_sub").agg(
        F.first(rival).alias(rival), F.min("_a").alias("start"), F.max("_z").alias("end"), F.sum("_n").alias("samples"), F.sum("_c").alias("contacts"), F.min("_g").alias("closest"), F.max(F.when(F.col("_hot") == 1, F.col("_z") - F.col("_a"))).alias("pressure"), F.bool_or("_closed").alias("closed")
    ).drop("_island", "_sub")


def timing_state(laps: DataFrame, by: list[str], at: Column, values: list[str]) -> DataFrame:
    """Each car's lap at a time."""
    return laps.where((F.col("start_ms") <= at) & (F.col("end_ms") > at)).select(*by, *values)
