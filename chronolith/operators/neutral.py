"""Neutralisations: marker intervals with supersession, transitions, checkpoints, recovery, pit loss and impact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from chronolith.operators import joins as J


def neutralisations(markers: DataFrame, by: list[str], order: list[str], t: str, kind: str, edge: str, interrupts: dict[str, list[str]]) -> DataFrame:
    """Intervals (kind, start, end, status) of start and end markers.

    A start opens an interval of its kind. It closes at the first of: its kind's next end (complete), its kind's next start
    or the start of a kind that ``interrupts`` it (interrupted); else it is unclosed. An end at the start's own time drops both.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    after, own = Window.partitionBy(*by).orderBy(F.desc("_i")).rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*by, kind).orderBy(*order)
    rows = markers.withColumns({"_i": F.row_number().over(w)})
    here = F.struct("_i", t, edge)
    rows = rows.withColumn("_own", F.lead(here).over(own))
    stops = sorted({k for ks in interrupts.values() for k in ks})
    for k in stops:
        rows = rows.withColumn(f"_by_{k}", F.last(F.when((F.col(kind) == k) & (F.col(edge) == "start"), F.struct("_i", t)), ignorenulls=True).over(after))
    first = reduce(lambda c, x: c.when(F.col(kind) == x[0], F.least(*[F.col(f"_by_{k}") for k in x[1]], F.lit(None)) if len(x[1]) > 1 else F.col(f"_by_{x[1][0]}")), interrupts.items(), F.when(F.lit(False), F.lit(None)))
    starts = rows.where(F.col(edge) == "start").withColumn("_stop", first)
    ended = F.col("_own").isNotNull() & (F.col("_stop").isNull() | (F.col("_own._i") < F.col("_stop._i")))
    status = F.when(ended, F.when(F.col(f"_own.{edge}") == "end", "complete").otherwise("interrupted")).when(F.col("_stop").isNotNull(), "interrupted").otherwise("unclosed")
    end = F.when(ended, F.col(f"_own.{t}")).otherwise(F.col(f"_stop.{t}"))
    out = starts.select(*by, kind, F.col(t).alias("start"), end.alias("end"), status.alias("status"))
    return out.where(~((F.col("status") == "complete") & (F.col("end") == F.col("start"))))


def first_later(left: DataFrame, right: DataFrame, by: list[str], t: str, within: float, out: str) -> DataFrame:
    """Left rows with the time of the first right row after ``t`` and at most ``within`` later; null without one. One shuffle, one sort."""
    names = left.columns
    mine = left.select(*by, F.col(t).alias("_t"), F.struct(*names).alias("_l"), F.lit(None).cast(right.schema[t].dataType).alias("_r"), F.lit(1).alias("_o"))
    theirs = right.select(*by, F.col(t).alias("_t"), F.lit(None).cast(mine.schema["_l"].dataType).alias("_l"), F.col(t).alias("_r"), F.lit(0).alias("_o"))
    w = Window.partitionBy(*by).orderBy(F.desc("_t"), F.desc("_o")).rowsBetween(Window.unboundedPreceding, -1)  # from the last row back; right rows of the same time come after
    near = mine.unionByName(theirs).withColumn("_next", F.last("_r", ignorenulls=True).over(w)).where("_l is not null")
    return near.select("_l.*", F.when(F.col("_next") - F.col("_t") <= within, F.col("_next")).alias(out))


def checkpoints(events: DataFrame, curves: DataFrame, race: list[str], event: str, entity: str, at: dict[str, Column]) -> DataFrame:
    """race, event, kind, entity, t, progress: each entity's interpolated progress at the named times of each event.

    A checkpoint at which any entity of the race has no progress is withheld: all its values are null.
    """
    times = events.select(*race, event, F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.cast("double").alias("t")) for k, c in at.items()])).alias("_x")).select(*race, event, "_x.*")
    cars = curves.select(*race, entity).distinct()
    asked = times.join(cars, race)  # a race's events and cars are few
    seen = J.bracketed(asked, curves, [*race, entity], "t", ["progress"])
    field = Window.partitionBy(*race, event, "kind")
    whole = F.count("progress").over(field) == F.count(F.lit(1)).over(field)
    return seen.withColumn("progress", F.when(whole, F.col("progress")))


def lap_deficit(leader: Column, own: Column, margin: float = 0.02) -> Column:
    """Whole laps behind the leader; null within ``margin`` of a boundary, where the count is not certain."""
    behind = leader - own
    share = behind - F.floor(behind)
    return F.when((share >= margin) & (share <= 1 - margin), F.floor(behind))


def pit_loss(laps: DataFrame, race: list[str], lap: str, entity: str, stopped: Column, peer: Column, duration: Column) -> DataFrame:
    """Each stop's loss against its peers on the same lap: the median change of gap, which is its duration minus the peers' median.

    So no pairs are made: a lap gives one median.
    """
    rows = laps.withColumns({"_d": duration, "_s": F.coalesce(stopped, F.lit(False)), "_p": F.coalesce(peer, F.lit(False))})
    field = rows.where("_p").groupBy(*race, lap).agg(F.percentile("_d", 0.5).alias("_m"), F.count("_d").alias("peers"))
    return rows.where("_s").join(field, [*race, lap]).withColumn("loss", F.col("_d") - F.col("_m")).drop("_d", "_s", "_p", "_m")


def recovered(laps: DataFrame, events: DataFrame, race: list[str], end: str, clean: Column, need: int = 2) -> DataFrame:
    """Events with ``recovery``: the end of the first ``need`` consecutive clean laps of the reference car that start after the event; null without them."""
    w = Window.partitionBy(*race).orderBy("start_ms")
    run = reduce(lambda a, b: a & b, [clean if i == 0 else F.coalesce(F.lead(clean, i).over(w), F.lit(False)) for i in range(need)])
    starts = laps.withColumns({"_ok": run, "_until": F.lead("end_ms", need - 1).over(w)}).where("_ok").select(*race, F.col("start_ms").alias(end), "_until")
    names = events.columns
    mine = events.select(*race, F.col(end), F.struct(*names).alias("_l"), F.lit(None).cast("long").alias("_until"), F.lit(0).alias("_o"))
    theirs = starts.select(*race, end, F.lit(None).cast(mine.schema["_l"].dataType).alias("_l"), "_until", F.lit(1).alias("_o"))
    order = Window.partitionBy(*race).orderBy(F.desc(end), F.desc("_o")).rowsBetween(Window.unboundedPreceding, 0)
    return mine.unionByName(theirs).withColumn("recovery", F.last("_until", ignorenulls=True).over(order)).where("_l is not null").select("_l.*", "recovery")


def effects(rows: DataFrame, ident: list[str], columns: dict[str, float]) -> DataFrame:
    """Long table (ident, effect, value, material): material where the value reaches its column's threshold."""
    long_ = rows.select(*ident, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(ident, list(columns), "effect", "value")
    limit = F.create_map(*[F.lit(x) for c, m in columns.items() for x in (c, float(m))])[F.col("effect")]
    return long_.where("value is not null").withColumn("material", F.abs("value") >= limit)
