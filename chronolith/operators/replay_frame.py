"""A whole replay as one frame of ticks: source gate, positions where samples support them, running order, gaps, and recorded order and gaps over the estimate.

``race`` are the columns of one race, ``entity`` is the car. Times are milliseconds on the race's clock. Everything is a
window over a car, a rank, a tick or a race's events, or an equi-join; nothing pairs cars with all events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from chronolith.operators import joins as J, replay as R, windows as W


def gate(samples: DataFrame, laps: DataFrame, race: list[str], entity: str, least: float) -> DataFrame:
    """race and coverage of the races of which samples cover ``least`` of the time between the first start and the last end; the median first and last sample of the cars count."""
    cars = samples.groupBy(*race, entity).agg(F.min("t").alias("_a"), F.max("t").alias("_z")).groupBy(*race).agg(F.percentile("_a", 0.5).alias("_a"), F.percentile("_z", 0.5).alias("_z"))
    window = laps.groupBy(*race).agg(F.min("start_ms").alias("_s"), F.max("end_ms").alias("_e")).where("_e > _s")
    share = (F.least("_z", "_e") - F.greatest("_a", "_s")) / (F.col("_e") - F.col("_s"))
    return cars.join(window, race).select(*race, F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)).alias("coverage")).where(F.col("coverage") >= least)


def anchored(samples: DataFrame, by: list[str], eps: float) -> DataFrame:
    """Runs of samples that do not move by more than ``eps`` as one point at the middle of their time, the last one at its start.

    Adds to each point the car's first and last sample (raw_a, raw_z) and its last movement (moved). Sentinels (0, 0) and
    samples without a time or place are left out; of several samples at a time the largest (x, y) stays.
    """
    ok = samples.where(F.col("t").isNotNull() & F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan(F.col("x").cast("double")) & ~F.isnan(F.col("y").cast("double")) & ~((F.col("x") == 0) & (F.col("y") == 0)))
    one = ok.groupBy(*by, "t").agg(F.max(F.struct("x", "y")).alias("_p")).select(*by, "t", F.col("_p.x").cast("double").alias("x"), F.col("_p.y").cast("double").alias("y"))
    w = Window.partitionBy(*by).orderBy("t")
    runs = W.islands(one, by, ["t"], F.hypot(F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w)) > eps, "_run")
    runs = runs.groupBy(*by, "_run").agg(F.min("t").alias("_a"), F.max("t").alias("_z"), F.min_by("x", "t").alias("x"), F.min_by("y", "t").alias("y"))
    car = Window.partitionBy(*by)
    last = F.col("_run") == F.max("_run").over(car)
    runs = runs.withColumns({"last": last, "raw_a": F.min("_a").over(car), "raw_z": F.max("_z").over(car), "moved": F.max("_a").over(car)})
    return runs.select(*by, F.when(F.col("last"), F.col("_a")).otherwise((F.col("_a") + F.col("_z")) / 2).cast("double").alias("t"), "x", "y", "last", "raw_a", "raw_z", "moved")


def on_ticks(points: DataFrame, ends: DataFrame, by: list[str], step: int, buffer: int, linger: int, max_gap: float) -> DataFrame:
    """by, t, x, y at multiples of ``step`` between a car's first and last sample, linear between points; ticks inside a longer gap than ``max_gap`` are left out.

    A car ends ``buffer`` after its last movement and ``linger`` after its last lap (``ends``: by, finish), whichever is first.
    """
    w = Window.partitionBy(*by).orderBy("t")
    p = points.join(ends, by, "left").withColumns({"_n": F.lead("t").over(w), "_nx": F.lead("x").over(w), "_ny": F.lead("y").over(w), "_first": F.row_number().over(w) == 1})
    until = F.least("raw_z", F.col("moved") + buffer, F.col("finish") + linger)
    first = F.ceil(F.when(F.col("_first"), F.col("raw_a")).otherwise(F.col("t")) / step)
    last = F.least(F.when(F.col("last"), F.floor(F.col("raw_z") / step)).otherwise(F.ceil(F.col("_n") / step) - 1), F.floor(until / step))
    at = F.col("_k") * step
    share = F.when(F.col("last") | (at <= F.col("t")), F.lit(0.0)).otherwise((at - F.col("t")) / (F.col("_n") - F.col("t")))
    ticks = p.where(last >= first).withColumn("_k", F.explode(F.sequence(first, last))).withColumn("_s", share).where(F.col("last") | (at <= F.col("t")) | (F.col("_n") - F.col("t") <= max_gap))
    move = lambda c: F.when(F.col("_s") == 0, F.col(c)).otherwise(F.col(c) + F.col("_s") * (F.col(f"_n{c}") - F.col(c)))
    return ticks.select(*by, at.cast("long").alias("t"), move("x").alias("x"), move("y").alias("y"))


def lap_state(laps: DataFrame, race: list[str], entity: str, step: int, state: list[str]) -> DataFrame:
    """race, entity, t, lap, inside (share of the lap), progress, finish and ``state``; a car's last lap is held, complete, until the race's last end."""
    car, all_cars = Window.partitionBy(*race, entity), Window.partitionBy(*race)
    ends = laps.groupBy(*race, entity).agg(F.max("end_ms").alias("finish"), F.max("lap_number").alias("_l"))
    ends = ends.withColumn("_z", F.max("finish").over(all_cars))
    rows = laps.join(ends, [*race, entity])
    held = F.col("lap_number") == F.col("_l")
    first, last = F.ceil(F.col("start_ms") / step), F.when(held, F.floor(F.col("_z") / step)).otherwise(F.ceil(F.col("end_ms") / step) - 1)
    ticks = rows.where(last >= first).withColumn("_k", F.explode(F.sequence(first, last))).withColumn("t", F.col("_k") * step)
    inside = F.least(F.lit(1.0), (F.col("t") - F.col("start_ms")) / F.col("lap_ms"))
    return ticks.select(*race, entity, "t", F.col("lap_number").alias("lap"), inside.alias("inside"), (F.col("lap_number") - 1 + inside).alias("progress"), "finish", *state)


def coherence(recorded: DataFrame, roster: DataFrame, race: list[str], entity: str) -> DataFrame:
    """race, t, coherent, epoch after each batch of recorded positions: every car of the roster has one and they are 1..N; epoch is the last batch that changed one.

    A change takes a car from one rank to another. Each rank's number of cars is a running sum over its own changes, and
    the number of ranks that hold exactly one car is a running sum over those; it is N only for a whole, coherent order.
    """
    car = Window.partitionBy(*race, entity).orderBy("t")
    rows = recorded.join(roster.select(*race, entity).distinct(), [*race, entity], "left_semi").where("position > 0 and t is not null").groupBy(*race, entity, "t").agg(F.max("position").alias("position"))
    rows = rows.withColumn("_old", F.lag("position").over(car)).withColumn("_moved", ~F.col("position").eqNullSafe(F.col("_old")))
    steps = F.array(F.struct(F.col("position").alias("_r"), F.lit(1).alias("_d")), F.struct(F.col("_old").alias("_r"), F.lit(-1).alias("_d")))
    held = rows.where("_moved").select(*race, "t", F.inline(steps)).where("_r is not null").groupBy(*race, "_r", "t").agg(F.sum("_d").alias("_d"))
    rank = Window.partitionBy(*race, "_r").orderBy("t")
    held = held.withColumn("_c", F.sum("_d").over(rank.rowsBetween(Window.unboundedPreceding, 0)))
    one = (F.col("_c") == 1).cast("int")
    held = held.withColumn("_one", one).withColumn("_u", F.col("_one") - F.coalesce(F.lag("_one").over(rank), F.lit(0)))
    n = roster.groupBy(*race).agg(F.count_distinct(entity).alias("_n"))
    held = held.join(n, race).groupBy(*race, "t").agg(F.sum(F.when(F.col("_r") <= F.col("_n"), F.col("_u")).otherwise(0)).alias("_u"))
    batches = rows.groupBy(*race, "t").agg(F.max(F.when(F.col("_moved"), F.col("t"))).alias("_e")).join(held, [*race, "t"], "left").join(n, race)
    run = Window.partitionBy(*race).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    return batches.select(*race, "t", (F.coalesce(F.sum("_u").over(run), F.lit(0)) == F.col("_n")).alias("coherent"), F.max("_e").over(run).alias("epoch"))


def estimated(ticks: DataFrame, race: list[str], entity: str) -> DataFrame:
    """Adds place, gap and ahead of the estimate: by progress, then by finish; a gap is held from a car's finish on.

    A tick where a car has no progress has no order and no gaps.
    """
    gaps = R.leader_gap(ticks.where(F.col("progress").isNotNull()), race).select(*race, entity, "t", F.greatest("gap", F.lit(0.0)).alias("gap"))
    # below the leading edge's first level the edge's first tick counts
    start = ticks.where(F.col("progress").isNotNull()).groupBy(*race).agg(F.min("t").alias("_t0"))
    out = ticks.join(gaps, [*race, entity, "t"], "left").join(start, race, "left")
    out = out.withColumn("gap", F.when(F.col("progress").isNotNull(), F.coalesce("gap", F.col("t") - F.col("_t0")))).drop("_t0")
    done = F.min_by("gap", F.when(F.col("t") >= F.col("finish"), F.col("t"))).over(Window.partitionBy(*race, entity))
    out = out.withColumn("gap", F.when(F.col("t") >= F.col("finish"), done).otherwise(F.col("gap")))
    tick = Window.partitionBy(*race, "t")
    order = tick.orderBy(F.round("progress", 9).desc(), "finish", entity)
    out = out.withColumn("_whole", F.count("progress").over(tick) == F.count(F.lit(1)).over(tick)).withColumns({"place": F.row_number().over(order).cast("long"), "_g0": F.lag("gap").over(order)})
    whole = lambda c: F.when(F.col("_whole"), c)
    out = out.withColumns({"place": whole(F.col("place")), "gap": whole(F.col("gap")), "ahead": whole(F.when(F.col("place") == 1, 0.0).otherwise(F.greatest(F.col("gap") - F.col("_g0"), F.lit(0.0))))})
    return out.drop("_whole", "_g0")


def overlaid(ticks: DataFrame, recorded: DataFrame, intervals: DataFrame, roster: DataFrame, race: list[str], entity: str, max_age: int) -> DataFrame:
    """Adds recorded order and gaps (``intervals``: gap_leader, gap_ahead) over the estimate, with source and time of observation of both.

    Order: where the roster's recorded positions are coherent, made dense over the cars of the tick. Gaps: the first car's
    are 0; another car's need its predecessor at the tick and an observation that is at most ``max_age`` old, not older
    than the last change of the order, and not negative.
    """
    batches = coherence(recorded, roster, race, entity)
    when = J.asof(ticks.select(*race, "t").distinct(), batches, race, "t", ["coherent", "epoch"])
    keys = [*race, entity]
    seen = J.asof(ticks, recorded.where("position > 0").groupBy(*keys, "t").agg(F.max("position").alias("position")).withColumn("_seen", F.col("t")), keys, "t", ["position", "_seen"])
    seen = J.asof(seen, intervals.groupBy(*keys, "t").agg(F.max(F.struct("gap_leader", "gap_ahead")).alias("_i")).withColumn("_at", F.col("t")), keys, "t", ["_i", "_at"])
    rows = seen.join(when, [*race, "t"], "left").withColumn("_on", F.coalesce("coherent", F.lit(False)))
    tick = Window.partitionBy(*race, "t").orderBy("position")
    rows = rows.withColumns({"_dense": F.row_number().over(tick).cast("long"), "_before": F.lag("position").over(tick)})
    lead, follows = F.col("position") == 1, F.col("_before") == F.col("position") - 1
    fresh = follows & (F.col("_at") >= F.col("epoch")) & (F.col("t") - F.col("_at") <= max_age) & (F.col("_i.gap_leader") >= 0) & (F.col("_i.gap_ahead") >= 0)
    real = ~F.isnan(F.col("_i.gap_leader").cast("double")) & ~F.isnan(F.col("_i.gap_ahead").cast("double"))
    rows = rows.withColumn("_gap_on", F.col("_on") & (lead | F.coalesce(fresh & real, F.lit(False))))
    zero = lambda c: F.when(lead, F.lit(0.0)).otherwise(F.col(f"_i.{c}").cast("double"))
    over = lambda on, new, old: F.when(F.col(on), new).otherwise(F.col(old))
    source = lambda on, value: F.when(F.col(on), "recorded").when(F.col(value).isNotNull(), "estimate")
    rows = rows.withColumns({
        "place_source": source("_on", "place"), "place_seen": F.when(F.col("_on"), F.col("_seen")), "gap_source": source("_gap_on", "gap"), "gap_seen": F.when(F.col("_gap_on"), F.when(lead, F.col("_seen")).otherwise(F.col("_at"))),
        "place": over("_on", F.col("_dense"), "place"), "gap": over("_gap_on", zero("gap_leader"), "gap"), "ahead": over("_gap_on", zero("gap_ahead"), "ahead"),
    })
    return rows.drop("position", "_seen", "_i", "_at", "coherent", "epoch", "_on", "_dense", "_before", "_gap_on")


def frame(samples: DataFrame, laps: DataFrame, recorded: DataFrame, intervals: DataFrame, race: list[str], entity: str, step: int, state: list[str], *, least: float = 0.9, eps: float = 1.0, max_gap: float = 10_000, buffer: int = 30_000, linger: int = 60_000, max_age: int = 10_000) -> DataFrame:
    """A row a car and tick of the races that pass the gate: x, y, lap, inside, ``state``, place, gap, ahead, and source and time of observation of place and gap.

    Ticks and the estimate are read several times, so they are checkpointed; inputs are read several times too, so what
    is dear to derive should be checkpointed before.
    """
    good = gate(samples, laps, race, entity, least).checkpoint()
    laps, samples = laps.join(good, race, "left_semi"), samples.join(good, race, "left_semi")
    by = [*race, entity]
    ends = laps.groupBy(*by).agg(F.max("end_ms").alias("finish"))
    at = on_ticks(anchored(samples, by, eps), ends, by, step, buffer, linger, max_gap)
    ticks = at.join(lap_state(laps, race, entity, step, state), [*by, "t"], "left").checkpoint()
    out = overlaid(estimated(ticks, race, entity).checkpoint(), recorded, intervals, samples, race, entity, max_age)
    return out.select(*by, "t", "x", "y", "lap", "inside", *state, "place", "gap", "ahead", "place_source", "place_seen", "gap_source", "gap_seen")
