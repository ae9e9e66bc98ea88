"""Traces along a distance: nested series opened to samples, cleaned, paired on common distances, measured and integrated.

A sample row is what Spark partitions; no series is held as a whole. ``lap`` are the columns that name one trace.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window


def opened(traces: DataFrame, lap: list[str], series: str, step: float, x: str, channels: dict[str, Column]) -> DataFrame:
    """A row an element of the array ``series``: ``x`` (its position times ``step``), ``seq`` and ``channels``, which may use ``_v`` and the traces' columns."""
    rows = traces.select("*", F.posexplode(series).alias("seq", "_v0")).withColumn("_v", F.col("_v0").cast("double"))
    return rows.select(*lap, (F.col("seq") * F.lit(float(step))).alias(x), "seq", *[c.alias(n) for n, c in channels.items()])


def cleaned(samples: DataFrame, lap: list[str], x: str, seq: str, channels: list[str], bounds: dict[str, tuple[float, float]], valid: Column) -> DataFrame:
    """A row a trace and distance: ``channels`` of its last valid sample (null where none is), with ``n_rows`` and ``n_clipped`` of the samples there.

    ``bounds`` clips channels before; what is clipped is counted. Samples without a distance count under a null distance.
    """
    outside = [(F.col(c) < lo) | (F.col(c) > hi) for c, (lo, hi) in bounds.items()]
    clipped = sum((F.coalesce(o.cast("int"), F.lit(0)) for o in outside), F.lit(0))
    rows = samples.withColumn("_fix", clipped).withColumns({c: F.when(F.col(c).isNotNull(), F.greatest(F.least(F.col(c), F.lit(hi)), F.lit(lo))) for c, (lo, hi) in bounds.items()})
    ok = F.coalesce(valid & F.col(x).isNotNull(), F.lit(False))
    last = F.max_by(F.struct(*channels), F.when(ok, F.col(seq)))
    at = rows.groupBy(*lap, x).agg(F.count("*").alias("n_rows"), F.sum("_fix").alias("n_clipped"), last.alias("_l"))
    return at.select(*lap, x, "n_rows", "n_clipped", *[F.col(f"_l.{c}").alias(c) for c in channels], F.col("_l").isNotNull().alias("ok"))


def audited(points: DataFrame, lap: list[str]) -> DataFrame:
    """A row a trace: valid points, coverage (percent of all samples) and clipped samples."""
    out = points.groupBy(*lap).agg(F.count_if("ok").alias("valid"), F.sum("n_rows").alias("_n"), F.sum("n_clipped").alias("clipped"))
    return out.select(*lap, "valid", (100.0 * F.col("valid") / F.col("_n")).alias("coverage"), "clipped")


def sides(pairs: DataFrame, key: list[str], entity: str, lap: str) -> DataFrame:
    """Both traces of each pair as rows: ``key``, side (a or b), ``entity``, ``lap``."""
    two = [F.struct(F.lit(s).alias("side"), F.col(e).alias(entity), F.col(n).alias(lap)) for s, e, n in (("a", entity, lap), ("b", f"other_{entity}", f"other_{lap}"))]
    return pairs.select(*key, F.inline(F.array(*two)))


def common(pairs: DataFrame, points: DataFrame, key: list[str], entity: str, lap: str, x: str, channels: list[str]) -> DataFrame:
    """A row a pair and distance that both traces have: a_ and b_ of each channel.

    Samples meet by one exchange on the pair; the windows and aggregates over pairs that follow keep it.
    """
    rows = sides(pairs, key, entity, lap).join(points.where("ok"), [*key, entity, lap]).repartition(*key)
    wide = rows.groupBy(*key, x).agg(F.count("*").alias("_n"), *[F.max(F.when(F.col("side") == s, F.col(c))).alias(f"{s}_{c}") for s in "ab" for c in channels])
    return wide.where("_n = 2").drop("_n")


def interval_time(x: Column, x0: Column, speed: Column, speed0: Column) -> Column:
    """Seconds from ``x0`` to ``x`` (m) at speeds in km/h, by trapezoid; null where either does not advance."""
    return F.when((x > x0) & (speed + speed0 > 0), 7.2 * (x - x0) / (speed + speed0))


def with_onsets(rows: DataFrame, by: list[str], x: str, flag: str, quiet: int, held: int, out: str) -> DataFrame:
    """Adds ``out``: ``flag`` (0 or 1) turns on here, was off at all samples of ``quiet`` before and stays on for ``held``; both stretches are sampled to their ends."""
    w = Window.partitionBy(*by).orderBy(x)
    before, after, at = w.rangeBetween(-quiet, 0), w.rangeBetween(0, held), F.col(x)
    on = (F.col(flag) == 1) & (F.sum(flag).over(before) == 1) & (F.min(flag).over(after) == 1)
    return rows.withColumn(out, on & (F.min(x).over(before) <= at - quiet) & (F.max(x).over(after) >= at + held))


def weighted(value: Column, weight: Column, where: Column | None = None) -> Column:
    """Mean of ``value`` by ``weight``, over rows with both and a weight above 0; null without one."""
    use = (weight > 0) & value.isNotNull()
    use = use if where is None else use & where
    return F.try_divide(F.sum(F.when(use, value * weight)), F.sum(F.when(use, weight)))


def technique(rows: DataFrame, key: list[str], x: str, full: float, coast: float, low: float, quiet: int, held: int) -> DataFrame:
    """A row a pair with points and five measures a side: shares of distance at full throttle, coasting and braking, the median speed at confirmed onsets of braking, and the speed where both together are slow.

    Channels: speed, throttle, brake. An interval takes its end sample.
    """
    w = Window.partitionBy(*key).orderBy(x)
    s = rows.withColumn("_dx", F.col(x) - F.lag(x).over(w))
    for side in "ab":
        s = with_onsets(s, key, x, f"{side}_brake", quiet, held, f"_{side}_on")
    slow, dx = (F.col("a_speed") + F.col("b_speed")) / 2 <= low, F.col("_dx")
    out = [F.count("*").alias("points")]
    for side in "ab":
        speed, throttle, brake = (F.col(f"{side}_{c}") for c in ("speed", "throttle", "brake"))
        share = lambda c: weighted(c.cast("double"), dx)
        out += [share(throttle >= full).alias(f"{side}_flat_out"), share((throttle <= coast) & (brake == 0)).alias(f"{side}_coasting"), share(brake == 1).alias(f"{side}_braking")]
        out += [F.percentile(F.when(F.col(f"_{side}_on"), speed), 0.5).alias(f"{side}_onset_speed"), weighted(speed, dx, slow).alias(f"{side}_low_speed")]
    return s.groupBy(*key).agg(*out)


def both_ways(rows: DataFrame, shared: list[str], named: dict[str, tuple[str, str]]) -> DataFrame:
    """Each row in both directions: ``named`` gives the columns (own, other) of side a; side b swaps them. Columns come out as name and other_name."""
    way = lambda flip: F.struct(*[F.col(c[flip]).alias(n) for n, c in named.items()], *[F.col(c[1 - flip]).alias(f"other_{n}") for n, c in named.items()])
    return rows.select(*shared, F.inline(F.array(way(0), way(1))))


def microsectors(rows: DataFrame, key: list[str], x: str, length: float, channels: list[str]) -> DataFrame:
    """A row a pair and segment of ``length`` (by where an interval starts): start, end, a_time, b_time and the means of the channels by distance."""
    w = Window.partitionBy(*key).orderBy(x)
    s = rows.withColumn("_x0", F.lag(x).over(w)).withColumns({f"_{i}_t": interval_time(F.col(x), F.col("_x0"), F.col(f"{i}_speed"), F.lag(f"{i}_speed").over(w)) for i in "ab"}).where(F.col("_x0").isNotNull())
    s = s.withColumns({"segment": F.floor(F.col("_x0") / length) + 1, "_dx": F.col(x) - F.col("_x0")})
    means = [weighted(F.col(f"{i}_{c}"), F.col("_dx")).alias(f"{i}_{c}") for i in "ab" for c in channels]
    return s.groupBy(*key, "segment").agg(F.min("_x0").alias("start"), F.max(x).alias("end"), F.sum("_a_t").alias("a_time"), F.sum("_b_t").alias("b_time"), *means)


def elapsed(points: DataFrame, lap: list[str], x: str, speed: str, out: str) -> DataFrame:
    """Adds ``out``: seconds since the trace's first sample, speed integrated over distance; an interval without an advance takes none."""
    w = Window.partitionBy(*lap).orderBy(x)
    t = F.coalesce(interval_time(F.col(x), F.lag(x).over(w), F.col(speed), F.lag(speed).over(w)), F.lit(0.0))
    return points.withColumn("_t", t).withColumn(out, F.sum("_t").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_t")


def best_loop(points: DataFrame, race: list[str], lap: list[str], order: str, x: str, y: str, full: int) -> DataFrame:
    """Points of each race's best lap with step and length: the least widest step plus closure (first to last point) plus the share of ``full`` points that is missing.

    ``lap`` are the columns that name a lap inside a race; ties go to the first of them. Laps of one point are none.
    """
    w = Window.partitionBy(*race, *lap).orderBy(order)
    s = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumn("step", F.hypot(F.col(x) - F.lag(x).over(w), F.col(y) - F.lag(y).over(w)))
    first, last = F.min_by(F.struct(x, y), order), F.max_by(F.struct(x, y), order)
    q = s.groupBy(*race, *lap).agg(F.max("step").alias("_w"), first.alias("_f"), last.alias("_l"), F.count("*").alias("_n")).where("_n > 1")
    closure = F.hypot(F.col(f"_l.{x}") - F.col(f"_f.{x}"), F.col(f"_l.{y}") - F.col(f"_f.{y}"))
    score = F.round(F.col("_w") + closure + 1 - F.least(F.lit(1.0), F.col("_n") / full), 9)
    best = q.groupBy(*race).agg(F.min(F.struct(score.alias("s"), *lap)).alias("_b")).select(*race, *[F.col(f"_b.{c}").alias(c) for c in lap])
    out = s.join(best, [*race, *lap]).withColumn("step", F.coalesce("step", F.lit(0.0)))
    return out.withColumn("length", F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, 0)))
