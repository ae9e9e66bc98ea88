"""Pit boundaries and visits, tyre warm-up, undercuts and stop-timing scenarios."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from chronolith.operators import windows as W


def boundaries(marks: DataFrame, by: list[str], order: list[str], t: str, edge: str) -> DataFrame:
    """entered, left and bad for each entry that an exit follows at once; bad: the entity's marks do not alternate from an entry on, or two have one time."""
    w = Window.partitionBy(*by).orderBy(*order)
    x = marks.withColumns({"_e1": F.lead(edge).over(w), "_t1": F.lead(t).over(w), "_e0": F.lag(edge).over(w), "_t0": F.lag(t).over(w)})
    wrong = F.col(edge).eqNullSafe(F.col("_e0")) | (F.col("_e0").isNull() & (F.col(edge) == "out")) | F.col(t).eqNullSafe(F.col("_t0"))
    x = x.withColumn("bad", F.bool_or(wrong).over(Window.partitionBy(*by)))
    return x.where((F.col(edge) == "in") & (F.col("_e1") == "out")).select(*by, F.col(t).alias("entered"), F.col("_t1").alias("left"), "bad")


def visits(marks: DataFrame, turns: DataFrame, by: list[str], order: list[str], t: str, edge: str, at: str, near: int) -> DataFrame:
    """Visits: recorded (entry and exit), partial (one of them) and inferred (a turn that no visit is within ``near`` of)."""
    w = Window.partitionBy(*by).orderBy(*order)
    x = marks.withColumns({"_e1": F.lead(edge).over(w), "_t1": F.lead(t).over(w), "_e0": F.lag(edge).over(w)})
    entries = x.where(F.col(edge) == "in").select(*by, F.col(t).alias("entered"), F.when(F.col("_e1") == "out", F.col("_t1")).alias("left"))
    exits = x.where((F.col(edge) == "out") & ~F.col("_e0").eqNullSafe(F.lit("in"))).select(*by, F.lit(None).cast("long").alias("entered"), F.col(t).alias("left"))
    seen = entries.unionByName(exits)
    # the last visit that began at or before the turn and the first one after it are all that can be near
    begins = seen.select(*by, F.coalesce("entered", "left").alias("_a"), F.coalesce("left", "entered").alias("_z"))
    events = begins.select(*by, F.col("_a").alias("_t"), "_a", "_z", F.lit(0).alias("_o"), F.lit(None).cast("long").alias(at))
    asks = turns.select(*by, F.col(at).alias("_t"), F.lit(None).cast("long").alias("_a"), F.lit(None).cast("long").alias("_z"), F.lit(1).alias("_o"), F.col(at))
    up, down = Window.partitionBy(*by).orderBy("_t", "_o").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*by).orderBy(F.desc("_t"), F.desc("_o")).rowsBetween(Window.unboundedPreceding, 0)
    both = events.unionByName(asks).withColumns({"_last": F.max("_z").over(up), "_next": F.min("_a").over(down)})
    alone = both.where((F.col("_o") == 1) & F.coalesce(F.col("_last") + near < F.col(at), F.lit(True)) & F.coalesce(F.col("_next") - near > F.col(at), F.lit(True)))
    kind = F.when(F.col("entered").isNotNull() & F.col("left").isNotNull(), "recorded").otherwise("partial")
    return seen.withColumn("kind", kind).unionByName(alone.select(*by, F.col(at).alias("entered"), F.col(at).alias("left"), F.lit("inferred").alias("kind")))


def warm_up(rows: DataFrame, lines: DataFrame, group: list[str], order: str, age: str, value: str, early: int, band: float) -> DataFrame:
    """loss (sum of residuals of the first ``early`` laps), settled (age of the first lap that with the next is inside ``band`` of the mature line) and status."""
    r = rows.join(lines, group).withColumn("_r", F.round(F.col(value) - F.col("intercept") - F.col("slope") * F.col(age), 9))
    first = W.first_pair(r, group, order, F.abs("_r") <= band, age).withColumnRenamed("first", "settled")
    sums = r.groupBy(*group).agg(F.sum(F.when(F.col(age) <= early, F.col("_r"))).alias("loss"))
    status = F.when(F.col("settled").isNull(), "censored").when(F.col("settled") <= early, "settled").otherwise("late")
    return sums.join(first, group).withColumn("status", status)


def undercuts(stops: DataFrame, race: list[str], entity: str, number: str, t: str, within: int, ranks: int) -> DataFrame:
    """Pairs of stops of one number at most ``within`` apart of entities at most ``ranks`` places apart before them: first, second, lead, lead_after, outcome.

    Stops meet by the places they may have, in buckets of ``within``: as an entity has its place alone, a stop meets a few others.
    """
    bucket = F.floor(F.col(t) / within)
    a = stops.withColumn("_b", F.explode(F.array(bucket, bucket + 1))).withColumn("_p", F.explode(F.sequence(F.col("before") - ranks, F.col("before") + ranks))).alias("a")
    b = stops.withColumns({"_b": bucket, "_p": F.col("before")}).alias("b")
    wait = F.col(f"b.{t}") - F.col(f"a.{t}")
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (*race, number, "_b", "_p")] + [F.col(f"a.{entity}") != F.col(f"b.{entity}"), wait > 0, wait <= within]
    before, after = F.col("b.before") - F.col("a.before"), F.col("b.after") - F.col("a.after")
    outcome = F.when((before < 0) & (after > 0), "undercut").when((before > 0) & (after < 0), "overcut").otherwise("unchanged")
    return a.join(b, on).select(*[F.col(f"a.{c}") for c in (*race, number)], F.col(f"a.{entity}").alias("first"), F.col(f"b.{entity}").alias("second"), before.alias("lead"), after.alias("lead_after"), outcome.alias("outcome"))


def timing_scenarios(fits: DataFrame, by: list[str], stint: str, length: int, most: int) -> DataFrame:
    """cost of moving the stop between two fitted stints (a + b * age, ``length`` laps each) by -most..most laps: laps that change stint, at their new age minus their old one."""
    nxt = fits.select(*by, (F.col(stint) - 1).alias(stint), F.col("a").alias("_a1"), F.col("b").alias("_b1"))
    s = F.col("shift")
    p = fits.join(nxt, [*by, stint]).withColumn("shift", F.explode(F.sequence(F.lit(-most), F.lit(most))))
    old = lambda mean: F.col("a") + F.col("b") * mean
    new = lambda mean: F.col("_a1") + F.col("_b1") * mean
    later = s * old(length + (s + 1) / 2.0) - s * new(length - (s - 1) / 2.0)
    sooner = -s * new(length + (1 - s) / 2.0) + s * old(length + (s + 1) / 2.0)
    return p.select(*by, stint, "shift", F.when(s > 0, later).when(s < 0, sooner).otherwise(0.0).alias("cost"))
