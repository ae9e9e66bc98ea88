"""Technique profiles: weighted metrics, their stability and negative controls, and path selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from chronolith.operators import evidence as E


def metrics(rows: DataFrame, by: list[str], order: str, x: str, means: dict[str, Column], onset: Column, least: float) -> DataFrame:
    """Means weighted by the distance in ``x`` (an interval takes its end sample) and onsets (times a flag turns on), where a group is at least ``least`` long."""
    w = Window.partitionBy(*by).orderBy(order)
    s = rows.withColumns({"_dx": F.col(x) - F.lag(x).over(w), "_f": onset}).withColumn("_f0", F.lag("_f").over(w)).where(F.col("_dx").isNotNull())
    total = F.sum("_dx")
    out = s.groupBy(*by).agg(*[(F.sum(F.col("_dx") * c) / total).alias(n) for n, c in means.items()], F.count_if(F.col("_f") & ~F.col("_f0")).alias("onsets"), total.alias("_t"))
    return out.where(F.col("_t") >= least).drop("_t")


def stability(rows: DataFrame, by: list[str], race: str, value: str, least: int, halves: float, moved: float, agreement: float) -> DataFrame:
    """races, median, halves (odd against even races), moved (the most that leaving one race out moves the median), agreement of signs and the stable flag."""
    odd = F.col(race) % 2 == 1
    whole = rows.groupBy(*by).agg(F.count("*").alias("races"), F.percentile(value, 0.5).alias("median"), F.abs(F.percentile(F.when(odd, F.col(value)), 0.5) - F.percentile(F.when(~odd, F.col(value)), 0.5)).alias("halves")).where(F.col("races") >= least)
    # a profile has few races: each is left out of its own group's list
    lists = rows.groupBy(*by).agg(F.sort_array(F.collect_list(value)).alias("_v"))
    n = F.size("_v")
    pick = lambda i, k: F.element_at("_v", (k + F.when(k >= i, 1).otherwise(0)).cast("int"))
    middle = lambda i: (pick(i, F.floor(n / 2)) + pick(i, F.floor((n - 1) / 2) + 1)) / 2
    out = lists.join(whole, by).withColumn("moved", F.array_max(F.transform(F.sequence(F.lit(1), n), lambda i: F.abs(middle(i) - F.col("median"))))).drop("_v")
    out = out.join(E.sign_agreement(rows, by, value), by)
    ok = (F.col("halves") <= halves) & (F.col("moved") <= moved) & (F.col("agreement") >= agreement)
    return out.withColumn("stable", F.coalesce(ok, F.lit(False)))


def negative_control(rows: DataFrame, by: list[str], race: str, entity: str, value: str, replicates: int, seed: int = 7) -> DataFrame:
    """real: the spread of the entities' medians; shuffled: its mean with labels shuffled inside each race; ratio.

    The order of a shuffle is that of md5s, which any engine can repeat.
    """
    w = Window.partitionBy(*by, race)
    labels = rows.select(*by, race, entity, F.row_number().over(w.orderBy(entity)).alias("_k"))
    drawn = rows.withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("_r").cast("string"), *[F.col(c).cast("string") for c in (*by, race, entity)]))
    drawn = drawn.select(*by, race, "_r", value, F.row_number().over(Window.partitionBy(*by, race, "_r").orderBy(digest, entity)).alias("_k"))
    spread = E.between_spread(drawn.join(labels, [*by, race, "_k"]), [*by, "_r"], entity, value).groupBy(*by).agg(F.avg("spread").alias("shuffled"))
    real = E.between_spread(rows, by, entity, value).withColumnRenamed("spread", "real")
    return real.join(spread, by).withColumn("ratio", F.try_divide("real", "shuffled"))


def best_path(rows: DataFrame, race: list[str], path: list[str], order: str, value: str, full: int) -> DataFrame:
    """Rows of each race's best path, with ``step``: the least widest step plus closure plus what is missing of ``full`` samples."""
    w = Window.partitionBy(*race, *path).orderBy(order)
    s = rows.withColumn("step", F.abs(F.col(value) - F.lag(value).over(w)))
    q = s.groupBy(*race, *path).agg(F.max("step").alias("_w"), F.abs(F.max_by(value, order) - F.min_by(value, order)).alias("_c"), (F.count("*") / full).alias("_f"), F.count("step").alias("_n")).where("_n > 0")
    score = F.round(F.col("_w") + F.col("_c") + 50 * (1 - F.col("_f")), 9)
    best = q.groupBy(*race).agg(F.min(F.struct(score.alias("s"), *path)).alias("_b")).select(*race, *[F.col(f"_b.{c}").alias(c) for c in path])
    return s.join(F.broadcast(best), [*race, *path])  # a row for each race
