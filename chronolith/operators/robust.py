"""Robust statistics: medians, MAD and Theil-Sen fits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chronolith.operators import windows as W

#: Fixed value: the MAD of a normal distribution is its standard deviation divided by this.
MAD_SCALE = 1.4826


def mad(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """n, median, mad and sigma (1.4826 * MAD) of each group."""
    known = df.where(F.col(value).isNotNull()).select(*group, value)
    medians = known.groupBy(*group).agg(F.percentile(value, 0.5).alias("_m"))
    centred = known.join(medians, group)
    return centred.groupBy(*group).agg(F.count("*").alias("n"), F.max("_m").alias("median"), F.percentile(F.abs(F.col(value) - F.col("_m")), 0.5).alias("mad")).withColumn("sigma", MAD_SCALE * F.col("mad"))


def quantiles(df: DataFrame, group: list[str], value: str, **at: float) -> DataFrame:
    """Exact quantiles (linear between neighbours) of few, large groups, from counts of distinct values: no group meets in one task."""
    c = W.running_counts(df, group, value)
    out = []
    for name, q in at.items():
        place = q * (F.col("total") - 1)
        hit = lambda k: F.max(F.when((F.col("before") <= k) & (k < F.col("before") + F.col("times")), F.col(value)))
        out.append((hit(F.floor(place)) + (F.max(place) - F.floor(F.max(place))) * (hit(F.ceil(place)) - hit(F.floor(place)))).alias(name))
    return c.groupBy(*group).agg(F.max("total").alias("n"), *out)


def robust_z(df: DataFrame, group: list[str], value: str, out: str) -> DataFrame:
    """(x - median) / sigma of the group; 0 where sigma is 0. For few, large groups (a metric each)."""
    centre = quantiles(df, group, value, median=0.5).select(*group, "median")
    away = df.join(F.broadcast(centre), group).select(*group, F.abs(F.col(value) - F.col("median")).alias("_d"))  # a row for each metric
    stats = centre.join(quantiles(away, group, "_d", mad=0.5).select(*group, (MAD_SCALE * F.col("mad")).alias("sigma")), group)
    z = F.when(F.col("sigma") == 0, F.lit(0.0)).otherwise(F.try_divide(F.col(value) - F.col("median"), F.col("sigma")))
    return df.join(F.broadcast(stats), group, "left").withColumn(out, z).drop("median", "sigma")


def theil_sen(df: DataFrame, group: list[str], x: str, y: str, least: int = 3) -> DataFrame:
    """n, slope (median over all pairs of different x), intercept and residual MAD of each group with at least ``least`` rows.

    Groups are small by nature (stints): the pairs are made inside the group's key.
    """
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*group, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    both = rows.alias("a").join(rows.alias("b"), [F.col(f"a.{g}") == F.col(f"b.{g}") for g in group] + [F.col("a._x") < F.col("b._x")])
    slopes = both.groupBy(*[F.col(f"a.{g}").alias(g) for g in group]).agg(F.percentile((F.col("b._y") - F.col("a._y")) / (F.col("b._x") - F.col("a._x")), 0.5).alias("slope"))
    lines = rows.join(slopes, group).groupBy(*group).agg(F.count("*").alias("n"), F.first("slope").alias("slope"), F.percentile(F.col("_y") - F.col("slope") * F.col("_x"), 0.5).alias("intercept")).where(F.col("n") >= least)
    left = rows.join(lines, group).groupBy(*group).agg(F.percentile(F.abs(F.col("_y") - F.col("intercept") - F.col("slope") * F.col("_x")), 0.5).alias("residual_mad"))
    return lines.join(left, group)
