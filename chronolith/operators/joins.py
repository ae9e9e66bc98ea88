"""As-of, interval, band, nearest, overlap and pair joins, each with an equi-join prefix so that no product is formed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window


def asof(left: DataFrame, right: DataFrame, keys: list[str], t: str, values: list[str], strict: bool = False, or_first: bool = False, max_age: float | None = None) -> DataFrame:
    """Left rows with ``values`` of the last right row at or before ``t`` (before, if ``strict``).

    One shuffle and one sort by (keys, t). ``or_first``: else the first right row of the keys. ``max_age``: values older are null.
    Right rows of one time are ordered by their values, nulls first: the last of them is taken, and the first as the keys' first row.
    Right rows without a time are none; left rows without a time match nothing (but take the first row with ``or_first``).
    """
    names = left.columns
    right = right.select(*keys, t, *values).where(F.col(t).isNotNull())
    mine = left.select(*keys, F.col(t), F.struct(*[F.col(c) for c in names]).alias("_l"), F.lit(None).cast("double").alias("_t"), F.lit(0 if strict else 1).alias("_o"), *[F.lit(None).cast(right.schema[v].dataType).alias(f"_r_{v}") for v in values])
    theirs = right.select(*keys, F.col(t), F.lit(None).cast(mine.schema["_l"].dataType).alias("_l"), F.col(t).cast("double").alias("_t"), F.lit(1 if strict else 0).alias("_o"), *[F.col(v).alias(f"_r_{v}") for v in values])
    w = Window.partitionBy(*keys).orderBy(F.col(t).asc_nulls_first(), "_o", *[f"_r_{v}" for v in values]).rowsBetween(Window.unboundedPreceding, 0)
    got = F.when(F.col("_l").isNull(), F.struct(F.col("_t"), *[F.col(f"_r_{v}") for v in values]))
    both = mine.unionByName(theirs).withColumn("_hit", F.last(got, ignorenulls=True).over(w))
    if or_first:
        whole = Window.partitionBy(*keys)
        both = both.withColumn("_hit", F.coalesce("_hit", F.min(got).over(whole)))
    if max_age is not None:
        both = both.withColumn("_hit", F.when(F.col(t).cast("double") - F.col("_hit")["_t"] <= max_age, F.col("_hit")))
    return both.where("_l is not null").select("_l.*", *[F.col("_hit")[f"_r_{v}"].alias(v) for v in values])


def pairs(df: DataFrame, group: list[str], entity: str, values: list[str], how: Column | None = None) -> DataFrame:
    """Ordered pairs of different entities in a group, both directions; ``how`` may compare ``a.x`` with ``b.x``."""
    on = [F.col(f"a.{g}") == F.col(f"b.{g}") for g in group] + [F.col(f"a.{entity}") != F.col(f"b.{entity}")]
    out = df.alias("a").join(df.alias("b"), on if how is None else [*on, how])
    return out.select(*[F.col(f"a.{g}") for g in group], F.col(f"a.{entity}").alias(entity), F.col(f"b.{entity}").alias(f"other_{entity}"), *[F.col(f"a.{v}").alias(v) for v in values], *[F.col(f"b.{v}").alias(f"other_{v}") for v in values])


def exactly(df: DataFrame, group: list[str], entity: str, k: int) -> DataFrame:
    """Rows of the groups with exactly ``k`` distinct entities."""
    return df.join(df.groupBy(*group).agg(F.count_distinct(entity).alias("_n")).where(F.col("_n") == k).drop("_n"), group, "left_semi")


def interval(points: DataFrame, spans: DataFrame, keys: list[str], t: str, start: str, end: str, width: float, how: str = "inner", closed: bool = False) -> DataFrame:
    """Points in [start, end) (or [start, end]) of spans with equal keys, by buckets of ``width``: each span goes to the buckets that it meets."""
    p = points.withColumn("_b", F.floor(F.col(t) / width)).alias("p")
    s = spans.withColumn("_b", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width)))).alias("s")
    at, first, last = F.col(f"p.{t}"), F.col(f"s.{start}"), F.col(f"s.{end}")
    inside = (at >= first) & ((at <= last) if closed else (at < last))
    out = p.join(s, [F.col(f"p.{k}") == F.col(f"s.{k}") for k in (*keys, "_b")] + [inside], how)
    if how in ("left_semi", "left_anti"):
        return out.drop("_b")
    return out.select(*[F.col(f"p.{c}") for c in points.columns], *[F.col(f"s.{c}") for c in spans.columns if c not in keys])


def nearest(left: DataFrame, right: DataFrame, keys: list[str], t: str, values: list[str], within: float, ident: list[str]) -> DataFrame:
    """Left rows (unique by ``ident``) with the right row nearest in ``t`` and not farther than ``within``; the earlier wins a tie."""
    r = right.select(*keys, F.col(t).alias("_rt"), *values)
    r = r.withColumn("_b", F.explode(F.array(*[F.floor(F.col("_rt") / within) + d for d in (-1, 0, 1)])))
    both = left.withColumn("_b", F.floor(F.col(t) / within)).join(r, [*keys, "_b"]).where(F.abs(F.col(t) - F.col("_rt")) <= within)
    best = both.withColumn("_n", F.row_number().over(Window.partitionBy(*ident).orderBy(F.abs(F.col(t) - F.col("_rt")), "_rt"))).where("_n = 1")
    return best.drop("_b", "_n").withColumnRenamed("_rt", f"near_{t}")


def reconcile(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys with status both, left_only or right_only."""
    a, b = left.select(*keys).distinct().withColumn("_a", F.lit(1)), right.select(*keys).distinct().withColumn("_b", F.lit(1))
    return a.join(b, keys, "full_outer").select(*keys, F.when(F.col("_b").isNull(), "left_only").when(F.col("_a").isNull(), "right_only").otherwise("both").alias("status"))


def snapshot(events: DataFrame, samples: DataFrame, keys: list[str], entity: str, t: str, value: str, within: float) -> DataFrame:
    """Per event (keys, event_id, at) and entity: last value at or before ``at`` and first at or after it, at most ``within`` away; values of one time are ordered, nulls first.

    A sample answers for the times from it to the entity's next one, and before it where the one before is out of reach. So an event
    meets one row of an entity, and what meets is a result: nothing is grouped or sent after the join.
    """
    v, own = F.col("_v"), Window.partitionBy(*keys, entity).orderBy("_t")
    s = samples.select(*keys, entity, F.col(t).alias("_t"), F.col(value).alias("_v")).where(F.col("_t").isNotNull()).repartition(*keys, entity)
    s = s.groupBy(*keys, entity, "_t").agg(F.max(v).alias("_last"), F.when(F.count(v) == F.count("*"), F.min(v)).alias("_first"))
    s = s.withColumns({"_t0": F.lag("_t").over(own), "_t1": F.lead("_t").over(own), "_next": F.lead("_first").over(own), "_b": F.floor(F.col("_t") / within)})
    near = F.explode(F.array(*[F.floor(F.col("at") / within) + d for d in (-1, 0, 1)]))
    asked = events.select(*keys, "event_id", "at").distinct().withColumn("_b", near)
    at, here = F.col("at"), F.col("_t")
    upto, since = at >= here, at - F.col("_t0") <= within
    mine = (F.abs(here - at) <= within) & F.when(upto, F.col("_t1").isNull() | (at < F.col("_t1"))).otherwise(F.col("_t0").isNull() | ~since)
    after = F.when(at <= here, F.col("_first")).when(F.col("_t1") - at <= within, F.col("_next"))
    return asked.join(s, [*keys, "_b"]).where(mine).select(*keys, "event_id", "at", entity, F.when(upto, F.col("_last")).alias("before"), after.alias("after"))


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """The frame, whose rows raise an error if a key occurs twice."""
    n = F.count("*").over(Window.partitionBy(*keys))
    return df.withColumn("_n", n).where(F.assert_true(F.col("_n") == 1, F.lit(f"{keys} not unique")).isNull()).drop("_n")


def either(left: DataFrame, right: DataFrame, keys: list[str], sides: list[tuple[str, str]], match: list[str]) -> DataFrame:
    """Right rows that equal one of a left row's sides in ``match``: each side is a row of its own, so that the join has equal keys."""
    rows = None
    for side in sides:
        one = left.select(*keys, *[F.col(c).alias(m) for c, m in zip(side, match, strict=True)])
        rows = one if rows is None else rows.unionByName(one)
    return rows.join(right, [*keys, *match])


def bracketed(left: DataFrame, right: DataFrame, keys: list[str], x: str, values: list[str], widest: float | None = None, deal: Callable[..., DataFrame] = lambda rows, *_: rows) -> DataFrame:
    """Left rows with ``values`` at ``x``, linear between the right rows (unique by keys and x) before and after; null outside them.

    With ``widest`` a gap that is longer gives null; at a right row's own x its value is taken. One shuffle, which
    ``deal`` may do, and two sorts.
    """
    names = left.columns
    mine = left.select(*keys, F.col(x).cast("double").alias("_x"), F.struct(*[F.col(c) for c in names]).alias("_l"), *[F.lit(None).cast("double").alias(f"_v_{v}") for v in values])
    theirs = right.where(F.col(x).isNotNull()).select(*keys, F.col(x).cast("double").alias("_x"), F.lit(None).cast(mine.schema["_l"].dataType).alias("_l"), *[F.col(v).cast("double").alias(f"_v_{v}") for v in values])
    knot = F.when(F.col("_l").isNull(), F.struct("_x", *[f"_v_{v}" for v in values]))
    # both frames end at the row and grow with it; one that began there would be read anew for each row
    up, down = (Window.partitionBy(*keys).orderBy(x).rangeBetween(Window.unboundedPreceding, 0) for x in (F.col("_x").asc_nulls_first(), F.col("_x").desc_nulls_last()))
    near = deal(mine.unionByName(theirs), *keys).withColumns({"_a": F.last(knot, ignorenulls=True).over(up), "_b": F.last(knot, ignorenulls=True).over(down)})
    wide = F.col("_b._x") - F.col("_a._x")
    between = F.lit(True) if widest is None else wide <= widest
    out = lambda v: F.when(F.col("_a._x") == F.col("_x"), F.col(f"_a._v_{v}")).when(between, F.col(f"_a._v_{v}") + F.try_divide(F.col("_x") - F.col("_a._x"), wide) * (F.col(f"_b._v_{v}") - F.col(f"_a._v_{v}")))
    return near.where("_l is not null").select("_l.*", *[out(v).alias(v) for v in values])


def best_pair(df: DataFrame, group: list[str], entity: str, order: str, within: int, bad: Column, score: Column) -> DataFrame:
    """The best pair of rows of two entities in each group: rows at most ``within`` apart in ``order``; not ``bad`` (0 or 1), then the least ``score``, then the first ones.

    Both may compare ``a.x`` with ``b.x``. Rows meet in buckets of ``order``.
    """
    bucket = F.floor(F.col(order) / (within + 1))
    a, b = df.withColumn("_b", F.explode(F.array(*[bucket + i for i in (-1, 0, 1)]))).alias("a"), df.withColumn("_b", bucket).alias("b")
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (*group, "_b")] + [F.col(f"a.{entity}") < F.col(f"b.{entity}"), F.abs(F.col(f"a.{order}") - F.col(f"b.{order}")) <= within]
    least = F.min(F.struct(bad.alias("bad"), score.alias("score"), F.col(f"a.{order}").alias(order), F.col(f"b.{order}").alias(f"other_{order}"), F.col(f"a.{entity}").alias(entity), F.col(f"b.{entity}").alias(f"other_{entity}"))).alias("x")
    return a.join(b, on).groupBy(*[F.col(f"a.{g}").alias(g) for g in group]).agg(least).select(*group, "x.*")


def one_to_one(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str, start: str, end: str, t: str) -> DataFrame:
    """Greedy matches (left_id, right_id): each left interval, by start, takes the earliest unused right event in [start, end] with equal keys.

    Rounds of mutual firsts: an interval proposes its earliest free event, an event takes the interval that starts first.
    What a round settles leaves; rounds are as many as the longest chain of overlapping intervals of one key.
    """
    both = left.select(*keys, left_id, F.col(start).alias("_s"), F.col(end).alias("_e")).join(right.select(*keys, right_id, F.col(t).alias("_t")), keys).where("_t between _s and _e")
    open_ = both.select(*keys, left_id, "_s", right_id, "_t").checkpoint()
    done = None
    while not open_.isEmpty():
        by_left, by_right = Window.partitionBy(left_id).orderBy("_t", right_id), Window.partitionBy(right_id).orderBy("_s", left_id)
        # an interval may take an event only if no interval before it could still claim that event
        first = open_.withColumns({"_i": F.row_number().over(by_left), "_j": F.row_number().over(by_right)}).where("_i = 1 and _j = 1").select(left_id, right_id).checkpoint()
        done = first if done is None else done.unionByName(first)
        open_ = open_.join(first.select(left_id), left_id, "left_anti").join(first.select(right_id), right_id, "left_anti").checkpoint()
    return done if done is not None else open_.select(left_id, right_id)
