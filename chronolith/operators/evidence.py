"""Evidence behind published figures: matched comparisons, roles, contexts, marker intervals, holdouts and ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from chronolith.functions import columns as C
from chronolith.operators import robust as R


def matched_baseline(rows: DataFrame, keys: list[str], treated: Column, value: str, x: str, within: float, ident: list[str]) -> DataFrame:
    """Treated rows with ``matched`` and ``baseline``: count and median of untreated rows of equal ``keys`` whose ``x`` is at most ``within`` away.

    Rows without a match are left out. Columns: ``ident``, ``keys``, ``value``, ``matched``, ``baseline``. Rows meet in
    buckets of ``x`` as wide as the band, so that a key's rows are not all paired.
    """
    flagged = rows.select(*dict.fromkeys([*keys, *ident]), x, value, treated.alias("_treated"))
    clean = flagged.where(~F.col("_treated")).select(*keys, F.col(x).alias("_x"), F.col(value).alias("_v"))
    clean = clean.withColumn("_b", F.explode(F.array(*[F.floor(F.col("_x") / within) + d for d in (-1, 0, 1)])))
    both = flagged.where("_treated").withColumn("_b", F.floor(F.col(x) / within)).join(clean, [*keys, "_b"]).where(F.abs(F.col(x) - F.col("_x")) <= within)
    return both.groupBy(*dict.fromkeys([*ident, *keys]), value).agg(F.count("*").alias("matched"), F.percentile("_v", 0.5).alias("baseline"))


def consistency(rows: DataFrame, group: list[str], x: str, y: str, least: int = 5, floor: float = 0.75, share: float = 0.01) -> DataFrame:
    """n, slope, sigma, p90 and slow of each group: residuals from its Theil-Sen line.

    sigma is 1.4826 times the median absolute residual, p90 the 90 % quantile of absolute residuals; slow counts
    residuals above max(``floor``, ``share`` of the median of ``y``).
    """
    lines = R.theil_sen(rows, group, x, y, least).select(*group, "slope", "intercept")
    fitted = rows.join(lines, group).withColumn("_r", F.col(y) - F.col("intercept") - F.col("slope") * F.col(x))
    limits = rows.groupBy(*group).agg(F.greatest(F.lit(floor), share * F.percentile(y, 0.5)).alias("_limit"))
    size = F.abs("_r")
    return fitted.join(limits, group).groupBy(*group).agg(
        F.count("*").alias("n"), F.first("slope").alias("slope"), (R.MAD_SCALE * F.percentile(size, 0.5)).alias("sigma"), F.percentile(size, 0.9).alias("p90"), F.count_if(F.col("_r") > F.col("_limit")).alias("slow")
    )


def roles(contests: DataFrame, a: str, b: str, won: Column) -> DataFrame:
    """Both sides of each contest by entity and role: n, wins, opponents and the Wilson interval of the wins."""
    rows = contests.select(F.col(a), F.col(b), won.cast("boolean").alias("_won"))
    sides = rows.select(F.col(a).alias("entity"), F.col(b).alias("_other"), F.lit("attack").alias("role"), "_won")
    sides = sides.unionByName(rows.select(F.col(b).alias("entity"), F.col(a).alias("_other"), F.lit("defence").alias("role"), (~F.col("_won")).alias("_won")))
    out = sides.groupBy("entity", "role").agg(F.count("*").alias("n"), F.count_if("_won").alias("wins"), F.count_distinct("_other").alias("opponents"))
    low, high = C.wilson(F.col("wins"), F.col("n"))
    return out.withColumns({"low": low, "high": high})


def contexts(keys: list[str], **sources: DataFrame) -> DataFrame:
    """Union of evidence: one row for each key that a source names, with the sorted list of sources and their count."""
    named = [df.select(*keys).distinct().withColumn("_source", F.lit(name)) for name, df in sources.items()]
    rows = named[0]
    for df in named[1:]:
        rows = rows.unionByName(df)
    found = F.sort_array(F.collect_set("_source"))  # at most one entry a source
    return rows.groupBy(*keys).agg(F.array_join(found, "+").alias("sources"), F.size(found).cast("long").alias("n_sources"))


def with_context(rows: DataFrame, context: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with their key's context; a missing one has no sources."""
    return rows.join(context, keys, "left").withColumns({"sources": F.coalesce("sources", F.lit("none")), "n_sources": F.coalesce("n_sources", F.lit(0).cast("long"))})


def marker_intervals(markers: DataFrame, by: list[str], order: list[str], t: str, edge: str) -> DataFrame:
    """Intervals of start and end markers: a start opens one if none is open, an end closes it; an unclosed one has no end, one of no length is none."""
    w = Window.partitionBy(*by).orderBy(*order)
    turns = markers.where(F.col(edge).isin("start", "end")).withColumn("_p", F.lag(edge).over(w)).where(~F.col(edge).eqNullSafe(F.col("_p")))
    pairs = turns.withColumn("end", F.lead(t).over(w)).where(F.col(edge) == "start").select(*by, F.col(t).alias("start"), "end")
    return pairs.where(F.col("end").isNull() | (F.col("end") > F.col("start")))


def air_state(traffic: Column, clean: Column, coverage: Column) -> Column:
    """traffic, clean or mixed by shares of covered samples; unknown below 80 % coverage."""
    return F.when(coverage < 0.8, "unknown").when(traffic >= 0.5, "traffic").when((clean >= 0.8) & (traffic <= 0.1), "clean").otherwise("mixed")


def event_pairs(events: DataFrame, group: list[str], entity: str, number: str, t: str, most: float) -> DataFrame:
    """Pairs of different entities whose events of equal ``number`` are apart by more than 0 and at most ``most``: the earlier one first.

    Events meet in buckets of ``most`` seconds: the earlier one goes to its own and the next.
    """
    bucket = F.floor(F.col(t) / most)
    a, b = events.withColumn("_b", F.explode(F.array(bucket, bucket + 1))).alias("a"), events.withColumn("_b", bucket).alias("b")
    wait = F.col(f"b.{t}") - F.col(f"a.{t}")
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (*group, number, "_b")] + [F.col(f"a.{entity}") != F.col(f"b.{entity}"), wait > 0, wait <= most]
    return a.join(b, on).select(*[F.col(f"a.{c}") for c in (*group, number)], F.col(f"a.{entity}").alias("first"), F.col(f"b.{entity}").alias("second"), wait.alias("wait"))


def counted_near(samples: DataFrame, asked: DataFrame, keys: list[str], t: str, status: str, at: str, back: int, ahead: int, kinds: list[str]) -> DataFrame:
    """Asked rows (any number of one time) with status, samples and before: a row for each status with a sample in [at - back, at + ahead]; before are those earlier than ``at``.

    Times are whole numbers. Samples are counted by time, and the counts run on inside buckets as wide as the window: a
    window ends in its start's bucket or the next one. So samples and asked rows are never paired, and no group is sorted whole.
    """
    width = back + ahead + 1
    n = {k: f"_n{i}" for i, k in enumerate(kinds)}
    bucket = lambda c: F.floor(c / width).alias("_b")
    at_time = samples.where(F.col(t).isNotNull()).groupBy(*keys, F.col(t).alias("_t")).agg(*[F.count_if(F.col(status) == k).alias(c) for k, c in n.items()])
    # counts up to a window's last time, before its first one and before ``at``
    marks = F.explode(F.array(F.struct((F.col(at) - back - 1).alias("_t"), F.lit(0).alias("_end")), F.struct((F.col(at) - 1).alias("_t"), F.lit(1).alias("_end")), F.struct((F.col(at) + ahead).alias("_t"), F.lit(2).alias("_end"))))
    sought = asked.select(*keys, at).distinct().select(*keys, at, marks.alias("_m")).select(*keys, at, "_m.*")
    none = lambda c, kind: F.lit(None).cast(kind).alias(c)
    both = at_time.select(*keys, "_t", bucket(F.col("_t")), *n.values(), none(at, sought.schema[at].dataType), none("_end", "int"))
    both = both.unionByName(sought.select(*keys, "_t", bucket(F.col("_t")), *[F.lit(0).cast("long").alias(c) for c in n.values()], at, "_end"))
    run = Window.partitionBy(*keys, "_b").orderBy("_t").rangeBetween(Window.unboundedPreceding, 0)
    inside = both.withColumns({c: F.sum(c).over(run) for c in n.values()}).where("_end is not null")
    sums = at_time.groupBy(*keys, bucket(F.col("_t"))).agg(*[F.sum(c).alias(c) for c in n.values()])  # a row a bucket
    start, last = F.floor((F.col(at) - back - 1) / width), F.col("_b")
    sums = sums.select(*keys, (F.col("_b") + 1).alias("_b"), *[F.col(c).alias(f"{c}p") for c in n.values()])
    met = inside.join(F.broadcast(sums), [*keys, "_b"], "left").withColumns({c: F.col(c) + F.when(last > start, F.coalesce(f"{c}p", F.lit(0))).otherwise(0) for c in n.values()})
    upto = lambda c, end: F.max(F.when(F.col("_end") == end, F.col(c)))
    counts = met.groupBy(*keys, at).agg(F.array(*[F.struct(F.lit(k).alias(status), (upto(c, 2) - upto(c, 0)).alias("samples"), (upto(c, 1) - upto(c, 0)).alias("before")) for k, c in n.items()]).alias("_x"))
    return asked.join(counts, [*keys, at]).select("*", F.explode("_x").alias("_s")).where("_s.samples > 0").select(*asked.columns, "_s.*")


def season_windows(rows: DataFrame, season: str, by: list[str], value: str, least: int = 5) -> DataFrame:
    """n and mean of ``value`` for every contiguous window (first, last) of seasons; sums by season are made before rows are repeated."""
    sums = rows.groupBy(season, *by).agg(F.count(value).alias("_n"), F.sum(value).alias("_s"))
    ends = rows.agg(F.min(season).alias("_lo"), F.max(season).alias("_hi"))
    spread = sums.crossJoin(F.broadcast(ends))  # one row
    spread = spread.withColumn("first", F.explode(F.sequence("_lo", season))).withColumn("last", F.explode(F.sequence(season, "_hi")))
    out = spread.groupBy("first", "last", *by).agg(F.sum("_n").alias("n"), F.sum("_s").alias("_s"))
    return out.where(F.col("n") >= least).select("first", "last", *by, "n", (F.col("_s") / F.col("n")).alias("mean"))


def tolerance_sweep(pairs: DataFrame, distance: Column, value: Column, tolerances: list[int]) -> DataFrame:
    """n and mean of ``value`` of the pairs within each tolerance; one pass, each pair goes to the tolerances that it meets."""
    rows = pairs.select(distance.alias("_d"), value.alias("_v")).groupBy("_d").agg(F.count("_v").alias("_n"), F.sum("_v").alias("_s"))
    rows = rows.withColumn("tolerance", F.explode(F.array(*[F.lit(t) for t in sorted(tolerances)]))).where(F.col("_d") <= F.col("tolerance"))
    return rows.groupBy("tolerance").agg(F.sum("_n").alias("n"), (F.sum("_s") / F.sum("_n")).alias("mean"))


def holdout(rows: DataFrame, group: list[str], order: str, x: str, y: str, first: int) -> DataFrame:
    """scored, mae and baseline_mae of each group: a line through its ``first`` rows and their median, on the rows after them."""
    ranked = rows.withColumn("_k", F.row_number().over(Window.partitionBy(*group).orderBy(order)))
    fit = ranked.where(F.col("_k") <= first).groupBy(*group).agg(F.regr_slope(y, x).alias("_b"), F.regr_intercept(y, x).alias("_a"), F.percentile(y, 0.5).alias("_m"), F.count("*").alias("_n")).where(F.col("_n") == first)
    rest = ranked.where(F.col("_k") > first).join(fit, group)
    return rest.groupBy(*group).agg(F.count("*").alias("scored"), F.avg(F.abs(F.col(y) - F.col("_a") - F.col("_b") * F.col(x))).alias("mae"), F.avg(F.abs(F.col(y) - F.col("_m"))).alias("baseline_mae"))


def clock_zero(anchors: DataFrame, by: list[str], entity: str, utc: str, local: str, within: float = 1.0, least: int = 8, entities: int = 4, share: float = 0.9) -> DataFrame:
    """zero = median(utc - local) of each group, anchors, entities, share of residuals within ``within``, and whether the gate accepts it."""
    shift = F.col(utc) - F.col(local)
    rows = anchors.where(shift.isNotNull()).withColumn("_zero", F.percentile(shift, 0.5).over(Window.partitionBy(*by)))
    near = F.count_if(F.abs(shift - F.col("_zero")) <= within)
    out = rows.groupBy(*by).agg(F.first("_zero").alias("zero"), F.count("*").alias("anchors"), F.count_distinct(entity).alias("entities"), (near / F.count("*")).alias("share"))
    return out.withColumn("accepted", (F.col("anchors") >= least) & (F.col("entities") >= entities) & (F.col("share") >= share))


def coverage_ledger(expected: DataFrame, present: DataFrame, failed: DataFrame, keys: list[str]) -> DataFrame:
    """status of each expected key: available, unavailable (tried and failed) or not_attempted."""
    mark = lambda df, name: df.select(*keys).distinct().withColumn(name, F.lit(True))
    out = expected.select(*keys).distinct().join(mark(present, "_p"), keys, "left").join(mark(failed, "_f"), keys, "left")
    return out.select(*keys, F.when(F.col("_p"), "available").when(F.col("_f"), "unavailable").otherwise("not_attempted").alias("status"))


def dense_order(rows: DataFrame, tick: list[str], progress: str, ties: list[str], out: str = "place") -> DataFrame:
    """Place in each tick by progress; null for the whole tick if any entity lacks progress."""
    w = Window.partitionBy(*tick)
    whole = F.count(progress).over(w) == F.count(F.lit(1)).over(w)
    return rows.withColumn(out, F.when(whole, F.row_number().over(w.orderBy(F.desc(progress), *ties))).cast("long"))


def sign_agreement(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    """agreement: percent of a group's values that have the sign of its median."""
    medians = rows.groupBy(*group).agg(F.percentile(value, 0.5).alias("_m"))
    same = F.count_if(F.signum(value) == F.signum("_m"))
    return rows.join(medians, group).groupBy(*group).agg((100.0 * same / F.count(value)).alias("agreement"))


def classified(rows: DataFrame, features: dict[str, tuple[float, str]], other: str, out: str) -> DataFrame:
    """Label of the first feature that reaches its global quantile: {feature: (quantile, label)}."""
    limits = rows.agg(*[F.percentile(c, q).alias(f"_q_{c}") for c, (q, _) in features.items()])
    label = C.first_reason(*[(F.col(c) >= F.col(f"_q_{c}"), name) for c, (_, name) in features.items()])
    return rows.crossJoin(F.broadcast(limits)).withColumn(out, F.coalesce(label, F.lit(other))).drop(*[f"_q_{c}" for c in features])  # one row


def section_coverage(parts: dict[str, tuple[DataFrame, Column]], entity: str, race: list[str], season: str) -> DataFrame:
    """A ledger row for each section: n, entities, races, usable rows and the latest season."""
    out = None
    for name, (rows, usable) in parts.items():
        one = rows.agg(F.count("*").alias("n"), F.count_distinct(entity).alias("entities"), F.count_distinct(F.struct(*race)).alias("races"), F.count_if(usable).alias("usable"), F.max(season).alias("latest")).select(F.lit(name).alias("section"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def error_metrics(rows: DataFrame, group: list[str], actual: str, predicted: str, radius: str) -> DataFrame:
    """n, mae, rmse, sign_accuracy, r, skill against zero, covered (share within ``radius``) and width of predictions."""
    y, p, e = F.col(actual), F.col(predicted), F.abs(F.col(actual) - F.col(predicted))
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    return rows.groupBy(*group).agg(
        F.count("*").alias("n"), F.avg(e).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), share(F.signum(y) == F.signum(p)).alias("sign_accuracy"), F.corr(actual, predicted).alias("r"),
        (1 - F.try_divide(F.avg(e), F.avg(F.abs(y)))).alias("skill"), share(e <= F.col(radius)).alias("covered"), F.avg(2 * F.col(radius)).alias("width"),
    )


def confusion(rows: DataFrame, group: list[str], truth: str, found: str) -> DataFrame:
    """tp, fp, fn, precision and recall of flags."""
    t, f = F.col(truth), F.col(found)
    out = rows.groupBy(*group).agg(F.count_if(t & f).alias("tp"), F.count_if(~t & f).alias("fp"), F.count_if(t & ~f).alias("fn"))
    return out.withColumns({"precision": F.try_divide("tp", F.col("tp") + F.col("fp")), "recall": F.try_divide("tp", F.col("tp") + F.col("fn"))})


def between_spread(rows: DataFrame, group: list[str], entity: str, value: str) -> DataFrame:
    """spread: the population deviation of the entities' medians."""
    return rows.groupBy(*group, entity).agg(F.percentile(value, 0.5).alias("_m")).groupBy(*group).agg(F.stddev_pop("_m").alias("spread"))


def centred(rows: DataFrame, group: list[str], value: str, eligible: Column, out: str) -> DataFrame:
    """Value minus the median of the group's eligible rows; null for the others."""
    known = rows.withColumn("_e", F.coalesce(eligible, F.lit(False)))
    middle = known.where("_e").groupBy(*group).agg(F.percentile(value, 0.5).alias("_m"))
    return known.join(middle, group, "left").withColumn(out, F.when(F.col("_e"), F.col(value) - F.col("_m"))).drop("_e", "_m")


def evidence_summary(parts: dict[str, tuple[DataFrame, Column]], race: list[str]) -> DataFrame:
    """name, candidates, eligible and races of each analysis."""
    out = None
    for name, (rows, eligible) in parts.items():
        one = rows.agg(F.count("*").alias("candidates"), F.count_if(eligible).alias("eligible"), F.count_distinct(F.struct(*race)).alias("races")).select(F.lit(name).alias("name"), "*")
        out = one if out is None else out.unionByName(one)
    return out
