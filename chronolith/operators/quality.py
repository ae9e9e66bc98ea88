"""Data quality: rules as rows of violations, table differences, fingerprints and coverage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from chronolith.operators.windows import running_counts


def _rule(name: str, bad: DataFrame) -> DataFrame:
    return bad.agg(F.count("*").alias("violations")).select(F.lit(name).alias("rule"), "violations")


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "rule", "violations").withColumn("rule", F.concat(F.lit("not_null:"), "rule"))


def unique(df: DataFrame, *columns: str) -> DataFrame:
    return _rule("unique:" + "+".join(columns), df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1"))


def accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    return _rule(f"accepted:{column}", df.where(F.col(column).isNotNull() & ~F.col(column).isin(values)))


def within(df: DataFrame, column: str, low: float, high: float, when: Column | None = None) -> DataFrame:
    rows = df if when is None else df.where(when)
    return _rule(f"range:{column}", rows.where((F.col(column) < low) | (F.col(column) > high)))


def related(df: DataFrame, column: str, to: DataFrame, key: str) -> DataFrame:
    return _rule(f"related:{column}", df.where(F.col(column).isNotNull()).join(to.select(F.col(key).alias(column)).distinct(), column, "left_anti"))


def holds(name: str, df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which a condition is not true."""
    return _rule(name, df.where(~F.coalesce(condition, F.lit(False))))


def report(*rules: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, rules)


def antisymmetric(df: DataFrame, keys: list[str], a: str, b: str, value: str, tolerance: float = 1e-9) -> DataFrame:
    """Unordered pairs whose two directions do not cancel or of which one is missing."""
    both = df.groupBy(*keys, F.least(a, b).alias("_x"), F.greatest(a, b).alias("_y")).agg(F.sum(value).alias("_s"), F.count_distinct(a).alias("_n"))
    return _rule("antisymmetric", both.where((F.abs("_s") > tolerance) | (F.col("_n") != 2)))


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """added and removed rows, copies counted."""
    right = right.select(*left.columns)
    gone = left.exceptAll(right).agg(F.count("*").alias("removed"))
    return right.exceptAll(left).agg(F.count("*").alias("added")).crossJoin(gone)


def fingerprint(df: DataFrame, by: list[str]) -> DataFrame:
    """Hash of each partition's rows that does not depend on the order of rows or columns; whole doubles equal integers."""
    cols = []
    for f in sorted(df.schema, key=lambda f: f.name):
        if f.name not in by:
            c = F.col(f"`{f.name}`")
            if f.dataType.typeName() in ("float", "double"):
                whole = (c == F.floor(c)) & (F.abs(c) < 2.0**62)
                c = F.when(whole, c.try_cast("long").cast("string")).otherwise(c.cast("string"))
            cols.append(F.coalesce(c.cast("string"), F.lit("\0")))
    h = F.xxhash64(F.concat_ws("\1", *cols))
    return df.groupBy(*by).agg(F.count("*").alias("rows"), F.bit_xor(h).alias("xor"), F.sum(F.shiftright(h, 24)).alias("sum"))


def thresholds(*checks: tuple[str, DataFrame, Column, float | None, float | None]) -> DataFrame:
    """name, value, passed of (name, frame, aggregate, least, most) checks; a missing bound does not bind, a null value fails."""
    out = []
    for name, df, value, least, most in checks:
        one = df.agg(value.cast("double").alias("value"))
        ok = F.lit(True)
        for bound in ([F.col("value") >= least] if least is not None else []) + ([F.col("value") <= most] if most is not None else []):
            ok = ok & bound
        out.append(one.select(F.lit(name).alias("name"), "value", F.coalesce(F.col("value").isNotNull() & ok, F.lit(False)).alias("passed")))
    return reduce(DataFrame.unionByName, out)


def lost_partitions(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Partitions of ``before`` that ``after`` no longer has."""
    return before.select(*keys).distinct().join(after.select(*keys).distinct(), keys, "left_anti")


def freshness(rows: DataFrame, resource: str, t: str, limit: int) -> DataFrame:
    """row_count, age (seconds behind the newest row of all resources) and healthy (age at most ``limit``) of each resource."""
    seen = rows.groupBy(resource).agg(F.count("*").alias("row_count"), F.max(F.unix_micros(F.col(t).cast("timestamp"))).alias("_last"))
    newest = seen.agg(F.max("_last").alias("_newest"))
    aged = seen.crossJoin(F.broadcast(newest)).withColumn("age", F.floor((F.col("_newest") - F.col("_last")) / 1_000_000))  # one row
    return aged.select(resource, "row_count", "age", (F.col("age") <= limit).alias("healthy"))


def must(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """The frame, whose rows raise an error where a condition is not true."""
    return df.where(F.assert_true(F.coalesce(condition, F.lit(False)), F.lit(message)).isNull())


def unique_or_fail(df: DataFrame, keys: list[str]) -> DataFrame:
    """The frame, whose rows raise an error if a key occurs twice."""
    n = F.count("*").over(Window.partitionBy(*keys))
    return df.withColumn("_n", n).where(F.assert_true(F.col("_n") == 1, F.lit(f"{keys} not unique")).isNull()).drop("_n")


def contract(tables: dict[str, DataFrame], wanted: dict[str, dict[str, str]], partition: str, first: int, last: int) -> DataFrame:
    """A row for each required column (1 if it is missing or of another type) and table (rows of partitions out of range)."""
    out = []
    for name, columns in wanted.items():
        df = tables[name]
        kinds = dict(df.dtypes)
        one = df.sparkSession.range(1)
        out += [one.select(F.lit(f"{name}.{c}").alias("rule"), F.lit(int(kinds.get(c) != kind)).cast("long").alias("violations")) for c, kind in columns.items()]
        out.append(_rule(f"{name} partitions", df.where(~F.col(partition).between(first, last))))
    return report(*out)


def receipts(receipt: DataFrame, now: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rows, current (the partition's fingerprint is still that of its receipt) and receipts (how many it has)."""
    many = receipt.groupBy(*keys).agg(F.count("*").alias("receipts"), F.first("xor").alias("_x"), F.first("sum").alias("_s"), F.first("rows").alias("_r"))
    both = now.join(many, keys, "full_outer")
    same = (F.col("xor") == F.col("_x")) & (F.col("sum") == F.col("_s")) & (F.col("rows") == F.col("_r"))
    return both.select(*keys, F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce(same & (F.col("receipts") == 1), F.lit(False)).alias("current"), F.coalesce("receipts", F.lit(0)).alias("receipts"))


def reconciled(markers: DataFrame, events: DataFrame, by: str, ident: str, t: str, within: int) -> DataFrame:
    """starts, met, events, back and status of each group: markers and events that have one of the other at most ``within`` away."""

    def near(a: DataFrame, b: DataFrame) -> DataFrame:
        other = b.select(by, F.col(t).alias("_t")).withColumn("_b", F.explode(F.array(*[F.floor(F.col("_t") / within) + i for i in (-1, 0, 1)])))
        return a.withColumn("_b", F.floor(F.col(t) / within)).join(other, [by, "_b"]).where(F.abs(F.col(t) - F.col("_t")) <= within).select(ident).distinct().withColumn("_near", F.lit(True))

    def side(a: DataFrame, b: DataFrame, n: str, met: str) -> DataFrame:
        return a.join(near(a, b), ident, "left").groupBy(by).agg(F.count("*").alias(n), F.count("_near").alias(met))

    both = side(markers, events, "starts", "met").join(side(events, markers, "events", "back"), by, "full_outer")
    status = F.when(F.col("starts").isNull(), "no markers").when(F.col("events").isNull(), "no events").when(F.col("starts") > F.col("met"), "marker without event").when(F.col("events") > F.col("back"), "event without marker").otherwise("reconciled")
    return both.select(by, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("starts", "met", "events", "back")], status.alias("status"))


def validated(cases: DataFrame, covered: DataFrame, found: DataFrame, keys: list[str], at: str, found_at: str, within: int) -> DataFrame:
    """Cases with covered (the marts have their keys) and matched (something was found at most ``within`` away)."""
    seen = covered.select(*keys).distinct().withColumn("covered", F.lit(True))
    spread = found.select(*keys, F.explode(F.sequence(F.col(found_at) - within, F.col(found_at) + within)).alias(at)).distinct().withColumn("matched", F.lit(True))
    out = cases.join(seen, keys, "left").join(spread, [*keys, at], "left")
    return out.withColumns({"covered": F.coalesce("covered", F.lit(False)), "matched": F.coalesce("matched", F.lit(False))})


def medians_of_others(rows: DataFrame, group: list[str], value: str, out: str, peers: int) -> DataFrame:
    """group, value and ``out`` for each distinct value: the median of the group's values without one of that value; null with fewer than ``peers``.

    From the counts of distinct values alone, so that no row is paired or numbered: the k-th of the others is the value up to
    which more than k of them are counted.
    """
    c = running_counts(rows, group, value)
    upto, low, high = F.col("before") + F.col("times"), lambda n: F.floor((n - 1) / 2), lambda n: F.floor(n / 2)
    near = F.when((F.col("before") <= high(F.col("total") - 1) + 1) & (upto > low(F.col("total") - 1)), F.struct(upto.alias("upto"), F.col(value).alias("v")))
    middle = c.withColumn("_near", near).groupBy(*group).agg(F.array_sort(F.collect_list("_near")).alias("_m"), F.max("total").alias("_t"))  # at most three values
    none = middle.select(*group, F.lit(None).cast(rows.schema[value].dataType).alias(value), F.col("_t").alias("_n"))  # the others of a row without a value are all
    met = c.select(*group, value, (F.col("total") - 1).alias("_n")).unionByName(none).join(middle, group)
    pick = lambda k: F.get(F.filter("_m", lambda m: m["upto"] - F.when(m["v"] >= F.col(value), 1).otherwise(0) > k), F.lit(0))["v"]
    return met.select(*group, value, F.when(F.col("_n") >= peers, (pick(low(F.col("_n"))) + pick(high(F.col("_n")))) / 2).alias(out))
