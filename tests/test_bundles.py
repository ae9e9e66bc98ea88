"""Publication of bundles: turns, receipts and failed loads."""

import pytest
from pyspark.sql import functions as F

from chronolith.sources import bundles as B


def frames(spark, n):
    return {"a": spark.range(n).withColumn("v", F.col("id") % 3), "b": spark.createDataFrame([(str(i), float(i)) for i in range(n)], "k string, x double")}


def test_two_writers_on_one_turn(spark, tmp_path):
    root = f"file://{tmp_path}/x"
    assert B.current(spark, root) == (0, None)
    base = B.write(frames(spark, 3), root, base=0)
    assert base == 1
    assert B.write(frames(spark, 4), root, base=base) == 2
    with pytest.raises(B.TurnTakenError):  # the second writer began from the turn that the first one replaced
        B.write(frames(spark, 5), root, base=base)
    assert B.read(spark, root)["a"].count() == 4
    assert B.write(frames(spark, 6), root) == 3


def test_a_claimed_turn_is_lost_or_passed_over(spark, tmp_path):
    root = f"file://{tmp_path}/x"
    B.write(frames(spark, 3), root)
    assert B._created(spark, f"{root}/turns/{2:012d}") and not B._created(spark, f"{root}/turns/{2:012d}")
    with pytest.raises(B.TurnTakenError):  # someone has claimed the turn and has not published yet
        B.write(frames(spark, 4), root, base=1)
    assert B.read(spark, root)["a"].count() == 3
    assert B.write(frames(spark, 5), root) == 3 and B.read(spark, root)["a"].count() == 5


def test_a_failed_load_changes_nothing(spark, tmp_path):
    root = f"file://{tmp_path}/x"
    B.write(frames(spark, 3), root)
    bad = frames(spark, 9) | {"b": spark.range(4).select(F.assert_true(F.col("id") < 2).isNull().alias("k"))}
    with pytest.raises(Exception):  # noqa: B017  whatever the load raises
        B.write(bad, root)
    assert {n: t.count() for n, t in B.read(spark, root).items()} == {"a": 3, "b": 3}


def test_receipts_find_changes(spark, tmp_path):
    root = f"file://{tmp_path}/x"
    B.write(frames(spark, 3), root)
    assert {r["name"]: (r["rows"], r["valid"]) for r in B.checked(spark, root).collect()} == {"a": (3, True), "b": (3, True)}
    version = B.current(spark, root)[1]
    frames(spark, 3)["b"].withColumn("x", F.col("x") + 1).write.mode("overwrite").parquet(f"{root}/{version}/b")
    with pytest.raises(ValueError, match="b differ"):
        B.read(spark, root)
    assert B.read(spark, root, verify=False)["b"].count() == 3


def test_fingerprints(spark):
    one = spark.createDataFrame([(1, None, [1, 2]), (2, "x", None), (2, "x", None)], "a long, b string, c array<int>")
    said = lambda df: tuple(B.fingerprint("t", df).first())
    assert said(one) == said(one.repartition(3).select("c", "a", "b"))
    assert said(one) != said(one.distinct()) and said(one) != said(one.withColumnRenamed("b", "d"))
    assert said(one.where("false")) == ("t", 0, "0")
