"""Laps are dealt once, to more tasks where the table has more rows."""

import pytest
from pyspark.sql import functions as F

from chronolith.plans import basics, bindings, replays, small  # noqa: F401  they register their queries
from chronolith.plans.registry import QUERIES


@pytest.fixture
def lineitem(spark, tmp_path):
    k = F.col("id")
    day = F.date_add(F.lit("1996-01-01").cast("date"), (k % 180).cast("int")).cast("timestamp")
    rows = spark.range(4_000).select(k.alias("l_orderkey"), (k % 50).alias("l_suppkey"), k.alias("l_partkey"), F.lit(1).alias("l_linenumber"), (1.0 + k % 50).alias("l_quantity"), F.lit(9.0).alias("l_extendedprice"), ((k % 11) / 100).alias("l_discount"), ((k % 9) / 100).alias("l_tax"), day.alias("l_shipdate"))
    rows.write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["b_laps", "b_timed"])
def test_tasks_grow_with_the_rows(spark, lineitem, monkeypatch, name):
    monkeypatch.setattr(bindings, "TASK_ROWS", 100)
    assert bindings.view(spark, lineitem, name).rdd.getNumPartitions() == 40


@pytest.mark.parametrize("name", ["pr08_representative", "jn08_band", "ag22_tick_collapse"])
def test_one_shuffle_of_each_reading(spark, lineitem, monkeypatch, name):
    monkeypatch.setattr(bindings, "TASK_ROWS", 100)
    df = QUERIES[name](spark, lineitem)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(season") == plan.count("FileScan parquet")
    assert df.count() > 0
