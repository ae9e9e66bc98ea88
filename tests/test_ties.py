"""Rows of one time, intervals shorter than a second and keys of many digits."""

import datetime

import duckdb
import pytest

from chronolith.operators import joins as J
from chronolith.plans import basics, reports, small  # noqa: F401  they register their queries
from chronolith.plans.registry import ORACLE, QUERIES


def test_asof_takes_values_of_one_time_in_order(spark):
    left = spark.createDataFrame([("k", 5, "a"), ("k", 1, "b")], "k string, t long, n string")
    for values in ([3.0, 9.0, 4.0], [9.0, 4.0, 3.0], [4.0, 3.0, 9.0]):
        right = spark.createDataFrame([("k", 2, v) for v in values], "k string, t long, v double").coalesce(1)
        got = {r["n"]: r["v"] for r in J.asof(left, right, ["k"], "t", ["v"], or_first=True).collect()}
        assert got == {"a": 9.0, "b": 3.0}


DAY = datetime.datetime(2024, 1, 1)
EVENTS = [  # user, second, type, value; a second is given to fractions
    (1, 100.0, "click", 5.0), (1, 100.2, "click", 9.0), (1, 100.4, "click", 7.0), (1, 90.0, "view", 0.0), (1, 130.0, "view", 0.0),
    (2, 200.0, "error", 1.0), (2, 200.6, "signup", 4.0), (2, 200.8, "view", 2.0), (2, 200.9, "view", 6.0), (2, 201.0, "error", 1.0), (2, 201.0, "signup", 1.0), (2, 300.0, "error", 1.0),
]


def both(spark, tmp_path, name, table, sql):
    duck = duckdb.connect()
    duck.execute("set timezone = 'UTC'")
    duck.execute(f"create table {table} as {sql}")
    duck.execute(f"copy {table} to '{tmp_path}/{table}.parquet' (format parquet)")
    got = QUERIES[name](spark, str(tmp_path))
    out = duck.execute(ORACLE[name])
    names = [c[0] for c in out.description]
    want = sorted((dict(zip(names, r, strict=True)) for r in out.fetchall()), key=str)
    return [r for r in sorted(({n: r[n] for n in names} for r in got.collect()), key=str)], want


@pytest.mark.parametrize("name", ["jn16_asof", "jn17_snapshot", "jn18_hold", "jn31_asof_or_first", "ca54_marker_intervals"])
def test_events_of_one_second(spark, tmp_path, name):
    rows = ", ".join(f"({i}, TIMESTAMP '{DAY + datetime.timedelta(seconds=s)}', {u}, '{e}', CAST({v} AS DOUBLE))" for i, (u, s, e, v) in enumerate(EVENTS))
    got, want = both(spark, tmp_path, name, "events", f"select cast(i as bigint) as event_id, ts, cast(u as bigint) as user_id, e as event_type, v as value from (values {rows}) as t(i, ts, u, e, v)")
    assert got == want
    if name == "jn31_asof_or_first":
        assert {r["event_id"]: r["clicked"] for r in got if r["event_id"] in (3, 4)} == {3: 5.0, 4: 9.0}
    if name == "ca54_marker_intervals":  # one of 0.6 s stays, one of no length goes, one without an end stays
        base = int(DAY.replace(tzinfo=datetime.timezone.utc).timestamp())
        assert sorted((r["start"] - base, r["end"] and r["end"] - base) for r in got) == [(200, 200), (300, None)]


def test_ids_of_more_than_four_digits(spark, tmp_path):
    sql = "select cast(k as bigint) as l_orderkey, cast(1 as bigint) as l_linenumber, cast(k as bigint) as l_suppkey, cast(1 as bigint) as l_partkey, DATE '2024-02-01' as l_shipdate, 0.05 as l_tax, 0.05 as l_discount, 1.0 as l_quantity, 10.0 as l_extendedprice from (values (7), (12345), (12346)) as t(k)"
    got, want = both(spark, tmp_path, "sc17_ids", "lineitem", sql)
    assert got == want == [{"id": "2024-R01-B0007"}, {"id": "2024-R01-B12345"}, {"id": "2024-R01-B12346"}]
