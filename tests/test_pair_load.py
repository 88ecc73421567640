"""Joins whose result is far larger than their input: dealt by the pairs they make, not by the bytes they read."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from fleetfeatures import catalogue
from fleetfeatures.operators.joins import join_on, pair_load

catalogue.load()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
@pytest.mark.parametrize("salted", [False, True])
def test_dealt_joins_are_the_joined_rows(spark, how, salted):
    left = spark.createDataFrame([(k, h, i) for k, n in ((1, 9), (2, 3), (None, 4), (7, 2)) for h in ("a", None) for i in range(n)] * 2, "k int, h string, n int")
    right = spark.createDataFrame([(k, h, i) for k, n in ((1, 5), (2, 2), (None, 3), (8, 2)) for h in ("a", None) for i in range(n)], "k bigint, g string, m int")
    on = ["k", ("h", "g")]
    load = pair_load(left, right, on, "left", task_pairs=20, share=0.05, rows_to_salt=8)
    assert pair_load(left, right, on, "left", task_pairs=20, share=0.05) == {"parts": 13, "hot": []}
    assert load["parts"] == 13 and len(load["hot"]) == 4
    plain = join_on(left, right, on, how)
    dealt = join_on(left, right, on, how, parts=load["parts"], hot=load["hot"] if salted else ())
    assert dealt.columns == plain.columns
    assert Counter(map(tuple, dealt.collect())) == Counter(map(tuple, plain.collect()))


def test_pairs_are_counted_with_rows_that_find_none(spark):
    left = spark.createDataFrame([(1,)] * 6 + [(None,)] * 5 + [(3,)] * 4, "k int")
    right = spark.createDataFrame([(1,)] * 5 + [(None,)] * 2, "k int")
    cores = spark.sparkContext.defaultParallelism
    assert pair_load(left, right, ["k"], "left", task_pairs=43) == {"parts": cores, "hot": []}
    assert pair_load(left, right, ["k"], "left", task_pairs=44) == {"parts": 0, "hot": []}
    assert pair_load(left, right, ["k"], "inner", task_pairs=40) == {"parts": 0, "hot": []}
    assert pair_load(left, right, ["k"], "inner", task_pairs=1)["parts"] == max(cores, 40)
    assert pair_load(left.limit(0), right, ["k"]) == {"parts": 0, "hot": []}


SUMS = {
    "slot_traffic": ["count(*)", "count(date)", "sum(truck_id)", "sum(no_of_vehicles * (truck_id % 10))", "sum(accident)"],
    "suffix_rename": ["count(*)", "sum(rowindex_origin)", "sum(rowindex_destination)", "sum(temp_origin * (rowindex_destination % 10))"],
}


@pytest.mark.parametrize("query, rows, hours", [("slot_traffic", 12_000, 24), ("suffix_rename", 30_000, 24), ("suffix_rename", 9_000, 1)])
def test_no_task_makes_most_of_the_pairs(spark, tmp_path, query, rows, hours):
    con = duckdb.connect()
    no_route = "i % 1999 = 0" if query == "slot_traffic" else "false"  # the views number a null route first here, last in DuckDB
    con.execute(f"""COPY (SELECT i AS event_id, TIMESTAMP '2024-01-01 00:00:01' + to_microseconds(i * {hours * 3_590_000_000 // rows}) AS ts,
        i AS user_id, CASE WHEN {no_route} THEN NULL ELSE ['click', 'view', 'error', 'signup'][(i * 7) % 11 % 4 + 1] END AS event_type,
        CAST((i * 7907) % 7_000 AS DOUBLE) / 100 AS value, '' AS props FROM range({rows}) t(i)) TO '{tmp_path}/events.parquet' (FORMAT parquet)""")
    for name, columns in (("customer", "1::BIGINT c_custkey, 'c' c_name, 1::BIGINT c_nationkey, 1.0::DOUBLE c_acctbal, 'm' c_mktsegment"),
                          ("supplier", "1::BIGINT s_suppkey, 's' s_name, 1::BIGINT s_nationkey, 1.0::DOUBLE s_acctbal")):
        con.execute(f"COPY (SELECT {columns}) TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
    for name in ("events", "customer", "supplier"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet'")
    sums = SUMS[query]
    expected = con.execute(f"SELECT route_id, {', '.join(sums)} FROM ({catalogue.ORACLES[query]}) GROUP BY 1").fetchall()
    out = catalogue.QUERIES[query](spark, str(tmp_path))
    parts = out.groupBy("route_id", F.spark_partition_id().alias("part")).agg(*[F.expr(s).alias(f"s{i}") for i, s in enumerate(sums)]).collect()
    found, made = {}, Counter()
    for route, part, *values in parts:
        found[route] = [a + (b or 0) for a, b in zip(found.get(route, [0] * len(sums)), values)]
        made[part] += values[0]
    assert found.keys() == {r[0] for r in expected}
    for route, *theirs in expected:
        assert found[route] == pytest.approx([v or 0 for v in theirs], rel=1e-9)
    assert sum(made.values()) > 5_000_000 and max(made.values()) < 0.5 * sum(made.values())
