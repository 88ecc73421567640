"""Joins that make very many rows: what can be done once per input row is done before them."""

from __future__ import annotations

from datetime import datetime

import __spark_entry__


def test_slot_traffic_times_are_put_out_before_the_join(spark, tmp_path):
    """A row per slot and traffic row of its route and hour: converting times after the join does so once per pair."""
    at = datetime(2024, 1, 1, 10, 5)
    rows = [(i, at, 1 + i % 2, "r", 100.0 * (i % 2), "{}") for i in range(4)] + [(4, None, None, None, None, None)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(
        str(tmp_path / "events.parquet"))
    for name, kinds in (("customer", "c_custkey long, c_name string, c_nationkey long, c_acctbal double, c_mktsegment string"),
                        ("supplier", "s_suppkey long, s_name string, s_nationkey long, s_acctbal double")):
        spark.createDataFrame([], kinds).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = __spark_entry__.queries()["slot_traffic"](spark, str(tmp_path))
    hours = {(1, 10): 4, (2, 10): 4, (2, 11): 0, (2, 20): 0}
    seen = [(r.truck_id, r.custom_date.hour) for r in found.where("truck_id IS NOT NULL AND date IS NOT NULL").collect()]
    assert {k: seen.count(k) for k in hours} == hours
    assert dict(found.dtypes)["custom_date"] == dict(found.dtypes)["date"] == "timestamp_ntz"
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("\n")
    join = next(i for i, line in enumerate(plan) if "Join" in line)
    assert not any("as timestamp_ntz" in line for line in plan[:join]) and any("as timestamp_ntz" in line for line in plan[join:])
