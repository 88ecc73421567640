"""The physical plans: what reaches the scan, what must not occur."""

import re

import pytest

from fleetfeatures import catalogue
from fleetfeatures.catalogue.views import ORDER, trip_tables
from fleetfeatures.plans import merge

catalogue.load()


def plan_of(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def test_date_bounds_and_columns_reach_the_scan(spark, sf):
    plan = plan_of(catalogue.QUERIES["filter_dates"](spark, sf))
    assert "GreaterThanOrEqual(ts," in plan and "LessThanOrEqual(ts," in plan
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>", plan)


def test_outlier_bounds_reach_the_scan(spark, sf):
    plan = plan_of(catalogue.QUERIES["iqr_outliers"](spark, sf))
    assert "GreaterThanOrEqual(l_extendedprice," in plan and "LessThanOrEqual(l_quantity," in plan
    assert "l_comment" not in plan and "l_tax" not in plan


def test_duplicates_are_cut_before_the_shuffle(spark, sf):
    plan = plan_of(catalogue.QUERIES["dedupe_first"](spark, sf), "simple")
    final, partial = plan.index("1, Final"), plan.index("1, Partial")
    assert final < plan.index("Exchange hashpartitioning") < partial


def test_slots_need_no_shuffle(spark, sf):
    for name in ("slots_6h", "slots_1h"):
        assert "Exchange" not in plan_of(catalogue.QUERIES[name](spark, sf), "simple")


def test_traffic_slots_carry_only_keys(spark, sf):
    tables = merge.prepare_tables(trip_tables(spark, sf), ORDER)
    plan = plan_of(merge.traffic_per_pair(tables), "simple")
    generate = next(line for line in plan.splitlines() if "Generate explode" in line)
    assert re.search(r"\[truck_id#\d+L?, route_id#\d+\], true", generate)


@pytest.mark.parametrize("name", ["route_weather", "traffic_on_route", "city_weather_both", "vehicle_driver",
                                  "merge_back", "dup_rows", "class_report", "upsert_latest", "histogram20", "wide_trips", "slot_traffic",
                                  "iqr_outliers", "upsert_buckets", "one_hot_wide", "csv_mixed_headers", "stratified_folds"])
def test_no_python_rows_and_no_all_pairs_join(spark, sf, name):
    plan = plan_of(catalogue.QUERIES[name](spark, sf), "simple")
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas", "InArrow"):
        assert bad not in plan


def test_the_schedule_is_deduplicated_once(spark, sf):
    tables = merge.prepare_tables(trip_tables(spark, sf), ORDER)
    spine = merge.trips_on_one_spine(tables)
    spine.collect()
    final = plan_of(spine).split("Initial Plan")[0]
    assert "ReusedExchange" in final


def test_distinct_counts_repeat_no_rows(spark, sf):
    plan = plan_of(catalogue.QUERIES["distinct_counts"](spark, sf), "simple")
    assert "Expand" not in plan and "Generate" not in plan
