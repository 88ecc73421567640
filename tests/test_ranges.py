"""Sums and counts over spans against their slots, on odd trips and facts."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_plans import plan_of

from fleetfeatures import catalogue
from fleetfeatures.catalogue.views import ORDER, trip_tables
from fleetfeatures.operators.ranges import NO_SLOT, exact, running_totals, signed_places, sums_over_spans
from fleetfeatures.plans import merge

catalogue.load()
_START = datetime(1969, 12, 30)


def _time(dice, step_minutes=17):
    return None if dice.random() < 0.06 else _START + timedelta(minutes=step_minutes * dice.randrange(900))


def _odd_tables(spark, seed):
    """Reversed and open spans, null keys, times before 1970, times off the grid, null dates, repeated facts and routes without facts."""
    dice = random.Random(seed)
    trips = [(dice.choice([1, 2, 3, None]), dice.choice(["a", "b", "c", "hot", "hot", None]), _time(dice), _time(dice), dice.randint(0, 1)) for _ in range(160)]
    weather = [(dice.choice(["a", "b", "hot", None]), dice.choice([None, _START + timedelta(hours=6 * dice.randrange(50), minutes=dice.choice([0, 0, 0, 30]))]),
                *[dice.choice([None, round(dice.uniform(-50, 50), 3)]) for _ in range(6)], dice.choice(["sun", "rain", "fog", None])) for _ in range(400)]
    traffic = [(dice.choice(["a", "b", "hot", None]), dice.choice([None, *[_START + timedelta(hours=dice.randrange(260), minutes=dice.choice([0, 0, 0, 20]))] * 9]),
                dice.choice([None, 0.1, 1e9 + 0.25, float(dice.randrange(1000))]), dice.choice([0, 0, 0, 1, None])) for _ in range(900)]
    measures = "temp wind_speed precip humidity visibility pressure".split()
    return {
        "truck_schedule_table": spark.createDataFrame(trips, "truck_id int, route_id string, departure_date timestamp, estimated_arrival timestamp, delay int"),
        "routes_weather": spark.createDataFrame(weather, f"route_id string, date timestamp, {', '.join(f'{m} double' for m in measures)}, description string"),
        "traffic_table": spark.createDataFrame(traffic, "route_id string, date timestamp, no_of_vehicles double, accident int")}


def _rows(df):
    rounded = df.select(*[F.round(F.col(c) + 1.3e-4, 3).alias(c) if t == "double" else F.col(c) for c, t in sorted(df.dtypes)])
    return sorted(map(tuple, rounded.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ranges_equal_slots(spark, seed):
    tables = _odd_tables(spark, seed)
    assert _rows(merge.route_weather_per_pair_by_range(tables)) == _rows(merge.route_weather_per_pair(tables))
    assert _rows(merge.traffic_per_pair_by_range(tables)) == _rows(merge.traffic_per_pair(tables)) == _rows(merge.traffic_per_pair_by_rows(tables))


def test_no_trips_and_no_facts(spark):
    tables = _odd_tables(spark, 4)
    for gone in ("truck_schedule_table", "routes_weather", "traffic_table"):
        less = {n: df.limit(0) if n == gone else df for n, df in tables.items()}
        assert _rows(merge.route_weather_per_pair_by_range(less)) == _rows(merge.route_weather_per_pair(less))
        assert _rows(merge.traffic_per_pair_by_range(less)) == _rows(merge.traffic_per_pair(less))


def test_large_totals_lose_nothing(spark):
    """A span of one small fact behind a running total of 10^15."""
    facts = spark.createDataFrame([("r", 1, 1e15), ("r", 2, 0.1), ("r", 3, 1e15)], "k string, slot long, v double").select("k", "slot", exact("v").alias("v"))
    spans = spark.createDataFrame([(7, "r", 2, 2)], "o int, k string, a long, b long")
    signed = signed_places(spans, ["o", "k"], F.col("a"), F.col("b"))
    assert [float(r.v) for r in sums_over_spans(signed, facts, ["o", "k"], ["k"], ["v"]).collect()] == [0.1]
    with pytest.raises(Exception, match="too large"):
        spark.createDataFrame([(1e19,)], "v double").select(exact("v")).collect()
    assert spark.createDataFrame([(float("nan"),), (None,)], "v double").select(exact("v").alias("v")).where("v IS NOT NULL").count() == 0


def test_places_of_one_owner_are_added_up(spark):
    spans = spark.createDataFrame([(1, 1, 4), (1, 5, 9), (1, 5, 9), (1, 6, 5), (1, None, 3), (None, 1, 2)], "o int, a long, b long")
    first, last = (F.coalesce(F.col(c), F.lit(NO_SLOT)) for c in "ab")
    got = {r.slot: r.sign for r in signed_places(spans, ["o"], first, last).collect()}
    assert got == {0: -1, 4: -1, 9: 2, NO_SLOT: 2}
    facts = spark.createDataFrame([(1, 3, 2), (1, NO_SLOT, 5)], "k int, slot long, n long")
    places = spark.createDataFrame([(1, 9), (2, 1)], "k int, slot long")
    assert {tuple(r) for r in running_totals(facts, places, ["k"], ["n"]).collect()} == {(1, NO_SLOT, 5), (1, 3, 7), (1, 9, 7), (2, 1, 0)}


@pytest.mark.parametrize("name", ["traffic_by_range", "weather_by_range"])
def test_no_row_per_slot(spark, sf, name):
    plan = plan_of(catalogue.QUERIES[name](spark, sf), "simple")
    for bad in ("Generate", "CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert bad not in plan


def test_shuffled_rows_follow_trips_not_hours(spark):
    """Ten times longer trips shuffle no more rows (a row per hour would shuffle ten times more)."""
    def shuffled(hours):
        trips = spark.range(2000).select(F.col("id").alias("truck_id"), (F.col("id") % 7).alias("route_id"),
                                         (F.lit("2020-01-01").cast("timestamp") + F.make_interval(hours=(F.col("id") % 50).cast("int"))).alias("departure_date"))
        trips = trips.withColumn("estimated_arrival", F.col("departure_date") + F.make_interval(hours=F.lit(hours)))
        facts = spark.range(700).select((F.col("id") % 7).alias("route_id"), (F.lit("2020-01-01").cast("timestamp") + F.make_interval(hours=F.col("id").cast("int"))).alias("date"),
                                        F.lit(1.0).alias("no_of_vehicles"), F.lit(0).alias("accident"))
        df = merge.traffic_per_pair_by_range({"truck_schedule_table": trips, "traffic_table": facts})
        df.collect()
        node, total = df._jdf.queryExecution().executedPlan(), 0
        todo = [node]
        while todo:
            n = todo.pop()
            if n.nodeName() == "AdaptiveSparkPlan":
                todo.append(n.executedPlan())
                continue
            if "QueryStage" in n.nodeName():
                todo.append(n.plan())
                continue
            metrics = n.metrics()
            if n.nodeName() == "Exchange" and metrics.contains("shuffleRecordsWritten"):
                total += metrics.apply("shuffleRecordsWritten").value()
            todo += [n.children().apply(i) for i in range(n.children().size())]
        return total
    short, long = shuffled(5), shuffled(50)
    assert 0 < long <= 1.3 * short
