"""Queries on slots, joins and the wide table (G, J, A1, A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetfeatures.catalogue import register
from fleetfeatures.catalogue.shaping import plain_times, rounded
from fleetfeatures.catalogue.sqltext import (
    A1_ROUNDED,
    MERGE_STEPS,
    MERGE_VIEWS,
    VEHICLES_ROUNDED,
    sql_ceil_six,
    sql_floor_six,
    sql_round_hour,
)
from fleetfeatures.catalogue.views import ORDER, trip_tables, view, with_views
from fleetfeatures.operators.joins import join_on, pair_load
from fleetfeatures.operators.slots import hourly_slots, six_hour_slots
from fleetfeatures.plans import merge

_ROUTE_MEANS = [f"route_avg_{m}" for m in ("temp", "wind_speed", "precip", "humidity", "visibility", "pressure")]


def _prepared(spark: SparkSession, folder: str):
    return merge.prepare_tables(trip_tables(spark, folder), ORDER)


@register("slots_6h", with_views("sched", f"""
SELECT s.rowindex, s.truck_id, s.route_id, s.delay, {sql_floor_six('departure_date')} AS departure_date,
       {sql_ceil_six('estimated_arrival')} AS estimated_arrival, g.date
FROM sched s LEFT JOIN LATERAL (SELECT unnest(generate_series({sql_floor_six('s.departure_date')},
     {sql_ceil_six('s.estimated_arrival')}, INTERVAL '6' HOUR)) AS date) g ON true"""))
def slots_6h(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(six_hour_slots(view(spark, folder, "sched")))


@register("slots_1h", with_views("sched", f"""
SELECT s.rowindex, s.truck_id, s.route_id, s.delay, {sql_round_hour('departure_date')} AS departure_date,
       {sql_round_hour('estimated_arrival')} AS estimated_arrival, g.custom_date
FROM sched s LEFT JOIN LATERAL (SELECT unnest(generate_series({sql_round_hour('s.departure_date')},
     {sql_round_hour('s.estimated_arrival')}, INTERVAL '1' HOUR)) AS custom_date) g ON true"""))
def slots_1h(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(hourly_slots(merge.round_trip_times(view(spark, folder, "sched"))))


@register("slot_weather", with_views(MERGE_VIEWS, MERGE_STEPS + """
SELECT p.*, w.* EXCLUDE (route_id, date) FROM slots6 p LEFT JOIN rw w
ON p.route_id IS NOT DISTINCT FROM w.route_id AND p.date IS NOT DISTINCT FROM w.date"""))
def slot_weather(spark: SparkSession, folder: str) -> DataFrame:
    tables = _prepared(spark, folder)
    slots = six_hour_slots(tables["truck_schedule_table"])
    return plain_times(merge.join_route_weather(slots, tables["routes_weather"]))


@register("route_weather", with_views(MERGE_VIEWS, MERGE_STEPS + f"""
SELECT s.*, {A1_ROUNDED}, a1.route_description FROM s LEFT JOIN a1
ON s.truck_id IS NOT DISTINCT FROM a1.truck_id AND s.route_id IS NOT DISTINCT FROM a1.route_id"""))
def route_weather(spark: SparkSession, folder: str) -> DataFrame:
    tables = _prepared(spark, folder)
    return plain_times(rounded(merge.trips_with_route_weather(tables), _ROUTE_MEANS))


@register("weather_by_range", with_views(MERGE_VIEWS, MERGE_STEPS + f"""
SELECT s.*, {A1_ROUNDED}, a1.route_description FROM s LEFT JOIN a1
ON s.truck_id IS NOT DISTINCT FROM a1.truck_id AND s.route_id IS NOT DISTINCT FROM a1.route_id"""))
def weather_by_range(spark: SparkSession, folder: str) -> DataFrame:
    tables = _prepared(spark, folder)
    return plain_times(rounded(merge.trips_with_route_weather(tables, by_range=True), _ROUTE_MEANS))


@register("trips_with_routes", with_views(MERGE_VIEWS, MERGE_STEPS + f"""
SELECT s.*, {sql_round_hour('estimated_arrival')} AS estimated_arrival_nearest_hour,
       {sql_round_hour('departure_date')} AS departure_date_nearest_hour, r.* EXCLUDE (route_id)
FROM s LEFT JOIN r ON s.route_id IS NOT DISTINCT FROM r.route_id"""))
def trips_with_routes(spark: SparkSession, folder: str) -> DataFrame:
    tables = _prepared(spark, folder)
    trips = merge.add_nearest_hours(tables["truck_schedule_table"])
    return plain_times(join_on(trips, tables["routes_table"], ["route_id"]))


@register("city_weather_both", with_views(MERGE_VIEWS, MERGE_STEPS + "SELECT * FROM ends"))
def city_weather_both(spark: SparkSession, folder: str) -> DataFrame:
    tables = _prepared(spark, folder)
    return plain_times(merge.trips_with_city_weather(tables))


@register("slot_traffic", with_views(MERGE_VIEWS, MERGE_STEPS + """
SELECT truck_id, route_id, custom_date, date, no_of_vehicles, accident FROM slott"""))
def slot_traffic(spark: SparkSession, folder: str) -> DataFrame:
    tables = _prepared(spark, folder)
    hours = hourly_slots(merge.round_trip_times(tables["truck_schedule_table"])).select(
        "truck_id", "route_id", "custom_date")
    # times are put out before the join: it makes a row per slot and traffic row of a route and hour
    hours, traffic = plain_times(hours), plain_times(tables["traffic_table"])
    return merge.join_traffic(hours, traffic, **pair_load(hours, traffic, merge.TRAFFIC_KEYS))


@register("traffic_on_route", with_views(MERGE_VIEWS, MERGE_STEPS + f"""
SELECT s.*, {VEHICLES_ROUNDED}, accident FROM s LEFT JOIN a2
ON s.truck_id IS NOT DISTINCT FROM a2.truck_id AND s.route_id IS NOT DISTINCT FROM a2.route_id"""))
def traffic_on_route(spark: SparkSession, folder: str) -> DataFrame:
    tables = _prepared(spark, folder)
    return plain_times(rounded(merge.trips_with_traffic(tables), ["avg_no_of_vehicles"]))


@register("traffic_by_range", with_views(MERGE_VIEWS, MERGE_STEPS + f"""
SELECT s.*, {VEHICLES_ROUNDED}, accident FROM s LEFT JOIN a2
ON s.truck_id IS NOT DISTINCT FROM a2.truck_id AND s.route_id IS NOT DISTINCT FROM a2.route_id"""))
def traffic_by_range(spark: SparkSession, folder: str) -> DataFrame:
    tables = _prepared(spark, folder)
    return plain_times(rounded(merge.trips_with_traffic(tables, by_range=True), ["avg_no_of_vehicles"]))


@register("merge_back", with_views(MERGE_VIEWS, MERGE_STEPS + f"""
SELECT ends.*, {A1_ROUNDED}, a1.route_description, {VEHICLES_ROUNDED}, a2.accident
FROM ends LEFT JOIN a1 ON ends.truck_id = a1.truck_id AND ends.route_id = a1.route_id
LEFT JOIN a2 ON ends.truck_id = a2.truck_id AND ends.route_id = a2.route_id"""))
def merge_back(spark: SparkSession, folder: str) -> DataFrame:
    tables = _prepared(spark, folder)
    return plain_times(rounded(merge.merge_back(tables), [*_ROUTE_MEANS, "avg_no_of_vehicles"]))


@register("vehicle_driver", with_views(MERGE_VIEWS, MERGE_STEPS + """
SELECT s.*, t.* EXCLUDE (truck_id), d.* FROM s
LEFT JOIN trucks t ON s.truck_id IS NOT DISTINCT FROM t.truck_id
LEFT JOIN drivers d ON s.truck_id IS NOT DISTINCT FROM d.vehicle_no"""))
def vehicle_driver(spark: SparkSession, folder: str) -> DataFrame:
    tables = _prepared(spark, folder)
    return plain_times(merge.add_vehicle_and_driver(tables["truck_schedule_table"], tables))


_WIDE_SQL = MERGE_STEPS + f""",
w AS (SELECT ends.* EXCLUDE (city_id_origin, city_id_destination, custom_date_origin, custom_date_destination),
  {A1_ROUNDED}, a1.route_description, {VEHICLES_ROUNDED}, a2.accident,
  t.* EXCLUDE (truck_id), d.*,
  CAST(CASE WHEN CAST(departure_date AS DATE) <> CAST(estimated_arrival AS DATE) THEN 1 ELSE 0 END AS INT) AS is_midnight
FROM ends LEFT JOIN a1 ON ends.truck_id = a1.truck_id AND ends.route_id = a1.route_id
LEFT JOIN a2 ON ends.truck_id = a2.truck_id AND ends.route_id = a2.route_id
LEFT JOIN trucks t ON ends.truck_id = t.truck_id
LEFT JOIN drivers d ON ends.truck_id = d.vehicle_no),
n AS (SELECT *, row_number() OVER (ORDER BY departure_date, truck_id, route_id, origin_id, destination_id,
             driver_id) - 1 AS unique_id FROM w)
"""
_WIDE_ROWS = "SELECT *, TIMESTAMP '2024-10-08 00:00:00' AS event_time FROM n"


ROUNDED = [*_ROUTE_MEANS, "avg_no_of_vehicles"]


def _wide(spark: SparkSession, folder: str, **options) -> DataFrame:
    wide = merge.wide_trips(trip_tables(spark, folder), ORDER, **options)
    return plain_times(rounded(wide, ROUNDED))


@register("wide_trips_with_nulls", with_views(MERGE_VIEWS, _WIDE_SQL + _WIDE_ROWS))
def wide_trips_with_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return _wide(spark, folder, drop_nulls=False)


_COMPLETE = """
WHERE temp_origin IS NOT NULL AND temp_destination IS NOT NULL AND avg_no_of_vehicles IS NOT NULL
  AND route_avg_temp IS NOT NULL AND load_capacity_pounds IS NOT NULL AND fuel_type IS NOT NULL
  AND truck_age IS NOT NULL AND driver_id IS NOT NULL AND distance IS NOT NULL"""
#: Steps of check SQL up to ``wide``, the wide table, to be gone on with.
WIDE_STEPS = f"{_WIDE_SQL.rstrip()},\nwide AS ({_WIDE_ROWS}{_COMPLETE})\n"


@register("wide_trips", with_views(MERGE_VIEWS, WIDE_STEPS + "SELECT * FROM wide"))
def wide_trips(spark: SparkSession, folder: str) -> DataFrame:
    return _wide(spark, folder)
