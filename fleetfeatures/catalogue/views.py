"""Trip, route, weather, traffic, vehicle and driver views over the test tables.

The same SQL text makes the views in Spark and, as common table expressions,
in the check SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetfeatures.plans.clean import merge_date_hour
from fleetfeatures.session import use_utc

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
        "embeddings", "pages", "benchmark", "labels", "conversations"]

_WEATHER = """value AS temp, value / 10 AS wind_speed,
       CASE event_id % 3 WHEN 0 THEN 'Sunny' WHEN 1 THEN 'Cloudy' ELSE 'Rain' END AS description,
       0.0E0 AS precip, CAST(event_id % 100 AS DOUBLE) AS humidity,
       CAST(event_id % 10 AS DOUBLE) AS visibility, 1000.0E0 + event_id % 30 AS pressure,
       0 AS chanceofrain, 0 AS chanceoffog, 0 AS chanceofsnow, 0 AS chanceofthunder
FROM events"""

VIEWS = {
    "sched": """SELECT event_id AS rowindex, user_id AS truck_id, event_type AS route_id,
       CAST(ts AS TIMESTAMP) AS departure_date,
       date_trunc('hour', CAST(ts AS TIMESTAMP) + CAST(floor(value * 6) AS INT) * INTERVAL '1' MINUTE)
           AS estimated_arrival,
       CASE WHEN value > 50 THEN 1 ELSE 0 END AS delay
FROM events""",
    "routes": """SELECT route_id, CAST(rn AS INT) AS id, CAST((rn - 1) % 4 AS INT) AS origin_id,
       CAST((rn + 1) % 4 AS INT) AS destination_id, rn * 100.0E0 AS distance, rn * 2.0E0 AS average_hours
FROM (SELECT route_id, row_number() OVER (ORDER BY route_id) AS rn
      FROM (SELECT DISTINCT event_type AS route_id FROM events) d) r""",
    "cityw": f"""SELECT event_id AS rowindex, CAST(user_id % 4 AS INT) AS city_id,
       date_trunc('hour', CAST(ts AS TIMESTAMP)) AS date,
       {_WEATHER}""",
    "routew": f"""SELECT event_id AS rowindex, event_type AS route_id,
       date_trunc('day', CAST(ts AS TIMESTAMP)) + CAST(floor(hour(ts) / 6) * 6 AS INT) * INTERVAL '1' HOUR AS date,
       {_WEATHER}""",
    "traffic": """SELECT event_id AS rowindex, event_type AS route_id,
       CAST(CAST(ts AS DATE) AS STRING) AS date, CAST(hour(ts) * 100 AS INT) AS hour,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS no_of_vehicles,
       CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS accident
FROM events""",
    "trucks": """SELECT c_custkey AS truck_id, CAST(c_nationkey AS INT) AS truck_age,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 1000.0E0 * (3 + c_custkey % 20) END AS load_capacity_pounds,
       c_acctbal / 100 AS mileage_mpg,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS fuel_type
FROM customer""",
    "drivers": """SELECT s_suppkey AS driver_id, s_name AS name,
       CASE WHEN s_suppkey % 2 = 0 THEN 'male' ELSE 'female' END AS gender,
       CAST(25 + s_nationkey AS INT) AS age, s_acctbal / 500 AS experience,
       CASE WHEN s_suppkey % 3 = 0 THEN 'conservative' ELSE 'proactive' END AS driving_style,
       CAST(s_suppkey % 10 AS INT) AS ratings, s_suppkey AS vehicle_no,
       40.0E0 + s_suppkey % 25 AS average_speed_mph
FROM supplier""",
}

ORDER = {
    "city_weather": ["rowindex"],
    "routes_weather": ["rowindex"],
    "traffic_table": ["rowindex"],
    "truck_schedule_table": ["rowindex"],
    "routes_table": ["id"],
    "trucks_table": ["truck_id"],
    "drivers_table": ["driver_id"],
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return use_utc(spark).read.parquet(f"{folder}/{name}.parquet")


def _name_tables(spark: SparkSession, folder: str, names: list[str]) -> None:
    for base in ("events", "customer", "supplier"):
        if any(f"FROM {base}" in VIEWS[name] for name in names):
            table(spark, folder, base).createOrReplaceTempView(base)


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the views above."""
    _name_tables(spark, folder, [name])
    return spark.sql(VIEWS[name])


def trip_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The seven tables under their own names, traffic with its date and hour joined."""
    names = {"city_weather": "cityw", "drivers_table": "drivers", "routes_table": "routes",
             "routes_weather": "routew", "traffic_table": "traffic", "truck_schedule_table": "sched",
             "trucks_table": "trucks"}
    _name_tables(spark, folder, list(names.values()))
    tables = {name: spark.sql(VIEWS[short]) for name, short in names.items()}
    return {**tables, "traffic_table": merge_date_hour(tables["traffic_table"])}


def with_views(names: str, body: str) -> str:
    """Check SQL: the named views, then the statement (which may go on with further expressions)."""
    views = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names.split())
    return f"WITH {views}\n{body}"
