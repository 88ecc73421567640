"""Declared schemas of the seven raw tables, with a comment per column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
          "timestamp": T.TimestampType()}

_WEATHER = [
    ("temp", "double", "temperature, Fahrenheit"),
    ("wind_speed", "double", "wind speed, miles per hour"),
    ("description", "string", "weather in words, such as Sunny"),
    ("precip", "double", "precipitation, inches"),
    ("humidity", "double", "relative humidity, percent"),
    ("visibility", "double", "visibility, miles"),
    ("pressure", "double", "air pressure, millibars"),
    ("chanceofrain", "double", "chance of rain, percent"),
    ("chanceoffog", "double", "chance of fog, percent"),
    ("chanceofsnow", "double", "chance of snow, percent"),
    ("chanceofthunder", "double", "chance of thunder, percent"),
]

_COLUMNS = {
    "city_weather": [
        ("city_id", "string", "city the weather was observed in"),
        ("date", "string", "day of the observation"),
        ("hour", "int", "military hour of the observation, 0 to 2300"),
        *_WEATHER,
    ],
    "drivers_table": [
        ("driver_id", "string", "driver"),
        ("name", "string", "name of the driver"),
        ("gender", "string", "gender of the driver"),
        ("age", "int", "age, years"),
        ("experience", "double", "driving experience, years"),
        ("driving_style", "string", "conservative or proactive"),
        ("ratings", "int", "mean rating, 1 to 10"),
        ("vehicle_no", "bigint", "truck the driver drives"),
        ("average_speed_mph", "double", "mean speed, miles per hour"),
    ],
    "routes_table": [
        ("route_id", "string", "route"),
        ("origin_id", "string", "city the route starts in"),
        ("destination_id", "string", "city the route ends in"),
        ("distance", "double", "length, miles"),
        ("average_hours", "double", "usual travel time, hours"),
    ],
    "routes_weather": [
        ("route_id", "string", "route the weather was observed on"),
        ("Date", "timestamp", "start of the six-hour slot"),
        *_WEATHER,
    ],
    "traffic_table": [
        ("route_id", "string", "route"),
        ("date", "string", "day of the count"),
        ("hour", "int", "military hour of the count, 500 is 5 in the morning"),
        ("no_of_vehicles", "double", "vehicles on the route in that hour"),
        ("accident", "int", "1 if there was an accident, else 0"),
    ],
    "truck_schedule_table": [
        ("truck_id", "bigint", "truck"),
        ("route_id", "string", "route of the trip"),
        ("departure_date", "string", "departure"),
        ("estimated_arrival", "string", "planned arrival"),
        ("delay", "int", "1 if the trip was late, else 0"),
    ],
    "trucks_table": [
        ("truck_id", "bigint", "truck"),
        ("truck_age", "int", "age, years"),
        ("load_capacity_pounds", "double", "largest load, pounds; may be missing"),
        ("mileage_mpg", "double", "fuel efficiency, miles per gallon"),
        ("fuel_type", "string", "fuel the truck runs on"),
    ],
}


def table_schema(name: str) -> T.StructType:
    """The schema of one raw table."""
    schema = T.StructType()
    for column, kind, comment in _COLUMNS[name]:
        schema.add(column, _TYPES[kind], True, {"comment": comment})
    return schema


def column_comments(name: str) -> dict[str, str]:
    """Comment per column, also for the bookkeeping columns cleaning adds."""
    comments = {column: comment for column, _, comment in _COLUMNS[name]}
    comments.update({"rowindex": "row number", "eventtime": "time the record was made"})
    return comments


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column comments; saved tables keep them."""
    return df.select(*[F.col(c).alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(c)
                       for c in df.columns])
