"""One row per time slot of a trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetfeatures.functions.timegrid import as_utc, ceil_six_hours, floor_six_hours


def slots_between(start: Column, end: Column, hours: int) -> Column:
    """All slot starts from ``start`` to ``end`` inclusive; null if reversed or open."""
    return F.when(start <= end, F.sequence(start, end, F.expr(f"INTERVAL '{hours}' HOUR")))


def six_hour_slots(df: DataFrame, arrival: str = "estimated_arrival", departure: str = "departure_date",
                   slot: str = "date") -> DataFrame:
    """G1: a row per six-hour slot from the floored departure to the ceiled arrival.

    Both trip times are replaced by their floored and ceiled values. A reversed
    or open span keeps one row with a null slot.
    """
    bounds = df.withColumns({departure: floor_six_hours(departure), arrival: ceil_six_hours(arrival)})
    return bounds.withColumn(slot, F.explode_outer(slots_between(F.col(departure), F.col(arrival), 6)))


def hourly_slots(df: DataFrame, departure: str = "departure_date", arrival: str = "estimated_arrival",
                 slot: str = "custom_date") -> DataFrame:
    """A row per hour from departure to arrival inclusive, counted from the departure."""
    bounds = df.withColumns({departure: as_utc(departure), arrival: as_utc(arrival)})
    return bounds.withColumn(slot, F.explode_outer(slots_between(F.col(departure), F.col(arrival), 1)))
