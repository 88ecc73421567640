"""Clean tables to one wide row per trip."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from fleetfeatures.constants import (
    BOOKKEEPING_COLUMNS,
    CHANCE_COLUMNS,
    DEDUPE_KEYS,
    HELPER_JOIN_COLUMNS,
    PAIR_KEYS,
    SUFFIX_PATTERNS,
    TIME_COLUMNS,
    TRIP_KEYS,
    WIDE_EVENT_TIME,
    WIDE_RENAMES,
)
from fleetfeatures.functions.timegrid import (
    HOUR_MICROS,
    SIX_HOUR_MICROS,
    as_utc,
    ceil_six_hours,
    crosses_midnight,
    floor_six_hours,
    parse_timestamp,
    round_hour,
    timestamp_literal,
)
from fleetfeatures.operators.aggregates import (
    route_weather_means,
    route_weather_means_over_spans,
    traffic_by_hour,
    traffic_means,
    traffic_means_from_sums,
    traffic_means_over_spans,
)
from fleetfeatures.operators.cleaning import keep_first_by_table
from fleetfeatures.operators.columns import (
    drop_by_table,
    drop_from_all,
    rename_by_map,
    rename_by_pattern,
    rename_in,
)
from fleetfeatures.operators.joins import HOT_MIN_ROWS, hot_key_sets, join_on
from fleetfeatures.operators.numbering import number_rows
from fleetfeatures.operators.ranges import slot_number
from fleetfeatures.operators.slots import hourly_slots, six_hour_slots

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class HotKeys:
    """Key hashes with very many trips, per join; empty lists mean plain joins."""

    pair: Sequence[int] = ()
    route: Sequence[int] = ()
    truck: Sequence[int] = ()
    route_slot: Sequence[int] = ()
    route_hour: Sequence[int] = ()
    origin_hour: Sequence[int] = ()
    destination_hour: Sequence[int] = ()
    trip: Sequence[int] = ()


def hot_trip_keys(tables: Tables, min_rows: int = HOT_MIN_ROWS, rows: int | None = None) -> HotKeys:
    """Look for hot keys of every join of the wide plan, unless the schedule is small.

    ``tables`` may still hold duplicates, which saves their shuffle here. One
    pass over the trips, one over each kind of slot, one over the trips with
    their routes: key columns only, nothing shuffled by key.
    """
    schedule = tables["truck_schedule_table"]
    if (schedule.count() if rows is None else rows) < min_rows:
        return HotKeys()
    schedule = parse_times(utc_columns(schedule.select(*TRIP_KEYS)), TIME_COLUMNS["truck_schedule_table"])
    trips = hot_key_sets(schedule, {"pair": PAIR_KEYS, "route": ["route_id"], "truck": ["truck_id"],
                                    "trip": TRIP_KEYS}, min_rows=min_rows)
    slots = hot_key_sets(six_hour_slots(schedule), {"route_slot": ["route_id", "date"]}, min_rows=min_rows)
    hours = hot_key_sets(_traffic_hours(schedule), {"route_hour": ["route_id", "custom_date"]}, min_rows=min_rows)
    ends_of = tables["routes_table"].select("route_id", "origin_id", "destination_id").distinct()
    ends = hot_key_sets(
        join_on(add_nearest_hours(schedule), ends_of, ["route_id"], hot=trips["route"]),
        {"origin_hour": ["origin_id", "departure_date_nearest_hour"],
         "destination_hour": ["destination_id", "estimated_arrival_nearest_hour"]}, min_rows=min_rows)
    return HotKeys(**trips, **slots, **hours, **ends)


def prepare_tables(tables: Tables, order_by: Mapping[str, Sequence[str]] | Sequence[str] = ("rowindex",)
                   ) -> dict[str, DataFrame]:
    """First row per key, helper columns gone, times in UTC, weather date renamed.

    Row numbers and event times go after the duplicates, which they order.
    """
    order = set().union(*order_by.values()) if isinstance(order_by, Mapping) else set(order_by)
    prepared = {name: parse_times(utc_columns(df), TIME_COLUMNS.get(name, ())) for name, df in tables.items()}
    # what no order needs goes before the duplicates, so that it is not shuffled with them
    prepared = drop_by_table(prepared, {t: CHANCE_COLUMNS for t in ("city_weather", "routes_weather")})
    prepared = drop_from_all(prepared, [c for c in BOOKKEEPING_COLUMNS if c not in order])
    prepared = keep_first_by_table(prepared, DEDUPE_KEYS, order_by)
    prepared = drop_from_all(prepared, BOOKKEEPING_COLUMNS)
    return rename_in(prepared, ["city_weather"])


def utc_columns(df: DataFrame) -> DataFrame:
    """T7 on a table: all zone-less times become UTC."""
    naive = [c for c, kind in df.dtypes if kind == "timestamp_ntz"]
    return df.withColumns({c: as_utc(c) for c in naive}) if naive else df


def parse_times(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """T1 on a table: times still held as text are read, unreadable ones become null."""
    text = [c for c, kind in df.dtypes if kind == "string" and c in columns]
    return df.withColumns({c: parse_timestamp(c) for c in text}) if text else df


def add_nearest_hours(schedule: DataFrame) -> DataFrame:
    """Both trip times at their nearest hour, as new columns."""
    return schedule.withColumns({
        "estimated_arrival_nearest_hour": round_hour("estimated_arrival"),
        "departure_date_nearest_hour": round_hour("departure_date")})


def round_trip_times(schedule: DataFrame) -> DataFrame:
    """T6 in place."""
    return schedule.withColumns({c: round_hour(c) for c in ("estimated_arrival", "departure_date")})


# --- weather on the route -------------------------------------------------

def join_route_weather(slots: DataFrame, routes_weather: DataFrame, hot: Sequence[int] = ()) -> DataFrame:
    """Slots with the weather of their route and slot."""
    return join_on(slots, routes_weather, ["route_id", "date"], hot=hot)


def route_weather_per_pair(tables: Tables, hot: HotKeys = HotKeys()) -> DataFrame:
    """G1, J1, A1. Only the keys of a trip are multiplied into slots."""
    slots = six_hour_slots(tables["truck_schedule_table"]).select(*PAIR_KEYS, "date")
    return route_weather_means(join_route_weather(slots, tables["routes_weather"], hot.route_slot))


def route_weather_per_pair_by_range(tables: Tables) -> DataFrame:
    """G1, J1, A1 by running totals: two lookups a trip in place of a row per slot; the same rows as :func:`route_weather_per_pair`."""
    first, last = floor_six_hours("departure_date"), ceil_six_hours("estimated_arrival")
    return route_weather_means_over_spans(tables["truck_schedule_table"], tables["routes_weather"], slot_number(first, SIX_HOUR_MICROS),
                                          slot_number(last, SIX_HOUR_MICROS), SIX_HOUR_MICROS)


def trips_with_route_weather(tables: Tables, hot: HotKeys = HotKeys(), *, by_range: bool = False) -> DataFrame:
    """Trips with the mean weather of their truck-route pair."""
    per_pair = route_weather_per_pair_by_range(tables) if by_range else route_weather_per_pair(tables, hot)
    return join_on(tables["truck_schedule_table"], per_pair, PAIR_KEYS, hot=hot.pair)


# --- weather at both ends -------------------------------------------------

def trips_with_city_weather(tables: Tables, hot: HotKeys = HotKeys(), trips: DataFrame | None = None) -> DataFrame:
    """Trips with their route and the weather at either end.

    The two copies of the weather are named before the joins, so no names
    clash. ``trips`` may already carry other columns.
    """
    spine = add_nearest_hours(tables["truck_schedule_table"] if trips is None else trips)
    spine = join_on(spine, tables["routes_table"], ["route_id"], hot=hot.route)
    ends = (("origin", "departure_date_nearest_hour", hot.origin_hour),
            ("destination", "estimated_arrival_nearest_hour", hot.destination_hour))
    for end, hour, hot_hours in ends:
        weather = tables["city_weather"]
        weather = weather.toDF(*[f"{c}_{end}" for c in weather.columns])
        spine = join_on(spine, weather, [(f"{end}_id", f"city_id_{end}"), (hour, f"custom_date_{end}")],
                        hot=hot_hours)
    return rename_by_map(spine, WIDE_RENAMES)


# --- traffic on the route -------------------------------------------------

def _traffic_hours(schedule: DataFrame) -> DataFrame:
    return hourly_slots(round_trip_times(schedule)).select(*PAIR_KEYS, "custom_date")


TRAFFIC_KEYS = ["route_id", ("custom_date", "date")]


def join_traffic(hours: DataFrame, traffic: DataFrame, hot: Sequence[int] = (), parts: int = 0) -> DataFrame:
    """Hourly slots with every traffic row of their route and hour, in ``parts`` partitions if any are asked for."""
    return join_on(hours, traffic, TRAFFIC_KEYS, hot=hot, parts=parts)


def traffic_per_pair(tables: Tables, hot: HotKeys = HotKeys()) -> DataFrame:
    """G2, J6, A2, with the traffic summed per hour before the join instead of multiplied by it."""
    hours = _traffic_hours(tables["truck_schedule_table"])
    return traffic_means_from_sums(join_traffic(hours, traffic_by_hour(tables["traffic_table"]), hot.route_hour))


def traffic_per_pair_by_rows(tables: Tables, hot: HotKeys = HotKeys()) -> DataFrame:
    """G2, J6, A2 literally; the same result as :func:`traffic_per_pair`."""
    hours = _traffic_hours(tables["truck_schedule_table"])
    return traffic_means(join_traffic(hours, tables["traffic_table"], hot.route_hour))


def traffic_per_pair_by_range(tables: Tables) -> DataFrame:
    """G2, J6, A2 by running totals: two lookups a trip in place of a row per hour; the same rows as :func:`traffic_per_pair`."""
    first, last = (slot_number(round_hour(c), HOUR_MICROS) for c in ("departure_date", "estimated_arrival"))
    return traffic_means_over_spans(tables["truck_schedule_table"], tables["traffic_table"], first, last, HOUR_MICROS)


def trips_with_traffic(tables: Tables, hot: HotKeys = HotKeys(), trips: DataFrame | None = None, *, by_range: bool = False) -> DataFrame:
    """Trips with the mean traffic of their truck-route pair."""
    spine = tables["truck_schedule_table"] if trips is None else trips
    per_pair = traffic_per_pair_by_range(tables) if by_range else traffic_per_pair(tables, hot)
    return join_on(spine, per_pair, PAIR_KEYS, hot=hot.pair)


# --- all of it ------------------------------------------------------------

def merge_back(tables: Tables, hot: HotKeys = HotKeys()) -> DataFrame:
    """The two enriched forms of the schedule joined on the trip keys.

    :func:`wide_trips` needs no such join, it adds to one spine; both give the same rows.
    """
    weather = trips_with_route_weather(tables, hot)
    ends = trips_with_city_weather(tables, hot, trips_with_traffic(tables, hot))
    return join_on(weather, ends, TRIP_KEYS, hot=hot.trip)


def trips_on_one_spine(tables: Tables, hot: HotKeys = HotKeys()) -> DataFrame:
    """J2, J7, J3-J5 without rejoining the schedule.

    Both per-pair results have the schedule's pairs as keys, so they are joined
    to each other, small side to small side, and the trips are shuffled once.
    """
    per_pair = join_on(route_weather_per_pair(tables, hot), traffic_per_pair(tables, hot), PAIR_KEYS)
    trips = join_on(tables["truck_schedule_table"], per_pair, PAIR_KEYS, hot=hot.pair)
    return trips_with_city_weather(tables, hot, trips)


def add_vehicle_and_driver(trips: DataFrame, tables: Tables, hot: HotKeys = HotKeys()) -> DataFrame:
    """Truck and driver of each trip."""
    trips = join_on(trips, tables["trucks_table"], ["truck_id"], hot=hot.truck)
    return join_on(trips, tables["drivers_table"], [("truck_id", "vehicle_no")], hot=hot.truck)


def finish_columns(df: DataFrame) -> DataFrame:
    """Final names, helper join columns gone."""
    return rename_by_map(rename_by_pattern(df, SUFFIX_PATTERNS), WIDE_RENAMES).drop(*HELPER_JOIN_COLUMNS)


def wide_trips(tables: Tables, order_by: Mapping[str, Sequence[str]] | Sequence[str] = ("rowindex",), *,
               hot: HotKeys | None = None, drop_nulls: bool = True) -> DataFrame:
    """The wide table from clean tables: one row per trip, all features, ``unique_id``.

    Full-row duplicates (C12) cannot arise and cost no shuffle: the schedule is
    unique on its keys after :func:`prepare_tables`, and each joined table adds
    its own key to the row. ``unique_id`` numbers the rows before those with
    nulls go, along a total order of the row keys.

    Keys with very many trips are split by adaptive execution, which goes by the
    sizes that a join's input really has; the plan is the same at every size.
    ``hot`` (:func:`hot_trip_keys`) salts them beforehand, for sessions without it.
    """
    hot = HotKeys() if hot is None else hot
    prepared = prepare_tables(tables, order_by)
    wide = add_vehicle_and_driver(trips_on_one_spine(prepared, hot), prepared, hot)
    wide = finish_columns(wide.withColumn("is_midnight", crosses_midnight("departure_date", "estimated_arrival")))
    order = ["departure_date", "truck_id", "route_id", "origin_id", "destination_id", "driver_id"]
    wide = number_rows(wide, "unique_id", order, start=0)
    if drop_nulls:
        wide = wide.na.drop("any")
    return wide.withColumn("event_time", timestamp_literal(WIDE_EVENT_TIME))

