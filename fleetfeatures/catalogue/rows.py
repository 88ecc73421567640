"""Queries on columns, rows and times (P, T, O, F)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfeatures.catalogue import register
from fleetfeatures.catalogue.shaping import plain_times
from fleetfeatures.catalogue.sqltext import HOUR, sql_ceil_six, sql_floor_six, sql_round_hour
from fleetfeatures.catalogue.views import table, view, with_views
from fleetfeatures.constants import CHANCE_COLUMNS, SUFFIX_PATTERNS, WIDE_RENAMES
from fleetfeatures.functions import text, timegrid
from fleetfeatures.operators import columns, numbering, rows
from fleetfeatures.operators.joins import gather_tiles, pair_load, spread_tiles
from fleetfeatures.plans import clean, merge

# --- columns --------------------------------------------------------------


@register("drop_rename", with_views("cityw", """
SELECT city_id, date AS custom_date, temp, wind_speed, description, precip, humidity, visibility, pressure
FROM cityw"""))
def drop_rename(spark: SparkSession, folder: str) -> DataFrame:
    tables = {"city_weather": view(spark, folder, "cityw")}
    tables = columns.drop_from_all(tables, ["rowindex", "event_time", "eventtime"])
    tables = columns.drop_by_table(tables, {"city_weather": CHANCE_COLUMNS})
    return plain_times(columns.rename_in(tables, ["city_weather"])["city_weather"])


@register("suffix_rename", with_views("routes cityw", """
SELECT r.route_id, o.rowindex AS rowindex_origin, d.rowindex AS rowindex_destination, o.temp AS temp_origin,
       d.temp AS temp_destination, o.description AS origin_description, d.description AS destination_description
FROM routes r JOIN cityw o ON r.origin_id = o.city_id
JOIN cityw d ON r.destination_id = d.city_id AND d.date = o.date"""))
def suffix_rename(spark: SparkSession, folder: str) -> DataFrame:
    hours = view(spark, folder, "cityw").select("rowindex", "city_id", "date", "temp", "description")
    routes = view(spark, folder, "routes").select("route_id", "origin_id", "destination_id")
    ends, at = [("origin_id", "city_id")], [("destination_id", "city_id"), "date"]
    places = hours.select("city_id", "date")
    load = pair_load(merge.join_on(routes, places, ends, "inner").drop("city_id"), places, at, "inner")
    tiles = gather_tiles(hours, ["city_id", "date"])
    first = merge.join_on(routes, tiles, ends, "inner")
    pairs = merge.join_on(first, tiles, at, "inner", suffixes=("_x", "_y"), **load)
    both = spread_tiles(pairs, {"tile_x": "_x", "tile_y": "_y"})
    named = columns.rename_by_map(columns.rename_by_pattern(both, SUFFIX_PATTERNS), WIDE_RENAMES)
    return named.drop("city_id_origin", "city_id_destination", "origin_id", "destination_id", "date")


@register("available_cols", with_views("sched", "SELECT truck_id, estimated_arrival, delay FROM sched"))
def available_cols(spark: SparkSession, folder: str) -> DataFrame:
    wanted = ["truck_id", "no_such_column", "estimated_arrival"]
    return plain_times(columns.select_available(view(spark, folder, "sched"), wanted, "delay"))


@register("required_cols", """
SELECT c AS "column", count(i.column_name) > 0 AS present
FROM (VALUES ('event_id'), ('value'), ('ratings'), ('accident')) v(c)
LEFT JOIN (DESCRIBE events) i ON i.column_name = c GROUP BY c""")
def required_cols(spark: SparkSession, folder: str) -> DataFrame:
    return columns.required_columns_report(spark, table(spark, folder, "events"),
                                           ["event_id", "value", "ratings", "accident"])


@register("constant_cols", with_views("routew", """
SELECT rowindex, route_id, date, temp, wind_speed, description, humidity, visibility, pressure FROM routew"""))
def constant_cols(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(columns.drop_constant_columns(view(spark, folder, "routew")))


@register("constant_appended", with_views("sched", """
SELECT truck_id, departure_date, TIMESTAMP '2024-10-08 00:00:00' AS event_time FROM sched"""))
def constant_appended(spark: SparkSession, folder: str) -> DataFrame:
    trips = view(spark, folder, "sched").select("truck_id", "departure_date")
    return plain_times(columns.add_constant(trips, "event_time", timegrid.timestamp_literal("2024-10-08 00:00:00")))


# --- rows -----------------------------------------------------------------


@register("drop_null_rows", with_views("traffic", "SELECT * FROM traffic WHERE no_of_vehicles IS NOT NULL"))
def drop_null_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rows.drop_null_rows(view(spark, folder, "traffic"))


@register("filter_dates", """
SELECT event_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-09'""")
def filter_dates(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "ts", "value")
    return rows.between_dates(events, "ts", "2024-01-05", "2024-01-09")


@register("filter_whole_days", """
SELECT event_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-10'""")
def filter_whole_days(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "ts", "value")
    return rows.between_dates(events, "ts", "2024-01-05", "2024-01-09", inclusive_day=True)


@register("filter_truck", with_views("sched", "SELECT * FROM sched WHERE truck_id = 7"))
def filter_truck(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(rows.where_equals(view(spark, folder, "sched"), "truck_id", "7"))


@register("filter_route", with_views("sched", "SELECT * FROM sched WHERE route_id = 'click'"))
def filter_route(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(rows.where_equals(view(spark, folder, "sched"), "route_id", "click"))


@register("empty_check", with_views("sched", "SELECT count(*) = 0 AS is_empty FROM sched WHERE route_id = 'nowhere'"))
def empty_check(spark: SparkSession, folder: str) -> DataFrame:
    return rows.emptiness(rows.where_equals(view(spark, folder, "sched"), "route_id", "nowhere"))


@register("split_time", with_views("sched", """
SELECT *, CASE WHEN estimated_arrival <= TIMESTAMP '2024-01-15 00:00:00' THEN 'train'
     WHEN estimated_arrival <= TIMESTAMP '2024-01-22 00:00:00' THEN 'valid'
     WHEN estimated_arrival > TIMESTAMP '2024-01-22 00:00:00' THEN 'test' END AS split FROM sched"""))
def split_time(spark: SparkSession, folder: str) -> DataFrame:
    trips = view(spark, folder, "sched")
    return plain_times(trips.withColumn(
        "split", rows.split_label("estimated_arrival", "2024-01-15 00:00:00", "2024-01-22 00:00:00")))


@register("split_random", """
SELECT event_id, user_id, ('0x' || substr(md5(event_id || ':42'), 1, 8))::BIGINT % 100 < 20 AS is_test FROM events""")
def split_random(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "user_id")
    train, test = rows.split_at_random(events, ["event_id"])
    return train.withColumn("is_test", F.lit(False)).unionByName(test.withColumn("is_test", F.lit(True)))


@register("row_index", with_views("sched", """
SELECT row_number() OVER (ORDER BY departure_date, truck_id, route_id) AS rowindex, truck_id, route_id, departure_date
FROM sched"""))
def row_index(spark: SparkSession, folder: str) -> DataFrame:
    trips = view(spark, folder, "sched").select("truck_id", "route_id", "departure_date")
    return plain_times(numbering.add_row_index(trips, ["departure_date", "truck_id", "route_id"]))


@register("unique_id", with_views("traffic", """
SELECT * FROM (SELECT *, row_number() OVER (ORDER BY route_id, date, hour, rowindex) - 1 AS unique_id FROM traffic)
WHERE no_of_vehicles IS NOT NULL"""))
def unique_id(spark: SparkSession, folder: str) -> DataFrame:
    numbered = numbering.number_rows(view(spark, folder, "traffic"), "unique_id",
                                     ["route_id", "date", "hour", "rowindex"], start=0)
    return rows.drop_null_rows(numbered)


@register("preview", "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5")
def preview(spark: SparkSession, folder: str) -> DataFrame:
    return rows.preview(table(spark, folder, "orders"), 5, ["o_orderdate", "o_orderkey"])


# --- times ----------------------------------------------------------------


@register("parse_coerce", """
SELECT event_id, TRY_CAST(stamp AS TIMESTAMP) AS parsed FROM (
SELECT event_id, CASE event_type WHEN 'click' THEN 'no date' WHEN 'view' THEN '2024-13-45 10:00:00'
       ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS stamp FROM events)""")
def parse_coerce(spark: SparkSession, folder: str) -> DataFrame:
    stamp = (F.when(F.col("event_type") == "click", "no date").when(F.col("event_type") == "view", "2024-13-45 10:00:00")
             .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return plain_times(table(spark, folder, "events").select("event_id", timegrid.parse_timestamp(stamp).alias("parsed")))


@register("military_hour", with_views("traffic", """
SELECT rowindex, route_id, no_of_vehicles, accident,
       CAST(date AS TIMESTAMP) + (hour // 100) * INTERVAL '1' HOUR AS date FROM traffic"""))
def military_hour(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(clean.merge_date_hour(view(spark, folder, "traffic")))


@register("military_hour_minutes", """
SELECT event_id, TRY_CAST(strftime(ts, '%Y-%m-%d') || ' ' || strftime(ts, '%H:%M') || ':00' AS TIMESTAMP) AS at
FROM events""")
def military_hour_minutes(spark: SparkSession, folder: str) -> DataFrame:
    clock = F.hour("ts") * 100 + F.minute("ts")
    return plain_times(table(spark, folder, "events").select(
        "event_id", timegrid.date_and_military_hour(F.date_format("ts", "yyyy-MM-dd"), clock).alias("at")))


@register("floor_hour", "SELECT event_id, date_trunc('hour', ts) AS hour_start FROM events")
def floor_hour(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(table(spark, folder, "events").select("event_id", timegrid.floor_hour("ts").alias("hour_start")))


@register("six_hour_bounds", with_views("sched", f"""
SELECT rowindex, {sql_floor_six('departure_date')} AS departure_floor, {sql_ceil_six('departure_date')} AS departure_ceil,
       {sql_floor_six('estimated_arrival')} AS arrival_floor, {sql_ceil_six('estimated_arrival')} AS arrival_ceil
FROM sched"""))
def six_hour_bounds(spark: SparkSession, folder: str) -> DataFrame:
    floor, ceil = timegrid.floor_six_hours, timegrid.ceil_six_hours
    return plain_times(view(spark, folder, "sched").select(
        "rowindex", floor("departure_date").alias("departure_floor"), ceil("departure_date").alias("departure_ceil"),
        floor("estimated_arrival").alias("arrival_floor"), ceil("estimated_arrival").alias("arrival_ceil")))


@register("round_hour", with_views("sched", f"""
SELECT rowindex, {sql_round_hour('departure_date')} AS departure_hour,
       {sql_round_hour('half')} AS half_hour
FROM (SELECT *, make_timestamp(epoch_us(departure_date) - epoch_us(departure_date) % {HOUR} + {HOUR // 2}) AS half
      FROM sched)"""))
def round_hour(spark: SparkSession, folder: str) -> DataFrame:
    half = F.date_trunc("hour", "departure_date") + F.expr("INTERVAL '30' MINUTE")
    return plain_times(view(spark, folder, "sched").select(
        "rowindex", timegrid.round_hour("departure_date").alias("departure_hour"),
        timegrid.round_hour(half).alias("half_hour")))


@register("crosses_midnight", with_views("sched", """
SELECT rowindex, CAST(CAST(departure_date AS DATE) <> CAST(estimated_arrival AS DATE) AS INT) AS is_midnight
FROM sched"""))
def crosses_midnight(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, "sched").select(
        "rowindex", timegrid.crosses_midnight("departure_date", "estimated_arrival").alias("is_midnight"))


# --- newest, latest, best -------------------------------------------------

_RUNS = """SELECT event_id AS run_id, event_type AS model_name, ts AS start_time, user_id AS version, value AS accuracy
FROM events"""


def _runs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id").alias("run_id"), F.col("event_type").alias("model_name"), F.col("ts").alias("start_time"),
        F.col("user_id").alias("version"), F.col("value").alias("accuracy"))


@register("run_latest", f"SELECT * FROM ({_RUNS}) ORDER BY start_time DESC, run_id LIMIT 1")
def run_latest(spark: SparkSession, folder: str) -> DataFrame:
    return rows.newest(_runs(spark, folder), "start_time", ["run_id"])


@register("model_latest", f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY version DESC, start_time DESC)
AS rn FROM ({_RUNS})) WHERE rn = 1""")
def model_latest(spark: SparkSession, folder: str) -> DataFrame:
    return rows.latest_per_key(_runs(spark, folder), ["model_name"], ["version", "start_time"])


@register("model_best", f"SELECT * FROM ({_RUNS}) ORDER BY accuracy DESC, run_id LIMIT 1")
def model_best(spark: SparkSession, folder: str) -> DataFrame:
    return rows.best_first(_runs(spark, folder), "accuracy", "run_id")


# --- text -----------------------------------------------------------------


@register("listing_json", """
SELECT event_id, event_type || '_' || event_id || '.csv' AS name, 'file' AS type,
       event_type || '_' || event_id AS table_name
FROM events WHERE event_type <> 'view'""")
def listing_json(spark: SparkSession, folder: str) -> DataFrame:
    suffix = F.when(F.col("event_type") == "view", ".txt").otherwise(".csv")
    name = F.concat_ws("", F.col("event_type"), F.lit("_"), F.col("event_id").cast("string"), suffix)
    entry = F.struct(name.alias("name"), F.lit("file").alias("type"),
                     F.concat(F.lit("store:/data/"), name).alias("download_url"))
    listing = table(spark, folder, "events").select("event_id", F.to_json(F.array(entry)).alias("listing"))
    files = text.explode_listing(listing, "listing").where(text.is_csv("name"))
    return files.select("event_id", "name", "type", text.table_name_of("download_url").alias("table_name"))


@register("page_paths", """
SELECT page_id, list_extract(string_split(url, '/'), -1) AS last_part, ends_with(url, '.csv') AS is_csv FROM pages""")
def page_paths(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select(
        "page_id", text.table_name_of("url").alias("last_part"), text.is_csv("url").alias("is_csv"))



