"""Queries on missing values, negatives, outliers and duplicates (C)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfeatures.catalogue import register
from fleetfeatures.catalogue.shaping import plain_times, rounded, sql_rounded
from fleetfeatures.catalogue.sqltext import sql_first
from fleetfeatures.catalogue.views import table, view, with_views
from fleetfeatures.operators import cleaning, numbering
from fleetfeatures.plans import clean

_HOLES = """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts END AS ts,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END AS user_id FROM events"""


def _holes(spark: SparkSession, folder: str) -> DataFrame:
    def hole(n: int, c: str):
        return F.when(F.col("event_id") % n != 0, F.col(c)).alias(c)
    return table(spark, folder, "events").select(
        "event_id", hole(7, "value"), hole(5, "event_type"), hole(11, "ts"), hole(3, "user_id"))


@register("fill_missing", f"""
WITH h AS ({_HOLES}),
m AS (SELECT event_type FROM h WHERE event_type IS NOT NULL GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)
SELECT event_id, {sql_rounded('coalesce(value, (SELECT avg(value) FROM h))', 'value')},
       coalesce(event_type, (SELECT event_type FROM m)) AS event_type,
       coalesce(ts, TIMESTAMP '1970-01-01 00:00:00') AS ts,
       {sql_rounded('coalesce(user_id::DOUBLE, (SELECT avg(user_id) FROM h))', 'user_id')} FROM h""")
def fill_missing(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cleaning.fill_missing(_holes(spark, folder)), ["value", "user_id"])


@register("mode_ties", """
SELECT p_partkey, coalesce(CASE WHEN p_size > 25 THEN p_brand END, (SELECT b FROM (
  SELECT p_brand AS b FROM part WHERE p_size > 25 GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 1))) AS p_brand
FROM part""")
def mode_ties(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select(
        "p_partkey", F.when(F.col("p_size") > 25, F.col("p_brand")).alias("p_brand"))
    return cleaning.fill_missing(part)


@register("forward_fill", """
SELECT event_id, ts, user_id, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
FROM (SELECT event_id, ts, user_id, CASE WHEN event_id % 7 < 4 THEN NULL ELSE value END AS v FROM events)""")
def forward_fill(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        "event_id", "ts", "user_id", F.when(F.col("event_id") % 7 >= 4, F.col("value")).alias("value"))
    return numbering.forward_fill(events, ["value"], ["ts", "event_id"], ["user_id"])


@register("forward_fill_frame", with_views("trucks", """
SELECT truck_id, truck_age, mileage_mpg,
       last_value(load_capacity_pounds IGNORE NULLS) OVER w AS load_capacity_pounds,
       last_value(fuel_type IGNORE NULLS) OVER w AS fuel_type
FROM trucks WINDOW w AS (ORDER BY truck_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def forward_fill_frame(spark: SparkSession, folder: str) -> DataFrame:
    return numbering.forward_fill(view(spark, folder, "trucks"), ["load_capacity_pounds", "fuel_type"], ["truck_id"])


@register("fix_negatives", with_views("trucks", f"""
SELECT truck_id, {sql_rounded('''CASE WHEN mileage_mpg < 0
       THEN (SELECT avg(mileage_mpg) FROM trucks WHERE mileage_mpg >= 0) ELSE mileage_mpg END''', 'mileage_mpg')}
FROM trucks"""))
def fix_negatives(spark: SparkSession, folder: str) -> DataFrame:
    trucks = view(spark, folder, "trucks").select("truck_id", "mileage_mpg")
    return rounded(cleaning.fix_negatives(trucks, "mileage_mpg"), ["mileage_mpg"])


def _sql_outliers(source: str, names: list[str]) -> str:
    steps, before = [], source
    for i, c in enumerate(names):
        steps.append(f"""q{i} AS (SELECT quantile_cont({c}, 0.25::DOUBLE) AS a, quantile_cont({c}, 0.75::DOUBLE) AS b FROM {before}),
o{i} AS (SELECT s.* FROM {before} s, q{i} WHERE {c} BETWEEN a - 1.5::DOUBLE * (b - a) AND b + 1.5::DOUBLE * (b - a))""")
        before = f"o{i}"
    return ",\n".join(steps)


@register("iqr_outliers", f"""
WITH {_sql_outliers('lineitem', ['l_extendedprice', 'l_quantity'])}
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM o1""")
def iqr_outliers(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return cleaning.remove_outliers(lines, ["l_extendedprice", "l_quantity"])


@register("iqr_weather", with_views("cityw", f""", {_sql_outliers('cityw', ['temp', 'wind_speed', 'humidity', 'pressure'])}
SELECT * FROM o3"""))
def iqr_weather(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = cleaning.remove_outliers_by_table(
        {"city_weather": view(spark, folder, "cityw")},
        {"city_weather": ["temp", "wind_speed", "humidity", "pressure"]})
    return plain_times(cleaned["city_weather"])


@register("iqr_keep_if_empty", """
SELECT 'orders' AS table_name, o_orderkey AS row_key FROM orders""")
def iqr_keep_if_empty(spark: SparkSession, folder: str) -> DataFrame:
    # a column of nulls only would drop every row, so the table stays as it was
    orders = table(spark, folder, "orders").withColumn("no_values", F.lit(None).cast("double"))
    kept = cleaning.remove_outliers_by_table({"orders": orders}, {"orders": ["no_values"], "absent": ["x"]})
    return kept["orders"].select(F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("row_key"))


@register("dup_count", """
SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT p_brand, p_size FROM part)) AS BIGINT) AS duplicates
FROM part""")
def dup_count(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.duplicate_row_count(table(spark, folder, "part").select("p_brand", "p_size"))


@register("dup_rows", """
SELECT p_partkey, p_name FROM (SELECT p_partkey, p_name, count(*) OVER (PARTITION BY p_name) AS n FROM part) WHERE n > 1""")
def dup_rows(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.rows_with_repeats(table(spark, folder, "part").select("p_partkey", "p_name"), "p_name")


@register("dup_any", "SELECT count(*) <> count(DISTINCT p_name) AS any_duplicated FROM part")
def dup_any(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.has_repeats(table(spark, folder, "part"), "p_name")


@register("dedupe_first", with_views("routew", sql_first("routew", "route_id, date", "rowindex")))
def dedupe_first(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(cleaning.keep_first(view(spark, folder, "routew"), ["route_id", "date"], ["rowindex"]))


@register("dedupe_rows", with_views("routew", "SELECT DISTINCT route_id, date, description FROM routew"))
def dedupe_rows(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(cleaning.drop_duplicate_rows(view(spark, folder, "routew").select(
        "route_id", "date", "description")))


@register("cleaned_traffic", with_views("traffic", f""",
f AS (SELECT row_number() OVER (ORDER BY rowindex) AS rowindex, route_id,
             CAST(date AS TIMESTAMP) + (hour // 100) * INTERVAL '1' HOUR AS date,
             coalesce(no_of_vehicles, (SELECT avg(no_of_vehicles) FROM traffic)) AS no_of_vehicles, accident FROM traffic),
{_sql_outliers('f', ['no_of_vehicles'])}
SELECT rowindex, route_id, date, {sql_rounded('no_of_vehicles', 'no_of_vehicles')}, accident FROM o0"""))
def cleaned_traffic(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = clean.clean_tables({"traffic_table": view(spark, folder, "traffic")}, {"traffic_table": ["rowindex"]})
    return plain_times(rounded(cleaned["traffic_table"], ["no_of_vehicles"]))


@register("cleaned_trucks", with_views("trucks", f""",
f AS (SELECT row_number() OVER (ORDER BY truck_id) AS rowindex, truck_id, truck_age, mileage_mpg AS m,
             coalesce(load_capacity_pounds, (SELECT avg(load_capacity_pounds) FROM trucks)) AS load_capacity_pounds,
             coalesce(fuel_type, (SELECT fuel_type FROM trucks WHERE fuel_type IS NOT NULL GROUP BY fuel_type
                                  ORDER BY count(*) DESC, fuel_type LIMIT 1)) AS fuel_type FROM trucks),
g AS (SELECT * EXCLUDE (m), CASE WHEN m < 0 THEN (SELECT avg(m) FROM f WHERE m >= 0) ELSE m END AS mileage_mpg FROM f),
{_sql_outliers('g', ['mileage_mpg', 'load_capacity_pounds', 'truck_age'])}
SELECT rowindex, truck_id, truck_age, fuel_type, {sql_rounded('mileage_mpg', 'mileage_mpg')},
       {sql_rounded('load_capacity_pounds', 'load_capacity_pounds')} FROM o2"""))
def cleaned_trucks(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = clean.clean_tables({"trucks_table": view(spark, folder, "trucks")}, {"trucks_table": ["truck_id"]})
    return rounded(cleaned["trucks_table"], ["mileage_mpg", "load_capacity_pounds"])


@register("cleaned_drivers", with_views("drivers", f""",
f AS (SELECT row_number() OVER (ORDER BY driver_id) AS rowindex, * EXCLUDE (experience),
             CASE WHEN experience < 0 THEN (SELECT avg(experience) FROM drivers WHERE experience >= 0) ELSE experience END AS experience FROM drivers),
{_sql_outliers('f', ['experience', 'age', 'ratings', 'average_speed_mph'])}
SELECT * EXCLUDE (experience), {sql_rounded('experience', 'experience')} FROM o3"""))
def cleaned_drivers(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = clean.clean_tables({"drivers_table": view(spark, folder, "drivers")}, {"drivers_table": ["driver_id"]})
    return rounded(cleaned["drivers_table"], ["experience"])


@register("cleaned_routes", with_views("routes", f""",
f AS (SELECT row_number() OVER (ORDER BY id) AS rowindex, * FROM routes),
{_sql_outliers('f', ['average_hours', 'distance'])}
SELECT * FROM o1"""))
def cleaned_routes(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clean_tables({"routes_table": view(spark, folder, "routes")}, {"routes_table": ["id"]})["routes_table"]


@register("cleaned_schedule", with_views("sched", """
SELECT row_number() OVER (ORDER BY rowindex) AS rowindex, truck_id, route_id, departure_date, delay,
       CASE WHEN rowindex % 9 <> 0 THEN date_trunc('hour', estimated_arrival + INTERVAL '25' MINUTE) END AS estimated_arrival FROM sched"""))
def cleaned_schedule(spark: SparkSession, folder: str) -> DataFrame:
    """Arrivals come as text, some of it unreadable."""
    text = F.date_format(F.col("estimated_arrival") + F.expr("INTERVAL '25' MINUTE"), "yyyy-MM-dd HH:mm:ss")
    trips = view(spark, folder, "sched").withColumn("estimated_arrival", F.when(F.col("rowindex") % 9 == 0, "no time").otherwise(text))
    cleaned = clean.clean_tables({"truck_schedule_table": trips}, {"truck_schedule_table": ["rowindex"]})
    return plain_times(cleaned["truck_schedule_table"])


@register("cleaned_routes_weather", with_views("routew", f""",
f AS (SELECT * REPLACE (row_number() OVER (ORDER BY rowindex) AS rowindex) FROM routew),
{_sql_outliers('f', ['temp', 'wind_speed', 'humidity', 'pressure'])}
SELECT * EXCLUDE (date), date AS "Date" FROM o3"""))
def cleaned_routes_weather(spark: SparkSession, folder: str) -> DataFrame:
    """Times come as text."""
    weather = view(spark, folder, "routew").withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))
    return plain_times(clean.clean_tables({"routes_weather": weather}, {"routes_weather": ["rowindex"]})["routes_weather"])


@register("cleaned_city_weather", with_views("cityw", f""",
f AS (SELECT * EXCLUDE (rowindex, temp, date), row_number() OVER (ORDER BY rowindex) AS rowindex, CASE WHEN hour(date) <> 13 THEN date END AS date,
             coalesce(CASE WHEN rowindex % 6 <> 0 THEN temp END, (SELECT avg(temp) FROM cityw WHERE rowindex % 6 <> 0)) AS temp FROM cityw),
{_sql_outliers('f', ['temp', 'wind_speed', 'humidity', 'pressure'])}
SELECT * EXCLUDE (temp), {sql_rounded('temp', 'temp')} FROM o3"""))
def cleaned_city_weather(spark: SparkSession, folder: str) -> DataFrame:
    """Day and military hour come apart, one hour of the day is no clock time, some temperatures are missing."""
    hour = F.hour("date")
    weather = view(spark, folder, "cityw").withColumns({
        "hour": F.when(hour == 13, 1375).otherwise(hour * 100), "date": F.to_date("date").cast("string"), "temp": F.when(F.col("rowindex") % 6 != 0, F.col("temp"))})
    cleaned = clean.clean_tables({"city_weather": weather}, {"city_weather": ["rowindex"]})
    return plain_times(rounded(cleaned["city_weather"], ["temp"]))


@register("fill_empty", _HOLES)
def fill_empty(spark: SparkSession, folder: str) -> DataFrame:
    """A table without rows has nothing to fill with and passes as it is, types included: it can be put to the other rows."""
    holes = _holes(spark, folder)
    return cleaning.fill_missing(holes.where("event_id < 0")).unionAll(holes)
