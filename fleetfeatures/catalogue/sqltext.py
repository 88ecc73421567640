"""Pieces of check SQL used by several queries."""

from __future__ import annotations

from fleetfeatures.catalogue.shaping import sql_rounded

HOUR = 3_600_000_000
SIX_HOURS = 6 * HOUR


def sql_floor_six(c: str) -> str:
    return f"make_timestamp(epoch_us({c}) - epoch_us({c}) % {SIX_HOURS})"


def sql_ceil_six(c: str) -> str:
    return f"make_timestamp(epoch_us({c}) + ({SIX_HOURS} - epoch_us({c}) % {SIX_HOURS}) % {SIX_HOURS})"


def sql_round_hour(c: str) -> str:
    m = f"epoch_us({c})"
    return (f"make_timestamp(CASE WHEN ({m} % {HOUR}) * 2 > {HOUR} "
            f"OR (({m} % {HOUR}) * 2 = {HOUR} AND ({m} // {HOUR}) % 2 = 1) "
            f"THEN {m} - {m} % {HOUR} + {HOUR} ELSE {m} - {m} % {HOUR} END)")


def sql_first(source: str, keys: str, order: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
            f"FROM {source}) WHERE rn = 1")


MERGE_STEPS = f""",
s AS (SELECT * EXCLUDE (rowindex) FROM ({sql_first('sched', 'truck_id, route_id, departure_date', 'rowindex')})),
r AS ({sql_first('routes', 'route_id, destination_id, origin_id', 'id')}),
cw AS (SELECT city_id, date AS custom_date, temp, wind_speed, description, precip, humidity, visibility, pressure
       FROM ({sql_first('cityw', 'city_id, date', 'rowindex')})),
rw AS (SELECT route_id, date, temp, wind_speed, description, precip, humidity, visibility, pressure
       FROM ({sql_first('routew', 'route_id, date', 'rowindex')})),
tr AS (SELECT route_id, CAST(date AS TIMESTAMP) + (hour // 100) * INTERVAL '1' HOUR AS date, no_of_vehicles, accident
       FROM traffic),
slots6 AS (SELECT s.* EXCLUDE (departure_date, estimated_arrival),
                  {sql_floor_six('departure_date')} AS departure_date,
                  {sql_ceil_six('estimated_arrival')} AS estimated_arrival, g.date
           FROM s LEFT JOIN LATERAL (SELECT unnest(generate_series({sql_floor_six('s.departure_date')},
                {sql_ceil_six('s.estimated_arrival')}, INTERVAL '6' HOUR)) AS date) g ON true),
slotw AS (SELECT p.truck_id, p.route_id, w.* EXCLUDE (route_id, date) FROM slots6 p LEFT JOIN rw w
          ON p.route_id IS NOT DISTINCT FROM w.route_id AND p.date IS NOT DISTINCT FROM w.date),
texts AS (SELECT truck_id, route_id, description, row_number() OVER (PARTITION BY truck_id, route_id
                 ORDER BY count(*) DESC, description) AS rn
          FROM slotw WHERE description IS NOT NULL GROUP BY truck_id, route_id, description),
a1 AS (SELECT m.*, t.description AS route_description FROM
       (SELECT truck_id, route_id, avg(temp) AS route_avg_temp, avg(wind_speed) AS route_avg_wind_speed,
               avg(precip) AS route_avg_precip, avg(humidity) AS route_avg_humidity,
               avg(visibility) AS route_avg_visibility, avg(pressure) AS route_avg_pressure
        FROM slotw WHERE truck_id IS NOT NULL AND route_id IS NOT NULL GROUP BY truck_id, route_id) m
       LEFT JOIN (SELECT * FROM texts WHERE rn = 1) t ON m.truck_id = t.truck_id AND m.route_id = t.route_id),
slots1 AS (SELECT s.* EXCLUDE (departure_date, estimated_arrival), {sql_round_hour('departure_date')} AS departure_date,
                  {sql_round_hour('estimated_arrival')} AS estimated_arrival, g.custom_date
           FROM s LEFT JOIN LATERAL (SELECT unnest(generate_series({sql_round_hour('s.departure_date')},
                {sql_round_hour('s.estimated_arrival')}, INTERVAL '1' HOUR)) AS custom_date) g ON true),
slott AS (SELECT p.*, t.date, t.no_of_vehicles, t.accident FROM slots1 p LEFT JOIN tr t
          ON p.route_id IS NOT DISTINCT FROM t.route_id AND p.custom_date IS NOT DISTINCT FROM t.date),
a2 AS (SELECT truck_id, route_id, avg(no_of_vehicles) AS avg_no_of_vehicles,
              CAST(coalesce(max(CASE WHEN accident = 1 THEN 1 ELSE 0 END), 0) AS INT) AS accident
       FROM slott WHERE truck_id IS NOT NULL AND route_id IS NOT NULL GROUP BY truck_id, route_id),
ends AS (SELECT h.*, r.* EXCLUDE (route_id),
    o.temp AS temp_origin, o.wind_speed AS wind_speed_origin, o.description AS origin_description,
    o.precip AS precip_origin, o.humidity AS humidity_origin, o.visibility AS visibility_origin,
    o.pressure AS pressure_origin, o.city_id AS city_id_origin, o.custom_date AS custom_date_origin,
    d.temp AS temp_destination, d.wind_speed AS wind_speed_destination, d.description AS destination_description,
    d.precip AS precip_destination, d.humidity AS humidity_destination, d.visibility AS visibility_destination,
    d.pressure AS pressure_destination, d.city_id AS city_id_destination, d.custom_date AS custom_date_destination
  FROM (SELECT s.*, {sql_round_hour('estimated_arrival')} AS estimated_arrival_nearest_hour,
               {sql_round_hour('departure_date')} AS departure_date_nearest_hour FROM s) h
  LEFT JOIN r ON h.route_id IS NOT DISTINCT FROM r.route_id
  LEFT JOIN cw o ON r.origin_id IS NOT DISTINCT FROM o.city_id
       AND h.departure_date_nearest_hour IS NOT DISTINCT FROM o.custom_date
  LEFT JOIN cw d ON r.destination_id IS NOT DISTINCT FROM d.city_id
       AND h.estimated_arrival_nearest_hour IS NOT DISTINCT FROM d.custom_date)
"""
MERGE_VIEWS = "sched routes cityw routew traffic trucks drivers"

A1_ROUNDED = ", ".join(
    sql_rounded(f"a1.route_avg_{m}", f"route_avg_{m}")
    for m in ("temp", "wind_speed", "precip", "humidity", "visibility", "pressure"))
VEHICLES_ROUNDED = sql_rounded("a2.avg_no_of_vehicles", "avg_no_of_vehicles")
