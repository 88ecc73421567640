"""Table names, column groups, cut points and parameter grids."""

# --- fixed values: tables -------------------------------------------------
TABLES = [
    "city_weather",
    "drivers_table",
    "routes_table",
    "routes_weather",
    "traffic_table",
    "truck_schedule_table",
    "trucks_table",
]

# --- fixed values: cleaning -----------------------------------------------
NEGATIVE_COLUMNS = {"drivers_table": "experience", "trucks_table": "mileage_mpg"}
DATE_HOUR_TABLES = ["city_weather", "traffic_table"]
OUTLIER_COLUMNS = {
    "city_weather": ["temp", "wind_speed", "humidity", "pressure"],
    "routes_weather": ["temp", "wind_speed", "humidity", "pressure"],
    "drivers_table": ["experience", "age", "ratings", "average_speed_mph"],
    "traffic_table": ["no_of_vehicles"],
    "routes_table": ["average_hours", "distance"],
    "trucks_table": ["mileage_mpg", "load_capacity_pounds", "truck_age"],
}
DEFAULT_DATE = "1970-01-01 00:00:00"

# --- fixed values: merging ------------------------------------------------
BOOKKEEPING_COLUMNS = ["rowindex", "event_time", "eventtime"]
DEDUPE_KEYS = {
    "city_weather": ["city_id", "date"],
    "routes_weather": ["route_id", "date"],
    "trucks_table": ["truck_id"],
    "drivers_table": ["driver_id"],
    "routes_table": ["route_id", "destination_id", "origin_id"],
    "truck_schedule_table": ["truck_id", "route_id", "departure_date"],
}
TIME_COLUMNS = {
    "city_weather": ["date"],
    "routes_weather": ["date"],
    "traffic_table": ["date"],
    "truck_schedule_table": ["departure_date", "estimated_arrival"],
}
CHANCE_COLUMNS = ["chanceofrain", "chanceoffog", "chanceofsnow", "chanceofthunder"]
WEATHER_MEASURES = ["temp", "wind_speed", "precip", "humidity", "visibility", "pressure"]
PAIR_KEYS = ["truck_id", "route_id"]
TRIP_KEYS = ["truck_id", "route_id", "departure_date", "estimated_arrival", "delay"]
HELPER_JOIN_COLUMNS = [
    "city_id_origin",
    "city_id_destination",
    "custom_date_origin",
    "custom_date_destination",
]
SUFFIX_PATTERNS = [("_x$", "_origin"), ("_y$", "_destination")]
WIDE_RENAMES = {
    "origin_temp": "temp_origin",
    "origin_wind_speed": "wind_speed_origin",
    "origin_precip": "precip_origin",
    "origin_humidity": "humidity_origin",
    "origin_visibility": "visibility_origin",
    "origin_pressure": "pressure_origin",
    "destination_temp": "temp_destination",
    "destination_wind_speed": "wind_speed_destination",
    "destination_precip": "precip_destination",
    "destination_humidity": "humidity_destination",
    "destination_visibility": "visibility_destination",
    "destination_pressure": "pressure_destination",
    "description_origin": "origin_description",
    "description_destination": "destination_description",
}
WIDE_EVENT_TIME = "2024-10-08 00:00:00"

# --- fixed values: features -----------------------------------------------
CONTINUOUS = [
    "route_avg_temp",
    "route_avg_wind_speed",
    "route_avg_precip",
    "route_avg_humidity",
    "route_avg_visibility",
    "route_avg_pressure",
    "distance",
    "average_hours",
    "temp_origin",
    "wind_speed_origin",
    "precip_origin",
    "humidity_origin",
    "visibility_origin",
    "pressure_origin",
    "temp_destination",
    "wind_speed_destination",
    "precip_destination",
    "humidity_destination",
    "visibility_destination",
    "pressure_destination",
    "avg_no_of_vehicles",
    "truck_age",
    "load_capacity_pounds",
    "mileage_mpg",
    "age",
    "experience",
    "average_speed_mph",
]
CATEGORICAL = [
    "route_description",
    "origin_description",
    "destination_description",
    "accident",
    "fuel_type",
    "gender",
    "driving_style",
    "ratings",
    "is_midnight",
]
ENCODED = [
    "route_description",
    "origin_description",
    "destination_description",
    "fuel_type",
    "gender",
    "driving_style",
]
TARGET = "delay"
TRAIN_UNTIL = "2019-01-30 00:00:00"
VALID_UNTIL = "2019-02-07 00:00:00"

# --- fixed values: parameter grids ----------------------------------------
# An inverse regularisation strength of C on n rows is regParam = 1 / (C * n).
# Unlimited tree depth becomes Spark's deepest tree, 30.
LOGISTIC_GRID = {"C": [0.1, 1.0, 10.0], "maxIter": [100, 200]}
FOREST_GRID = {
    "numTrees": [50, 100, 200],
    "maxDepth": [30, 10, 20],
    "minInstancesPerNode": [1, 2],
}
BOOSTED_GRID = {
    "maxIter": [50, 100, 200],
    "stepSize": [0.01, 0.1, 0.2],
    "maxDepth": [3, 6, 10],
}
FOLDS = 3
