"""Raw tables to clean tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from fleetfeatures.constants import DATE_HOUR_TABLES, NEGATIVE_COLUMNS, OUTLIER_COLUMNS, TABLES
from fleetfeatures.functions.timegrid import date_and_military_hour, floor_hour, parse_timestamp
from fleetfeatures.operators.cleaning import fill_missing, fix_negatives, remove_outliers_by_table
from fleetfeatures.operators.numbering import add_row_index
from fleetfeatures.schemas import column_comments
from fleetfeatures.sources.feature_store import stamp_event_time, write_feature_table


def merge_date_hour(df: DataFrame, date: str = "date", hour: str = "hour") -> DataFrame:
    """T2 on a table: the date column becomes the point in time, the hour column goes."""
    return df.withColumn(date, date_and_military_hour(date, hour)).drop(hour)


def parse_date_column(df: DataFrame, column: str) -> DataFrame:
    """T1 on a table."""
    return df.withColumn(column, parse_timestamp(column))


def floor_arrival(df: DataFrame, column: str = "estimated_arrival") -> DataFrame:
    """T1 and T3 on a table: readable arrivals at the start of their hour."""
    return df.withColumn(column, floor_hour(parse_timestamp(column)))


def clean_tables(tables: Mapping[str, DataFrame], order_by: Mapping[str, Sequence[str]],
                 outlier_columns: Mapping[str, Sequence[str]] = OUTLIER_COLUMNS) -> dict[str, DataFrame]:
    """Fill, number, fix negatives, join date and hour, parse, floor, remove outliers; in this order.

    ``order_by`` names per table the columns whose order stands for the order
    of the file. Each table stays one lazy plan; what runs here are the
    aggregates whose few results (fills, means, quartiles) the plan contains.
    """
    cleaned = {}
    for name, df in tables.items():
        df = add_row_index(fill_missing(df), order_by[name])
        if name in NEGATIVE_COLUMNS:
            df = fix_negatives(df, NEGATIVE_COLUMNS[name])
        if name in DATE_HOUR_TABLES:
            df = merge_date_hour(df)
        if name == "routes_weather":
            df = parse_date_column(df, "Date")
        if name == "truck_schedule_table":
            df = floor_arrival(df)
        cleaned[name] = df
    return remove_outliers_by_table(cleaned, outlier_columns)


def store_clean_tables(tables: Mapping[str, DataFrame], location: str, *, version: int = 1,
                       event_time: str | None = None, database: str = "default") -> list[str]:
    """The clean tables as feature tables keyed by ``rowindex``, names in lower case."""
    stored = []
    for name in TABLES:
        if name in tables:
            df = stamp_event_time(tables[name], "eventtime", event_time)
            df = df.toDF(*[c.lower() for c in df.columns])
            stored.append(write_feature_table(
                df, name, version, location, primary_key=["rowindex"], event_time="eventtime",
                description=f"Features for {name}", database=database, keys_unique=True,
                comments={c.lower(): text for c, text in column_comments(name).items()}))
    return stored
