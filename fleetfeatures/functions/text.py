"""Path and JSON text helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LISTING_SCHEMA = "array<struct<name:string,type:string,download_url:string>>"


def is_csv(path: Column | str) -> Column:
    """does the path end in ``.csv``?"""
    return F.endswith(F.col(path) if isinstance(path, str) else path, F.lit(".csv"))


def dataset_of(path: Column | str) -> Column:
    """The file itself, or the ``<name>.csv`` folder whose part files it is one of."""
    column = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(column, r"(\.csv)/part-[^/]*\.csv$", "$1")


def table_name_of(path: Column | str) -> Column:
    """F2/S3: last part of the path, without its ``.csv``."""
    column = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(F.element_at(F.split(column, "/"), -1), r"\.csv", "")


def explode_listing(df: DataFrame, json_column: str) -> DataFrame:
    """a JSON list of file objects to one row per object, other columns kept."""
    entries = F.from_json(F.col(json_column), LISTING_SCHEMA)
    rest = [c for c in df.columns if c != json_column]
    return df.select(*rest, F.inline_outer(entries))
