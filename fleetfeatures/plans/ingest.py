"""CSV folder to tables to dictionary of frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetfeatures.constants import TABLES
from fleetfeatures.schemas import table_schema
from fleetfeatures.sources.catalog import load_all_tables
from fleetfeatures.sources.files import land_folder


def ingest(spark: SparkSession, folder: str, database: str = "default") -> dict[str, DataFrame]:
    """Land every CSV file below ``folder``, known tables by their declared schema, and read them back."""
    land_folder(spark, folder, database, {name: table_schema(name) for name in TABLES})
    return load_all_tables(spark, database) or {}
