"""Catalog tables: read, query, list."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


def load_table(spark: SparkSession, name: str, database: str = "default") -> DataFrame:
    """A whole table."""
    return spark.table(f"{database}.{name}")


def query(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """The result of a query text; ``{name}`` in it stands for a frame passed by name."""
    return spark.sql(text, **tables)


def table_names(spark: SparkSession, database: str = "default") -> list[str]:
    """Names of the tables in a database, temporary views not included."""
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def load_all_tables(spark: SparkSession, database: str = "default") -> dict[str, DataFrame] | None:
    """Every table of the database as a lazy frame; None if it cannot be read."""
    try:
        return {name: load_table(spark, name, database) for name in table_names(spark, database)}
    except AnalysisException as error:
        log.error("cannot read database %s: %s", database, error)
        return None
