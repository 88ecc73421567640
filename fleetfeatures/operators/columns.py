"""Choosing, dropping and renaming columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop those of the columns the frame has."""
    present = available(df, columns)
    return df.drop(*present) if present else df


def drop_from_all(tables: Tables, columns: Sequence[str]) -> dict[str, DataFrame]:
    """Drop the columns wherever they occur."""
    return {name: drop_columns(df, columns) for name, df in tables.items()}


def drop_by_table(tables: Tables, columns: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Drop columns per table; unknown tables and columns are skipped."""
    return {name: drop_columns(df, columns.get(name, ())) for name, df in tables.items()}


def rename_in(tables: Tables, names: Sequence[str], old: str = "date", new: str = "custom_date"
              ) -> dict[str, DataFrame]:
    """Rename one column in the named tables."""
    return {name: df.withColumnRenamed(old, new) if name in names else df for name, df in tables.items()}


def rename_by_pattern(df: DataFrame, patterns: Sequence[tuple[str, str]]) -> DataFrame:
    """Regular-expression rename of all columns, one pattern after the other."""
    names = df.columns
    for pattern, replacement in patterns:
        names = [re.sub(pattern, replacement, n) for n in names]
    return df if names == df.columns else df.toDF(*names)


def rename_by_map(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """P5: rename by mapping; names the frame lacks are skipped."""
    known = {k: v for k, v in renames.items() if k in df.columns}
    return df.withColumnsRenamed(known) if known else df


def available(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The wanted columns the frame has, in the wanted order."""
    return [c for c in columns if c in df.columns]


def select_available(df: DataFrame, columns: Sequence[str], target: str | None = None) -> DataFrame:
    """The wanted columns the frame has, and the target."""
    return df.select(*available(df, columns), *([target] if target else []))


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """The required columns the frame lacks."""
    return [c for c in required if c not in df.columns]


def required_columns_report(spark: SparkSession, df: DataFrame, required: Sequence[str]) -> DataFrame:
    """A row per required column, and whether it is there."""
    rows = [(c, c in df.columns) for c in required]
    return spark.createDataFrame(rows, "column string, present boolean")


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None, value: object = 0) -> list[str]:
    """The columns that hold ``value`` in every row (any one value if None) and no null, found in one pass."""
    columns = list(columns or df.columns)

    def holds(c: str) -> Column:
        wanted = F.lit(True) if value is None else F.min(c) == F.lit(value).try_cast(df.schema[c].dataType)
        return F.coalesce((F.min(c) == F.max(c)) & (F.count(c) == F.count("*")) & wanted, F.lit(False))

    checks = [holds(c).alias(c) for c in columns]
    row = df.agg(*checks).first()
    return [c for c in columns if row[c]]


def drop_constant_columns(df: DataFrame, columns: Sequence[str] | None = None, value: object = 0) -> DataFrame:
    """Drop the columns that say nothing."""
    return df.drop(*constant_columns(df, columns, value))


def add_constant(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Append a constant column."""
    return df.withColumn(name, value)
