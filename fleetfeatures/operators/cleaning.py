"""Missing values, negatives, outliers and duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetfeatures.constants import DEFAULT_DATE
from fleetfeatures.operators.joins import HOT_MIN_ROWS, hot_keys, join_on
from fleetfeatures.operators.quantiles import exact_quantiles
from fleetfeatures.operators.rows import first_per_key
from fleetfeatures.session import cut_lineage

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def fill_values(df: DataFrame) -> dict[str, Any]:
    """What to put in place of nulls, for the columns that have any.

    Numbers get their mean, times the default date, everything else the most
    frequent value, the smallest of equally frequent ones. A column without
    values is left out, so an empty frame gives no fills (C4). Two passes: all
    null counts and means, then, only if a text column has nulls, one count
    per distinct value of those columns.
    """
    fields = df.schema.fields
    numeric = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    counts = [F.count(f.name).alias(f"n_{i}") for i, f in enumerate(fields)]
    means = [F.avg(F.col(c).cast("double")).alias(f"mean_{c}") for c in numeric]
    row = df.agg(F.count("*").alias("rows"), *counts, *means).first()
    gaps = [f for i, f in enumerate(fields) if row[f"n_{i}"] < row["rows"]]
    fills: dict[str, Any] = {}
    labels = []
    for f in gaps:
        if isinstance(f.dataType, T.NumericType):
            if row[f"mean_{f.name}"] is not None:
                fills[f.name] = row[f"mean_{f.name}"]
        elif isinstance(f.dataType, _TIMES):
            fills[f.name] = DEFAULT_DATE
        else:
            labels.append(f.name)
    fills.update(most_frequent(df, labels))
    return fills


def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, Any]:
    """Per column the most frequent value, ties to the smallest; all-null columns are left out.

    Counts are combined before the shuffle and one row per column comes back,
    so neither a frequent value nor many distinct ones gather in one task.
    """
    if not columns:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    counted = (df.select(F.inline(pairs)).where(F.col("value").isNotNull())
               .groupBy("column", "value").agg(F.count("*").alias("n")))
    top = counted.groupBy("column").agg(
        F.min(F.struct((-F.col("n")).alias("less"), F.col("value"))).alias("top"))
    types = dict(df.dtypes)
    rows = top.select("column", F.col("top.value").alias("value")).collect()
    return {r["column"]: (r["value"] == "true") if types[r["column"]] == "boolean" else r["value"]
            for r in rows}


def fill_with(df: DataFrame, fills: Mapping[str, Any]) -> DataFrame:
    """Apply :func:`fill_values`; a whole-number column that had nulls becomes double."""
    filled = {}
    for f in df.schema.fields:
        if f.name not in fills:
            continue
        value = F.lit(fills[f.name])
        if isinstance(f.dataType, _WHOLE):
            filled[f.name] = F.coalesce(F.col(f.name).cast("double"), value.cast("double"))
        else:
            filled[f.name] = F.coalesce(F.col(f.name), value.cast(f.dataType))
    return df.withColumns(filled) if filled else df


def fill_missing(df: DataFrame) -> DataFrame:
    """Fill every column by its type."""
    return fill_with(df, fill_values(df))


def fix_negatives(df: DataFrame, column: str) -> DataFrame:
    """Negatives become the mean of the non-negative values."""
    value = F.col(column).cast("double")
    mean = df.agg(F.avg(F.when(value >= 0, value))).first()[0]
    return df.withColumn(column, F.when(value < 0, F.lit(mean).cast("double")).otherwise(value))


def outlier_bounds(df: DataFrame, column: str) -> tuple[float, float] | None:
    """Quartiles widened by 1.5 times their distance; None for a column without values."""
    quartiles = exact_quantiles(df, [column], [0.25, 0.75])[column]
    if quartiles is None:
        return None
    low, high = quartiles
    return low - 1.5 * (high - low), high + 1.5 * (high - low)


def remove_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows within the bounds, column after column.

    Each column's quartiles are those of the rows the columns before it left.
    Null rows go with the outliers; columns the frame lacks are skipped. The
    bounds enter the plan as literals, so the filters reach the scan.
    """
    for column in columns:
        if column not in df.columns:
            continue
        bounds = outlier_bounds(df, column)
        df = df.where(F.col(column).between(*bounds)) if bounds else df.where(F.lit(False))
    return df


def remove_outliers_by_table(tables: Mapping[str, DataFrame],
                             columns: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Per-table column lists; a table that would end up empty stays as it was."""
    result = dict(tables)
    for name, names in columns.items():
        if name in result:
            cleaned = remove_outliers(result[name], names)
            if not cleaned.isEmpty():
                result[name] = cleaned
    return result


_DIGEST = ["__digest", "__digest2"]


def _by_digest(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with a 128-bit digest each, and the digests that occur more than once.

    Only digests are shuffled to find those; where they are few, joining them
    leaves the rows where they are, so that only rows of such groups move. The
    frame is read twice, so it must give the same rows each time.
    """
    rows = df.withColumns({name: F.xxhash64(F.lit(i), *df.columns) for i, name in enumerate(_DIGEST)})
    counts = rows.groupBy(*_DIGEST).agg(F.count("*").alias("n"))
    return rows, cut_lineage(counts.filter("n > 1").select(*_DIGEST))


def _has_maps(df: DataFrame) -> bool:
    """Maps have no digest; frames with one are grouped by their whole rows."""
    return any("map<" in kind for _, kind in df.dtypes)


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier row in full; rows of equal digest are compared in full."""
    rows = df
    if not _has_maps(df):
        rows, repeated = _by_digest(df)
        rows = rows.join(repeated, _DIGEST, "left_semi")
    groups = rows.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def rows_with_repeats(df: DataFrame, column: str, *, hot_min_rows: int = HOT_MIN_ROWS) -> DataFrame:
    """All rows whose value occurs more than once (nulls count as equal).

    Counting and a semi-join instead of a window per value: a value on a third
    of all rows is counted map-side, and its rows are spread in the join.
    """
    repeated = df.groupBy(column).agg(F.count("*").alias("n")).where("n > 1").select(column)
    return join_on(df, repeated, [column], "left_semi",
                   hot=hot_keys(df, [column], min_rows=hot_min_rows))


def has_repeats(df: DataFrame, column: str) -> DataFrame:
    """One row, does any value occur more than once?"""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.max(F.col("n") > 1), F.lit(False)).alias("any_duplicated"))


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """C11: one row per key, the first along ``order_by``.

    Asking for row number 1 only lets every task cut its rows to one per key
    before the shuffle, so a key with very many copies costs no more than any
    other. Equal orders are decided by the rest of the row, so every run, and
    every use of the result in one plan, sees the same row.
    """
    order = [c for c in order_by if c not in keys]
    order += [c for c, kind in df.dtypes if c not in keys and c not in order and "map<" not in kind]
    return first_per_key(df, keys, [F.col(c).asc() for c in order])


def keep_first_by_table(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]],
                        order_by: Mapping[str, Sequence[str]] | Sequence[str] = ("rowindex",)
                        ) -> dict[str, DataFrame]:
    """C11 for several tables; ``order_by`` is one list for all or one per table."""
    result = dict(tables)
    for name, subset in keys.items():
        if name in result:
            order = order_by[name] if isinstance(order_by, Mapping) else order_by
            known = [c for c in order if c in result[name].columns]
            result[name] = keep_first(result[name], subset, known)
    return result


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One of each row; whole rows are compared where their digest occurs more than once."""
    if _has_maps(df):
        return df.distinct()
    rows, repeated = _by_digest(df)
    once = rows.join(repeated, _DIGEST, "left_anti").select(*df.columns)
    return once.unionAll(rows.join(repeated, _DIGEST, "left_semi").select(*df.columns).distinct())
