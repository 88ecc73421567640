"""Profiles of a table (A3-A12). Several columns are profiled in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetfeatures.operators.quantiles import exact_quantiles


def _unpivot(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns])
    return df.select(F.inline(pairs))


def _literal_rows(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, schema)


def shape(df: DataFrame) -> DataFrame:
    """A3: number of rows and columns."""
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"))


def null_counts(df: DataFrame) -> DataFrame:
    """A4: nulls per column, a row per column."""
    row = [F.struct(F.lit(c).alias("column"), (F.count("*") - F.count(c)).alias("n_null")) for c in df.columns]
    return df.agg(F.array(*row).alias("r")).select(F.inline("r"))


def distinct_counts(df: DataFrame, columns: Sequence[str], *, approximate: bool = False) -> DataFrame:
    """A5: number of different non-null values per column.

    Each column is counted by itself: a scan of one column, whose values every
    task combines before they are shuffled. Rows are not repeated per column.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    together = None
    for c in columns:
        counted = df.select(F.col(c).alias("value")).agg(count("value").alias("n_distinct")).select(F.lit(c).alias("column"), "n_distinct")
        together = counted if together is None else together.unionAll(counted)
    return together


def value_frequencies(df: DataFrame, column: str) -> DataFrame:
    """Non-null values with their counts, most frequent first."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counted.orderBy(F.col("n").desc(), column)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum, a row per column."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    stats = df.agg(*[
        F.struct(F.count(c).alias("n"), F.avg(c).cast("double").alias("mean"), F.stddev_samp(c).alias("std"),
                 F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high")).alias(c)
        for c in columns])
    rows = []
    for c in columns:
        q1, q2, q3 = [F.lit(q).cast("double") for q in (quartiles[c] or [None] * 3)]
        s = F.col(c)
        rows.append(F.struct(
            F.lit(c).alias("column"), s["n"].alias("count"), s["mean"].alias("mean"), s["std"].alias("std"),
            s["low"].alias("min"), q1.alias("q25"), q2.alias("q50"), q3.alias("q75"), s["high"].alias("max")))
    return stats.select(F.inline(F.array(*rows)))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 20) -> DataFrame:
    """Equal-width bins per column, also the empty ones; the last bin is closed.

    A column with one value gets bins over half a unit to either side of it.
    """
    values = _unpivot(df, columns, "double").where("value IS NOT NULL")
    ends = df.agg(*[F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c)
                    for c in columns]).first()
    ranges = {}
    for c in columns:
        lo, hi = ends[c]["lo"], ends[c]["hi"]
        if lo is not None:
            ranges[c] = (lo, hi) if lo < hi else (lo - 0.5, hi + 0.5)
    slots = [(c, i + 1, lo + (hi - lo) * i / bins, lo + (hi - lo) * (i + 1) / bins)
             for c, (lo, hi) in ranges.items() for i in range(bins)]
    edges = _literal_rows(df, slots, "column string, bin int, low double, high double")
    bin_no: Column = F.lit(None).cast("int")
    for c, (lo, hi) in ranges.items():
        place = F.floor((F.col("value") - lo) * bins / (hi - lo)).cast("int") + 1
        bin_no = F.when(F.col("column") == c, F.least(place, F.lit(bins))).otherwise(bin_no)
    counted = values.groupBy("column", bin_no.alias("bin")).agg(F.count("*").alias("n"))
    # the edges are columns x bins rows, made here
    return (F.broadcast(edges).join(counted, ["column", "bin"], "left")
            .select("column", "bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n")))


def box_plot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 quartile distances) and outlier count."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    known = [c for c in columns if quartiles[c] is not None]
    aggregates = []
    for c in known:
        q1, _, q3 = quartiles[c]
        inside = F.col(c).between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        aggregates.append(F.struct(
            F.min(F.when(inside, F.col(c))).cast("double").alias("low"),
            F.max(F.when(inside, F.col(c))).cast("double").alias("high"),
            F.count(F.when(~inside, F.lit(1))).alias("outliers")).alias(c))
    rows = [F.struct(F.lit(c).alias("column"), *[F.lit(None).cast("double").alias(n) for n in (
        "whisker_low", "q25", "q50", "q75", "whisker_high")], F.lit(0).cast("long").alias("outliers"))
            for c in columns if c not in known]
    if not known:
        return df.limit(0).agg(F.count("*")).select(F.inline(F.array(*rows)))
    for c in known:
        q1, q2, q3 = [F.lit(float(q)) for q in quartiles[c]]
        rows.append(F.struct(
            F.lit(c).alias("column"), F.col(c)["low"].alias("whisker_low"), q1.alias("q25"), q2.alias("q50"),
            q3.alias("q75"), F.col(c)["high"].alias("whisker_high"), F.col(c)["outliers"].alias("outliers")))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def choices(df: DataFrame, column: str) -> DataFrame:
    """A10: the different values of a column."""
    return df.select(column).distinct()


def bounds(df: DataFrame, column: str) -> DataFrame:
    """Smallest and largest value."""
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def column_report(df: DataFrame) -> DataFrame:
    """Position, name, type and non-null count, a row per column."""
    rows = [F.struct(F.lit(i).alias("position"), F.lit(name).alias("column"), F.lit(kind).alias("type"),
                     F.count(name).alias("n_not_null"))
            for i, (name, kind) in enumerate(df.dtypes)]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))
