"""How results are put out: times without zone, computed doubles to fixed digits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def plain_times(df: DataFrame) -> DataFrame:
    """Zoned times as zone-less UTC times."""
    zoned = [c for c, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


HAIR = 1.3e-8


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Computed doubles to fixed digits, since the order of a sum is free.

    Means of 2, 4, 8 ... two-digit numbers lie exactly on rounding ties; the
    hair added here and in :func:`sql_rounded` sends them the same way on both
    sides.
    """
    return df.withColumns({c: F.round(F.col(c) + HAIR, digits) for c in columns})


def sql_rounded(expression: str, name: str | None = None, digits: int = 6) -> str:
    """The check SQL of :func:`rounded`."""
    return f"round({expression} + CAST({HAIR} AS DOUBLE), {digits})" + (f" AS {name}" if name else "")
