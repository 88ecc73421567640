"""Choosing rows: filters, splits, null rows, previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetfeatures.constants import TRAIN_UNTIL, VALID_UNTIL
from fleetfeatures.functions.timegrid import as_utc, timestamp_literal


def drop_null_rows(df: DataFrame) -> DataFrame:
    """Rows without any null."""
    return df.na.drop("any")


def between_dates(df: DataFrame, column: str, first_day: str, last_day: str, *,
                  inclusive_day: bool = False) -> DataFrame:
    """P10: rows from the first day to the last, both included.

    The last day counts up to its midnight only, unless ``inclusive_day``.
    """
    low, high = timestamp_literal(first_day), timestamp_literal(last_day)
    # a zone-less column stays bare so that the bounds reach the scan
    if dict(df.dtypes)[column] == "timestamp_ntz":
        low, high = low.cast("timestamp_ntz"), high.cast("timestamp_ntz")
    if inclusive_day:
        return df.where((F.col(column) >= low) & (F.col(column) < high + F.expr("INTERVAL '1' DAY")))
    return df.where(F.col(column).between(low, high))


def where_equals(df: DataFrame, column: str, choice: object) -> DataFrame:
    """Rows with the chosen value; a choice the column's type cannot hold matches none."""
    return df.where(F.col(column) == F.lit(choice).try_cast(df.schema[column].dataType))


def emptiness(df: DataFrame) -> DataFrame:
    """One row, is the frame empty?"""
    return df.limit(1).agg((F.count("*") == 0).alias("is_empty"))


def split_label(time: str, train_until: str = TRAIN_UNTIL, valid_until: str = VALID_UNTIL) -> Column:
    """Train up to the first cut, valid up to the second, test after; no time, no split."""
    at = as_utc(time)
    return (F.when(at <= timestamp_literal(train_until), "train")
            .when(at <= timestamp_literal(valid_until), "valid")
            .when(at > timestamp_literal(valid_until), "test"))


def split_by_time(df: DataFrame, time: str = "estimated_arrival", train_until: str = TRAIN_UNTIL,
                  valid_until: str = VALID_UNTIL) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The train, validation and test frames."""
    at = as_utc(time)
    first, second = timestamp_literal(train_until), timestamp_literal(valid_until)
    return df.where(at <= first), df.where((at > first) & (at <= second)), df.where(at > second)


def hash_share(keys: Sequence[str], seed: int = 42) -> Column:
    """A number 0-99 that depends on the keys and the seed only."""
    text = F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(100)).cast("int")


def split_at_random(df: DataFrame, keys: Sequence[str], test_percent: int = 20, seed: int = 42
                    ) -> tuple[DataFrame, DataFrame]:
    """About 80/20, every row always on the same side however the data is partitioned."""
    share = hash_share(keys, seed)
    return df.where(share >= test_percent), df.where(share < test_percent)


def preview(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first rows along an order."""
    return df.orderBy(*order_by).limit(n)


def newest(df: DataFrame, time: str, tie: Sequence[str] = ()) -> DataFrame:
    """O1: the one newest row."""
    return df.orderBy(F.col(time).desc(), *tie).limit(1)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row that sorts first in each key group; null keys form a group."""
    place = F.row_number().over(Window.partitionBy(F.struct(*keys)).orderBy(*(order or keys)))
    return df.withColumn("__place", place).where("__place = 1").drop("__place")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key along ``order``; equals are decided by the rest of the row."""
    rest = [c for c, kind in df.dtypes if c not in keys and c not in order and "map<" not in kind]
    return first_per_key(df, keys, [F.col(c).desc() for c in [*order, *rest]])


def best_first(df: DataFrame, score: str, position: str) -> DataFrame:
    """O3: the row with the highest score, the earliest of equals."""
    return df.orderBy(F.col(score).desc(), position).limit(1)

