"""Row numbers and fills over a total order, without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetfeatures.operators.joins import join_on
from fleetfeatures.session import cut_lineage

_POSITION_BITS = 33


def number_rows(df: DataFrame, name: str, order_by: Sequence[str | Column], *, start: int = 1) -> DataFrame:
    """Consecutive numbers along ``order_by``, which must be a total order.

    The frame is range-sorted over all tasks, written to the shared folder (so
    that a lost executor cannot shift the numbers) and each partition's numbers
    start where the one before it ends.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    ordered = cut_lineage(df.orderBy(*order).withColumn("__place", F.monotonically_increasing_id()))
    part = F.shiftright("__place", _POSITION_BITS)
    inside = F.col("__place").bitwiseAND((1 << _POSITION_BITS) - 1)
    # one row per partition: a few thousand at most, whatever the data size
    sizes = ordered.groupBy(part.alias("__part")).agg(F.count("*").alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    numbered = ordered.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    numbered = numbered.withColumn(name, F.col("__offset") + inside + start)
    return numbered.select(*[c for c in df.columns if c != name], name)


def add_row_index(df: DataFrame, order_by: Sequence[str | Column], *, name: str = "rowindex") -> DataFrame:
    """``rowindex`` 1..n as the first column."""
    numbered = number_rows(df, name, order_by)
    return numbered.select(name, *[c for c in df.columns if c != name])


def forward_fill(df: DataFrame, columns: Sequence[str], order_by: Sequence[str],
                 by: Sequence[str] = ()) -> DataFrame:
    """Replace nulls by the last value before them along ``order_by``.

    The whole frame is one run of rows, or each ``by`` group is. The frame is
    range-sorted on group and order, so that a long run spans many tasks: rows
    are filled inside each task's block, and a block's leading nulls take the
    last value of the blocks before it.
    """
    columns, by = list(columns), list(by)
    blocks = cut_lineage(
        df.repartitionByRange(*by, *order_by).withColumn("__block", F.spark_partition_id()))
    seen = (Window.partitionBy(*by, "__block").orderBy(*order_by)
            .rowsBetween(Window.unboundedPreceding, 0))
    filled = blocks.withColumns({c: F.last(c, ignorenulls=True).over(seen) for c in columns})
    place = F.struct(*order_by)
    tails = blocks.groupBy(*by, "__block").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"__tail_{c}") for c in columns])
    earlier = (Window.partitionBy(*by).orderBy("__block")
               .rowsBetween(Window.unboundedPreceding, -1))
    carried = tails.select(
        *by, "__block",
        *[F.last(f"__tail_{c}", ignorenulls=True).over(earlier).alias(f"__carry_{c}") for c in columns])
    joined = join_on(filled, carried, [*by, "__block"], "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"__carry_{c}")) for c in columns}).select(*df.columns)
