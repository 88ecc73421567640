"""Sums over spans of a time grid from running totals: two lookups a span, whatever its length (G1/G2 + J1/J6 + A1/A2).

A span from slot ``first`` to slot ``last`` covers what happened up to ``last`` less what happened up to ``first - 1``. So
spans are not multiplied into their slots. They become signed places (+1 at ``last``, -1 before ``first``); places of one
owner that coincide are added up before they are shuffled; facts are summed per key and slot, and their running totals are
taken at every slot that has facts or is looked up. A key has at most as many of those as the time grid has slots, however
many spans or facts it has, so a key that holds a third of the trips or of the facts stays bounded. Owner and running totals
meet by (key, slot).

Sums are exact: doubles enter as decimals with ten places (:func:`exact`), so differences of large totals lose nothing.

Reversed spans and spans with an open end have one slot, null, as in ``operators.slots``: they cover the facts without a
slot. Facts between the slots of the grid are covered by no span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The number of the null slot; it is the least, so it is in every running total and goes with the difference.
NO_SLOT = -(2 ** 62)
_LARGEST = 1e18


def exact(column: str) -> Column:
    """A number as a decimal with ten places; not-a-number is missing, a number of 10^18 or more is an error, not a loss."""
    value = F.col(column).cast("double")
    fits = F.when(F.abs(value) < _LARGEST, F.col(column).cast("decimal(28,10)"))
    return F.when(value.isNotNull() & ~F.isnan(value), fits.otherwise(F.raise_error(F.lit(f"{column} is too large for exact sums"))))


def slot_number(time: Column, micros: int) -> Column:
    """The number of a time on the grid; ``NO_SLOT`` for null, null between two slots."""
    at = F.unix_micros(time)
    # exact multiples only, so the division has no remainder on either side of 1970
    return F.when(at.isNull(), F.lit(NO_SLOT)).when(F.pmod(at, F.lit(micros)) == 0, (at / micros).cast("long"))


def signed_places(spans: DataFrame, owner: Sequence[str], first: Column, last: Column) -> DataFrame:
    """owner, slot, sign: the two places of every span, added up per owner and slot; owners with a null key have none."""
    known = spans.na.drop("any", subset=list(owner)).select(*owner, first.alias("first"), last.alias("last"))
    whole = F.coalesce((F.col("first") <= F.col("last")) & (F.col("first") != NO_SLOT), F.lit(False))
    ends = known.select(*owner, F.when(whole, F.col("last")).otherwise(F.lit(NO_SLOT)).alias("slot"), F.lit(1).cast("long").alias("sign"))
    starts = known.filter(whole).select(*owner, (F.col("first") - 1).alias("slot"), F.lit(-1).cast("long").alias("sign"))
    return ends.unionAll(starts).groupBy(*owner, "slot").agg(F.sum("sign").alias("sign")).filter("sign <> 0")


def running_totals(facts: DataFrame, places: DataFrame, key: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """key, slot and the totals of ``sums`` up to that slot, for every slot in ``facts`` or ``places``."""
    there = facts.filter(F.col("slot").isNotNull()).select(*key, "slot", *sums)
    asked = places.select(*key, "slot", *[F.lit(None).cast(dict(facts.dtypes)[c]).alias(c) for c in sums])
    per_slot = there.unionByName(asked).groupBy(*key, "slot").agg(*[F.sum(c).alias(c) for c in sums])
    until = Window.partitionBy(*key).orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_slot.select(*key, "slot", *[F.coalesce(F.sum(c).over(until), F.lit(0)).alias(c) for c in sums])


def _difference(joined: DataFrame, groups: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Signed totals added up; a decimal keeps its ten places, which a product with a 64-bit sign would not."""
    kinds = dict(joined.dtypes)
    return joined.groupBy(*groups).agg(*[
        F.sum(F.col("sign").cast("decimal(9,0)") * F.col(c).cast("decimal(28,10)") if kinds[c].startswith("decimal") else F.col("sign") * F.col(c)).alias(c)
        for c in sums])


def sums_over_spans(signed: DataFrame, facts: DataFrame, owner: Sequence[str], key: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """owner and the sums of the facts that its spans cover, a fact as often as spans cover it; every owner has a row."""
    totals = running_totals(facts, signed, key, sums)
    return _difference(signed.join(totals, [*key, "slot"]), owner, sums)


def counts_over_spans(signed: DataFrame, facts: DataFrame, owner: Sequence[str], key: Sequence[str], value: str, count: str) -> DataFrame:
    """owner, value, count: how often each value (not null) lies in the owner's spans, from running histograms per key.

    A running histogram has a row for each value its key ever has, at each slot that is looked up: slots of the grid times
    values of a key, whatever the number of spans.
    """
    known = facts.filter(F.col(value).isNotNull() & F.col("slot").isNotNull())
    values = known.select(*key, value).distinct()
    places = signed.select(*key, "slot").distinct().join(values, list(key))
    totals = running_totals(known, places, [*key, value], [count])
    return _difference(signed.join(totals, [*key, "slot"]), [*owner, value], [count]).filter(F.col(count) > 0)
