"""Aggregates over the slots of a truck-route pair (A1, A2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetfeatures.constants import PAIR_KEYS, WEATHER_MEASURES
from fleetfeatures.functions.timegrid import as_utc
from fleetfeatures.operators.ranges import counts_over_spans, exact, signed_places, slot_number, sums_over_spans


def _keys_present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present


def route_weather_means(df: DataFrame, keys: Sequence[str] = PAIR_KEYS) -> DataFrame:
    """A1: mean of each weather measure and the most frequent description per key.

    Sums and counts per (key, description) first: plain buffers that every task
    combines before the shuffle. The means and the description (smallest of
    equally frequent ones) follow from those few rows. Null keys form no group.
    """
    sums = [F.sum(m).alias(f"sum_{m}") for m in WEATHER_MEASURES]
    counts = [F.count(m).alias(f"n_{m}") for m in WEATHER_MEASURES]
    per_text = (df.where(_keys_present(keys)).groupBy(*keys, "description")
                .agg(*sums, *counts, F.count("description").alias("n_text")))
    means = [F.try_divide(F.sum(f"sum_{m}"), F.sum(f"n_{m}")).alias(f"route_avg_{m}") for m in WEATHER_MEASURES]
    ranked = F.when(F.col("description").isNotNull(),
                    F.struct((-F.col("n_text")).alias("less"), F.col("description").alias("text")))
    grouped = per_text.groupBy(*keys).agg(*means, F.min(ranked).alias("__top"))
    return grouped.withColumn("route_description", F.col("__top.text")).drop("__top")


def traffic_means(df: DataFrame, keys: Sequence[str] = PAIR_KEYS, vehicles: str = "no_of_vehicles",
                  accident: str = "accident") -> DataFrame:
    """A2: mean number of vehicles, and 1 if any hour had an accident, else 0."""
    return df.where(_keys_present(keys)).groupBy(*keys).agg(
        F.avg(vehicles).alias("avg_no_of_vehicles"),
        F.coalesce(F.max((F.col(accident) == 1).cast("int")), F.lit(0)).alias("accident"))


def traffic_by_hour(traffic: DataFrame) -> DataFrame:
    """Traffic rows summed per route and hour, so that joining slots to it multiplies nothing.

    A2 over these sums (:func:`traffic_means_from_sums`) equals A2 over the rows.
    """
    return traffic.groupBy("route_id", "date").agg(
        F.sum("no_of_vehicles").alias("sum_vehicles"),
        F.count("no_of_vehicles").alias("n_vehicles"),
        F.max((F.col("accident") == 1).cast("int")).alias("any_accident"))


def traffic_means_from_sums(df: DataFrame, keys: Sequence[str] = PAIR_KEYS) -> DataFrame:
    """A2 over slots joined to :func:`traffic_by_hour`."""
    return df.where(_keys_present(keys)).groupBy(*keys).agg(
        F.try_divide(F.sum("sum_vehicles"), F.sum("n_vehicles")).alias("avg_no_of_vehicles"),
        F.coalesce(F.max("any_accident"), F.lit(0)).alias("accident"))


def route_weather_means_over_spans(spans: DataFrame, weather: DataFrame, first: Column, last: Column, micros: int,
                                   keys: Sequence[str] = PAIR_KEYS, date: str = "date") -> DataFrame:
    """A1 for spans of slots (:mod:`operators.ranges`): the same rows as :func:`route_weather_means` over their slots."""
    at = slot_number(as_utc(date), micros)
    sums = [F.sum(exact(m)).alias(f"sum_{m}") for m in WEATHER_MEASURES]
    counts = [F.count(exact(m)).alias(f"n_{m}") for m in WEATHER_MEASURES]
    per_slot = weather.withColumn("slot", at).groupBy("route_id", "slot").agg(*sums, *counts)
    per_text = weather.withColumn("slot", at).groupBy("route_id", "slot", "description").agg(F.count("*").alias("n_text"))
    signed = signed_places(spans, keys, first, last)
    totals = sums_over_spans(signed, per_slot, keys, ["route_id"], [f"{a}_{m}" for a in ("sum", "n") for m in WEATHER_MEASURES])
    means = totals.select(*keys, *[F.try_divide(F.col(f"sum_{m}").cast("double"), F.col(f"n_{m}")).alias(f"route_avg_{m}") for m in WEATHER_MEASURES])
    texts = counts_over_spans(signed, per_text, keys, ["route_id"], "description", "n_text")
    top = texts.groupBy(*keys).agg(F.min(F.struct((-F.col("n_text")).alias("less"), "description")).alias("top"))
    return means.join(top.select(*keys, F.col("top.description").alias("route_description")), list(keys), "left")


def traffic_means_over_spans(spans: DataFrame, traffic: DataFrame, first: Column, last: Column, micros: int,
                             keys: Sequence[str] = PAIR_KEYS, date: str = "date") -> DataFrame:
    """A2 for spans of slots: the same rows as :func:`traffic_means` over their slots."""
    per_slot = traffic.withColumn("slot", slot_number(as_utc(date), micros)).groupBy("route_id", "slot").agg(
        F.sum(exact("no_of_vehicles")).alias("vehicles"), F.count(exact("no_of_vehicles")).alias("n_vehicles"),
        F.count(F.when(F.col("accident") == 1, 1)).alias("accidents"))
    totals = sums_over_spans(signed_places(spans, keys, first, last), per_slot, keys, ["route_id"], ["vehicles", "n_vehicles", "accidents"])
    return totals.select(*keys, F.try_divide(F.col("vehicles").cast("double"), F.col("n_vehicles")).alias("avg_no_of_vehicles"),
                         (F.col("accidents") > 0).cast("int").alias("accident"))
