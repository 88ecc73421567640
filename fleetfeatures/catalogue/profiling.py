"""Queries on profiles of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetfeatures.catalogue import register
from fleetfeatures.catalogue.shaping import plain_times, rounded, sql_rounded
from fleetfeatures.catalogue.views import table, view, with_views
from fleetfeatures.operators import profile

_TRAFFIC = ["rowindex", "route_id", "date", "hour", "no_of_vehicles", "accident"]
_LINES = ["l_quantity", "l_extendedprice", "l_discount"]


@register("shape", "SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns FROM orders")
def shape(spark: SparkSession, folder: str) -> DataFrame:
    return profile.shape(table(spark, folder, "orders"))


@register("null_counts", with_views("traffic", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count({c}) AS n_null FROM traffic""" for c in _TRAFFIC)))
def null_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.null_counts(view(spark, folder, "traffic"))


@register("distinct_counts", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct FROM lineitem"""
    for c in ("l_quantity", "l_returnflag", "l_suppkey")))
def distinct_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.distinct_counts(table(spark, folder, "lineitem"), ["l_quantity", "l_returnflag", "l_suppkey"])


@register("value_freq", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def value_freq(spark: SparkSession, folder: str) -> DataFrame:
    return profile.value_frequencies(table(spark, folder, "orders"), "o_orderpriority")


@register("describe", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS "count", {sql_rounded(f'avg({c})', 'mean')},
       {sql_rounded(f'stddev_samp({c})', 'std')}, min({c})::DOUBLE AS min,
       {sql_rounded(f'quantile_cont({c}, 0.25::DOUBLE)', 'q25')}, {sql_rounded(f'quantile_cont({c}, 0.5::DOUBLE)', 'q50')},
       {sql_rounded(f'quantile_cont({c}, 0.75::DOUBLE)', 'q75')}, max({c})::DOUBLE AS max FROM lineitem""" for c in _LINES))
def describe(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.describe(table(spark, folder, "lineitem"), _LINES), ["mean", "std", "q25", "q50", "q75"])


_HISTOGRAM = " UNION ALL ".join(f"""
SELECT '{c}' AS "column", b.bin::INT AS bin, {sql_rounded('lo + (hi - lo) * (b.bin - 1) / 20', 'low')},
       {sql_rounded('lo + (hi - lo) * b.bin / 20', 'high')}, count(v) AS n
FROM (SELECT min({c}) AS lo, max({c}) AS hi FROM {{t}}) e CROSS JOIN range(1, 21) b(bin)
LEFT JOIN (SELECT {c} AS v, least(floor(({c} - lo) * 20 / (hi - lo)) + 1, 20) AS bin
           FROM {{t}}, (SELECT min({c}) AS lo, max({c}) AS hi FROM {{t}})) x ON x.bin = b.bin
GROUP BY b.bin, lo, hi""" for c in ("value", "user_id"))


@register("histogram20", _HISTOGRAM.format(t="events"))
def histogram20(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.histogram(table(spark, folder, "events"), ["value", "user_id"]), ["low", "high"])


@register("boxplot", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", min(CASE WHEN i THEN {c} END)::DOUBLE AS whisker_low, {sql_rounded('q1', 'q25')},
       {sql_rounded('q2', 'q50')}, {sql_rounded('q3', 'q75')}, max(CASE WHEN i THEN {c} END)::DOUBLE AS whisker_high,
       count(CASE WHEN NOT i THEN 1 END) AS outliers
FROM (SELECT {c}, q1, q2, q3, {c} BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1) AS i
      FROM {t}, (SELECT quantile_cont({c}, 0.25::DOUBLE) AS q1, quantile_cont({c}, 0.5::DOUBLE) AS q2,
                        quantile_cont({c}, 0.75::DOUBLE) AS q3 FROM {t})) GROUP BY q1, q2, q3"""
    for c, t in (("o_totalprice", "orders"), ("o_custkey", "orders"))))
def boxplot(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.box_plot(table(spark, folder, "orders"), ["o_totalprice", "o_custkey"]),
                   ["q25", "q50", "q75"])


@register("choices", with_views("sched", "SELECT DISTINCT truck_id FROM sched"))
def choices(spark: SparkSession, folder: str) -> DataFrame:
    return profile.choices(view(spark, folder, "sched"), "truck_id")


@register("date_bounds", with_views("sched", """
SELECT min(departure_date) AS min_value, max(departure_date) AS max_value FROM sched"""))
def date_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(profile.bounds(view(spark, folder, "sched"), "departure_date"))


@register("schema_report", with_views("traffic", " UNION ALL ".join(
    f"""SELECT {i} AS position, '{c}' AS "column", '{t}' AS type, count({c}) AS n_not_null FROM traffic"""
    for i, (c, t) in enumerate(zip(_TRAFFIC, ["bigint", "string", "string", "int", "double", "int"])))))
def schema_report(spark: SparkSession, folder: str) -> DataFrame:
    return profile.column_report(view(spark, folder, "traffic"))


