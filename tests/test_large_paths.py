"""The ways taken beyond one task, forced on small data and compared with brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_plans import plan_of

from fleetfeatures.catalogue.shaping import HAIR
from fleetfeatures.catalogue.views import ORDER, trip_tables
from fleetfeatures.operators import quantiles
from fleetfeatures.operators.cleaning import rows_with_repeats
from fleetfeatures.operators.joins import hot_key_sets, hot_keys, join_on
from fleetfeatures.operators.models import with_folds
from fleetfeatures.operators.numbering import add_row_index, forward_fill, number_rows
from fleetfeatures.operators.quantiles import exact_quantiles
from fleetfeatures.plans import merge


def test_numbers_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("g"))
    got = add_row_index(df, ["g", "k"]).toPandas().sort_values("rowindex")
    want = df.toPandas().sort_values(["g", "k"])
    assert list(got.columns) == ["rowindex", "k", "g"]
    assert got["rowindex"].tolist() == list(range(1, 5001))
    assert got["k"].tolist() == want["k"].tolist()
    zero = number_rows(df, "n", ["k"], start=0)
    assert zero.where("n <> k").count() == 0


def test_numbers_with_a_hot_leading_value(spark):
    df = spark.range(0, 9000, 1, 9).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    got = number_rows(df, "n", ["k", "id"])
    want = df.toPandas().sort_values(["k", "id"])["id"].tolist()
    assert got.orderBy("n").toPandas()["id"].tolist() == want


@pytest.mark.parametrize("by", [[], ["user"]])
def test_forward_fill_over_many_blocks(spark, by):
    rng = random.Random(3)
    data = [(i, rng.choice(["hot", "hot", "a", "b"]), rng.random() if rng.random() < 0.02 else None,
             "x%d" % i if rng.random() < 0.1 else None) for i in range(4000)]
    df = spark.createDataFrame(data, "i int, user string, v double, s string").repartition(6)
    got = forward_fill(df, ["v", "s"], ["i"], by).toPandas().sort_values("i")
    want = pd.DataFrame(data, columns=["i", "user", "v", "s"])
    filled = want.groupby("user")[["v", "s"]].ffill() if by else want[["v", "s"]].ffill()
    for c in ("v", "s"):
        a, b = got[c].tolist(), filled[c].tolist()
        assert [None if pd.isna(x) else x for x in a] == [None if pd.isna(x) else x for x in b]


@settings(max_examples=12, deadline=None)
@given(values=st.lists(st.one_of(st.floats(-1e9, 1e9), st.integers(-3, 3).map(float), st.just(7.5)),
                       min_size=1, max_size=300), cells=st.sampled_from([2, 3, 16]))
def test_quantiles_by_cells(spark, values, cells):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = exact_quantiles(df, ["x"], probs, cells=cells)["x"]
    assert got == pytest.approx(list(np.quantile(values, probs)), rel=1e-12, abs=1e-12)


def test_quantiles_with_a_hot_value_and_empty_column(spark):
    values = [5.0] * 4000 + [float(i) for i in range(6000)]
    df = spark.createDataFrame([(v, None) for v in values], "x double, e double")
    got = exact_quantiles(df, ["x", "e"], [0.25, 0.5, 0.75])
    assert got["x"] == list(np.quantile(values, [0.25, 0.5, 0.75]))
    assert exact_quantiles(df, ["x", "e"], [0.5]) == {"x": [float(np.quantile(values, 0.5))], "e": None}


def test_quantiles_of_odd_values(spark):
    rows = [(float("nan"), 1.0), (None, float("inf")), (5.0, float("inf")), (1.0, float("-inf")), (9.0, 2.0)] * 3
    df = spark.createDataFrame(rows, "x double, y double")
    got = exact_quantiles(df, ["x", "y"], [0.0, 0.5, 1.0])
    assert got == {"x": [1.0, 5.0, 9.0], "y": [float("-inf"), 2.0, float("inf")]}
    assert exact_quantiles(df.limit(0), ["x"], [0.5]) == {"x": None}
    wide = spark.createDataFrame([(-1.7e308,), (0.0,), (1.7e308,)], "x double")
    assert exact_quantiles(wide, ["x"], [0.0, 0.5, 0.75, 1.0])["x"] == [-1.7e308, 0.0, 0.85e308, 1.7e308]


@pytest.mark.parametrize("n", [10, 1000, 500_000])
def test_quantiles_do_not_depend_on_size(spark, n):
    values = [(i * 7919 % n) // 3 + 0.1 for i in range(n)]
    df = spark.range(n).select((F.floor((F.col("id") * 7919 % n) / 3) + 0.1).alias("x"))
    assert exact_quantiles(df, ["x"], [0.25, 0.5, 0.75])["x"] == list(np.quantile(values, [0.25, 0.5, 0.75]))


def skewed(spark, n=6000):
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 8).select(
        F.when(hot, None).when(F.col("id") % 7 == 0, F.lit(-5)).otherwise(F.col("id") % 100).cast("int").alias("k"),
        F.when(hot, F.lit(0)).otherwise(F.col("id")).alias("v"))


def test_hot_keys_are_found(spark):
    df = skewed(spark)
    assert len(hot_keys(df, ["k"], share=0.05, min_rows=1)) == 2
    assert hot_keys(df, ["k"]) == []
    both = hot_key_sets(df, {"k": ["k"], "kv": ["k", "v"]}, share=0.2, min_rows=1)
    assert [len(both["k"]), len(both["kv"])] == [1, 1]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = skewed(spark)
    right = spark.createDataFrame([(None, 1), (None, 2), (-5, 3), (4, 4), (4, 5), (1000, 6)], "k bigint, w int")
    hot = hot_keys(left, ["k"], share=0.05, min_rows=1)
    plain, salted = join_on(left, right, ["k"], how), join_on(left, right, ["k"], how, hot=hot, salts=8)
    assert salted.columns == plain.columns
    assert salted.count() == plain.count()
    assert salted.exceptAll(plain).count() == 0


def test_salt_spreads_equal_rows(spark):
    left = spark.range(0, 8000, 1, 8).select(F.lit(1).alias("k"), F.lit("copy").alias("v"))
    right = spark.createDataFrame([(1, 9)], "k int, w int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_on(left, right, ["k"], hot=hot_keys(left, ["k"], min_rows=1), salts=64)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in sizes) == 8000 and max(r["count"] for r in sizes) < 8000


def test_adaptive_execution_bounds_tasks_at_any_share(spark):
    """Keys of 0.5% and of 40% of the rows: no task joins much more than its part, without any hint or threshold of rows."""
    left = spark.range(0, 200_000, 1, 16).select(F.when(F.col("id") % 5 < 2, 0).when(F.col("id") % 200 == 4, 1).otherwise(F.col("id")).alias("k"),
                                                 F.sha2(F.col("id").cast("string"), 256).alias("v"))
    right = spark.range(0, 200_000, 1, 4).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("w"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k", "spark.sql.shuffle.partitions": "64",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = join_on(left, right, ["k"])
        # the values are asked for too, so that they are shuffled
        tasks = joined.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.max("v"), F.max("w")).toPandas()["n"]
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert tasks.sum() == 200_000 and tasks.max() < 20_000 < 80_000


def test_repeats_with_hot_values(spark):
    df = skewed(spark)
    assert rows_with_repeats(df, "v", hot_min_rows=1).count() == df.where("v = 0").count()
    assert rows_with_repeats(df, "k", hot_min_rows=1).count() == rows_with_repeats(df, "k").count() == df.count()


@pytest.mark.parametrize("seed", [1, 2])
def test_three_scans_settle_quantiles(spark, monkeypatch, seed):
    """The sketch, a count of cells, and the values of a few rows; with many equal values, and when the sketch is wrong."""
    scans = []
    for name in ("_count_spans", "_count_cells"):
        def counted(*args, call=getattr(quantiles, name)):
            scans.append(call)
            return call(*args)
        monkeypatch.setattr(quantiles, name, counted)
    df = spark.range(0, 400_000, 1, 8).select(F.randn(seed).alias("x"), F.when(F.rand(seed) < 0.4, 7.0).otherwise(F.exp(F.randn(seed + 5) * 9)).alias("y"))
    df = df.where("x IS NOT NULL").repartition(4).persist()
    values = df.toPandas()
    got = exact_quantiles(df, ["x", "y"], [0.25, 0.5, 0.75])
    assert got == {c: list(np.quantile(values[c], [0.25, 0.5, 0.75])) for c in "xy"} and len(scans) <= 2
    monkeypatch.setattr(quantiles, "REACH", 0.0)  # ranks next to what the sketch says are in the gaps
    assert exact_quantiles(df, ["x", "y"], [0.25, 0.5, 0.75]) == got
    monkeypatch.setattr(quantiles, "FETCHED", 10)
    assert exact_quantiles(df, ["x", "y"], [0.25, 0.5, 0.75]) == got
    df.unpersist()


def test_quantiles_next_to_zero(spark):
    df = spark.createDataFrame([(0.0,), (5e-324,), (5e-324,), (1e-323,)], "x double")
    assert exact_quantiles(df, ["x"], [0.0, 1 / 3, 1.0])["x"] == [0.0, 5e-324, 1e-323]


def test_folds_do_not_depend_on_partitions(spark):
    df = spark.range(0, 5000).select("id", F.when(F.col("id") % 10 < 3, 1).when(F.col("id") % 10 < 9, 0).alias("delay"))
    want = {tuple(r) for r in with_folds(df.repartition(3), ["id"], rows=100).collect()}
    assert {tuple(r) for r in with_folds(df.repartition(17, "id"), ["id"], rows=100).collect()} == want and len(want) == 5000
    sizes = spark.createDataFrame(sorted(want, key=repr), "id long, delay int, fold int").groupBy("delay").pivot("fold", [0, 1, 2]).count().collect()
    assert len(sizes) == 3 and all(max(r[1:]) - min(r[1:]) <= 1 for r in sizes)
    assert "rangepartitioning" not in plan_of(with_folds(df, ["id"]), "simple")


def test_folds_are_stratified_beyond_one_task(spark):
    df = spark.range(0, 3001, 1, 5).select("id", (F.col("id") % 10 == 0).cast("int").alias("delay"))
    sizes = with_folds(df, ["id"]).groupBy("delay").pivot("fold", [0, 1, 2]).count().collect()
    for r in sizes:
        assert max(r[1:]) - min(r[1:]) <= 1


@pytest.fixture(scope="module")
def trips(spark, sf):
    return trip_tables(spark, sf)


def equal(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    # the hair keeps sums whose last digits differ on one side of a rounding tie
    a = a.select(*[F.round(F.col(c) + HAIR, 6).alias(c) if t == "double" else F.col(c) for c, t in a.dtypes])
    b = b.select(*a.columns)
    b = b.select(*[F.round(F.col(c) + HAIR, 6).alias(c) if t == "double" else F.col(c) for c, t in b.dtypes])
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_wide_trips_with_everything_hot(spark, trips):
    hot = merge.hot_trip_keys(trips, min_rows=10)
    assert hot.route and hot.truck and hot.pair
    equal(merge.wide_trips(trips, ORDER, hot=hot, drop_nulls=False),
          merge.wide_trips(trips, ORDER, hot=merge.HotKeys(), drop_nulls=False))


def test_wide_trips_have_no_duplicates_and_one_row_per_trip(spark, trips):
    wide = merge.wide_trips(trips, ORDER, drop_nulls=False)
    prepared = merge.prepare_tables(trips, ORDER)
    assert wide.count() == wide.drop("unique_id").distinct().count() == prepared["truck_schedule_table"].count()


def test_traffic_by_hour_equals_traffic_by_rows(spark, trips):
    prepared = merge.prepare_tables(trips, ORDER)
    equal(merge.traffic_per_pair(prepared), merge.traffic_per_pair_by_rows(prepared))


def test_spine_equals_rejoined_schedule(spark, trips):
    prepared = merge.prepare_tables(trips, ORDER)
    equal(merge.trips_on_one_spine(prepared), merge.merge_back(prepared))
