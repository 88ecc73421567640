"""Hand-made edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetfeatures.constants import CATEGORICAL, CONTINUOUS
from fleetfeatures.functions import timegrid
from fleetfeatures.operators import aggregates, cleaning, columns, features, metrics, profile, rows, slots
from fleetfeatures.operators.joins import join_on
from fleetfeatures.plans.clean import clean_tables


def at(text):
    return dt.datetime.fromisoformat(text)


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_half_hours_go_to_the_even_hour(spark):
    given = ["2024-01-01 00:30:00", "2024-01-01 01:30:00", "2024-01-01 02:30:00", "2024-01-01 02:30:00.000001",
             "2024-01-01 02:29:59.999999", "1969-12-31 22:30:00", "1969-12-31 23:30:00"]
    got = column(spark, given, "string", timegrid.round_hour(timegrid.parse_timestamp("v")))
    assert got == [at("2024-01-01 00:00"), at("2024-01-01 02:00"), at("2024-01-01 02:00"), at("2024-01-01 03:00"),
                   at("2024-01-01 02:00"), at("1969-12-31 22:00"), at("1970-01-01 00:00")]


def test_six_hour_multiples_stay(spark):
    given = ["2024-01-01 06:00:00", "2024-01-01 06:00:00.000001", None, "1969-12-31 17:00:00"]
    stamp = timegrid.parse_timestamp("v")
    assert column(spark, given, "string", timegrid.floor_six_hours(stamp)) == [
        at("2024-01-01 06:00"), at("2024-01-01 06:00"), None, at("1969-12-31 12:00")]
    assert column(spark, given, "string", timegrid.ceil_six_hours(stamp)) == [
        at("2024-01-01 06:00"), at("2024-01-01 12:00"), None, at("1969-12-31 18:00")]


def test_military_hours(spark):
    data = [("2024-01-05", 0), ("2024-01-05", 5), ("2024-01-05", 930), ("2024-01-05", 2300), ("2024-01-05", 2400),
            ("2024-01-05", 1075), ("2024-01-05", None), ("2024-01-05", -100), ("2024-01-05", 10000), ("5th of May", 100),
            (None, 100)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "i int, d string, h int")
    got = [r[0] for r in df.orderBy("i").select(timegrid.date_and_military_hour("d", "h")).collect()]
    assert got == [at("2024-01-05 00:00"), at("2024-01-05 00:05"), at("2024-01-05 09:30"), at("2024-01-05 23:00")] + [None] * 7


def test_zone_less_times_are_utc(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-31 02:30:00' AS n, TIMESTAMP '2024-03-31 02:30:00+02:00' AS z")
    row = df.select(F.unix_seconds(timegrid.as_utc("n")) - F.unix_seconds(timegrid.as_utc("z"))).first()
    assert row[0] == 7200


def spans(spark):
    return spark.sql("""SELECT * FROM VALUES
        (1, TIMESTAMP '2024-01-01 06:00:00', TIMESTAMP '2024-01-01 06:00:00'),
        (2, TIMESTAMP '2024-01-01 07:00:00', TIMESTAMP '2024-01-01 13:00:00'),
        (3, TIMESTAMP '2024-01-02 18:30:00', TIMESTAMP '2024-01-02 05:00:00'),
        (4, NULL, TIMESTAMP '2024-01-01 13:00:00'),
        (5, TIMESTAMP '2024-01-01 13:00:00', NULL) AS t(i, departure_date, estimated_arrival)""")


def test_slots(spark):
    six = slots.six_hour_slots(spans(spark)).groupBy("i").agg(F.count("*"), F.count("date"), F.min("date"))
    assert {r[0]: tuple(r)[1:] for r in six.collect()} == {
        1: (1, 1, at("2024-01-01 06:00")), 2: (3, 3, at("2024-01-01 06:00")), 3: (1, 0, None), 4: (1, 0, None),
        5: (1, 0, None)}
    one = slots.hourly_slots(spans(spark)).groupBy("i").agg(F.count("*"), F.count("custom_date"))
    assert {r[0]: tuple(r)[1:] for r in one.collect()} == {1: (1, 1), 2: (7, 7), 3: (1, 0), 4: (1, 0), 5: (1, 0)}


def test_slot_count_is_span_over_six_hours_plus_one(spark, sf):
    from fleetfeatures.catalogue.views import view
    trips = view(spark, sf, "sched")
    hours = (F.unix_seconds(timegrid.ceil_six_hours("estimated_arrival"))
             - F.unix_seconds(timegrid.floor_six_hours("departure_date"))) / 21600
    expected = trips.select(F.greatest(hours + 1, F.lit(1.0)).alias("n")).agg(F.sum("n")).first()[0]
    assert slots.six_hour_slots(trips).count() == expected


def test_fill_of_ties_nulls_and_empty(spark):
    df = spark.createDataFrame(
        [("b", 1, 1.0, None, None), ("a", None, None, None, True), (None, 4, 2.5, None, True), ("b", 1, None, None, None),
         ("a", 1, None, None, False)], "s string, n int, x double, e string, t boolean")
    assert cleaning.fill_values(df) == {"s": "a", "n": 1.75, "x": 1.75, "t": True}
    filled = cleaning.fill_missing(df)
    assert dict(filled.dtypes)["n"] == "double"
    assert sorted(r["s"] for r in filled.collect()) == ["a", "a", "a", "b", "b"]
    assert {r["e"] for r in filled.collect()} == {None}
    assert cleaning.fill_values(df.limit(0)) == {}
    assert cleaning.fill_missing(df.limit(0)).count() == 0


def test_fill_of_times(spark):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP '2024-01-01 00:00:00'), (NULL) AS t(d)")
    assert {r.d for r in cleaning.fill_missing(df).collect()} == {at("2024-01-01"), at("1970-01-01")}


def test_negatives(spark):
    df = spark.createDataFrame([(-1.0,), (2.0,), (4.0,), (None,), (0.0,)], "x double")
    assert sorted((r.x for r in cleaning.fix_negatives(df, "x").collect()), key=str) == [0.0, 2.0, 2.0, 4.0, None]


def test_outliers_are_removed_column_by_column(spark):
    data = [(float(i), float(i % 7)) for i in range(40)] + [(1000.0, 3.0), (20.0, 900.0), (None, 1.0)]
    df = spark.createDataFrame(data, "a double, b double")
    kept = cleaning.remove_outliers(df, ["a", "absent", "b"])
    assert kept.count() == 40
    stays = cleaning.remove_outliers_by_table({"t": df.withColumn("n", F.lit(None).cast("double"))}, {"t": ["n"]})
    assert stays["t"].count() == 43


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "x", 3), (1, "x", 1), (None, "y", 9), (None, "y", 5), (2, "z", 4), (2, "w", 4)],
                               "k int, v string, rowindex int")
    first = {(r.k, r.v, r.rowindex) for r in cleaning.keep_first(df, ["k"], ["rowindex"]).collect()}
    assert first == {(1, "x", 1), (None, "y", 5), (2, "w", 4)}
    assert cleaning.duplicate_row_count(df.select("k", "v")).first()[0] == 2
    assert cleaning.duplicate_row_count(df.limit(0)).first()[0] == 0
    assert cleaning.rows_with_repeats(df, "k").count() == 6
    assert cleaning.rows_with_repeats(df, "rowindex").count() == 2
    assert cleaning.has_repeats(df, "rowindex").first()[0] is True
    assert cleaning.has_repeats(df.limit(0), "k").first()[0] is False


def test_whole_rows_decide_where_digests_are_equal(spark, monkeypatch):
    # a digest passes over nulls, so the first two rows have the same one; NaN equals NaN, -0.0 equals 0.0, a third of all rows are one
    rows = [(None, "x", 1.0), ("x", None, 1.0), ("n", "n", float("nan")), ("n", "n", float("nan")), ("z", "z", 0.0), ("z", "z", -0.0),
            (None, None, None), (None, None, None), *[("hot", "hot", 5.0)] * 5, ("one", "one", 1.0), ("two", "two", 2.0)]
    df = spark.createDataFrame(rows, "a string, b string, x double")
    for _ in range(2):
        assert cleaning.duplicate_row_count(df).first()[0] == 7
        assert sorted(map(repr, cleaning.drop_duplicate_rows(df).collect())) == sorted(map(repr, df.distinct().collect()))
        assert cleaning.drop_duplicate_rows(df.limit(0)).count() == 0
        monkeypatch.setattr(cleaning, "_DIGEST", ["__only"])  # half the digest, another name: the same rows


def test_rows_that_occur_once_are_not_shuffled(spark):
    wide = spark.range(1000).select("id", *[F.concat(F.lit(f"{i}-"), F.col("id")).alias(f"c{i}") for i in range(30)])
    result = cleaning.drop_duplicate_rows(wide.unionAll(wide.limit(3)))
    assert result.count() == 1000
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_null_keys_match_null_keys(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    right = spark.createDataFrame([(1, 10), (None, 20)], "k int, w int")
    assert {tuple(r) for r in join_on(left, right, ["k"]).collect()} == {(1, "a", 10), (None, "b", 20), (3, "c", None)}
    assert join_on(left, right, ["k"], "left_anti").count() == 1
    with pytest.raises(ValueError, match="both sides"):
        join_on(left, right.withColumn("v", F.lit(1)), ["k"])
    named = join_on(left, right.withColumn("v", F.lit(1)), ["k"], suffixes=("_x", "_y"))
    assert columns.rename_by_pattern(named, [("_x$", "_origin"), ("_y$", "_destination")]).columns == [
        "k", "v_origin", "w", "v_destination"]


def test_accident_in_the_last_row_only_and_without_match(spark):
    df = spark.createDataFrame(
        [(1, "r", 10.0, 0), (1, "r", None, 0), (1, "r", 20.0, 1), (2, "r", None, None), (None, "r", 5.0, 1)],
        "truck_id int, route_id string, no_of_vehicles double, accident int")
    assert {tuple(r) for r in aggregates.traffic_means(df).collect()} == {(1, "r", 15.0, 1), (2, "r", None, 0)}


def test_weather_means(spark):
    measures = "temp double, wind_speed double, precip double, humidity double, visibility double, pressure double"
    df = spark.createDataFrame(
        [(1, "r", "Sunny", 10.0, 1.0, 0.0, 1.0, None, 1.0), (1, "r", "Rain", None, 3.0, 0.0, 1.0, None, 1.0),
         (1, "r", None, 20.0, 2.0, 0.0, 1.0, None, 1.0), (2, "r", None, None, None, None, None, None, None)],
        f"truck_id int, route_id string, description string, {measures}")
    got = {r.truck_id: r for r in aggregates.route_weather_means(df).collect()}
    assert (got[1].route_avg_temp, got[1].route_avg_wind_speed, got[1].route_avg_visibility) == (15.0, 2.0, None)
    assert (got[1].route_description, got[2].route_description, got[2].route_avg_temp) == ("Rain", None, None)


def test_split_at_the_cuts(spark):
    given = ["2019-01-30 00:00:00", "2019-01-30 00:00:01", "2019-02-07 00:00:00", "2019-02-07 00:00:01", None]
    assert column(spark, given, "string", rows.split_label("v")) == ["train", "valid", "valid", "test", None]
    df = spark.createDataFrame([(g,) for g in given], "estimated_arrival string")
    assert [p.count() for p in rows.split_by_time(df)] == [1, 2, 1]


def test_date_range_ends_at_midnight(spark):
    df = spark.sql("""SELECT * FROM VALUES (TIMESTAMP '2024-01-02 00:00:00'), (TIMESTAMP '2024-01-02 08:00:00'),
                      (TIMESTAMP '2024-01-03 00:00:00') AS t(d)""")
    assert rows.between_dates(df, "d", "2024-01-01", "2024-01-02").count() == 1
    assert rows.between_dates(df, "d", "2024-01-01", "2024-01-02", inclusive_day=True).count() == 2


def test_random_split_is_stable(spark):
    df = spark.range(10000)
    train, test = rows.split_at_random(df, ["id"])
    again = rows.split_at_random(df.repartition(5), ["id"])[1]
    assert train.count() + test.count() == 10000 and 1800 < test.count() < 2200
    assert test.exceptAll(again).count() == 0


def test_scaling_of_a_constant_column_and_moments(spark):
    df = spark.createDataFrame([(float(i), 5.0) for i in range(10)], "a double, c double")
    scaled = features.apply_scaling(df, features.fit_scaling(df, ["a", "c"]))
    row = scaled.agg(F.avg("a"), F.stddev_pop("a"), F.min("c"), F.max("c")).first()
    assert row[0] == pytest.approx(0, abs=1e-12) and row[1] == pytest.approx(1) and (row[2], row[3]) == (0.0, 0.0)


def test_one_hot_of_unseen_and_null(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "s string")
    encoding = features.fit_one_hot(train, ["s"])
    assert features.one_hot_names(encoding) == ["s_a", "s_b", "s_None"]
    new = spark.createDataFrame([("c",), (None,), ("a",)], "s string")
    assert [tuple(r) for r in features.apply_one_hot(new, encoding).collect()] == [(0, 0, 0), (0, 0, 1), (1, 0, 0)]


def test_metrics_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 2), (2, 0), (None, 1)], "l int, p int")
    got = metrics.scores(df, "l", "p").first()
    assert got.accuracy == pytest.approx(3 / 5) and got.recall == pytest.approx(3 / 5)
    assert got.precision == pytest.approx((2 * 2 / 4 + 0 + 2 * 1.0) / 5)
    report = {r["row"]: r for r in metrics.class_report(df, "l", "p").collect()}
    assert (report["1"].precision, report["1"].recall, report["1"].f1, report["1"].support) == (0, 0, 0, 1)
    assert report["macro avg"].recall == pytest.approx((1 + 0 + 0.5) / 3)


def test_histogram_of_one_value_and_box_plot(spark):
    df = spark.createDataFrame([(3.0, float(i)) for i in range(10)] + [(3.0, 500.0), (None, None)], "c double, x double")
    one = {r.bin: r.n for r in profile.histogram(df, ["c"]).collect()}
    assert len(one) == 20 and one[11] == 11 and sum(one.values()) == 11
    none = profile.box_plot(df.select(F.lit(None).cast("double").alias("e"), "x"), ["e", "x"]).collect()
    assert {r.column: r.q50 for r in none} == {"e": None, "x": 5.0}
    assert profile.box_plot(df.select(F.lit(None).cast("double").alias("e")), ["e"]).first().outliers == 0
    box = profile.box_plot(df, ["x"]).first()
    assert (box.q50, box.whisker_low, box.whisker_high, box.outliers) == (5.0, 0.0, 9.0, 1)


def test_constant_and_required_columns(spark):
    df = spark.createDataFrame([(0, 1, None), (0, 2, 3)], "z int, a int, n int")
    assert columns.constant_columns(df) == ["z"]
    fives = df.withColumn("five", F.lit(5.0)).withColumn("t", F.lit("x"))
    assert columns.constant_columns(fives) == ["z"] and columns.constant_columns(fives, value=None) == ["z", "five", "t"]
    assert columns.missing_columns(df, ["a", "q"]) == ["q"]
    assert len(CONTINUOUS) == 27 and len(CATEGORICAL) == 9


def test_clean_schedule_parses_and_floors(spark):
    df = spark.createDataFrame(
        [(1, "r1", "2019-01-01 07:00:00", "2019-01-01 13:13:12", 0), (2, "r1", "2019-01-01 07:00:00", "soon", 1)],
        "truck_id bigint, route_id string, departure_date string, estimated_arrival string, delay int")
    got = clean_tables({"truck_schedule_table": df}, {"truck_schedule_table": ["truck_id"]})["truck_schedule_table"]
    assert got.columns[0] == "rowindex"
    assert [r.estimated_arrival for r in got.orderBy("rowindex").collect()] == [at("2019-01-01 13:00"), None]


def test_a_choice_of_another_type_matches_nothing(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    assert rows.where_equals(df, "k", "abc").count() == 0
    assert rows.where_equals(df, "k", "2").first().s == "b"
