"""Sources, sinks and feature tables."""

import json

import pytest
from pyspark.sql import functions as F

from fleetfeatures.constants import TABLES
from fleetfeatures.functions.text import explode_listing
from fleetfeatures.plans.ingest import ingest
from fleetfeatures.schemas import column_comments, table_schema
from fleetfeatures.sources import catalog, feature_store, files


def test_ingest_single_files_and_part_folders(spark, tmp_path):
    folder = tmp_path / "in" / "deeper"
    folder.mkdir(parents=True)
    (folder / "trucks_table.csv").write_text(
        "truck_id,truck_age,load_capacity_pounds,mileage_mpg,fuel_type\n1,3,NaN,-2,gas\n2,4,1000,17,\n")
    (folder / "notes.txt").write_text("not a table")
    files.write_csv(spark.range(10).repartition(3), str(folder / "numbers.csv"))
    spark.sql(f"CREATE DATABASE landed LOCATION '{tmp_path}/db'")
    tables = ingest(spark, str(tmp_path / "in"), "landed")
    assert sorted(tables) == ["numbers", "trucks_table"] == catalog.table_names(spark, "landed")
    assert tables["numbers"].count() == 10
    trucks = tables["trucks_table"].orderBy("truck_id").collect()
    assert tables["trucks_table"].schema["truck_id"].dataType.simpleString() == "bigint"
    assert (trucks[0].load_capacity_pounds, trucks[0].mileage_mpg, trucks[1].fuel_type) == (None, -2.0, None)
    again = ingest(spark, str(tmp_path / "in"), "landed")
    assert again["numbers"].count() == 10


def test_unreadable_and_empty_databases(spark, tmp_path):
    spark.sql(f"CREATE DATABASE nothing LOCATION '{tmp_path}/db'")
    assert catalog.load_all_tables(spark, "nothing") == {}
    assert catalog.load_all_tables(spark, "no_such_database") is None


def test_schemas_have_comments(spark):
    for name in TABLES:
        schema = table_schema(name)
        assert all(f.metadata["comment"] for f in schema.fields)
        assert set(schema.names) <= set(column_comments(name))


def test_feature_table_upsert_keeps_old_and_new(spark, tmp_path):
    spark.sql(f"CREATE DATABASE features LOCATION '{tmp_path}/db'")
    def batch(rows):
        return spark.createDataFrame(rows, "k int, v string, t string").withColumn("t", F.col("t").cast("timestamp"))
    options = {"primary_key": ["k"], "event_time": "t", "database": "features",
               "comments": {"v": "it's a value"}, "description": "driver's table"}
    first = batch([(1, "old", "2024-01-01"), (2, "old", "2024-01-01"), (3, "old", "2024-03-01"), (3, "dup", "2024-01-01")])
    table = feature_store.write_feature_table(first, "things", 2, str(tmp_path / "store"), **options)
    assert table == "features.things_v2"
    held = spark.table(table)
    second = batch([(2, "new", "2024-01-01"), (3, "new", "2024-02-01"), (4, "new", "2024-01-01")])
    feature_store.write_feature_table(second, "things", 2, str(tmp_path / "store"), **options)
    assert {tuple(r)[:2] for r in spark.table(table).collect()} == {(1, "old"), (2, "new"), (3, "old"), (4, "new")}
    assert held.schema["v"].metadata["comment"] == "it's a value"
    properties = {r.key: r.value for r in feature_store.feature_table_properties(spark, "things", 2, "features").collect()}
    assert (properties["primary_key"], properties["event_time"]) == ("k", "t")
    assert feature_store.read_feature_table(spark, "things", 1, "features") is None
    third = batch([(4, "newest", "2025-01-01")]).withColumn("k", F.col("k").cast("bigint")).withColumn("extra", F.lit(1.5))
    feature_store.write_feature_table(third, "things", 2, str(tmp_path / "store"), **options)
    assert spark.table(table).dtypes == [("k", "bigint"), ("v", "string"), ("t", "timestamp"), ("extra", "double")]
    assert {(r.k, r.v, r.extra) for r in spark.table(table).collect()} == {
        (1, "old", None), (2, "new", None), (3, "old", None), (4, "newest", 1.5)}
    assert spark.table(table).schema["v"].metadata["comment"] == "it's a value"
    odd = batch([(1, "x", "2026-01-01")]).withColumn("v", F.lit(True))
    with pytest.raises(ValueError, match="column v"):
        feature_store.write_feature_table(odd, "things", 2, str(tmp_path / "store"), **options)
    assert len(list((tmp_path / "store" / "things_v2").iterdir())) == 3
    assert feature_store.vacuum_feature_table(spark, "things", 2, "features") == 2
    assert spark.table(table).count() == 4
    feature_store.drop_feature_table(spark, "things", 2, "features")
    feature_store.drop_feature_table(spark, "things", 2, "features")
    assert not (tmp_path / "store" / "things_v2").exists()
    assert feature_store.read_feature_table(spark, "things", 2, "features") is None


def test_event_time_defaults_to_now(spark):
    stamped = feature_store.stamp_event_time(spark.range(3))
    assert stamped.where(F.col("eventtime") > "2020-01-01").count() == 3
    assert feature_store.stamp_event_time(stamped, value="1999-01-01 00:00:00").where("eventtime < '2000-01-01'").count() == 0


def test_listing(spark):
    text = json.dumps([{"name": "a.csv", "type": "file", "download_url": "x:/a.csv"}, {"name": "d", "type": "dir"}])
    df = spark.createDataFrame([(1, text), (2, "[]"), (3, "no json")], "i int, listing string")
    got = {tuple(r) for r in explode_listing(df, "listing").collect()}
    assert (1, "a.csv", "file", "x:/a.csv") in got and (1, "d", "dir", None) in got
    assert {r[0] for r in got} >= {2}


def test_csv_by_header_name(spark, tmp_path):
    (tmp_path / "r.csv").write_text("id,Distance,average_hours,note\n0,100.0,2.0,NA\n1,nan,x,ok\n")
    schema = spark.createDataFrame([], "average_hours double, distance double").schema
    got = files.read_csv(spark, str(tmp_path / "r.csv"), schema)
    assert got.columns == ["average_hours", "distance"]
    assert [tuple(r) for r in got.collect()] == [(2.0, 100.0), (None, None)]
    with pytest.raises(ValueError, match="speed"):
        files.read_csv(spark, str(tmp_path / "r.csv"), spark.createDataFrame([], "speed int").schema)
    assert [r.note for r in files.read_csv(spark, str(tmp_path / "r.csv")).collect()] == [None, "ok"]
