"""CSV folder to scored trips, through every stage."""

from pyspark.sql import functions as F

from fleetfeatures.catalogue.modelling import TRAIN_END, VALID_END
from fleetfeatures.catalogue.views import view
from fleetfeatures.constants import TABLES
from fleetfeatures.plans import clean, ingest, merge, score, train
from fleetfeatures.schemas import table_schema
from fleetfeatures.sources import feature_store, files

VIEWS = {"city_weather": "cityw", "drivers_table": "drivers", "routes_table": "routes", "routes_weather": "routew",
         "traffic_table": "traffic", "truck_schedule_table": "sched", "trucks_table": "trucks"}


def raw(spark, sf, name):
    df = view(spark, sf, VIEWS[name])
    if name == "city_weather":
        df = df.withColumns({"hour": F.hour("date") * 100, "date": F.date_format("date", "yyyy-MM-dd")})
    if name == "routes_weather":
        df = df.withColumnRenamed("date", "Date")
    if name == "truck_schedule_table":
        df = df.withColumn("departure_date", F.date_format("departure_date", "yyyy-MM-dd HH:mm:ss"))
    return df.select(*table_schema(name).names)


def test_csv_to_scores(spark, sf, tmp_path):
    for name in TABLES:
        files.write_csv(raw(spark, sf, name), str(tmp_path / "csv" / f"{name}.csv"))
    spark.sql(f"CREATE DATABASE fleet LOCATION '{tmp_path}/db'")
    tables = ingest.ingest(spark, str(tmp_path / "csv"), "fleet")
    assert sorted(tables) == sorted(TABLES)

    cleaned = clean.clean_tables(tables, {name: df.columns for name, df in tables.items()})
    assert all("rowindex" == df.columns[0] for df in cleaned.values())
    assert cleaned["trucks_table"].where("mileage_mpg < 0 OR fuel_type IS NULL").isEmpty()
    clean.store_clean_tables(cleaned, str(tmp_path / "features"), event_time="2024-09-24 00:00:00", database="fleet")

    stored = feature_store.read_feature_tables(spark, TABLES, 1, "fleet")
    assert sorted(stored) == sorted(TABLES) and "date" in stored["routes_weather"].columns
    wide = merge.wide_trips(stored)
    feature_store.write_feature_table(wide, "final_merge_df", 1, str(tmp_path / "features"),
                                      primary_key=["unique_id"], event_time="event_time", keys_unique=True, database="fleet")
    wide = feature_store.read_feature_table(spark, "final_merge_df", 1, "fleet")
    rows = wide.count()
    assert rows > 20 and wide.select("unique_id").distinct().count() == rows

    train.train_models(wide, str(tmp_path / "models"), {"Logistic_Regression": {"C": [1.0], "maxIter": [10]}},
                       TRAIN_END, VALID_END)
    scored = score.score_saved(spark, str(tmp_path / "models" / "best"), wide)
    assert scored.count() == rows
