"""Sparse one-hot vectors: many categories, nulls, unseen values, and a model fitted on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetfeatures.operators import features, models, sparse
from fleetfeatures.operators.models import with_folds


def _dense(df):
    return sorted((r.id, tuple(r.features.toArray())) for r in df.collect())


def test_vectors_equal_flat_columns(spark, tmp_path):
    rows = [(1, "b", 1, 0.5), (2, "a", None, 1.5), (3, None, 2, -1.0), (4, "a.b`c", 2, 0.0), (5, "a", 1, 7.0)]
    train = spark.createDataFrame(rows, "id int, `odd.name` string, n int, x double")
    other = spark.createDataFrame([*rows, (6, "unseen", 9, 2.0), (7, "", None, None)], train.schema)
    columns = ["odd.name", "n"]
    plain = train.toDF("id", "odd", "n", "x")
    encoding = features.fit_one_hot(plain, ["odd", "n"])
    flat = features.apply_one_hot(other.toDF("id", "odd", "n", "x"), encoding)
    want = sorted((r[0], tuple(r[1:])) for r in flat.where("x IS NOT NULL").collect())
    categories = sparse.fit_categories(train, columns, str(tmp_path / "c"))
    got = _dense(sparse.one_hot_vectors(other, categories, columns, ["x"]).where("x IS NOT NULL"))
    assert got == want
    again = sparse.load_categories(spark, str(tmp_path / "c"))
    assert _dense(sparse.one_hot_vectors(other, again, columns, ["x"]).where("x IS NOT NULL")) == want
    placed = sparse.add_positions(other, categories, columns)
    assert placed.columns == [*other.columns, "odd.name_position", "n_position"] and placed.where("id = 6").first()[4:] == (None, None)
    assert sparse.sizes(categories, columns) == [4, 3]


def test_no_training_rows(spark, tmp_path):
    train = spark.createDataFrame([], "id int, c string")
    categories = sparse.fit_categories(train, ["c"], str(tmp_path / "c"))
    got = sparse.one_hot_vectors(spark.createDataFrame([(1, "a"), (2, None)], "id int, c string"), categories, ["c"])
    assert [set(v) for _, v in _dense(got)] == [{0.0}, {0.0}]


def test_a_model_on_more_categories_than_columns_could_hold(spark, tmp_path):
    df = spark.range(0, 36_000, 1, 4).select("id", F.concat(F.lit("c"), (F.col("id") % 12_000).cast("string")).alias("c"),
                                              ((F.col("id") % 12_000) % 3 == 0).cast("int").alias("delay"), (F.col("id") % 7).cast("double").alias("x"))
    categories = sparse.fit_categories(df, ["c"], str(tmp_path / "c"))
    assert sparse.sizes(categories, ["c"]) == [12_000]
    ready = with_folds(sparse.one_hot_vectors(df, categories, ["c"], ["x"]), ["id"])
    entries = ready.select("features").first().features
    assert entries.size == 12_001 and len(entries.indices) <= 2
    fitted = models.grid_search("Logistic_Regression", ready, "features", {"C": [100.0], "maxIter": [30]}, parallelism=1)
    assert fitted.fold_accuracy > 0.95
    right = models.predict(fitted.model, ready).where("prediction = delay").count()
    assert right > 0.99 * 36_000
