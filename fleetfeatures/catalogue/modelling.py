"""Queries on features, metrics, models and scoring (A13, A14, M)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfeatures.catalogue import register
from fleetfeatures.catalogue.merging import ROUNDED, WIDE_STEPS
from fleetfeatures.catalogue.shaping import plain_times, rounded, sql_rounded
from fleetfeatures.catalogue.sqltext import MERGE_VIEWS
from fleetfeatures.catalogue.views import ORDER, table, trip_tables, with_views
from fleetfeatures.constants import TARGET
from fleetfeatures.operators import features, metrics, models, sparse
from fleetfeatures.plans import merge, score, train
from fleetfeatures.session import cut_lineage, scratch_folder

TRAIN_END, VALID_END = "2024-01-18 00:00:00", "2024-01-23 00:00:00"
SMALL_GRIDS = {
    "Logistic_Regression": {"C": [0.1, 1.0], "maxIter": [20]},
    "Random_Forest": {"numTrees": [10], "maxDepth": [4, 6], "minInstancesPerNode": [1]},
    "Boosted_Trees": {"maxIter": [5], "stepSize": [0.1, 0.2], "maxDepth": [3]},
}

# --- metrics --------------------------------------------------------------

_PER_CLASS = """WITH k AS (SELECT quality AS l, toxic AS p FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL),
c AS (SELECT class, (SELECT count(*) FROM k WHERE l = class) AS support, (SELECT count(*) FROM k WHERE p = class) AS predicted,
             (SELECT count(*) FROM k WHERE l = class AND p = class) AS hits
      FROM (SELECT l AS class FROM k UNION SELECT p FROM k)),
r AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0::DOUBLE ELSE hits::DOUBLE / predicted END AS precision,
             CASE WHEN support = 0 THEN 0.0::DOUBLE ELSE hits::DOUBLE / support END AS recall FROM c),
f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0::DOUBLE
             ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM r)
"""
_WEIGHTED = {m: sql_rounded(f"sum({m} * support) / sum(support)") for m in ("precision", "recall", "f1")}


@register("class_metrics", _PER_CLASS + f"""
SELECT {sql_rounded('sum(hits)::DOUBLE / sum(support)', 'accuracy')}, {_WEIGHTED['f1']} AS f1_score,
       {_WEIGHTED['precision']} AS precision, {_WEIGHTED['recall']} AS recall FROM f""")
def class_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rated = metrics.scores(table(spark, folder, "labels"), "quality", "toxic")
    return rounded(rated, ["accuracy", "f1_score", "precision", "recall"])


@register("class_report", _PER_CLASS + f"""
SELECT class::VARCHAR AS "row", {sql_rounded('precision', 'precision')}, {sql_rounded('recall', 'recall')},
       {sql_rounded('f1', 'f1')}, support::BIGINT AS support FROM f
UNION ALL SELECT 'macro avg', {sql_rounded('avg(precision)')}, {sql_rounded('avg(recall)')}, {sql_rounded('avg(f1)')},
       sum(support)::BIGINT FROM f
UNION ALL SELECT 'weighted avg', {_WEIGHTED['precision']}, {_WEIGHTED['recall']}, {_WEIGHTED['f1']},
       sum(support)::BIGINT FROM f
UNION ALL SELECT 'accuracy', {', '.join([sql_rounded('sum(hits)::DOUBLE / sum(support)')] * 3)}, sum(support)::BIGINT FROM f""")
def class_report(spark: SparkSession, folder: str) -> DataFrame:
    report = metrics.class_report(table(spark, folder, "labels"), "quality", "toxic")
    return rounded(report, ["precision", "recall", "f1"])


# --- features -------------------------------------------------------------

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("one_hot", "SELECT c_custkey, " + ", ".join(
    f"""CASE WHEN c_mktsegment = '{s}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "c_mktsegment_{s}\"""" for s in _SEGMENTS)
    + " FROM customer")
def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return features.apply_one_hot(customer, features.fit_one_hot(customer, ["c_mktsegment"]))


@register("one_hot_wide", """
WITH t AS (SELECT DISTINCT l_orderkey::VARCHAR AS v FROM lineitem WHERE l_linenumber <= 3), k AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS p FROM t),
m AS (SELECT DISTINCT l_linenumber::VARCHAR AS v FROM lineitem WHERE l_linenumber <= 3),
q AS (SELECT v, (SELECT count(*) FROM k) + row_number() OVER (ORDER BY v) - 1 AS p FROM m)
SELECT l_orderkey, l_linenumber, k.p AS l_orderkey_position, q.p AS l_linenumber_position, (SELECT count(*) FROM k) + (SELECT count(*) FROM q) AS n_categories
FROM lineitem LEFT JOIN k ON k.v = l_orderkey::VARCHAR LEFT JOIN q ON q.v = l_linenumber::VARCHAR""")
def one_hot_wide(spark: SparkSession, folder: str) -> DataFrame:
    """A column with more categories than fit in columns (one per order), and lines that training did not see."""
    lines, encoded = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"]
    categories = sparse.fit_categories(lines.where("l_linenumber <= 3"), encoded, scratch_folder(spark))
    return sparse.add_positions(lines, categories, encoded).withColumn("n_categories", F.lit(sum(sparse.sizes(categories, encoded))).cast("long"))


@register("one_hot_unseen", """
SELECT event_id, """ + ", ".join(
    f"""CASE WHEN event_type = '{s}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS event_type_{s}""" for s in ("click", "view"))
    + " FROM events")
def one_hot_unseen(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "event_type")
    encoding = features.fit_one_hot(events.where(F.col("event_type").isin("view", "click")), ["event_type"])
    return features.apply_one_hot(events, encoding)


_SCALED = ["l_quantity", "l_extendedprice", "l_tax"]


@register("standard_scale", """
WITH p AS (SELECT """ + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALED)
          + " FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01') SELECT l_orderkey, l_linenumber, "
          + ", ".join(sql_rounded(f"({c} - m_{c}) / s_{c}", c) for c in _SCALED) + " FROM lineitem, p")
def standard_scale(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    scaling = features.fit_scaling(lines.where("l_shipdate < TIMESTAMP_NTZ '1998-01-01 00:00:00'"), _SCALED)
    return rounded(features.apply_scaling(lines.select("l_orderkey", "l_linenumber", *_SCALED), scaling), _SCALED)


@register("stratified_folds", """
SELECT delay, fold::INT AS fold, true AS even
FROM (SELECT DISTINCT CASE WHEN value > 50 THEN 1 ELSE 0 END AS delay FROM events) CROSS JOIN range(0, 3) f(fold)""")
def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        "event_id", F.when(F.col("value") > 50, 1).otherwise(0).alias(TARGET))
    counted = models.with_folds(events, ["event_id"]).groupBy(TARGET, "fold").agg(F.count("*").alias("n"))
    spread = counted.groupBy(TARGET).agg(F.min("n").alias("least"), F.max("n").alias("most"),
                                         F.collect_list("fold").alias("folds"))
    return spread.select(TARGET, F.explode("folds").alias("fold"), (F.col("most") - F.col("least") <= 1).alias("even"))


# --- models ---------------------------------------------------------------


def _wide(spark: SparkSession, folder: str) -> DataFrame:
    # every fit reads the wide table several times
    return cut_lineage(merge.wide_trips(trip_tables(spark, folder), ORDER))


def _frames(spark: SparkSession, folder: str) -> train.Frames:
    return train.build_frames(_wide(spark, folder), TRAIN_END, VALID_END)


def _grid_lines(spark: SparkSession, folder: str, name: str) -> DataFrame:
    frames = _frames(spark, folder)
    fitted = train.fit_models(frames, {name: SMALL_GRIDS[name]})
    return train.evaluate(fitted, frames)


@register("grid_lr")
def grid_lr(spark: SparkSession, folder: str) -> DataFrame:
    return _grid_lines(spark, folder, "Logistic_Regression")


@register("grid_rf")
def grid_rf(spark: SparkSession, folder: str) -> DataFrame:
    return _grid_lines(spark, folder, "Random_Forest")


@register("grid_gbt")
def grid_gbt(spark: SparkSession, folder: str) -> DataFrame:
    return _grid_lines(spark, folder, "Boosted_Trees")


@register("train_eval")
def train_eval(spark: SparkSession, folder: str) -> DataFrame:
    return train.train_models(_wide(spark, folder), scratch_folder(spark), SMALL_GRIDS, TRAIN_END, VALID_END)


@register("run_log")
def run_log(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark)
    grids = {"Logistic_Regression": SMALL_GRIDS["Logistic_Regression"]}
    train.train_models(_wide(spark, folder), path, grids, TRAIN_END, VALID_END)
    runs, logged = spark.read.parquet(f"{path}/runs"), spark.read.parquet(f"{path}/metrics")
    return runs.join(logged, "run_id").select("run_name", "status", "key", "value")


_PARTS = ["train", "valid", "test"]


@register("models_rated", with_views(MERGE_VIEWS, WIDE_STEPS + f""",
p AS (SELECT CASE WHEN estimated_arrival <= TIMESTAMP '{TRAIN_END}' THEN 'train'
             WHEN estimated_arrival <= TIMESTAMP '{VALID_END}' THEN 'valid' ELSE 'test' END AS part, delay
      FROM wide WHERE estimated_arrival IS NOT NULL),
c AS (SELECT part, count(*)::BIGINT AS n_rows, sum(delay)::BIGINT AS n_late FROM p GROUP BY part)
SELECT m.model, c.part, c.n_rows, c.n_late, true AS recomputed, true AS in_range
FROM c CROSS JOIN (VALUES ('Logistic_Regression'), ('Random_Forest'), ('Boosted_Trees')) m(model)"""))
def models_rated(spark: SparkSession, folder: str) -> DataFrame:
    """What is determined of the three searches: rows and late trips per part, accuracy as counted from the predictions."""
    frames = _frames(spark, folder)
    fitted = train.fit_models(frames, SMALL_GRIDS)
    rated = train.evaluate(fitted, frames).select("model", "part", "accuracy")
    result = None
    for f in fitted:
        for part, df in zip(_PARTS, (frames.train, frames.valid, frames.test)):
            hit = (F.col(TARGET) == F.col("prediction")).cast("int")
            counted = models.predict(f.model, df).agg(
                F.count("*").alias("n_rows"), F.sum(TARGET).cast("long").alias("n_late"), F.avg(hit).alias("hits"))
            row = counted.select(F.lit(f.name).alias("model"), F.lit(part).alias("part"), "n_rows", "n_late", "hits")
            result = row if result is None else result.unionByName(row)
    return result.join(rated, ["model", "part"]).select(
        "model", "part", "n_rows", "n_late", (F.abs(F.col("hits") - F.col("accuracy")) < 1e-9).alias("recomputed"),
        F.col("accuracy").between(0, 1).alias("in_range"))


@register("scored_trips", with_views(MERGE_VIEWS, WIDE_STEPS + """
SELECT * EXCLUDE (delay), true AS scored FROM wide
WHERE departure_date BETWEEN TIMESTAMP '2024-01-20 00:00:00' AND TIMESTAMP '2024-01-28 00:00:00'"""))
def scored_trips(spark: SparkSession, folder: str) -> DataFrame:
    """All columns of the trips that are scored, and whether each got a class."""
    scored = score_batch(spark, folder)
    marked = scored.withColumn("scored", F.coalesce(F.col(TARGET).isin(0, 1), F.lit(False))).drop(TARGET)
    return rounded(marked, ROUNDED)


@register("score_batch")
def score_batch(spark: SparkSession, folder: str) -> DataFrame:
    wide, path = _wide(spark, folder), scratch_folder(spark)
    grids = {"Random_Forest": SMALL_GRIDS["Random_Forest"]}
    train.train_models(wide, path, grids, TRAIN_END, VALID_END)
    chosen = score.choose_trips(wide, dates=("2024-01-20", "2024-01-28"))
    return plain_times(score.score_saved(spark, f"{path}/best", chosen))
