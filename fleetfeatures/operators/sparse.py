"""One-hot vectors for columns with any number of values (M1): a category table on disk, sparse vectors, no list on the driver.

The categories of all columns are one table of (column, value, position): positions run through the columns in the order
given, within a column along the values, null last. They are numbered by a distributed sort. Rows get their positions by
joining the table by value, each column with its own part of it; Spark broadcasts a part if it is small by its statistics,
and shuffles otherwise. Spark ML turns positions into sparse vectors; a vector holds one entry per column, however many
categories there are. A value that was not in the training rows has no entry (all zeros).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfeatures.operators.joins import join_on
from fleetfeatures.operators.numbering import number_rows

CATEGORY = "column int, name string, value string, position long"


def fit_categories(train: DataFrame, columns: Sequence[str], path: str) -> DataFrame:
    """The category table of the training rows, written to ``path`` and read from there."""
    found = None
    for i, c in enumerate(columns):
        values = train.select(F.lit(i).alias("column"), F.lit(c).alias("name"), F.col(f"`{c}`").cast("string").alias("value")).distinct()
        found = values if found is None else found.unionAll(values)
    numbered = number_rows(found, "position", ["column", F.col("value").isNull(), "value"], start=0)
    numbered.write.mode("overwrite").parquet(path)
    return load_categories(train.sparkSession, path)


def load_categories(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`fit_categories` wrote."""
    return spark.read.schema(CATEGORY).parquet(path)


def sizes(categories: DataFrame, columns: Sequence[str]) -> list[int]:
    """Number of categories of each column: as many numbers as columns."""
    counted = {r["column"]: r["n"] for r in categories.groupBy("column").agg(F.count("*").alias("n")).collect()}
    return [counted.get(i, 0) for i in range(len(columns))]


def add_positions(df: DataFrame, categories: DataFrame, columns: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """The rows with each column's position (``<column>_position``, or ``names``); null for a value that is not there."""
    for i, (c, name) in enumerate(zip(columns, names or [f"{c}_position" for c in columns])):
        own = categories.where(F.col("column") == i).select(F.col("value").alias("__value"), F.col("position").alias(name))
        df = join_on(df.withColumn("__text", F.col(f"`{c}`").cast("string")), own, [("__text", "__value")]).drop("__text", "__value")
    return df


def one_hot_vectors(df: DataFrame, categories: DataFrame, columns: Sequence[str], others: Sequence[str] = (), output: str = "features") -> DataFrame:
    """The rows with a sparse vector of the ``others`` (numbers) and a 0/1 entry per category, in the order of the table."""
    counts = sizes(categories, columns)
    at, hot = ([f"__{kind}_{i}" for i in range(len(columns))] for kind in ("at", "hot"))
    # beyond the last category of its column: the encoder's category for unknown values, which has no entry
    local = add_positions(df, categories, columns, at).withColumns({
        a: F.coalesce(F.col(a) - sum(counts[:i]), F.lit(max(n, 1))).cast("double") for i, (a, n) in enumerate(zip(at, counts))})
    plain = [f"__other_{i}" for i in range(len(others))]
    local = local.withColumns({p: F.col(f"`{o}`").cast("double") for p, o in zip(plain, others)})
    encoder = OneHotEncoder(inputCols=at, outputCols=hot, handleInvalid="keep", dropLast=True)
    # the encoder learns only how many categories there are, from one row that has the last of each
    last = df.sparkSession.createDataFrame([tuple(float(max(n - 1, 0)) for n in counts)], ", ".join(f"{a} double" for a in at))
    encoded = encoder.fit(last).transform(local) if columns else local
    return VectorAssembler(inputCols=[*plain, *(hot if columns else [])], outputCol=output, handleInvalid="keep").transform(encoded).drop(*at, *hot, *plain)
