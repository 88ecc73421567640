"""CSV folders in, CSV folders out."""

from __future__ import annotations

import re
from collections.abc import Mapping
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetfeatures.functions.text import dataset_of, is_csv, table_name_of


def list_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Path and table name of each CSV dataset below the folder, contents unread.

    A dataset is a file ``<name>.csv``, or a folder of that name with part files.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
             .select("path").where(is_csv("path")))
    datasets = files.select(dataset_of("path").alias("path")).distinct()
    return datasets.select("path", table_name_of("path").alias("table_name"))


#: The words that mean a missing value in a CSV file.
MISSING_WORDS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
                 "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


#: Quotes inside a quoted value are doubled, as other programs write them; a backslash is an ordinary character, and so are
#: blanks at the ends of a value.
_QUOTING = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A CSV file or folder with headers; missing-value words are null.

    Every file is read by its own header: files are grouped by header, each group is read by its names, and the groups are
    put together by name. A column that only some files have is null in the others. Values may hold quotes (doubled) and,
    in quotes, commas and line ends; a file with line ends inside quotes is read by one task, all others are split.

    With a schema, columns are taken by name, whatever their order and case; further ones are left out, and a name that no
    file has is an error. A whole number may be written as ``2.0`` or ``1e3``. A value that its type cannot hold is null;
    :func:`unreadable` counts those. Without a schema the types are inferred, which reads the data again.
    """
    if schema is None:
        return _inferred(spark, path)
    texts = words_to_null(_texts(spark, path))
    there = {c.lower(): c for c in texts.columns}
    lacking = [f.name for f in schema.fields if f.name.lower() not in there]
    if lacking:
        raise ValueError(f"{path} has no columns {lacking}; its header is {texts.columns}")
    return nan_to_null(texts.select(*[
        typed(_column(there[f.name.lower()]), f.dataType).alias(f.name) for f in schema.fields]))


def unreadable(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Per column of the schema, how many values there are and how many its type cannot hold."""
    texts = words_to_null(_texts(spark, path))
    there = {c.lower(): c for c in texts.columns}
    counts = texts.agg(*[F.struct(F.count(value).alias("n_values"), F.count(F.when(typed(value, f.dataType).isNull(), value)).alias("n_unreadable")).alias(f"c{i}")
                         for i, f in enumerate(schema.fields) for value in [_column(there[f.name.lower()])]])
    rows = F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f"c{i}.n_values").alias("n_values"), F.col(f"c{i}.n_unreadable").alias("n_unreadable"))
                     for i, f in enumerate(schema.fields)])
    return counts.select(F.inline(rows))


def typed(text: Column, kind: T.DataType) -> Column:
    """Text as a value of a type, null if it cannot be; whole numbers also from ``2.0`` and ``1e3``."""
    if not isinstance(kind, T.IntegralType):
        return text.try_cast(kind)
    # digits before a fraction of zeros are taken as they are; an exponent goes by way of a double, while that is exact
    plain = F.regexp_replace(F.trim(text), r"\.0*$", "").try_cast(kind)
    number = text.try_cast("double")
    exact = (number == F.floor(number)) & (F.abs(number) < 2.0 ** 53)
    return F.coalesce(plain, F.when(exact, number.cast("decimal(20,0)")).try_cast(kind))


def headers(spark: SparkSession, path: str) -> DataFrame:
    """Per file (path, header, spans): its first line, and whether a line end may lie inside quotes.

    A quoted value that goes on in the next line leaves an odd number of quotes in its line. One pass over the text,
    combined before the shuffle, with a buffer per file: the header so far and at most two truth values. A maximum in place
    of the set would make Spark sort all lines of a task by their file, since a buffer with a text and no set is sorted for.
    """
    lines = spark.read.option("pathGlobFilter", "*.csv").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value",
        F.monotonically_increasing_id().alias("place"))
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2 == 1
    # the first block of a file is in one task, in order
    first = F.when((F.col("start") == 0) & (F.trim("value") != ""), F.col("place"))
    return lines.groupBy("path").agg(
        F.min_by("value", first).alias("header"), F.array_contains(F.collect_set(odd), True).alias("spans"))


def _texts(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, every file by its own header."""
    by_header = (headers(spark, path).groupBy("header", "spans").agg(F.collect_list("path").alias("paths"))
                 .orderBy("header", "spans").collect())  # the files' paths, which a listing holds on the driver too
    reader = spark.read.options(**_QUOTING).option("pathGlobFilter", "*.csv")
    if not by_header:
        return reader.csv(path)
    together = None
    for group in by_header:
        # a group of all files is read as the one path it is
        where = [path] if len(by_header) == 1 else [_plain_path(p) for p in group.paths]
        rows = reader.option("multiLine", bool(group.spans)).csv(where)
        together = rows if together is None else _by_name(together, rows)
    return together


def _plain_path(location: str) -> str:
    """The path to read for a file's location: without percent signs for characters, and with pattern characters as they are."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(location))


def _by_name(one: DataFrame, other: DataFrame) -> DataFrame:
    """Rows of both, columns matched by name without case."""
    known = {c.lower(): c for c in one.columns}
    renamed = other.toDF(*[known.get(c.lower(), c) for c in other.columns])
    return one.unionByName(renamed, allowMissingColumns=True)


def _inferred(spark: SparkSession, path: str) -> DataFrame:
    """Without a schema: files of one header by Spark's inference, files of several from their texts."""
    kinds = headers(spark, path).select("header", "spans").distinct().limit(2).collect()
    if len(kinds) < 2:
        reader = spark.read.options(**_QUOTING).option("pathGlobFilter", "*.csv").option("multiLine", bool(kinds and kinds[0].spans))
        return _numbers_among_words(nan_to_null(words_to_null(reader.option("inferSchema", True).csv(path))))
    return nan_to_null(_numbers_among_words(words_to_null(_texts(spark, path))))


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def words_to_null(df: DataFrame) -> DataFrame:
    """Text that stands for a missing value becomes null."""
    return df.select(*[F.when(~_column(c).isin(MISSING_WORDS), _column(c)).alias(c) if kind == "string" else _column(c)
                       for c, kind in df.dtypes])


def _numbers_among_words(df: DataFrame) -> DataFrame:
    """Text columns that hold only numbers once missing words are null become numbers."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    if not texts:
        return df
    counts = df.agg(*[F.struct(F.count(_column(c)).alias("n"), F.count(_column(c).try_cast("bigint")).alias("whole"),
                               F.count(_column(c).try_cast("double")).alias("double")).alias(f"c{i}")
                      for i, c in enumerate(texts)]).first()
    kinds = {c: "bigint" if r["whole"] == r["n"] else "double" for c, r in zip(texts, counts) if r["n"] and r["double"] == r["n"]}
    return df.select(*[_column(c).try_cast(kinds[c]).alias(c) if c in kinds else _column(c) for c in df.columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Not-a-number means missing."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def land_folder(spark: SparkSession, folder: str, database: str = "default",
                schemas: Mapping[str, T.StructType] | None = None) -> list[str]:
    """Each CSV dataset below the folder becomes a table named after it, replacing an older one.

    The listing is one row per table; the contents go from file to table on the executors.
    """
    names = []
    for row in list_csv(spark, folder).orderBy("path").collect():
        df = read_csv(spark, row["path"], (schemas or {}).get(row["table_name"]))
        df.write.mode("overwrite").saveAsTable(f"{database}.{row['table_name']}")
        names.append(row["table_name"])
    return names


def write_csv(df: DataFrame, path: str) -> None:
    """CSV part files with header, no index column; quotes inside values are doubled."""
    df.write.mode("overwrite").options(**_QUOTING).csv(path)
