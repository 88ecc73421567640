"""What several of these operators need: tables by name, scratch tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfeatures.session import shared_folder

#: A word is a run of characters that are neither a blank nor one of tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
#: Spark's setting that removes shuffle files at the end of an execution.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BLANKS = "\t\n\x0b\x0c\r"

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_path(spark: SparkSession) -> str:
    """A new path in the folder that all executors share."""
    return f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Give the executors this package's modules, once per application: Python tasks import them by name."""
    context = spark.sparkContext
    if getattr(context, "_llm_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="llm-")) / "fleetfeatures_llm.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in ("__init__.py", "session.py"):
            out.write(package.parent / module, f"fleetfeatures/{module}")
        for module in sorted(package.glob("*.py")):
            out.write(module, f"fleetfeatures/llm/{module.name}")
    context.addPyFile(str(archive))
    context._llm_shipped = True


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Executions inside drop their shuffle files when they end, not when the driver next collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """The frame, written to the shared folder and read back: lost executors cannot change it, readers take only the columns they
    use. What was shuffled for it is removed; the table itself stays until ``discard``."""
    spark, path = df.sparkSession, path or shared_path(df.sparkSession)
    with shuffles_removed(spark):
        df.write.mode("errorifexists").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` whose last reader has been written itself."""
    for t in tables:
        remove(t.sparkSession, t._scratch)


def numbered(df: DataFrame) -> DataFrame:
    """The frame with ``row``, a number of its own for each row, written once: a scan that is cut another way (executors lost or
    joined, files packed anew) would number its rows anew, so later passes read the stored numbers."""
    return written(df.withColumn("row", F.monotonically_increasing_id()))


def small(df: DataFrame, most: int = 10_000) -> DataFrame:
    """The frame, to be broadcast if it has few rows; else joined as Spark sees fit."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table of ours that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def blanks_to_space(text: Column) -> Column:
    return F.translate(text, _BLANKS, " " * len(_BLANKS))


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.array_remove(F.split(blanks_to_space(F.coalesce(text, F.lit(""))), " "), "")


def without_blanks(text: Column) -> Column:
    return F.translate(text, " " + _BLANKS, "")


def count_of(text: Column, characters: str) -> Column:
    """How many characters of a text are among ``characters``."""
    return F.length(text) - F.length(F.translate(text, characters, ""))
