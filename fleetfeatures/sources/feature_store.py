"""Versioned feature tables: plain catalog tables ``<name>_v<version>``.

Key, event time and description are table properties. Every write makes a new
folder and then points the table to it, so readers see the old or the new rows
and a failed write changes nothing. New columns and wider types enter the
table's definition with the rows that bring them; types that have no common one
are refused before anything is written. Folders that a later write superseded
stay for readers until :func:`vacuum_feature_table`.
"""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfeatures.functions.timegrid import timestamp_literal
from fleetfeatures.operators.joins import join_on
from fleetfeatures.operators.rows import latest_per_key
from fleetfeatures.schemas import with_comments

log = logging.getLogger(__name__)


def table_of(name: str, version: int, database: str = "default") -> str:
    """Catalog name of a feature table."""
    return f"{database}.{name}_v{version}"


def stamp_event_time(df: DataFrame, column: str = "eventtime", value: Column | str | None = None) -> DataFrame:
    """Add the event time if it is absent: the given time, else now."""
    if column in df.columns:
        return df
    stamp = F.current_timestamp() if value is None else value
    return df.withColumn(column, timestamp_literal(stamp) if isinstance(stamp, str) else stamp)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], event_time: str, *,
           keys_unique: bool = False) -> DataFrame:
    """One row per key, the one with the latest event time; of equal times the new row wins.

    Only old rows whose key is in ``new`` take part in the comparison. A small
    ``new`` is broadcast by its size, and the other old rows pass unshuffled.
    """
    incoming = new if keys_unique else latest_per_key(new, keys, [event_time])
    incoming_keys = incoming.select(*keys)
    touched = join_on(old, incoming_keys, list(keys), "left_semi")
    rival = touched.withColumn("__new", F.lit(0)).unionByName(
        incoming.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    winners = latest_per_key(rival, keys, [event_time, "__new"]).drop("__new")
    untouched = join_on(old, incoming_keys, list(keys), "left_anti")
    return untouched.unionByName(winners, allowMissingColumns=True)


#: From narrow to wide; a value of an earlier kind has a place in every later one.
_NUMBERS = ["tinyint", "smallint", "int", "bigint", "float", "double"]
#: Whole digits a type of whole numbers can hold.
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
#: Doubles hold every whole number up to here.
_EXACT_DOUBLE = 2 ** 53


def _decimal(kind: str) -> tuple[int, int] | None:
    """Whole and fractional digits of a decimal or whole-number type."""
    if kind in _DIGITS:
        return _DIGITS[kind], 0
    found = re.fullmatch(r"decimal\((\d+),(\d+)\)", kind)
    return (int(found[1]) - int(found[2]), int(found[2])) if found else None


def common_type(name: str, old: str, new: str) -> str:
    """The type that holds both; an error if there is none."""
    if old == new:
        return old
    if old in _NUMBERS and new in _NUMBERS:
        wide = max(old, new, key=_NUMBERS.index)
        # 32-bit floats lose digits of whole numbers
        return "double" if wide == "float" and min(old, new, key=_NUMBERS.index) in ("int", "bigint") else wide
    if "decimal" in old + new and (a := _decimal(old)) and (b := _decimal(new)):
        whole, part = max(a[0], b[0]), max(a[1], b[1])
        if whole + part <= 38:
            return f"decimal({whole + part},{part})"
    if {old, new} in ({"date", "timestamp"}, {"date", "timestamp_ntz"}):
        return max(old, new)
    raise ValueError(f"column {name} is {old} in the table and {new} in the batch")


def reconcile(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the common type in every column they share.

    64-bit whole numbers become doubles only if no digit of theirs is lost; that takes a look at these columns.
    """
    before, after = dict(old.dtypes), dict(new.dtypes)
    types = {c: common_type(c, before[c], after[c]) for c in before if c in after}
    for df, kinds in ((old, before), (new, after)):
        risky = [c for c, t in types.items() if kinds[c] == "bigint" and t == "double"]
        if risky:
            row = df.agg(*[F.max((F.col(c) > _EXACT_DOUBLE) | (F.col(c) < -_EXACT_DOUBLE)).alias(c) for c in risky]).first()
            if lost := [c for c in risky if row[c]]:
                raise ValueError(f"columns {lost} hold whole numbers that doubles would round; cast them first")
    return tuple(df.withColumns({c: F.col(c).cast(t) for c, t in types.items() if dict(df.dtypes)[c] != t}) for df in (old, new))


def write_feature_table(df: DataFrame, name: str, version: int, location: str, *, primary_key: Sequence[str],
                        event_time: str, description: str | None = None, comments: Mapping[str, str] | None = None,
                        keys_unique: bool = False, database: str = "default") -> str:
    """Create the table below ``location``, or upsert into it if it exists. Returns its catalog name.

    ``keys_unique`` says that ``df`` has one row per key (as after numbering);
    it is then written as it is partitioned and sorted, without a shuffle.
    Without a description the table keeps the one it has.
    """
    spark = df.sparkSession
    table = table_of(name, version, database)
    folder = f"{location.rstrip('/')}/{name}_v{version}/{uuid.uuid4().hex}"
    exists = spark.catalog.tableExists(table)
    if exists:
        stored, df = reconcile(spark.table(table), df)
        rows = upsert(stored, df, primary_key, event_time, keys_unique=keys_unique)
    else:
        rows = df if keys_unique else latest_per_key(df, primary_key, [event_time])
    with_comments(rows, dict(comments or {})).write.parquet(folder)
    if exists and rows.dtypes == spark.table(table).dtypes:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
        return table
    texts = {f.name: f.metadata.get("comment", "") for f in spark.table(table).schema.fields} if exists else {}
    texts |= dict(comments or {})
    if description is None:
        description = (spark.catalog.getTable(table).description or "") if exists else ""
    columns = ", ".join(f"`{c}` {kind}" + (f" COMMENT '{_quoted(texts[c])}'" if texts.get(c) else "") for c, kind in rows.dtypes)
    # the rows of the table are in its folders, so a new definition over the new folder replaces the old one whole
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{folder}' "
        f"COMMENT '{_quoted(description)}' TBLPROPERTIES ("
        f"'primary_key' = '{','.join(primary_key)}', 'event_time' = '{event_time}')")
    return table


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def read_feature_table(spark: SparkSession, name: str, version: int, database: str = "default") -> DataFrame | None:
    """A feature table, or None (logged) if there is none."""
    try:
        return spark.table(table_of(name, version, database))
    except AnalysisException as error:
        log.warning("no feature table %s version %s: %s", name, version, error)
        return None


def read_feature_tables(spark: SparkSession, names: Sequence[str], version: int = 1,
                        database: str = "default") -> dict[str, DataFrame]:
    """The feature tables that exist, by name."""
    found = {name: read_feature_table(spark, name, version, database) for name in names}
    return {name: df for name, df in found.items() if df is not None}


def feature_table_properties(spark: SparkSession, name: str, version: int, database: str = "default") -> DataFrame:
    """Key, event time and other properties of a feature table."""
    return spark.sql(f"SHOW TBLPROPERTIES {table_of(name, version, database)}")


def drop_feature_table(spark: SparkSession, name: str, version: int, database: str = "default") -> None:
    """Remove one version of a feature table, its rows included."""
    table = table_of(name, version, database)
    folder = _folder_of(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    if folder and folder.rstrip("/").rsplit("/", 2)[-2] == f"{name}_v{version}":
        _delete(spark, folder.rstrip("/").rsplit("/", 1)[0])


def vacuum_feature_table(spark: SparkSession, name: str, version: int, database: str = "default") -> int:
    """Delete the folders that later writes superseded; how many there were. No reader may still use them."""
    folder = _folder_of(spark, table_of(name, version, database)).rstrip("/")
    jvm = spark.sparkContext._jvm
    home = jvm.org.apache.hadoop.fs.Path(folder.rsplit("/", 1)[0])
    listed = home.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(home)
    old = [x.getPath().toString() for x in listed if x.getPath().getName() != folder.rsplit("/", 1)[1]]
    for path in old:
        _delete(spark, path)
    return len(old)


def _folder_of(spark: SparkSession, table: str) -> str | None:
    """Where the rows of a table are, or None without the table."""
    if not spark.catalog.tableExists(table):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return described.first()["data_type"]


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
