"""Queries on sources and sinks (S): what is written is read back, from a new folder each time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfeatures.catalogue import register
from fleetfeatures.catalogue.shaping import plain_times, rounded, sql_rounded
from fleetfeatures.catalogue.views import table, view, with_views
from fleetfeatures.plans.clean import clean_tables, store_clean_tables
from fleetfeatures.schemas import column_comments
from fleetfeatures.session import scratch_folder
from fleetfeatures.sources import catalog, feature_store, files
from fleetfeatures.sources.bucket_store import BucketTable


def _new_database(spark: SparkSession) -> tuple[str, str]:
    folder = scratch_folder(spark)
    name = "ff_" + folder.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}/{name}'")
    return name, folder


@register("csv_roundtrip", "SELECT * FROM orders")
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    orders, path = table(spark, folder, "orders"), scratch_folder(spark)
    files.write_csv(orders, path)
    return files.read_csv(spark, path, orders.schema)


@register("csv_inferred", "SELECT c_custkey::INT AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_folder(spark)
    files.write_csv(table(spark, folder, "customer"), path)
    return files.read_csv(spark, path)


@register("csv_reordered", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def csv_reordered(spark: SparkSession, folder: str) -> DataFrame:
    """Columns in another order and case, after one that the schema lacks."""
    orders, path = table(spark, folder, "orders"), scratch_folder(spark)
    shuffled = orders.select(F.monotonically_increasing_id().alias("id"), F.col("o_totalprice").alias("O_TOTALPRICE"),
                             "o_orderpriority", "o_custkey", "o_orderkey", "o_orderstatus")
    files.write_csv(shuffled, path)
    return files.read_csv(spark, path, orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority").schema)


@register("csv_missing_words", """
SELECT c_custkey::INT AS c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS c_mktsegment,
       CASE WHEN c_custkey % 3 <> 0 THEN c_acctbal END AS c_acctbal FROM customer""")
def csv_missing_words(spark: SparkSession, folder: str) -> DataFrame:
    """Types inferred beside words that stand for missing values."""
    customer, path = table(spark, folder, "customer"), scratch_folder(spark)
    key = F.col("c_custkey")
    files.write_csv(customer.select(
        "c_custkey", F.when(key % 10 == 0, "N/A").when(key % 5 == 0, "null").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.when(key % 3 == 0, "NA").otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal")), path)
    return files.read_csv(spark, path)


@register("csv_mixed_headers", """
SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders""")
def csv_mixed_headers(spark: SparkSession, folder: str) -> DataFrame:
    """One dataset whose files have three headers: other orders of the columns, one without a column, one with a further one."""
    orders, path = table(spark, folder, "orders"), f"{scratch_folder(spark)}/orders.csv"
    parts = [["o_orderkey", "o_custkey", "o_totalprice"], ["O_TotalPrice", "o_orderpriority", "o_orderkey", "o_custkey"],
             ["o_orderpriority", "o_orderstatus", "o_custkey", "o_orderkey", "o_totalprice"]]
    for k, columns in enumerate(parts):
        orders.where(f"o_orderkey % 3 = {k}").select(*columns).write.mode("append").option("header", True).csv(path)
    return files.read_csv(spark, path, orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority").schema)


@register("csv_quoted", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'say "' || o_orderpriority || '", you' WHEN 1 THEN 'two' || chr(10) || '"lines"' WHEN 2 THEN 'back\\slash, '
       ELSE o_orderpriority END AS note, o_totalprice FROM orders""")
def csv_quoted(spark: SparkSession, folder: str) -> DataFrame:
    """Values with quotes, commas, line ends and backslashes, quotes doubled as in most programs."""
    orders, path = table(spark, folder, "orders"), f"{scratch_folder(spark)}/notes.csv"
    kind = F.col("o_orderkey") % 4
    note = (F.when(kind == 0, F.concat(F.lit('say "'), "o_orderpriority", F.lit('", you'))).when(kind == 1, F.lit('two\n"lines"'))
            .when(kind == 2, F.lit("back\\slash, ")).otherwise(F.col("o_orderpriority")))
    notes = orders.select("o_orderkey", note.alias("note"), "o_totalprice")
    for lines, rows in (("with", notes.where(kind == 1)), ("without", notes.where(kind != 1))):
        rows.write.mode("append").options(header=True, escape='"', ignoreTrailingWhiteSpace=False, quoteAll=lines == "with").csv(path)
    return files.read_csv(spark, path, notes.schema)


@register("csv_whole_doubles", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN l_partkey END AS l_partkey FROM lineitem""")
def csv_whole_doubles(spark: SparkSession, folder: str) -> DataFrame:
    """Whole numbers written as doubles, as programs do that have no missing whole numbers."""
    lines, path = table(spark, folder, "lineitem"), f"{scratch_folder(spark)}/lines.csv"
    chosen = lines.select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") % 2 == 0, F.col("l_partkey")).alias("l_partkey"))
    number = F.col("l_partkey").cast("double")
    short = F.format_string("%.3e", number)
    text = F.when(number.isNotNull() & (F.col("l_orderkey") % 2 == 1) & (short.try_cast("double") == number), short).otherwise(number.cast("string"))
    chosen.select(F.concat(F.col("l_orderkey").cast("string"), F.lit(".0")).alias("l_orderkey"), "l_linenumber",
                  F.coalesce(text, F.lit("nan")).alias("l_partkey")).write.option("header", True).csv(path)
    return files.read_csv(spark, path, chosen.schema)


@register("csv_unreadable", """
SELECT 'o_orderkey' AS "column", count(*) AS n_values, 0::BIGINT AS n_unreadable FROM orders
UNION ALL SELECT 'o_orderpriority', count(*), count(*) FROM orders
UNION ALL SELECT 'o_totalprice', count(*), count(*) FILTER (o_totalprice <> floor(o_totalprice)) FROM orders""")
def csv_unreadable(spark: SparkSession, folder: str) -> DataFrame:
    """How many values a schema of whole numbers cannot hold."""
    orders, path = table(spark, folder, "orders"), f"{scratch_folder(spark)}/orders.csv"
    files.write_csv(orders, path)
    kinds = "o_orderkey long, o_orderpriority int, o_totalprice long"
    return files.unreadable(spark, path, spark.createDataFrame([], kinds).schema)


@register("csv_landed", """
SELECT 'orders' AS table_name, o_orderkey AS row_key, o_totalprice AS amount FROM orders
UNION ALL SELECT 'supplier', s_suppkey, s_acctbal FROM supplier""")
def csv_landed(spark: SparkSession, folder: str) -> DataFrame:
    database, path = _new_database(spark)
    source = {name: table(spark, folder, name) for name in ("orders", "supplier")}
    for name, df in source.items():
        files.write_csv(df, f"{path}/csv/{name}.csv")
    files.land_folder(spark, f"{path}/csv", database, {name: df.schema for name, df in source.items()})
    landed = catalog.load_all_tables(spark, database)
    keys = {"orders": ("o_orderkey", "o_totalprice"), "supplier": ("s_suppkey", "s_acctbal")}
    parts = [df.select(F.lit(name).alias("table_name"), F.col(keys[name][0]).alias("row_key"),
                       F.col(keys[name][1]).alias("amount")) for name, df in landed.items()]
    return parts[0].unionByName(parts[1])


@register("sql_read", """
SELECT o_orderpriority, count(*) AS n_orders, max(o_totalprice) AS top_price FROM orders
WHERE o_orderstatus = 'F' GROUP BY o_orderpriority""")
def sql_read(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.query(spark, """
        SELECT o_orderpriority, count(*) AS n_orders, max(o_totalprice) AS top_price FROM {orders}
        WHERE o_orderstatus = 'F' GROUP BY o_orderpriority""", orders=table(spark, folder, "orders"))


@register("table_list", """
SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer
UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'supplier', count(*) FROM supplier""")
def table_list(spark: SparkSession, folder: str) -> DataFrame:
    database, _ = _new_database(spark)
    for name in ("supplier", "customer", "part"):
        table(spark, folder, name).write.mode("overwrite").saveAsTable(f"{database}.{name}")
    found = catalog.load_all_tables(spark, database)
    parts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in found.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _store_trucks(spark: SparkSession, folder: str) -> str:
    database, path = _new_database(spark)
    trucks = feature_store.stamp_event_time(view(spark, folder, "trucks"), "eventtime", "2024-10-08 00:00:00")
    feature_store.write_feature_table(
        trucks, "trucks_table", 1, path, primary_key=["truck_id"], event_time="eventtime",
        description="Features for trucks_table", comments=column_comments("trucks_table"), database=database)
    return database


@register("feature_roundtrip", with_views("trucks", """
SELECT *, TIMESTAMP '2024-10-08 00:00:00' AS eventtime FROM trucks"""))
def feature_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    database = _store_trucks(spark, folder)
    stored = feature_store.read_feature_tables(spark, ["trucks_table", "not_there"], 1, database)
    return plain_times(stored["trucks_table"])


@register("feature_drop", "SELECT true AS was_there, false AS is_there, count(*) AS n_rows FROM customer")
def feature_drop(spark: SparkSession, folder: str) -> DataFrame:
    database = _store_trucks(spark, folder)
    stored = feature_store.read_feature_table(spark, "trucks_table", 1, database)
    rows = stored.count()
    feature_store.drop_feature_table(spark, "trucks_table", 1, database)
    gone = feature_store.read_feature_table(spark, "trucks_table", 1, database)
    return table(spark, folder, "customer").agg(
        F.lit(stored is not None).alias("was_there"), F.lit(gone is not None).alias("is_there"),
        F.max(F.lit(rows)).cast("long").alias("n_rows"))


@register("feature_comments", """
SELECT 'truck_id' AS column, 'truck' AS comment UNION ALL SELECT 'truck_age', 'age, years'
UNION ALL SELECT 'load_capacity_pounds', 'largest load, pounds; may be missing'
UNION ALL SELECT 'mileage_mpg', 'fuel efficiency, miles per gallon' UNION ALL SELECT 'fuel_type', 'fuel the truck runs on'
UNION ALL SELECT 'eventtime', 'time the record was made'""".replace("AS column", 'AS "column"'))
def feature_comments(spark: SparkSession, folder: str) -> DataFrame:
    database = _store_trucks(spark, folder)
    described = spark.sql(f"DESCRIBE TABLE {feature_store.table_of('trucks_table', 1, database)}")
    return described.select(F.col("col_name").alias("column"), "comment")


_BATCH = """SELECT s_suppkey, s_name, s_nationkey, s_acctbal, TIMESTAMP '2024-01-01 00:00:00' AS eventtime FROM supplier
UNION ALL SELECT s_suppkey, s_name || ' late', s_nationkey, s_acctbal + 1, TIMESTAMP '2024-02-01 00:00:00'
          FROM supplier WHERE s_acctbal > 5000
UNION ALL SELECT s_suppkey, s_name || ' early', s_nationkey, s_acctbal - 1, TIMESTAMP '2023-12-01 00:00:00'
          FROM supplier WHERE s_acctbal <= 5000
UNION ALL SELECT c_custkey + 1000000, c_name, c_nationkey, c_acctbal, TIMESTAMP '2024-02-01 00:00:00' FROM customer"""


@register("upsert_latest", f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY eventtime DESC) AS rn
FROM ({_BATCH})) WHERE rn = 1""")
def upsert_latest(spark: SparkSession, folder: str) -> DataFrame:
    database, path = _new_database(spark)
    options = {"primary_key": ["s_suppkey"], "event_time": "eventtime", "database": database}
    supplier, customer = table(spark, folder, "supplier"), table(spark, folder, "customer")
    feature_store.write_feature_table(feature_store.stamp_event_time(supplier, value="2024-01-01 00:00:00"), "supplier", 1, path, **options)
    batch = _supplier_batch(supplier, customer)
    name = feature_store.write_feature_table(batch, "supplier", 1, path, **options)
    return plain_times(spark.table(name))


def _supplier_batch(supplier: DataFrame, customer: DataFrame) -> DataFrame:
    """Later and earlier rows of known keys, and new keys."""
    stamp, high = feature_store.stamp_event_time, F.col("s_acctbal") > 5000
    late = supplier.where(high).withColumns({"s_name": F.concat("s_name", F.lit(" late")), "s_acctbal": F.col("s_acctbal") + 1})
    early = supplier.where(~high).withColumns({"s_name": F.concat("s_name", F.lit(" early")), "s_acctbal": F.col("s_acctbal") - 1})
    fresh = customer.select((F.col("c_custkey") + 1000000).alias("s_suppkey"), F.col("c_name").alias("s_name"),
                            F.col("c_nationkey").alias("s_nationkey"), F.col("c_acctbal").alias("s_acctbal"))
    return (stamp(late, value="2024-02-01 00:00:00").unionByName(stamp(early, value="2023-12-01 00:00:00"))
            .unionByName(stamp(fresh, value="2024-02-01 00:00:00")))


@register("upsert_buckets", f"""
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY eventtime DESC) AS rn
FROM ({_BATCH})) WHERE rn = 1""")
def upsert_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """The upsert of :func:`upsert_latest` in a table of key buckets; the batch comes in two parts."""
    store = BucketTable(spark, scratch_folder(spark), "supplier", 1)
    supplier = table(spark, folder, "supplier")
    store.write(feature_store.stamp_event_time(supplier, value="2024-01-01 00:00:00"), primary_key=["s_suppkey"], event_time="eventtime", buckets=16)
    batch = _supplier_batch(supplier, table(spark, folder, "customer"))
    store.write(batch.where("s_suppkey >= 1000000"))
    store.write(batch.where("s_suppkey < 1000000"))
    store.vacuum(older_than=0.0)
    return plain_times(store.read())


@register("bucket_snapshots", """
SELECT 0 AS snapshot, o_orderpriority, count(*) AS n_rows, min(o_orderkey) AS first_key FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY ALL
UNION ALL SELECT 1, CASE WHEN o_orderkey % 5 = 0 THEN 'changed' ELSE o_orderpriority END, count(*), min(o_orderkey) FROM orders
          WHERE o_orderkey % 3 <> 0 OR o_orderkey % 5 = 0 GROUP BY ALL""")
def bucket_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Readers of an older snapshot keep its rows after an upsert that changes, adds and leaves rows."""
    store = BucketTable(spark, scratch_folder(spark), "orders", 1)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    stamp = feature_store.stamp_event_time
    store.write(stamp(orders.where("o_orderkey % 3 <> 0"), value="2024-01-01 00:00:00"), primary_key=["o_orderkey"], event_time="eventtime", buckets=8)
    changed = orders.where("o_orderkey % 5 = 0").withColumn("o_orderpriority", F.lit("changed"))
    store.write(stamp(changed, value="2024-02-01 00:00:00"))
    parts = [store.read(n).groupBy("o_orderpriority").agg(F.count("*").alias("n_rows"), F.min("o_orderkey").alias("first_key")).select(
        F.lit(n).alias("snapshot"), "*") for n in (0, 1)]
    return parts[0].unionByName(parts[1])


@register("upsert_new_column", """
SELECT s_suppkey, s_acctbal, TIMESTAMP '2024-02-01 00:00:00' AS eventtime,
       CASE WHEN s_acctbal > 5000 THEN s_name END AS nick FROM supplier WHERE s_acctbal > 5000
UNION ALL SELECT s_suppkey, s_acctbal, TIMESTAMP '2024-01-01 00:00:00', NULL FROM supplier WHERE s_acctbal <= 5000""")
def upsert_new_column(spark: SparkSession, folder: str) -> DataFrame:
    """A batch brings a column that the table lacks."""
    database, path = _new_database(spark)
    options = {"primary_key": ["s_suppkey"], "event_time": "eventtime", "database": database}
    supplier, stamp = table(spark, folder, "supplier"), feature_store.stamp_event_time
    feature_store.write_feature_table(
        stamp(supplier.select("s_suppkey", "s_acctbal"), value="2024-01-01 00:00:00"), "supplier", 1, path, **options)
    late = supplier.where("s_acctbal > 5000").select("s_suppkey", "s_acctbal", F.col("s_name").alias("nick"))
    name = feature_store.write_feature_table(stamp(late, value="2024-02-01 00:00:00"), "supplier", 1, path, **options)
    return plain_times(spark.table(name))


@register("upsert_widened_type", """
SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN s_nationkey + 0.5::DOUBLE ELSE s_nationkey::DOUBLE END AS n FROM supplier""")
def upsert_widened_type(spark: SparkSession, folder: str) -> DataFrame:
    """Whole numbers in the table, doubles in the batch; a second batch of whole numbers changes nothing."""
    database, path = _new_database(spark)
    options = {"primary_key": ["s_suppkey"], "event_time": "eventtime", "database": database}
    supplier, stamp = table(spark, folder, "supplier"), feature_store.stamp_event_time
    whole = supplier.select("s_suppkey", F.col("s_nationkey").cast("int").alias("n"))
    feature_store.write_feature_table(stamp(whole, value="2024-01-01 00:00:00"), "supplier", 1, path, **options)
    wide = supplier.where("s_acctbal > 5000").select("s_suppkey", (F.col("s_nationkey") + F.lit(0.5)).alias("n"))
    feature_store.write_feature_table(stamp(wide, value="2024-02-01 00:00:00"), "supplier", 1, path, **options)
    name = feature_store.write_feature_table(stamp(whole, value="2023-01-01 00:00:00"), "supplier", 1, path, **options)
    feature_store.vacuum_feature_table(spark, "supplier", 1, database)
    return spark.table(name).select("s_suppkey", "n")


@register("stored_clean_traffic", with_views("traffic", f"""
SELECT row_number() OVER (ORDER BY rowindex) AS rowindex, route_id,
       CAST(date AS TIMESTAMP) + (hour // 100) * INTERVAL '1' HOUR AS date, accident,
       {sql_rounded('coalesce(no_of_vehicles, (SELECT avg(no_of_vehicles) FROM traffic))', 'no_of_vehicles')},
       TIMESTAMP '2024-09-24 00:00:00' AS eventtime
FROM traffic"""))
def stored_clean_traffic(spark: SparkSession, folder: str) -> DataFrame:
    database, path = _new_database(spark)
    cleaned = clean_tables({"traffic_table": view(spark, folder, "traffic")}, {"traffic_table": ["rowindex"]}, {})
    store_clean_tables(cleaned, path, event_time="2024-09-24 00:00:00", database=database)
    stored = feature_store.read_feature_tables(spark, ["traffic_table"], 1, database)
    return plain_times(rounded(stored["traffic_table"], ["no_of_vehicles"]))
