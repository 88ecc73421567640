"""Operator 2, mixing sources to target weights: Efraimidis-Spirakis sampling inside complete epochs.

Each source gets a word target; it is passed whole as often as the target
allows, and a fraction of it is added: documents in the order of exponential
keys -ln(u) / quality weight, up to the word budget. u comes from a hash of the
document's id and a seed, so reruns agree.

The order within sources is a range sort over all tasks, so a source of any
share is spread; running sums inside a task's slice are joined to the sums of
the slices before it (one row per slice and source).

Defined cases: null texts have size 0; a null source is one source, the last;
rows with equal ids are told apart by size only, which changes no total; a
weight that is null or not positive counts as 1; an empty table gives an empty
result; columns are selected by name, so extra ones cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetfeatures.llm.common import WORD, small, written

SHARE = 1.5
MOST = 2
WEIGHTS = (5, 2, 1)
SEED = "mix-1"
_HEX = 13


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def digest_of(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A hash of id, text and seed: the chance of a document, and what orders equal keys."""
    parts = [F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))]
    return F.md5(F.concat_ws(":", *parts))


def exponential_key(digest: Column, weight: Column) -> Column:
    """-ln(u) / weight with u in (0, 1) from the digest."""
    u = (F.conv(F.substring(digest, 1, _HEX), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(16 ** _HEX))
    good = F.when(weight > 0, weight.cast("double"))
    return -F.log(u) / F.coalesce(good, F.lit(1.0))


def source_targets(sizes: DataFrame) -> DataFrame:
    """From (source, source_size): the target of each source.

    With sources ordered by size per weight, those at their limit come first; the level of the others follows from
    what these leave. One row per source: the order of sources needs them in one place.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    weighed = sizes.withColumn("weight", F.get(
        F.array(*[F.lit(w) for w in WEIGHTS]), (F.row_number().over(place) - 1) % len(WEIGHTS)))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    full = F.coalesce(F.sum("source_size").over(before), F.lit(0))
    spent = F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = (F.lit(SHARE) * F.sum("source_size").over(every) - MOST * full) / (F.sum("weight").over(every) - spent)
    levels = weighed.withColumn("level", level)
    free = F.when(F.col("level") * F.col("weight") <= MOST * F.col("source_size"), F.col("level"))
    return levels.withColumn("first_free", F.first(free, ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).select("source", "source_size", F.least(
            (F.lit(MOST) * F.col("source_size")).cast("double"), F.col("first_free") * F.col("weight")).alias("target"))


def slim_rows(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and digest of documents; texts go no further."""
    return docs.select("doc_id", "source", size_of(F.col("text")).alias("size"),
                       digest_of(F.col("doc_id"), F.col("text")).alias("digest"))


def keyed(slim: DataFrame, weight: Column) -> DataFrame:
    return slim.select("doc_id", "source", "size", "digest", exponential_key(F.col("digest"), weight).alias("key"))


def sliced_rows(slim: DataFrame) -> DataFrame:
    """The slim rows in slices of the order source, key, digest; written, so that slices stay what they are."""
    order = [F.col("source").asc_nulls_last(), "key", "digest"]
    return written(slim.repartitionByRange(*order).withColumn("slice", F.spark_partition_id()))


def source_plan(sliced: DataFrame) -> DataFrame:
    """Per source: source_size, target, epochs, and ``cut`` (key, digest), the last document of the fraction."""
    sums = sliced.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    totals = source_targets(sums.groupBy("source").agg(F.sum("slice_size").alias("source_size")))
    totals = totals.withColumn("epochs", F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("s_source"), F.col("slice").alias("s_slice"),
                         F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)).alias("before"))
    starts = starts.join(totals, F.col("s_source").eqNullSafe(F.col("source"))).drop("source")
    # equal rows (same id and text) are taken or left together
    peers = Window.partitionBy("slice", "source").orderBy("key", "digest").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    same = sliced.groupBy("source", "slice", "key", "digest").agg(F.sum("size").alias("size"))
    running = same.withColumn("upto", F.sum("size").over(peers)).join(
        starts, (F.col("slice") == F.col("s_slice")) & F.col("source").eqNullSafe(F.col("s_source")))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    with_it = F.col("before") + F.col("upto")
    without = with_it - F.col("size")
    # the document across the budget is taken if that comes nearer to it
    inside = (with_it <= rest) | ((without < rest) & (with_it - rest < rest - without))
    cuts = running.filter(inside).groupBy("source").agg(F.max(F.struct("key", "digest")).alias("cut"))
    cuts = cuts.withColumnRenamed("source", "c_source")
    return totals.join(cuts, F.col("source").eqNullSafe(F.col("c_source")), "left").drop("c_source")


def times(plan: DataFrame) -> DataFrame:
    """The plan under names of its own, for joins."""
    return plan.select(*[F.col(c).alias(f"plan_{c}") for c in plan.columns])


def copies() -> Column:
    """How often a document is passed: whole epochs, and once more inside the fraction."""
    return F.col("plan_epochs") + F.coalesce(
        (F.struct("key", "digest") <= F.col("plan_cut")).cast("int"), F.lit(0))


def mix(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words, repeats counted) of every document."""
    slim = slim_rows(docs)
    sliced = sliced_rows(keyed(slim, F.lit(1.0)) if labels is None else keyed(with_quality(slim, labels), F.col("weight")))
    joined = sliced.join(small(times(written(source_plan(sliced)))), F.col("source").eqNullSafe(F.col("plan_source")))
    return joined.select("doc_id", "source", "size", F.col("plan_source_size").alias("source_size"),
                         F.col("plan_target").alias("target"), (copies() * F.col("size")).cast("long").alias("taken"))


def mix_rows(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The documents of the mix, each row as often as it is passed; columns as they came.

    Whether a row is in depends on its source's plan and its own key. Only labelled documents (id and weight, no texts) are
    joined to the rows.
    """
    slim = slim_rows(docs)
    plan = written(source_plan(sliced_rows(keyed(slim, F.lit(1.0)) if labels is None else keyed(with_quality(slim, labels), F.col("weight")))))
    digest = digest_of(F.col("row.doc_id"), F.col("row.text"))
    rows = docs.select(F.struct("*").alias("row")).select("row", digest.alias("digest"))
    weight = F.lit(1.0)
    if labels is not None:
        rated = small(written(quality_weights(labels)))
        rows = rows.join(rated, F.col("row.doc_id") == F.col("l_doc_id"), "left")
        weight = F.coalesce("weight", F.lit(1.0))
    rows = rows.withColumn("key", exponential_key(F.col("digest"), weight))
    joined = rows.join(small(times(plan)), F.col("row.source").eqNullSafe(F.col("plan_source")))
    repeated = joined.withColumn("again", F.explode(F.array_repeat(F.lit(1), copies().cast("int"))))
    return repeated.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def quality_weights(labels: DataFrame) -> DataFrame:
    """(l_doc_id, weight): 2 good, 0.5 poor, 1 not labelled (the best label counts)."""
    rated = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("l_doc_id")).agg(
        F.max("quality").alias("quality"))
    return rated.select("l_doc_id", F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).otherwise(1.0).alias("weight"))


def with_quality(slim: DataFrame, labels: DataFrame) -> DataFrame:
    """Slim rows with a quality weight from labels."""
    joined = slim.join(quality_weights(labels), F.col("doc_id") == F.col("l_doc_id"), "left")
    return joined.withColumn("weight", F.coalesce("weight", F.lit(1.0)))


#: Steps of check SQL from a table ``d`` (doc_id, source, size, weight) to ``mixed``.
SQL_MIX = f"""
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
sw AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
sl AS (SELECT *, ({SHARE} * sum(source_size) OVER () - {MOST} * coalesce(sum(source_size) OVER b, 0))::DOUBLE
          / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level, source_size / weight AS ratio
       FROM sw WINDOW b AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
fl AS (SELECT arg_min(level, ratio) AS level FROM sl WHERE level * weight <= {MOST} * source_size),
t AS (SELECT source, source_size, least(({MOST} * source_size)::DOUBLE, fl.level * weight) AS target FROM sl, fl),
k AS (SELECT *, -ln((('0x' || substr(digest, 1, {_HEX}))::BIGINT + 0.5::DOUBLE)
          / {float(16 ** _HEX)!r}::DOUBLE) / weight AS key FROM (
        SELECT *, md5('{SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS digest FROM d)),
u AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, digest RANGE UNBOUNDED PRECEDING) AS upto,
             sum(size) OVER (PARTITION BY source, key, digest) AS peers FROM k),
e AS (SELECT u.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
      FROM u JOIN t ON u.source IS NOT DISTINCT FROM t.source),
f AS (SELECT *, target - epochs * source_size AS rest FROM e),
mixed AS (SELECT *, (epochs + (upto <= rest OR (upto - peers < rest
             AND upto - rest < rest - (upto - peers)))::INT)::BIGINT AS copies FROM f)"""

SQL = rf"""
WITH q AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
             CASE quality WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END::DOUBLE AS weight
      FROM documents LEFT JOIN q USING (doc_id)), {SQL_MIX}
SELECT doc_id, source, size, source_size::BIGINT AS source_size, target, (copies * size)::BIGINT AS taken FROM mixed"""
