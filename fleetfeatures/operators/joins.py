"""Equi-joins that match null keys and spread hot keys (J1-J10 build on these)."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_MIN_ROWS = 1_000_000
HOT_SHARE = 0.01
SALTS = 64
TILE_ROWS = 128
TASK_PAIRS = 4_000_000
MOST_PARTS = 2_000

KeyPairs = Sequence[str | tuple[str, str]]


def _pairs(on: KeyPairs) -> list[tuple[str, str]]:
    return [(k, k) if isinstance(k, str) else tuple(k) for k in on]


def hot_keys(df: DataFrame, keys: Sequence[str], *, share: float = HOT_SHARE,
             min_rows: int = HOT_MIN_ROWS) -> list[int]:
    """Hashes of the key combinations that hold at least ``share`` of all rows.

    One pass over the key columns with a fixed-size frequent-items sketch, no
    shuffle by key; at most ``1 / share`` numbers come back. The list only
    decides which keys are spread over more tasks, never which rows are kept,
    so the sketch need not be exact.
    """
    return hot_key_sets(df, {"keys": keys}, share=share, min_rows=min_rows)["keys"]


def hot_key_sets(df: DataFrame, key_sets: dict[str, Sequence[str]], *, share: float = HOT_SHARE,
                 min_rows: int = HOT_MIN_ROWS) -> dict[str, list[int]]:
    """:func:`hot_keys` for several key lists of one frame in the same pass."""
    rows = df.count()
    if rows < min_rows:
        return {name: [] for name in key_sets}
    limit = max(min_rows, share * rows)
    most = max(1, int(1 / share))
    types = dict(df.dtypes)
    sketches = []
    for name, keys in key_sets.items():
        hashed = ", ".join(_hash_sql(k, types[k]) for k in keys)
        sketches.append(F.expr(f"approx_top_k(xxhash64({hashed}), {most}, {most * 100})").alias(name))
    found = df.agg(*sketches).first()
    return {name: [e["item"] for e in found[name] if e["count"] >= limit] for name in key_sets}


def _hash_sql(name: str, dtype: str) -> str:
    return f"CAST(`{name}` AS DOUBLE)" if _is_numeric(dtype) else f"`{name}`"


def _is_numeric(dtype: str) -> bool:
    return dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") or dtype.startswith("decimal")


def _hash_of(df: DataFrame, keys: Sequence[str]) -> Column:
    # numbers of different width must hash alike on both sides
    types = dict(df.dtypes)
    return F.expr(f"xxhash64({', '.join(_hash_sql(k, types[k]) for k in keys)})")


def join_on(left: DataFrame, right: DataFrame, on: KeyPairs, how: str = "left", *,
            hot: Sequence[int] = (), salts: int = SALTS,
            suffixes: tuple[str, str] | None = None, parts: int = 0) -> DataFrame:
    """Equi-join in which null equals null.

    ``on`` lists common names or ``(left, right)`` pairs; a common key appears
    once in the result, pairs keep both columns. Clashing other names are an
    error unless ``suffixes`` says how to tell them apart.

    Rows whose key hash is in ``hot`` are spread over ``salts`` sub-keys, and
    only the matching right rows are repeated, so a key that holds a third of
    the left side does not end in one task. The salt is a hash of the row and
    its partition: equal rows are spread too, and a recomputed task puts every
    row where it was before. Which side is broadcast is left to Spark's size
    check.

    ``parts`` deals both sides by key into so many partitions, which adaptive
    execution does not merge (:func:`pair_load` says how many).
    """
    pairs = _pairs(on)
    semi = how in ("left_semi", "left_anti")
    if semi:
        right = right.select(*[r for _, r in pairs])
    held = {r: f"__right_{r}" for l, r in pairs if l == r or semi}
    clash = set(left.columns) & set(right.columns) - set(held)
    if clash and suffixes is None:
        raise ValueError(f"both sides have {sorted(clash)}; rename first or give suffixes")
    left_named = {c: c + suffixes[0] for c in clash}
    right_named = {**{c: c + suffixes[1] for c in clash}, **held}
    left = left.withColumnsRenamed(left_named) if left_named else left
    right = right.withColumnsRenamed(right_named) if right_named else right
    left_keys = [left_named.get(l, l) for l, _ in pairs]
    right_keys = [right_named.get(r, r) for _, r in pairs]
    condition = [F.col(l).eqNullSafe(F.col(r)) for l, r in zip(left_keys, right_keys)]
    helpers = [] if semi else list(held.values())
    if hot:
        hashes = list(hot)
        own = F.pmod(F.xxhash64(*left.columns, F.spark_partition_id()), F.lit(salts)).cast("int")
        left = left.withColumn("__salt_left", F.when(_hash_of(left, left_keys).isin(hashes), own).otherwise(0))
        spread = F.when(_hash_of(right, right_keys).isin(hashes), F.sequence(F.lit(0), F.lit(salts - 1)))
        right = right.withColumn("__salt_right", F.explode(F.coalesce(spread, F.array(F.lit(0)))))
        condition.append(F.col("__salt_left") == F.col("__salt_right"))
        helpers += ["__salt_left"] if semi else ["__salt_left", "__salt_right"]
        left_keys, right_keys = [*left_keys, "__salt_left"], [*right_keys, "__salt_right"]
    if parts:
        # one key that is never null, since Spark deals by other expressions to compare keys that may be; nulls in it are equal
        left, right = (df.withColumn(name, F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])).repartition(parts, name)
                       for df, name, keys in ((left, "__key_left", left_keys), (right, "__key_right", right_keys)))
        condition = [F.col("__key_left") == F.col("__key_right")]
        helpers += ["__key_left"] if semi else ["__key_left", "__key_right"]
    joined = left.join(right, reduce(and_, condition), how)
    return joined.drop(*helpers) if helpers else joined


def pair_load(left: DataFrame, right: DataFrame, on: KeyPairs, how: str = "left", *, task_pairs: int = TASK_PAIRS,
              share: float = HOT_SHARE, rows_to_salt: int = 16 * SALTS) -> dict[str, object]:
    """``parts`` and ``hot`` of :func:`join_on` for a left or inner join whose result is far larger than its input.

    Adaptive execution merges partitions by the bytes that a join reads, so that
    such a join ends in a few tasks, or one. Here the rows of each key are counted
    on both sides, and the pairs they make say how many partitions there are to
    be: one per ``task_pairs`` and one per core at least, none asked for if one
    is enough. Keys with more than ``share`` of all pairs, if those are more than
    one task's, are hot, but for keys of so few left rows that repeating the right
    ones would weigh against the pairs. A job that counts both inputs, and another
    if there are hot keys; numbers come back, at most ``1 / share`` for hot keys.
    """
    pairs = _pairs(on)
    n_left = left.groupBy(*[F.col(l).alias(f"l_{l}") for l, _ in pairs]).agg(F.count(F.lit(1)).alias("n_left"))
    n_right = right.groupBy(*[F.col(r).alias(f"r_{r}") for _, r in pairs]).agg(F.count(F.lit(1)).alias("n_right"))
    made = F.col("n_left").cast("double") * F.coalesce("n_right", F.lit(1))
    counted = join_on(n_left, n_right, [(f"l_{l}", f"r_{r}") for l, r in pairs], how).withColumn("pairs", made)
    seen = counted.agg(F.coalesce(F.sum("pairs"), F.lit(0.0)).alias("all"), F.coalesce(F.max("pairs"), F.lit(0.0)).alias("most")).first()
    parts = 0
    if seen["all"] > task_pairs:
        parts = min(MOST_PARTS, max(ceil(seen["all"] / task_pairs), left.sparkSession.sparkContext.defaultParallelism))
    limit = max(share * seen["all"], task_pairs)
    hot = []
    if seen["most"] > limit:
        key = _hash_of(counted, [f"l_{l}" for l, _ in pairs])
        hot = [r["key"] for r in counted.where((F.col("pairs") > limit) & (F.col("n_left") >= rows_to_salt)).select(key.alias("key")).collect()]
    return {"parts": parts, "hot": hot}


def gather_tiles(df: DataFrame, keys: Sequence[str], size: int = TILE_ROWS) -> DataFrame:
    """The keys and, as ``tile``, arrays of at most ``size`` of a key's rows without their keys.

    For joins of keys with many rows on both sides, whose result is far larger
    than its input: joined as tiles and spread afterwards, a result repeats a
    left row ``size`` times and the same right rows every ``size`` rows. File
    formats write that in a fraction of the bytes that a repeat every few
    thousand rows takes. Any dealing of rows into tiles is right.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))) - 1
    rest = [c for c in df.columns if c not in keys]
    tiles = df.withColumn("__tile_no", F.floor(place / size)).groupBy(*keys, "__tile_no")
    return tiles.agg(F.collect_list(F.struct(*rest)).alias("tile")).drop("__tile_no")


def spread_tiles(df: DataFrame, tiles: Mapping[str, str]) -> DataFrame:
    """A row per row of each tile, one tile after the other; the other columns come first.

    ``tiles`` gives each tile column the suffix of the columns it holds. The
    observed count keeps Spark from compiling this into one loop with what lies
    below: such a loop holds all rows that one row of a join leads to.
    """
    df = df.observe(f"tiles_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))
    for tile, suffix in tiles.items():
        fields = df.schema[tile].dataType.elementType.names
        rest = [c for c in df.columns if c != tile]
        df = df.select(*rest, F.inline(tile).alias(*[f + suffix for f in fields]))
    return df
