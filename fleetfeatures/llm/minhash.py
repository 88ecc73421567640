"""Operator 6, near-duplicate documents: DartMinHash signatures, banded joining, exact check.

A document is a set of five-word shingles (weights may be given). Darts are
thrown by hash: each unit of an element's weight times each unit of rank is a
cell that holds a Poisson(1) number of darts, at ranks and coordinates their
hashes tell. Per coordinate the dart of least rank that lies inside the
document's region is kept; two documents keep the same dart with the
probability of their weighted Jaccard similarity. Ranks are searched up to about
(t ln t + 2t) darts, and further while a coordinate is empty.

Coordinates are banded; documents that share a band meet in its bucket. Pairs in
a bucket are not all formed: first each document is compared with one leader of
its buckets, then with each bucket's leader where that is in another component,
then what is still apart inside a bucket and may be similar, by bit sketches
of the sets and, in large buckets, by the number of shingles that few others have. Each comparison is exact (Jaccard similarity of the shingle sets at
least ``SIMILARITY``). Components of links are the classes.

A pair of similarity 0.8 shares none of the 25 bands of 5 coordinates with
probability (1 - 0.8^5)^25 = 5e-5; at 0.9 with 1e-10.

Defined cases: equal sets are copies and collapse first, whatever their number;
a text of fewer than five words has one shingle of all its words; null, empty
and blank texts have the empty set and are copies of each other; a null doc_id
is an id like others, the last; repeated rows are copies; extra columns stay.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetfeatures.llm.common import numbered, ship, written
from fleetfeatures.llm.graph import components
from fleetfeatures.llm.hashing import U, groups, mix, windows, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 25
ROWS = 5
#: Buckets up to this size are compared pair by pair; in larger ones a bound comes first.
SMALL = 32
RARE = 12
#: 64-bit words of a set's sketch, a bit a shingle by hash; it bounds what two sets share.
SKETCH = 32
BOUNDS = ["n", "sketch", "spare"]

_SEEDS = [U(0x1F83D9ABFB41BD6B), U(0x5BE0CD19137E2179), U(0x3C6EF372FE94F82B), U(0x510E527FADE682D1)]
#: Upper ends of a Poisson(1) number's cumulative probabilities, as fractions of 2^64.
_POISSON = np.array([min(2 ** 64 - 1, int(2 ** 64 * sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)))) for k in range(24)], U)


def shingle_sets(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct shingles, ascending, and how often each occurs."""
    for a, b in groups(texts):
        words, counts = word_hashes(texts[a:b])
        ends = np.cumsum(counts)
        for end, n in zip(ends.tolist(), counts.tolist()):
            yield np.unique(windows(words[end - n:end], SHINGLE), return_counts=True)


def dart_signature(elements: np.ndarray, weights: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """Per coordinate the dart of least rank in the region of the weighted elements (none: zeros)."""
    kept = np.zeros(size, U)
    total = float(weights.sum())
    if total <= 0.0:
        return kept
    units = np.ceil(weights).astype(np.int64)
    column = np.repeat(elements, units)
    unit = np.arange(len(column)) - np.repeat(np.cumsum(units) - units, units)
    room = np.repeat(weights, units) - unit  # of the unit that is inside the weight
    column = mix(column ^ _SEEDS[0] ^ mix(unit.astype(U)))
    filled, low, high = np.zeros(size, bool), 0, max(1, math.ceil(size * (math.log(size) + 2) / total))
    while not filled.all():
        cells = mix(column[None, :] + mix(np.arange(low, high).astype(U) ^ _SEEDS[1])[:, None])
        darts = np.searchsorted(_POISSON, cells.ravel(), side="right")
        owner = np.repeat(np.arange(cells.size), darts)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(darts) - darts, darts)
        dart = mix(cells.ravel()[owner] ^ mix(number.astype(U) + _SEEDS[2]))
        height = (mix(dart ^ _SEEDS[3]) >> U(11)).astype(float) * 2.0 ** -53
        inside = height <= room[owner % len(column)]
        dart, owner = dart[inside], owner[inside]
        rank = (owner // len(column)) + (mix(dart ^ _SEEDS[1]) >> U(11)).astype(float) * 2.0 ** -53
        coordinate = (mix(dart ^ _SEEDS[0]) % U(size)).astype(np.int64)
        order = np.argsort(-rank, kind="stable")  # written last, the least rank stays
        order = order[~filled[coordinate[order]]]
        kept[coordinate[order]] = dart[order]
        filled[coordinate] = True
        low, high = high, high + max(1, high - low)
    return kept


def band_keys(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    parts = signature.reshape(bands, -1)
    key = np.arange(bands).astype(U) + U(1)
    for k in range(parts.shape[1]):
        key = mix(key ^ mix(parts[:, k] + U(k)))
    return key.view(np.int64)


def _bytes(texts: pd.Series) -> list[bytes]:
    return [t.encode() for t in texts]


def signatures(docs: DataFrame) -> DataFrame:
    """row, doc_id, set_id (a digest of the shingle set) and band keys of every row of ``docs`` (row, doc_id, text)."""
    ship(docs.sparkSession)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, keys = [], []
            for elements, _ in shingle_sets(_bytes(batch["text"])):
                ids.append(hashlib.md5(elements.tobytes()).hexdigest())
                keys.append(band_keys(dart_signature(elements, np.ones(len(elements)))) if len(elements) else np.zeros(0, np.int64))
            yield pd.DataFrame({"row": batch["row"], "doc_id": batch["doc_id"], "set_id": ids, "bands": keys})

    rows = docs.select("row", F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    signed = rows.mapInPandas(sign, "row long, doc_id string, set_id string, bands array<long>")
    return written(signed.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType)))


def sketch(elements: np.ndarray) -> np.ndarray:
    """A field of bits with one of each element set."""
    bits = np.zeros(64 * SKETCH, np.uint8)
    bits[(mix(elements.astype(U)) % U(64 * SKETCH)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def shingle_arrays(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles, sketch) for the rows named in ``nodes``."""
    def shingle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [e.view(np.int64) for e, _ in shingle_sets(_bytes(batch["text"]))]
            yield pd.DataFrame({"node": batch["row"], "shingles": sets, "sketch": [sketch(e) for e in sets]})

    wanted = docs.join(nodes, F.col("row") == F.col("node"), "left_semi")
    texts = wanted.select("row", F.coalesce("text", F.lit("")).alias("text"))
    return written(texts.mapInPandas(shingle, "node long, shingles array<long>, sketch array<long>"))


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    other = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(one, "a").join(other, "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.filter(shared >= SIMILARITY * (F.size("x") + F.size("y") - shared)).select("a", "b")


def _pairs(rows: DataFrame, a: str, b: str) -> DataFrame:
    return rows.filter(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _bounds(sets: DataFrame) -> DataFrame:
    """(node, n, sketch, spare): shingles of a node, their sketch, and how many of them have no bit of their own in it."""
    bits = F.aggregate("sketch", F.lit(0), lambda n, x: n + F.bit_count(x))
    size = F.size("shingles")
    return sets.select("node", size.alias("n"), "sketch", (size - bits).alias("spare"))


def _may_be_similar() -> Column:
    """Whether two sets can be similar enough by their sizes and sketches: a bit that only one sketch has stands for an element
    that only that set has. No similar pair is left out."""
    both = [F.bit_count(F.get("sketch", F.lit(i)).bitwiseAND(F.get("b_sketch", F.lit(i)))) for i in range(SKETCH)]
    most = reduce(Column.__add__, both) + F.least(F.col("spare"), F.col("b_spare"))
    # solved for what is shared, so that the sketches are compared once; rounding must not rule a pair out
    return most >= SIMILARITY / (1 + SIMILARITY) * (F.col("n") + F.col("b_n")) - 1e-6


def _by_node(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, component, bounds, small, large): a row per node of ``placed`` (bucket, node, component) with lists of its small
    and of its large buckets, one a band at most. What is fetched for a node is fetched once, not for each of its buckets."""
    sized = placed.groupBy("bucket").agg((F.count("*") > SMALL).alias("big"))
    held = placed.join(sized, "bucket").groupBy("node", "component").agg(
        F.collect_list(F.when(~F.col("big"), F.col("bucket"))).alias("small"),
        F.collect_list(F.when(F.col("big"), F.col("bucket"))).alias("large"))
    return written(held.join(_bounds(sets), "node"))


def _pairs_in_small_buckets(placed: DataFrame) -> DataFrame:
    """Nodes of different components in a bucket that may be similar, as (leader, node)."""
    other = placed.select("bucket", F.col("node").alias("b"), F.col("component").alias("c"),
                          *[F.col(c).alias(f"b_{c}") for c in BOUNDS])
    met = placed.join(other, "bucket").filter((F.col("component") < F.col("c")) & _may_be_similar())
    return met.select(F.col("node").alias("leader"), F.col("b").alias("node"))


def _pairs_in_large_buckets(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """The same where very many distant copies of one text meet, without the pairs that cannot be similar.

    ``placed`` has a row per node, with its ``bands`` and the list ``large`` of its buckets.
    A shingle that at most ``RARE`` of these nodes have is rare. Two sets without a common rare shingle share at most the
    lesser of their other parts, and together hold both rare parts and at least the greater other part. This bound is
    part of the join's condition, as is that a pair comes from the first band it shares. Pairs with common rare shingles
    come from a join on those (groups of ``RARE`` at most), with their number added to the bound.
    """
    single = sets.join(placed, "node", "left_semi").select("node", F.explode("shingles").alias("shingle"))
    counts = single.groupBy("shingle").agg(F.count("*").alias("n")).filter(F.col("n") <= RARE)
    rare = written(single.join(counts, "shingle"))
    nodes = placed.join(rare.groupBy("node").agg(F.count("*").alias("rare")), "node", "left").na.fill(0, ["rare"])
    nodes = written(nodes.withColumn("usual", F.col("n") - F.col("rare")))
    sizes = nodes.select("node", "component", *BOUNDS, "rare", "usual")
    one = nodes.select("*", F.explode("large").alias("bucket"))
    other = one.select("bucket", *[F.col(c).alias(f"b_{c}") for c in ("node", "component", "bands", *BOUNDS, "rare", "usual")])
    met = one.join(other, "bucket").filter(
        (F.col("component") < F.col("b_component"))
        & (F.least("usual", "b_usual") >= SIMILARITY * (F.col("rare") + F.col("b_rare") + F.greatest("usual", "b_usual")))
        & _may_be_similar() & (F.get(F.array_intersect("bands", "b_bands"), 0) == F.col("bucket"))).select(
        F.col("node").alias("leader"), F.col("b_node").alias("node"))
    few = rare.filter("n > 1").select("shingle", "node")
    common = few.join(few.select("shingle", F.col("node").alias("b_node")), "shingle").filter("node < b_node").groupBy(
        "node", "b_node").agg(F.count("*").alias("shared"))
    both = common.join(sizes, "node").join(sizes.select(*[F.col(c).alias(f"b_{c}") for c in sizes.columns]), "b_node")
    most = F.least("usual", "b_usual") + F.col("shared")
    near = both.filter((F.col("component") != F.col("b_component"))
                       & (most >= SIMILARITY * (F.col("n") + F.col("b_n") - most))
                       & _may_be_similar())
    return met.unionAll(near.select(F.col("node").alias("leader"), F.col("b_node").alias("node")))


def linked_nodes(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component) for ``nodes`` (node, bands) that have a similar partner."""
    spread = nodes.select("node", F.explode("bands").alias("bucket"))
    chance = F.struct(F.xxhash64("node").alias("h"), F.col("node"))
    local = F.struct(F.xxhash64("node", "bucket").alias("h"), F.col("node"))
    leaders = spread.groupBy("bucket").agg(F.count("*").alias("n"), F.min(chance).alias("first"), F.min(local).alias("own"))
    leaders = leaders.filter("n > 1").select("bucket", "first", F.col("own.node").alias("own"))
    shared = written(spread.join(leaders, "bucket"))
    sets = shingle_arrays(docs, shared.select("node").distinct())

    best = shared.groupBy("node").agg(F.min("first").alias("first"))
    links = written(similar(_pairs(best.select("node", F.col("first.node").alias("leader")), "node", "leader"), sets))
    parts = written(components(links))
    for last in (False, True):
        placed = shared.select("node", "bucket", "own").join(parts, "node", "left").withColumn(
            "component", F.coalesce("component", "node"))
        apart = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        apart = apart.filter("lo < hi").select("bucket")
        placed = placed.join(apart, "bucket", "left_semi")
        if last:
            placed = _by_node(placed, sets)
            few = placed.select("node", "component", *BOUNDS, F.explode("small").alias("bucket"))
            large = placed.drop("small").filter(F.size("large") > 0).join(nodes, "node")
            pairs = _pairs_in_small_buckets(few).unionAll(_pairs_in_large_buckets(large, sets))
        else:
            owners = parts.select(F.col("node").alias("own"), F.col("component").alias("c"))
            pairs = placed.join(owners, "own", "left").filter(
                F.coalesce("c", "own") != F.col("component")).select("node", F.col("own").alias("leader"))
        links = written(links.unionAll(similar(_pairs(pairs, "node", "leader"), sets)))
        parts = written(components(links))
    return parts


def near_classes(docs: DataFrame) -> DataFrame:
    """One row per document of ``docs`` (row, doc_id, text): row, doc_id, class_id (the least doc_id of its class), class_size, stays."""
    signed = signatures(docs)
    sets = written(signed.groupBy("set_id").agg(F.min("row").alias("node"), F.first("bands").alias("bands")))
    parts = linked_nodes(docs, sets.select("node", "bands"))
    classes = sets.select("set_id", "node").join(parts, "node", "left").select(
        "set_id", F.coalesce("component", "node").alias("component"))
    placed = signed.select("row", "doc_id", "set_id").join(classes, "set_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row")))
    heads = placed.groupBy("component").agg(first.alias("first"), F.count("*").alias("class_size"))
    return placed.join(heads, "component").select(
        "row", "doc_id", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("row") == F.col("first.row")).alias("stays"))


def class_report(docs: DataFrame) -> DataFrame:
    return near_classes(numbered(docs.select("doc_id", "text"))).select("doc_id", "class_id", "class_size", "stays")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents without those whose class keeps another; columns as they came."""
    rows = numbered(docs.select(F.struct("*").alias("doc")))
    gone = written(near_classes(rows.select("row", "doc.doc_id", "doc.text")).filter(~F.col("stays")).select(F.col("row").alias("gone")))
    return rows.join(gone, F.col("row") == F.col("gone"), "left_anti").select(*[F.col("doc")[c].alias(c) for c in docs.columns])
