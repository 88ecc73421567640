"""Operator 8, best-fit packing: a grouping genetic algorithm over shards, with islands and elite migration.

Documents become token pieces of at most ``capacity`` (only longer documents
are cut). Pieces are dealt into shards of bounded size. Several islands evolve a
packing of each shard, as rows that Spark spreads: a solution is a list of bins;
crossover injects whole well-filled bins of one parent into the other, removes
the bins that hold the same pieces, and best-fits the displaced pieces. After a
round each island receives the elite of its neighbour. A shard is done when its
bins reach the lower bound, ceil(tokens / capacity). Pieces in poorly filled
bins of all shards are then packed again together.

Defined cases: a null or empty text is one piece that holds the end token alone;
repeated rows are pieces of their own; an empty table packs to nothing; very
long texts are cut whole, nothing is dropped; columns are selected by name.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetfeatures.llm.common import ship, written
from fleetfeatures.llm.tokens import WordTokenizer, once

CAPACITY = 4096
END_ID = 1
#: Mean number of pieces of a shard: bounds a task's memory, not what is packed.
SHARD = 2048
ISLANDS = 3
ROUNDS = 2
GENERATIONS = 12
WELL_FILLED = 0.99
POORLY_FILLED = 0.9

COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32"]
Bins = list[list[int]]


def token_pieces(docs: DataFrame, file: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every document."""
    ship(docs.sparkSession)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            tokenizer = once(WordTokenizer, file)
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = tokenizer.ids(text or "") + end
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append((doc_id, number, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(rows, columns=COLUMNS)

    # ids travel as strings: pandas would turn nullable numbers into floats
    pieces = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(
        cut, "doc_id string, piece int, start long, length long, ids_crc32 long")
    return pieces.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def best_fit(lengths: list[int], items: list[int], bins: Bins, capacity: int) -> None:
    """Put ``items`` (longest first) each where it leaves the least room; opens bins as needed."""
    room = sorted((capacity - sum(lengths[i] for i in b), n) for n, b in enumerate(bins))
    for i in sorted(items, key=lambda i: (-lengths[i], i)):
        at = bisect_left(room, (lengths[i], -1))
        if at == len(room):
            bins.append([i])
            insort(room, (capacity - lengths[i], len(bins) - 1))
        else:
            left, n = room.pop(at)
            bins[n].append(i)
            insort(room, (left - lengths[i], n))


def fitness(lengths: list[int], bins: Bins, capacity: int) -> tuple[int, float]:
    """Fewer bins first; then uneven filling, which gathers the room in few bins."""
    return len(bins), -sum((sum(lengths[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(lengths: list[int], one: Bins, other: Bins, capacity: int, dice: random.Random) -> Bins:
    """Whole well-filled bins of ``one`` go into ``other``; its bins that hold the same pieces are undone."""
    full = [b for b in one if sum(lengths[i] for i in b) >= WELL_FILLED * capacity] or [max(one, key=lambda b: sum(lengths[i] for i in b))]
    chosen = dice.sample(full, max(1, len(full) // 2))
    held = {i for b in chosen for i in b}
    child, displaced = [list(b) for b in chosen], []
    for b in other:
        if held.isdisjoint(b) and sum(lengths[i] for i in b) >= POORLY_FILLED * capacity:
            child.append(list(b))
        else:
            displaced.extend(i for i in b if i not in held)
    best_fit(lengths, displaced, child, capacity)
    return child


def evolve(lengths: list[int], seeds: list[Bins], seed: int, capacity: int, generations: int = GENERATIONS) -> Bins:
    """The best packing found from the seeds, a best-fit one and two shaken ones."""
    if not lengths:
        return []
    dice, least = random.Random(seed), -(-sum(lengths) // capacity)
    first: Bins = []
    best_fit(lengths, list(range(len(lengths))), first, capacity)
    population = [first, *seeds]
    best = min(population, key=lambda b: fitness(lengths, b, capacity))
    if len(best) == least:
        return best
    for _ in range(2):
        shaken: Bins = []
        half = [i for i in range(len(lengths)) if dice.random() < 0.5]
        best_fit(lengths, half, shaken, capacity)
        best_fit(lengths, sorted(set(range(len(lengths))) - set(half)), shaken, capacity)
        population.append(shaken)
    for _ in range(generations):
        population.sort(key=lambda b: fitness(lengths, b, capacity))
        if len(population[0]) == least:
            break
        one, other = dice.sample(population, 2)
        population = [*population[:4], crossover(lengths, one, other, capacity, dice)]
    return min(population, key=lambda b: fitness(lengths, b, capacity))


def _numbers(bins: Bins, size: int) -> list[int]:
    where = [0] * size
    for n, b in enumerate(bins):
        for i in b:
            where[i] = n
    return where


def _bins(where: list[int]) -> Bins:
    bins: dict[int, list[int]] = {}
    for i, n in enumerate(where):
        bins.setdefault(int(n), []).append(i)
    return list(bins.values())


def _island(capacity: int, number: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for shard, island, lengths, elites in zip(batch["shard"], batch["island"], batch["lengths"], batch["elites"]):
                lengths = [int(x) for x in lengths]
                bins = evolve(lengths, [_bins(e) for e in elites], hash((int(shard), int(island), number)), capacity)
                rows.append((shard, island, len(bins), _numbers(bins, len(lengths))))
            yield pd.DataFrame(rows, columns=["shard", "island", "n_bins", "bins"])
    return run


def _packed_once(pieces: DataFrame, capacity: int, shard: int) -> DataFrame:
    """``pieces`` (row and columns of a piece) with ``bin`` (shard, number)."""
    shards = max(1, -(-pieces.count() // shard))
    item = F.struct((-F.col("length")).alias("longest"), "row", *COLUMNS)
    dealt = written(pieces.groupBy(F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard")).agg(
        F.sort_array(F.collect_list(item)).alias("items")))
    base = dealt.select("shard", F.transform("items", lambda x: x["length"]).alias("lengths"))
    islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island")
    none = F.array().cast("array<array<int>>").alias("elites")
    kind = "shard long, island int, n_bins int, bins array<int>"
    elites = written(base.select("shard", islands, "lengths", none).repartition("shard", "island")
                     .mapInPandas(_island(capacity, 0), kind))
    for number in range(1, ROUNDS):
        # an island goes on from its own elite and that of the island before it
        moved = elites.select("shard", F.explode(F.array("island", (F.col("island") + 1) % ISLANDS)).alias("island"), "bins")
        arrived = moved.groupBy("shard", "island").agg(F.sort_array(F.collect_list("bins")).alias("elites"))
        elites = written(base.join(arrived, "shard").select("shard", "island", "lengths", "elites")
                         .mapInPandas(_island(capacity, number), kind))
    best = elites.groupBy("shard").agg(F.min(F.struct("n_bins", "island", "bins")).alias("best"))
    packed = dealt.join(best, "shard").select("shard", F.explode(F.arrays_zip(
        F.col("items").alias("item"), F.col("best.bins").alias("number"))).alias("x"))
    return packed.select("x.item.*", F.struct("shard", F.col("x.number").alias("number")).alias("bin")).drop("longest")


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """The pieces with sequence_id and offset."""
    rows = written(pieces.withColumn("row", F.monotonically_increasing_id()))
    first = written(_packed_once(rows, capacity, shard))
    fill = first.groupBy("bin").agg(F.sum("length").alias("fill"))
    poor = fill.filter(F.col("fill") < POORLY_FILLED * capacity).select("bin")
    again = _packed_once(first.join(poor, "bin", "left_semi").drop("bin"), capacity, shard)
    settled = first.join(poor, "bin", "left_anti").select(*again.columns)
    both = settled.withColumn("level", F.lit(0)).unionAll(again.withColumn("level", F.lit(1)))
    # shard numbers stay below 2^38, bins of a shard below 2^24
    number = F.shiftleft(F.col("bin.shard"), 25) + F.shiftleft(F.col("level").cast("long"), 24) + F.col("bin.number")
    upto = F.sum("length").over(Window.partitionBy("sequence_id").orderBy("row").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    return both.withColumn("sequence_id", number).select(*COLUMNS, "sequence_id", (upto - F.col("length")).alias("offset"))


def pack_documents(docs: DataFrame, file: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(token_pieces(docs, file, capacity), capacity)
