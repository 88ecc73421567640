"""Operator 5, long repeats: a logarithmic family of indexes of sampled suffixes.

Every string of ``LENGTH`` bytes holds ``WIDTH`` shorter strings of ``ANCHOR``
bytes; the one of least hash, the leftmost of equals, is its anchor. Equal long
strings have equal anchors at equal offsets, so an index of anchored suffixes
alone finds all repeats; about one suffix in 75 is one.

A batch of documents gets an index: its anchored suffixes, sorted by the hash of
their anchor, which stands in for a suffix array (suffixes are not ordered by
their bytes). It is joined on that hash with the levels there are; levels of equal size are merged before the next batch
comes, so a suffix is rewritten a logarithmic number of times.

Suffixes that begin alike are then settled byte by byte. An anchor's context is
all that its long strings can cover. Equal contexts settle each other by one
hash. Contexts that differ are compared inside their group: each offset's long
string is hashed, and equal ones repeat. Groups of many contexts are not brought
together: their strings are counted by hash over all tasks, after a filter on
the bytes that a run of offsets has in common.

Defined cases: null and empty texts have no bytes; texts shorter than ``LENGTH``
lose nothing; copies lose all; matches never cross texts; repeated rows are
copies of each other; very long texts are cut into overlapping pieces for
hashing, with the same result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetfeatures.llm.common import discard, numbered, remove, shared_path, ship, shuffles_removed, written
from fleetfeatures.llm.hashing import U, groups, inverse_powers, mix, powers

LENGTH = 200
ANCHOR = 50
WIDTH = LENGTH - ANCHOR + 1
#: Bytes of a piece: bounds a task's memory on very long texts.
PIECE = 1 << 20
BATCHES = 4
#: Contexts of one anchor that are compared in one place; beyond, they are counted over all tasks.
TOGETHER = 32
RUN = 38
SUFFIX = "key long, ctx long, row long, place long"


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which any substring's hash follows (last axis)."""
    sums = np.zeros((*data.shape[:-1], data.shape[-1] + 1), U)
    np.cumsum((data.astype(U) + U(1)) * powers(data.shape[-1]), axis=-1, out=sums[..., 1:])
    return sums


def anchors(pieces: list[tuple[bytes, int, int]]) -> tuple[np.ndarray, ...]:
    """Of pieces (bytes, first and end of the anchors that are theirs): piece number, anchor place, least and largest
    offset of its long strings, hash of the anchor, hash of the context."""
    sizes = np.array([len(t) for t, _, _ in pieces])
    base = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(t for t, _, _ in pieces), np.uint8)
    count = len(data) - LENGTH + 1
    if count <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    sums, back = prefix_sums(data), inverse_powers(len(data) + 1)
    short = mix((sums[ANCHOR:] - sums[:-ANCHOR]) * back[:len(sums) - ANCHOR])
    rank = (short & U(0xFFFFFFFF00000000)) | np.arange(len(short)).astype(U)
    blocks = np.full(-(-len(rank) // WIDTH) * WIDTH, U(2 ** 64 - 1))
    blocks[:len(rank)] = rank
    blocks = blocks.reshape(-1, WIDTH)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:count], ahead[WIDTH - 1:WIDTH - 1 + count])
    at = (least & U(0xFFFFFFFF)).astype(np.int64)
    starts = np.maximum(0, sizes - LENGTH + 1)
    owner = np.repeat(np.arange(len(pieces)), starts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts) + base[owner]
    if not len(place):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    anchor = at[place]
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(place)])) - 1
    anchor, owner, low, high = anchor[first], owner[first], place[first], place[last]
    inside = anchor - base[owner]
    mine = (inside >= np.array([a for _, a, _ in pieces])[owner]) & (inside < np.array([b for _, _, b in pieces])[owner])
    anchor, owner, low, high, inside = anchor[mine], owner[mine], low[mine], high[mine], inside[mine]
    left, right = np.minimum(WIDTH - 1, inside), np.minimum(LENGTH, sizes[owner] - inside)
    context = (sums[anchor + right] - sums[anchor - left]) * back[anchor - left]
    context = mix(context ^ mix((left * 512 + right).astype(U)))
    return owner, inside, anchor - high, anchor - low, short[anchor].view(np.int64), context.view(np.int64)


def cut(texts: list[bytes]) -> Iterator[tuple[int, int, bytes, int, int]]:
    """Text number, place of the piece, piece, first and end of its own anchors; overlaps hold what those need."""
    for i, t in enumerate(texts):
        for start in range(0, max(1, len(t) - 2 * LENGTH), PIECE):
            first = WIDTH - 1 if start else 0
            last = start + PIECE >= len(t) - 2 * LENGTH
            piece = t[start:] if last else t[start:start + PIECE + 2 * LENGTH]
            yield i, start, piece, first, len(piece) if last else PIECE + WIDTH - 1


def _place(p: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return (p << 16) | (low << 8) | high


def suffixes(bodies: DataFrame) -> DataFrame:
    """The anchored suffixes of all texts."""
    ship(bodies.sparkSession)

    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, texts = batch["row"].to_numpy(), batch["body"].tolist()
            pieces = [x for x in cut(texts) if len(x[2]) >= LENGTH]
            for a, b in groups([x[2] for x in pieces]):
                part = pieces[a:b]
                owner, p, low, high, key, context = anchors([(t, first, end) for _, _, t, first, end in part])
                if len(owner):
                    text, start = np.array([x[0] for x in part])[owner], np.array([x[1] for x in part])[owner]
                    yield pd.DataFrame({"key": key, "ctx": context, "row": rows[text], "place": _place(p + start, low, high)})

    return bodies.select("row", "body").mapInPandas(sample, SUFFIX)


class SuffixLevels:
    """Sorted arrays of suffixes in a shared folder; sizes are powers of two of a batch."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.levels: list[tuple[int, str]] = []

    def _write(self, rows: DataFrame) -> str:
        path = shared_path(self.spark)
        with shuffles_removed(self.spark):
            rows.repartition("key").sortWithinPartitions("key").write.parquet(path)
        return path

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(SUFFIX).parquet(path)

    def merge(self) -> None:
        """Merge equal sizes, the smallest first."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, one), (_, other) = self.levels.pop(), self.levels.pop()
            self.levels.append((2 * size, self._write(self._read(one).unionAll(self._read(other)))))
            remove(self.spark, one)
            remove(self.spark, other)

    def append(self, batch: DataFrame) -> DataFrame:
        """Add a batch; returns the keys that occur twice in it, or in it and in a level."""
        self.merge()
        path = self._write(batch)
        counts = self._read(path).groupBy("key").agg(F.count("*").alias("n"))
        for _, level in self.levels:
            counts = counts.unionAll(self._read(level).groupBy("key").agg(F.lit(1).cast("long").alias("n")).join(
                self._read(path).select("key"), "key", "left_semi"))
        self.levels.append((1, path))
        return counts.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")

    def rows(self) -> DataFrame:
        first, *others = [self._read(path) for _, path in self.levels]
        for level in others:
            first = first.unionAll(level)
        return first

    def drop(self) -> None:
        for _, path in self.levels:
            remove(self.spark, path)
        self.levels = []


def repeated_suffixes(bodies: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The suffixes whose key another suffix has too, of any batch."""
    index = SuffixLevels(bodies.sparkSession)
    found = [written(index.append(suffixes(bodies.filter(F.pmod(F.xxhash64("row"), F.lit(batches)) == k)))) for k in range(batches)]
    # written first: a join on what was summed by the same key could not be split where a key is common
    keys = written(reduce(DataFrame.unionAll, found).distinct())
    discard(*found)
    rows = written(index.rows().join(keys, "key"))
    index.drop()
    discard(keys)
    return rows


def settle(keys: np.ndarray, place: np.ndarray, single: np.ndarray, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For contexts: row number and offset of each long string that also occurs in another context of its key."""
    number, offset, gram = long_strings(place, bodies)
    code = np.unique(keys, return_inverse=True)[1][number]
    order = np.lexsort((gram, offset, code))
    same = (code[order][1:] == code[order][:-1]) & (offset[order][1:] == offset[order][:-1]) & (gram[order][1:] == gram[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    chosen = order[twice & single[number[order]]]
    return number[chosen], offset[chosen]


def _sums(place: np.ndarray, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of contexts, aligned so that the anchor is at the same column; columns without bytes count as none."""
    grid = np.zeros((len(bodies), WIDTH - 1 + LENGTH), np.uint8)
    left = np.minimum(WIDTH - 1, place >> 16)
    for i, (body, skip) in enumerate(zip(bodies, (WIDTH - 1 - left).tolist())):
        grid[i, skip:skip + len(body)] = np.frombuffer(body, np.uint8)
    return prefix_sums(grid), left


def long_strings(place: np.ndarray, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context number, offset and hash of every long string whose anchor is that of the context."""
    sums, _ = _sums(place, bodies)
    offsets = np.arange(WIDTH)
    valid = (offsets >= ((place >> 8) & 255)[:, None]) & (offsets <= (place & 255)[:, None])
    start = WIDTH - 1 - offsets
    gram = mix((sums[:, start + LENGTH] - sums[:, start]) * inverse_powers(WIDTH)[start])
    number, offset = np.nonzero(valid)
    return number, offset, gram[number, offset].view(np.int64)


def common_parts(place: np.ndarray, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context number, number of a run of offsets, and hash of the bytes that all long strings of the run hold."""
    sums, _ = _sums(place, bodies)
    runs = np.arange(-(-WIDTH // RUN))
    first, last = runs * RUN, np.minimum(WIDTH, (runs + 1) * RUN) - 1
    start, end = WIDTH - 1 - first, WIDTH - 1 - last + LENGTH
    part = mix((sums[:, end] - sums[:, start]) * inverse_powers(WIDTH)[start])
    number, run = np.nonzero((first <= (place & 255)[:, None]) & (last >= ((place >> 8) & 255)[:, None]))
    return number, run, part[number, run].view(np.int64)


CONTEXT = "key long, row long, place long, single boolean, body binary"
FOUND = "row long, first long, last long"


def contexts(bodies: DataFrame, wanted: DataFrame) -> DataFrame:
    """The contexts' bytes for ``wanted`` (key, row, place, single)."""
    def slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, body, items in zip(batch["row"], batch["body"], batch["items"]):
                out = []
                for x in items:
                    p = x["place"] >> 16
                    out.append((x["key"], row, x["place"], x["single"], body[max(0, p - WIDTH + 1):p + LENGTH]))
                yield pd.DataFrame(out, columns=["key", "row", "place", "single", "body"])

    items = wanted.groupBy("row").agg(F.collect_list(F.struct("key", "place", "single")).alias("items"))
    return bodies.select("row", "body").join(items, "row").mapInPandas(slices, CONTEXT)


def _runs(row: np.ndarray, place: np.ndarray, offset: np.ndarray) -> pd.DataFrame:
    """Places of long strings, consecutive ones of a row as one run."""
    start = (place >> 16) - offset
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    new = np.concatenate(([True], (row[1:] != row[:-1]) | (start[1:] > start[:-1] + 1))) if len(row) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(row)])) - 1 if len(row) else first
    return pd.DataFrame({"row": row[first], "first": start[first], "last": start[last]})


def settle_together(found: DataFrame) -> DataFrame:
    """Runs of repeated long strings, for contexts whose key has few: each key's stand side by side."""
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            kept = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            if len(kept) > 2000:
                whole = kept["key"] != kept["key"].iloc[-1]
                yield _settled(kept[whole])
                kept = kept[~whole]
        if kept is not None and len(kept):
            yield _settled(kept)

    return found.repartition("key").sortWithinPartitions("key").mapInPandas(compare, FOUND)


def _settled(part: pd.DataFrame) -> pd.DataFrame:
    if not len(part):
        return pd.DataFrame({"row": [], "first": [], "last": []}, dtype="int64")
    place = part["place"].to_numpy()
    number, offset = settle(part["key"].to_numpy(), place, part["single"].to_numpy(bool), part["body"].tolist())
    return _runs(part["row"].to_numpy()[number], place[number], offset)


def settle_apart(found: DataFrame) -> DataFrame:
    """The same for keys with many contexts: strings are counted by hash, where the bytes around them repeat."""
    def strings(whole: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for a in range(0, len(batch), 1000):
                    part = batch.iloc[a:a + 1000]
                    place, bodies = part["place"].to_numpy(), part["body"].tolist()
                    if whole:
                        number, offset, gram = long_strings(place, bodies)
                        keep = part["runs"].to_numpy()[number] >> (offset // RUN) & 1 == 1
                        number, offset, gram = number[keep], offset[keep], gram[keep]
                    else:
                        number, offset, gram = common_parts(place, bodies)
                    yield pd.DataFrame({"key": part["key"].to_numpy()[number], "row": part["row"].to_numpy()[number],
                                        "place": place[number], "single": part["single"].to_numpy()[number],
                                        "at": offset.astype("int32"), "gram": gram})
        return run

    kind = "key long, row long, place long, single boolean, at int, gram long"
    by = ["key", "at", "gram"]

    def repeated(rows: DataFrame) -> DataFrame:
        counts = rows.groupBy(*by).agg(F.count("*").alias("n"), F.max("single").alias("any_single")).filter("n > 1 AND any_single")
        return rows.join(counts.select(*by), by, "left_semi")

    parts = written(found.mapInPandas(strings(False), kind))
    runs = written(repeated(parts).groupBy("row", "place").agg(F.sum(F.expr("shiftleft(1, at)")).cast("int").alias("runs")))
    discard(parts)
    grams = written(found.join(runs, ["row", "place"]).mapInPandas(strings(True), kind))
    discard(runs)
    start = F.shiftright("place", 16) - F.col("at")
    settled = written(repeated(grams).filter("single").select("row", start.alias("first"), start.alias("last")))
    discard(grams)
    return settled


def repeated_runs(bodies: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(row, first, last): runs of places of ``bodies`` (row, body) where a long string starts that also starts elsewhere.

    Scratch tables go as soon as what reads them is written, so that a text is on disk once besides one shuffle of it.
    """
    rows = repeated_suffixes(bodies, batches)
    alike = rows.groupBy("key", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("row", "place")).alias("one"))
    alike = written(alike.select("key", "ctx", "n", "one.row", "one.place"))
    copies = rows.join(alike.filter("n > 1").select("key", "ctx"), ["key", "ctx"], "left_semi")
    high, low = F.col("place").bitwiseAND(255), F.shiftright("place", 8).bitwiseAND(255)
    p = F.shiftright("place", 16)
    settled = written(copies.select("row", (p - high).alias("first"), (p - low).alias("last")))
    many = alike.groupBy("key").agg(F.count("*").alias("m"), F.min("n").alias("least")).filter("m > 1 AND least = 1")
    unlike = alike.join(many, "key").select("key", "row", "place", (F.col("n") == 1).alias("single"), "m")
    wanted = written(unlike.select("key", "row", "place", "single", "m"))
    discard(rows, alike)
    near = written(settle_together(contexts(bodies, wanted.filter(F.col("m") <= TOGETHER))))
    wide = written(contexts(bodies, wanted.filter(F.col("m") > TOGETHER)))
    discard(wanted)
    apart = settle_apart(wide)
    discard(wide)
    return settled.unionAll(near).unionAll(apart)


REPORT = "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def without_repeats(body: bytes, runs) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed and their maximal runs."""
    left, at, removed, spans = [], 0, 0, 0
    for first, last in sorted((int(r["first"]), int(r["last"])) for r in runs):
        end = last + LENGTH
        if end <= at and spans:
            continue
        if first > at or not spans:
            left.append(body[at:first])
            spans += 1
            at = first
        removed += end - at
        at = end
    left.append(body[at:])
    return b"".join(left), removed, spans


def repeat_report(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """One row per document: bytes, bytes removed, runs removed, digest of what is left."""
    bodies = numbered(docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body")))
    runs = repeated_runs(bodies, batches).groupBy("row").agg(F.collect_list(F.struct("first", "last")).alias("runs"))

    def report(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, body, found in zip(batch["doc_id"], batch["body"], batch["runs"]):
                kept, removed, spans = without_repeats(body, [] if found is None else found)
                out.append((doc_id, len(body), removed, spans, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in REPORT.split(", ")])

    rows = bodies.join(runs, "row", "left").select(F.col("doc_id").cast("string").alias("doc_id"), "body", "runs")
    return rows.mapInPandas(report, REPORT).withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
