"""Operator 13, exact duplicates: polynomial fingerprints that compose, then chunkwise comparison.

A text's bytes x0 .. xn-1 have the fingerprint sum(xi * B^(n-1-i)) modulo a prime, for two primes. Fingerprints compose:
that of two pieces after each other is that of the first, shifted by B^(length of the second), plus that of the second. A
text of more than one chunk is cut into chunks, which are hashed wherever they land and put together by a sum of shifted
hashes; so a huge text is hashed in parallel, and partial sums are combined before they are shuffled.

Texts of equal length and fingerprint are compared chunk by chunk with one representative of their group, the row that
would stay. The copies of the representative grow with the group, each for at most ``SPREAD`` rows, so that a group of a
third of all rows is compared in many tasks. What differs from its representative (two texts with one fingerprint) is
grouped anew, until nothing differs: the result is exact, whatever the primes are.

Texts are read twice: once for the fingerprints; once to fetch the texts of groups, where a bit field of fixed size
(``hashfilter``) leaves most other texts out before the join on fingerprints decides.

Defined cases: A-Z are lower-cased and nothing else; a null text is empty; of equal texts the row with the largest doc_id
stays, a null doc_id is the least; of rows with equal doc_id and text one stays; an empty table gives no rows; further
columns are ignored by the report and kept by ``keep_one``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetfeatures.llm.common import numbered, ship, written
from fleetfeatures.llm.hashfilter import among, bit_field

#: Bytes of a chunk: what is hashed and compared at once.
CHUNK = 1 << 16
#: Rows that meet one copy of a representative.
SPREAD = 4096
KEY = ["n_bytes", "fingerprint"]


def primes_below(limit: int, count: int) -> tuple[int, ...]:
    """The largest primes below a limit."""
    found: list[int] = []
    n = limit - 1
    while len(found) < count:
        if all(n % d for d in range(2, int(n ** 0.5) + 1)):
            found.append(n)
        n -= 1
    return tuple(found)


#: Below 2^29, so that sums over a chunk stay exact in doubles (2^8 * 2^29 * 2^16 = 2^53).
PRIMES = primes_below(1 << 29, 2)
_BASE = 0x2545F491


def _powers(primes: tuple[int, ...], chunk: int) -> np.ndarray:
    """Row i holds B^(chunk-1-i) modulo each prime."""
    table = np.ones((chunk, len(primes)))
    for column, p in enumerate(primes):
        value = 1
        for i in range(chunk - 1, -1, -1):
            table[i, column] = value
            value = value * (_BASE % p) % p
    return table


class Hasher:
    """Fingerprints of chunks of up to ``chunk`` bytes."""

    def __init__(self, primes: tuple[int, ...], chunk: int) -> None:
        self.primes, self.chunk, self.powers = primes, chunk, _powers(primes, chunk)

    def of(self, data: np.ndarray) -> list[int]:
        if not len(data):
            return [0] * len(self.primes)
        sums = data.astype(np.float64) @ self.powers[self.chunk - len(data):]
        return [int(s) % p for s, p in zip(sums, self.primes)]

    def shifted(self, data: np.ndarray, after: int) -> list[int]:
        """What a chunk with ``after`` bytes behind it adds to the fingerprint of its text."""
        return [h * pow(_BASE % p, after, p) % p for h, p in zip(self.of(data), self.primes)]


_HASHERS: dict[tuple, Hasher] = {}


def hasher(primes: tuple[int, ...], chunk: int) -> Hasher:
    """One table of powers per worker process and setting."""
    if (primes, chunk) not in _HASHERS:
        _HASHERS[primes, chunk] = Hasher(primes, chunk)
    return _HASHERS[primes, chunk]


def joined(hashes: list[int]) -> int:
    return (hashes[0] << 29) | hashes[1]


#: Fingerprints have 58 bits; moved up, their leading bits choose the bit of the field.
_UP = 6


def lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts after each other with A-Z in lower case, and the bounds of each text."""
    texts = column.cast(pa.large_binary())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0]:bounds[-1]]
    return data | (((data - np.uint8(65)) < 26).astype(np.uint8) << 5), bounds - bounds[0]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def _short_keys(short: DataFrame, primes: tuple[int, ...], chunk: int, field=None) -> DataFrame:
    """doc_id, n_bytes, fingerprint, sha of every row; with a bit field also the text, of the rows whose bit is set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = hasher(primes, chunk)
        bits = field.value if field else None
        for batch in batches:
            data, bounds = lowered(batch.column("text"))
            edges = bounds.tolist()
            keys = np.array([joined(own.of(data[a:b])) for a, b in zip(edges, edges[1:])], np.int64)
            sizes = np.diff(bounds)
            rows = np.arange(len(keys)) if bits is None else np.flatnonzero(among(bits, keys << _UP))
            body = memoryview(data)
            columns = {"doc_id": batch.column("doc_id").take(pa.array(rows)), "n_bytes": pa.array(sizes[rows]), "fingerprint": pa.array(keys[rows]),
                       "sha": pa.array([hashlib.sha256(body[edges[i]:edges[i + 1]]).digest() for i in rows.tolist()], pa.binary())}
            if bits is not None:
                columns["data"] = pa.array([bytes(body[edges[i]:edges[i + 1]]) for i in rows.tolist()], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    schema = T.StructType([short.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("fingerprint", T.LongType()),
                           T.StructField("sha", T.BinaryType()), *([T.StructField("data", T.BinaryType())] if field else [])])
    return short.mapInArrow(run, schema)


def _chunks(long: DataFrame, chunk: int) -> DataFrame:
    """The chunks of long texts, written once: row, doc_id, n_bytes, part, after (bytes behind it), data; the last chunk has the sha."""
    kind = long.schema["doc_id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data, _ = lowered(batch.column("text").slice(i, 1))
                digest, doc_id, row = hashlib.sha256(), batch.column("doc_id").slice(i, 1), batch.column("row").slice(i, 1)
                for start in range(0, len(data), chunk):
                    piece = data[start:start + chunk].tobytes()
                    digest.update(piece)
                    after = len(data) - start - len(piece)
                    yield pa.RecordBatch.from_pydict({
                        "row": row, "doc_id": doc_id, "n_bytes": pa.array([len(data)]), "part": pa.array([start // chunk]),
                        "after": pa.array([after]), "data": pa.array([piece]), "sha": pa.array([None if after else digest.digest()], pa.binary())})

    schema = T.StructType([T.StructField("row", T.LongType()), kind, *[T.StructField(n, T.LongType()) for n in ("n_bytes", "part", "after")],
                           T.StructField("data", T.BinaryType()), T.StructField("sha", T.BinaryType())])
    return written(long.withColumn("row", F.monotonically_increasing_id()).mapInArrow(cut, schema))


def _long_keys(chunks: DataFrame, primes: tuple[int, ...], chunk: int) -> DataFrame:
    """row, doc_id, n_bytes, fingerprint, sha of the long texts: chunks are dealt out, hashed, shifted and summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = hasher(primes, chunk)
        for batch in batches:
            sums = [own.shifted(np.frombuffer(d.as_buffer(), np.uint8), a) for d, a in zip(batch.column("data"), batch.column("after").to_pylist())]
            yield pa.RecordBatch.from_pydict({"row": batch.column("row"), "h0": pa.array([s[0] for s in sums], pa.int64()),
                                              "h1": pa.array([s[1] for s in sums], pa.int64())})

    dealt = chunks.select("row", "part", "after", "data").repartition("row", "part")
    sums = dealt.mapInArrow(run, "row long, h0 long, h1 long").groupBy("row").agg(*[
        (F.sum(h) % p).alias(h) for h, p in zip(("h0", "h1"), primes)])
    heads = chunks.filter("after = 0").select("row", "doc_id", "n_bytes", "sha")
    return written(heads.join(sums, "row").select("row", "doc_id", "n_bytes", F.shiftleft("h0", 29).bitwiseOR(F.col("h1")).alias("fingerprint"), "sha"))


def _unequal(members: DataFrame, heads: DataFrame, spread_rows: int) -> DataFrame:
    """Rows of ``members`` (row, key, part, data) whose text is not that of their group's representative.

    Each side is shuffled once; a chunk meets one chunk, so nothing of a group is held together.
    """
    groups = heads.select(*KEY, "keep_row", F.ceil(F.col("group_size") / spread_rows).cast("long").alias("salts"))
    slim = members.join(groups, KEY)
    one = slim.filter("row <> keep_row").withColumn("salt", F.pmod(F.xxhash64("row"), F.col("salts")))
    other = slim.filter("row = keep_row").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    other = other.select(*KEY, "part", "salt", F.col("data").alias("kept_data"))
    return written(one.join(other, [*KEY, "part", "salt"]).filter("data <> kept_data").select("row", *KEY).distinct())


def classes(docs: DataFrame, *, primes: tuple[int, ...] = PRIMES, chunk: int = CHUNK, spread_rows: int = SPREAD) -> DataFrame:
    """doc_id, keep_id, group_size, kept and sha (bytes) of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    texts = _texts(docs)
    short, long = texts.filter(F.octet_length("text") <= chunk), texts.filter(F.octet_length("text") > chunk)
    chunks = _chunks(long, chunk)
    long_keys = _long_keys(chunks, primes, chunk)
    keys = _short_keys(short, primes, chunk).unionByName(long_keys.drop("row"))
    groups = written(keys.groupBy(*KEY).agg(F.count("*").alias("n"), F.max("doc_id").alias("doc_id"), F.min("sha").alias("sha")))
    several = groups.filter("n > 1").select(*KEY)
    field = spark.sparkContext.broadcast(bit_field(several.select(F.shiftleft("fingerprint", _UP).alias("hash")), "hash"))
    found = _short_keys(short, primes, chunk, field).join(several, KEY).withColumn("part", F.lit(0).cast("long"))
    found = found.withColumn("row", 2 * F.monotonically_increasing_id())
    of_long = chunks.select("row", "part", "data").join(long_keys.join(several, KEY), "row").withColumn("row", 2 * F.col("row") + 1)
    members = written(found.unionByName(of_long))

    rest = members.filter("part = 0").select("row", "doc_id", *KEY, "sha")
    results = [groups.filter("n = 1").select("doc_id", F.col("doc_id").alias("keep_id"), F.col("n").alias("group_size"), F.lit(True).alias("kept"), "sha")]
    while True:
        top = F.max(F.struct("doc_id", (-F.col("row")).alias("minus")))
        heads = written(rest.groupBy(*KEY).agg(F.count("*").alias("group_size"), top.alias("top")).select(
            *KEY, "group_size", F.col("top.doc_id").alias("keep_id"), (-F.col("top.minus")).alias("keep_row")))
        other = _unequal(members, heads, spread_rows)
        some = other.limit(1).count() > 0
        if some:
            less = other.groupBy(*KEY).agg(F.count("*").alias("less"))
            heads = written(heads.join(less, KEY, "left").withColumn("group_size", F.col("group_size") - F.coalesce("less", F.lit(0))).drop("less"))
            equal, rest = rest.join(other.select("row"), "row", "left_anti"), written(rest.join(other.select("row"), "row", "left_semi"))
            members = written(members.join(other.select("row"), "row", "left_semi"))
        else:
            equal = rest
        results.append(equal.join(heads, KEY).select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "sha"))
        if not some:
            break
    out = results[0]
    for result in results[1:]:
        out = out.unionAll(result)
    return out


def duplicate_report(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per document."""
    return classes(docs, **settings).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    stored = numbered(docs.select(F.struct(*docs.columns).alias("whole"), F.col("doc_id"), F.col("text")))
    named = stored.select(F.struct("doc_id", (-F.col("row")).alias("minus")).alias("doc_id"), "text")
    kept = classes(named, **settings).filter("kept").select((-F.col("doc_id.minus")).alias("row"))
    return stored.join(kept, "row", "left_semi").select("whole.*")


SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256 FROM d"""
