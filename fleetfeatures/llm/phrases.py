"""Operator 12, phrase collocations: a weighted de Bruijn graph of word sequences, shorter counts from its flow.

The graph's edges are the longest phrases (five words) with their counts; an edge leads from its first four words to its
last four. Only edges and the ends of word sequences are counted from the texts, together in one shuffle. Every shorter
count follows from the flow: a phrase of k words is followed by a word, or ends its sequence, so its count is the sum of
the counts of the (k+1)-word phrases that begin with it plus the number of sequences that end with it. Level by level, a
node takes up what flows out of it, what flows into it and what ends in it.

Unary paths are compacted on the way: where all of a node's flow comes in by one edge, or goes out by one, the node only
repeats a longer phrase with the same count, and is merged into it. What is left are the phrases that no longer phrase
explains; a longer phrase's count is never larger, so one word more on either side is all that needs to be looked at.

Before the graph is built, sequences are cut where two neighbouring words cannot belong to a frequent phrase, as a graph
of rare edges would be many times the corpus. Pairs (and words) are counted by 64-bit hashes, and those that reach the least
count go into a bit field of fixed size (``hashfilter``). A phrase is never more frequent than its pairs, and hashes or
bits that coincide only keep more; so counts of frequent phrases stay exact. A word that is cut off on both sides still
counts as a sequence of one word, if it is frequent.

Score of a cut into a first part (count l) and a rest (count r) of a phrase with count a, among n words of the language:
floor(1000 a n / (l r)), in whole numbers of 38 digits; the lowest-scoring cut counts.

Defined cases: a null text is empty, a null lang is ``und``; A-Z are lower-cased and nothing else; a language without
frequent phrases gives no rows, and so does an empty table; texts of any length are cut into sequences in blocks of fixed
size; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetfeatures.llm.common import ship, written
from fleetfeatures.llm.hashfilter import LOG_BITS, among, bit_field
from fleetfeatures.llm.hashing import U, mix, powers

LONGEST = 5
LEAST = 100
BEST = 2000
#: Bytes of text that are cut into words at once (a longer text alone).
AT_ONCE = 1 << 20
#: Keys, and distinct sequences, that a task holds before it hands them on.
HELD = 1 << 21
HELD_SEQUENCES = 1 << 18
EXACT = "CAST(1000 * a AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0)) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"

_WORD, _BLANK, _END = 0, 1, 2
_KIND = np.full(256, _WORD, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _END
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_LOWER[0x09] = 0x20
_STEP = U(0x9E3779B97F4A7C15)


class Words:
    """The words of some texts: where they are, which follow each other in a piece, and their hashes per language."""

    def __init__(self, texts: list[bytes], salts: np.ndarray) -> None:
        raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        kind, data = _KIND[raw], _LOWER[raw]
        word = kind == _WORD
        before = np.concatenate(([False], word[:-1]))
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(~word & before)  # the last byte of all is an end of a piece
        self.text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), self.starts, side="right")
        piece = np.cumsum(kind == _END)[self.starts]
        self.follows = piece[1:] == piece[:-1]  # word i + 1 follows word i
        # one blank is left before each word, so that neighbours stand as in a phrase
        keep = word.copy()
        blank = self.starts[1:][self.follows] - 1
        keep[blank] = True
        at = np.cumsum(keep) - keep
        self.clean, self.first, self.last = data[keep].tobytes(), at[self.starts], at[self.ends - 1] + 1
        self.hashes = self._hashes(data, word, salts) if len(self.starts) else np.zeros(0, U)
        self.pairs = mix(self.hashes[:-1] * _STEP + self.hashes[1:])[self.follows] if len(self.starts) else np.zeros(0, U)

    def _hashes(self, data: np.ndarray, word: np.ndarray, salts: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(word)
        lengths = self.ends - self.starts
        place = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        values = (data[at].astype(U) + U(1)) * powers(int(lengths.max()))[place]
        sums = np.add.reduceat(values, np.cumsum(lengths) - lengths)
        return mix(mix(sums + lengths.astype(U)) ^ salts[self.text])


def _salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _read(batch: pa.RecordBatch) -> Iterator[tuple[list[str], Words]]:
    """The words of a batch, about a megabyte of text at a time, with the language of each text."""
    texts, column = batch.column("text").cast(pa.binary()), batch.column("lang")
    upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + AT_ONCE, side="right")))
        langs = column.slice(start, end - start).to_pylist()
        yield langs, Words(texts.slice(start, end - start).to_pylist(), np.array([_salt(x) for x in langs], U))
        start = end


def _frequent_hashes(docs: DataFrame, least: int) -> DataFrame:
    """(lang, null, number of words) per language, and (null, hash, count) of words and pairs that reach ``least``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        total: Counter[str] = Counter()

        def handed_on() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_pydict({"lang": pa.nulls(len(keys), pa.string()), "hash": pa.array(keys.view(np.int64)), "n": pa.array(counts)})

        for batch in batches:
            for langs, words in _read(batch):
                for i, n in enumerate(np.bincount(words.text, minlength=len(langs)).tolist()):
                    total[langs[i]] += n
                held += [words.hashes, words.pairs]
                if sum(map(len, held)) >= HELD:
                    yield handed_on()
        if held:
            yield handed_on()
        yield pa.RecordBatch.from_pydict({"lang": pa.array(list(total), pa.string()), "hash": pa.nulls(len(total), pa.int64()),
                                          "n": pa.array(list(total.values()), pa.int64())})

    counted = docs.mapInArrow(count, "lang string, hash long, n long").groupBy("lang", "hash").agg(F.sum("n").alias("n"))
    return written(counted.filter((F.col("n") >= least) | F.col("hash").isNull()))


def _sequences(docs: DataFrame, field, log_bits: int) -> DataFrame:
    """(lang, words, n): the sequences that pairs in the field leave.

    Sequences of one or two words are frequent words and pairs: equal ones of a task are counted together. Longer ones are
    mostly different from each other, so holding them would only take memory: they are counted together for one block of
    text and handed on.
    """
    def rows(found: dict[str, Counter[bytes]]) -> Iterator[pa.RecordBatch]:
        for lang, counts in found.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(counts), pa.string()), "words": pa.array(list(counts), pa.binary()).cast(pa.string()),
                                              "n": pa.array(list(counts.values()), pa.int64())})
        found.clear()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short: dict[str, Counter[bytes]] = {}
        long: dict[str, Counter[bytes]] = {}
        for batch in batches:
            for langs, words in _read(batch):
                if not len(words.starts):
                    continue
                linked = np.zeros(len(words.starts) - 1, bool)
                linked[words.follows] = among(field.value, words.pairs, log_bits)
                first = np.flatnonzero(np.concatenate(([True], ~linked)))
                last = np.flatnonzero(np.concatenate((~linked, [True])))
                size = last - first + 1
                frequent = (size > 1) | among(field.value, words.hashes[first], log_bits)
                for some, wanted in ((short, frequent & (size < 3)), (long, size > 2)):
                    begin, end = first[wanted], last[wanted]
                    clean = words.clean
                    found = [clean[a:b] for a, b in zip(words.first[begin].tolist(), words.last[end].tolist())]
                    bounds = np.searchsorted(words.text[begin], np.arange(len(langs) + 1)).tolist()
                    for i, lang in enumerate(langs):
                        if bounds[i] < bounds[i + 1]:
                            some.setdefault(lang, Counter()).update(found[bounds[i]:bounds[i + 1]])
                yield from rows(long)
                if sum(map(len, short.values())) >= HELD_SEQUENCES:
                    yield from rows(short)
        yield from rows(short)

    return docs.mapInArrow(cut, "lang string, words string, n long")


def graph(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, log_bits: int = LOG_BITS) -> tuple[DataFrame, DataFrame]:
    """Words per language (lang, n), and the counted rows of the graph (lang, k, gram, n): edges have ``longest`` words, fewer
    words are the ends of sequences."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    frequent = _frequent_hashes(texts, least)
    field = spark.sparkContext.broadcast(bit_field(frequent.filter(F.col("hash").isNotNull()), "hash", log_bits))
    word = F.split("words", " ")
    size = F.size("word")

    def part(start, length):
        return F.struct(length.alias("k"), F.concat_ws(" ", F.slice("word", start, length)).alias("gram"))

    edges = F.when(size >= longest, F.transform(F.sequence(F.lit(1), size - (longest - 1)), lambda i: part(i, F.lit(longest)))).otherwise(F.array())
    ends = F.transform(F.sequence(F.lit(1), F.least(F.lit(longest - 1), size)), lambda k: part(size - k + 1, k))
    rows = _sequences(texts, field, log_bits).select("lang", "n", word.alias("word")).select("lang", "n", F.explode(F.concat(edges, ends)).alias("part"))
    counted = rows.groupBy("lang", F.col("part.k").alias("k"), F.col("part.gram").alias("gram")).agg(F.sum("n").alias("n"))
    return frequent.filter(F.col("hash").isNull()).select("lang", "n"), written(counted)


def levels(counted: DataFrame, longest: int = LONGEST) -> list[DataFrame]:
    """Tables (lang, k, gram, n, merged) from the longest phrases to single words; ``merged`` says that a phrase of one word
    more has the same count."""
    out = [counted.filter(F.col("k") == longest).withColumn("merged", F.lit(False))]
    for k in range(longest - 1, 0, -1):
        longer = out[-1]
        flows = [longer.select("lang", F.substring_index("gram", " ", k).alias("gram"), F.col("n").alias("onward"), F.col("n").alias("edge")),
                 longer.select("lang", F.substring_index("gram", " ", -k).alias("gram"), F.lit(0).cast("long").alias("onward"), F.col("n").alias("edge")),
                 counted.filter(F.col("k") == k).select("lang", "gram", F.col("n").alias("onward"), F.lit(0).cast("long").alias("edge"))]
        nodes = flows[0].unionAll(flows[1]).unionAll(flows[2]).groupBy("lang", "gram").agg(F.sum("onward").alias("n"), F.max("edge").alias("edge"))
        out.append(written(nodes.select("lang", F.lit(k).alias("k"), "gram", "n", (F.col("edge") == F.col("n")).alias("merged"))))
    return out


def collocations(docs: DataFrame, *, longest: int = LONGEST, least: int = LEAST, best: int = BEST, log_bits: int = LOG_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: per language the ``best`` first phrases."""
    totals, counted = graph(docs, longest, least, log_bits)
    tables = [t.filter(F.col("n") >= least) for t in levels(counted, longest)]
    counts = tables[1]
    for t in tables[2:]:
        counts = counts.unionAll(t)
    counts = written(counts.select("lang", "gram", "n"))
    phrases = tables[0]
    for t in tables[1:-1]:
        phrases = phrases.unionAll(t)
    phrases = phrases.filter(~F.col("merged")).select("lang", "k", F.col("gram").alias("phrase"), F.col("n").alias("a"))
    cuts = phrases.withColumn("before", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    cuts = cuts.withColumns({"head": F.expr("substring_index(phrase, ' ', before)"), "rest": F.expr("substring_index(phrase, ' ', before - k)")})
    one = counts.select("lang", F.col("gram").alias("head"), F.col("n").alias("l"))
    other = counts.select("lang", F.col("gram").alias("rest"), F.col("n").alias("r"))
    scored = cuts.join(one, ["lang", "head"]).join(other, ["lang", "rest"]).join(totals, "lang")
    lowest = scored.withColumn("score", F.expr(EXACT)).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "before", "a", "l", "r", "n")).alias("cut")).select("lang", "phrase", "cut.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = lowest.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


SQL = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS gram
      FROM w, (SELECT unnest(range(1, {LONGEST + 1})) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, gram, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, gram, string_split(gram, ' ') AS w, f AS a FROM f WHERE k >= 2 AND f >= {LEAST}),
inside AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS gram, max(a) AS longer
           FROM c, (SELECT unnest(range(2, {LONGEST})) AS m), (SELECT unnest(range(1, {LONGEST})) AS i) WHERE m < k AND i + m - 1 <= k GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN inside USING (lang, gram) WHERE longer IS NULL OR 100 * longer < 100 * a),
cut AS (SELECT kept.lang, kept.gram AS phrase, j, a, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM kept JOIN (SELECT unnest(range(1, {LONGEST})) AS j) ON j < k JOIN n ON n.lang = kept.lang
        JOIN f x ON x.lang = kept.lang AND x.gram = array_to_string(w[1:j], ' ')
        JOIN f y ON y.lang = kept.lang AND y.gram = array_to_string(w[j + 1:], ' ')),
low AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS place FROM cut),
o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM low WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= {BEST}"""
