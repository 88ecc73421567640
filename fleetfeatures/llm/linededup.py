"""Operator 10, line dedup: equal lines and lines a few edits apart, with column expressions only.

A line with a word stays where it occurs first (by doc_id, null last, then row and line number); later occurrences go.
A first occurrence goes too if a line that occurs earlier is at most ``edits`` insertions, deletions or replacements away from
it and both have at least ``LEAST`` characters.

Lines t edits apart are found by a segment-partition join. A line has t + 1 segments; one of them occurs unchanged in the
other line, near its own place, so a line probes the index of segments for lines of its own length and of up to t characters
less. A probe's places follow from the edits that can lie before and after the segment. What is left and right of a shared
segment stays open, and index entries and probes that share a segment are split again in it, until few characters are open:
a group then holds lines that are equal elsewhere, whatever number of lines shares a first segment. Beyond one edit a pair has
several common segments, so only groups of more than ``TOGETHER`` are split again there. Sizes of groups are counted before
anything is joined, and no group's pairs are formed before that. Open parts are verified by the banded ``levenshtein`` function.

Defined cases: null and empty texts have no lines; lines without a word stay and are not counted; equal rows are
occurrences of their own, the later one loses its lines; extra columns stay, also under names used here; very long lines are
split more often.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetfeatures.llm.common import discard, numbered, without_blanks, written

EDITS = 1
LEAST = 20
TOGETHER = 16
#: Blocks of 32,768 bits, a bit a document, that are broadcast at most (32 MB).
MARKS = 8192
#: Stands in open parts where a segment was; lines do not hold it.
CUT = "\n"


def _entries(edits: int, index: bool, shorter: int) -> list[tuple[bool, int, int, int]]:
    """How a text is split that is indexed, or else that is to match texts ``shorter`` characters shorter:
    (is an index entry, shorter, segment, how far the segment is moved). An index entry is a probe for its own length too."""
    moves = [(i, m) for i in range(edits + 1)
             for m in range(max(-i, shorter - edits + i), min(i, shorter + edits - i) + 1)]
    if not index:
        return [(False, shorter, i, m) for i, m in moves]
    return [(True, 0, i, 0) for i in range(edits + 1)] + [(False, 0, i, m) for i, m in moves if m]


def _first_entries(edits: int) -> list[tuple[bool, int, int, int]]:
    return _entries(edits, True, 0) + [e for d in range(1, edits + 1) for e in _entries(edits, False, d)]


def _part(text: Column, key: Column, edits: int, entry: tuple[bool, int, int, int]) -> Column:
    """One segment of an open part: (key of the segment that must be equal, what stays open); null where it does not fit."""
    _, shorter, i, move = entry
    base = F.length(text) - shorter
    first = F.floor(base * i / (edits + 1)).cast("int")
    size = F.floor(base * (i + 1) / (edits + 1)).cast("int") - first
    start = first + move
    left, right = F.substring(text, F.lit(1), start), F.substring(text, start + size + 1, F.length(text))
    rest = right if i == 0 else left if i == edits else F.concat(left, F.lit(CUT), right)
    found = F.struct(F.xxhash64(key, F.lit(i), base, F.substring(text, start + 1, size)).alias("key"), rest.alias("open"))
    return F.when((base > 0) & (start >= 0) & (start + size <= F.length(text)), found)


def _near(one: Column, other: Column, edits: int) -> Column:
    """Whether open parts are at most ``edits`` apart, each piece between cuts by itself."""
    near = F.levenshtein(one, other, edits) >= 0
    if edits == 1:  # a segment is at an end then, nothing is cut
        return near

    def apart(a: Column, b: Column) -> Column:
        steps = F.levenshtein(a, b, edits)
        return F.when(steps < 0, edits + 1).otherwise(steps)

    pieces = F.zip_with(F.split(one, CUT), F.split(other, CUT), apart)
    return near & (F.aggregate(pieces, F.lit(0), lambda n, x: n + x) <= edits)


def _lines(rows: DataFrame) -> DataFrame:
    """row, doc_id, j and line of every line of ``rows`` (row, doc) that has a word."""
    lines = rows.select("row", F.col("doc.doc_id").alias("doc_id"), F.posexplode(F.split("doc.text", "\n")).alias("j", "line"))
    return lines.filter(F.length(without_blanks(F.col("line"))) > 0)


def first_lines(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """One row per distinct line: its identity, where it occurs first, characters, keys of its segments (index, then probes)."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row"), F.col("j"))
    long = F.length("line") >= LEAST
    keys = [F.when(long, _part(F.col("line"), F.lit(0), edits, e)["key"]) for e in _first_entries(edits)]
    lines = _lines(docs).select(
        F.xxhash64("line").alias("h"), F.xxhash64(F.lit(7), "line").alias("g"), place.alias("place"),
        F.length("line").cast("long").alias("chars"), *[k.alias(f"k{i}") for i, k in enumerate(keys)])
    firsts = lines.groupBy("h", "g").agg(F.min("place").alias("place"), F.first("chars").alias("chars"),
                                         *[F.first(f"k{i}").alias(f"k{i}") for i in range(len(keys))])
    return written(firsts)


def _meeting(rows: DataFrame, edits: int) -> DataFrame:
    """Rows whose key holds an index entry and something else, with ``few``: the group can be compared as it is."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("n"), F.max("index").alias("any_index")).filter("n > 1 AND any_index")
    few = (F.col("n") <= TOGETHER) if edits > 1 else F.lit(False)
    return rows.drop("few").join(sizes.select("key", few.alias("few")), "key")


def _named(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The documents whose ``row`` occurs in ``wanted``, found by a bit a document, so that other texts are not shuffled. Where the
    bits would be too many to broadcast, all documents: the join that follows decides."""
    block, at = F.bitmap_bucket_number("row"), F.bitmap_bit_position("row")
    marks = written(wanted.groupBy(block.alias("block")).agg(F.bitmap_construct_agg(at).alias("bits")))
    if marks.limit(MARKS + 1).count() > MARKS:
        return docs
    byte = F.conv(F.hex(F.substring("bits", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    held = docs.join(F.broadcast(marks), block == F.col("block"))
    return held.filter(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1).select(*docs.columns)


def near_lines(docs: DataFrame, firsts: DataFrame, edits: int = EDITS) -> DataFrame:
    """(row, j, chars) of first occurrences that are at most ``edits`` edits away from an earlier line."""
    entries = _first_entries(edits)
    kinds = F.explode(F.array(*[F.struct(F.col(f"k{i}").alias("key"), F.lit(i).alias("kind"), F.lit(e[0]).alias("index"))
                                for i, e in enumerate(entries)])).alias("s")
    index = firsts.filter(F.col("k0").isNotNull()).select("place", kinds).filter(F.col("s.key").isNotNull()).select(
        "s.key", "s.kind", "s.index", F.col("place.row").alias("row"), F.col("place.j").alias("j"))
    wanted = written(_meeting(index, edits).groupBy("row").agg(F.collect_list(F.struct("j", "kind", "few")).alias("lines")))
    texts = _named(docs, wanted).select("row", F.split("doc.text", "\n").alias("text")).join(wanted, "row")
    found = texts.select("row", "text", F.explode("lines").alias("x")).select(
        "row", "x.j", "x.kind", "x.few", F.get("text", F.col("x.j")).alias("line"))
    # a second, independent hash of the matched segment from here on
    seed = F.lit(11).cast("long")
    part = F.coalesce(*[F.when(F.col("kind") == i, _part(F.col("line"), seed, edits, e)) for i, e in enumerate(entries)])
    rows = found.select("row", "j", "few", F.get(F.array(*[F.lit(e[0]) for e in entries]), F.col("kind")).alias("index"),
                        F.get(F.array(*[F.lit(e[1]) for e in entries]), F.col("kind")).alias("shorter"), part.alias("s"))
    rows = written(rows.select("s.key", "row", "j", "index", "shorter", "few", "s.open"))
    discard(wanted)
    again = [(e, role) for role in [(True, 0), *[(False, d) for d in range(edits + 1)]] for e in _entries(edits, *role)]
    done, rounds = None, [rows]
    while True:
        settled = F.col("few") | (F.length("open") - F.col("shorter") <= 2 * edits)
        ready = rows.filter(settled)
        done = ready if done is None else done.unionAll(ready)
        split = rows.filter(~settled).select("row", "j", F.explode(F.array(*[
            F.when((F.col("index") == role[0]) & (F.col("shorter") == role[1]), F.struct(
                F.lit(e[0]).alias("index"), F.lit(e[1]).alias("shorter"), _part(F.col("open"), F.col("key"), edits, e).alias("s")))
            for e, role in again])).alias("x")).filter(F.col("x.s").isNotNull())
        split = split.select("x.s.key", "row", "j", "x.index", "x.shorter", "x.s.open")
        rows = written(_meeting(split, edits).select("key", "row", "j", "index", "shorter", "few", "open"))
        rounds.append(rows)
        if rows.isEmpty():
            break
    other = done.select("key", F.col("row").alias("o_row"), F.col("j").alias("o_j"), F.col("open").alias("o_open"))
    pairs = _meeting(done, edits).filter("index").join(other, "key").filter(
        ((F.col("row") != F.col("o_row")) | (F.col("j") != F.col("o_j"))) & _near(F.col("open"), F.col("o_open"), edits))
    one = pairs.select("row", "j", "o_row", "o_j").distinct()
    places = firsts.select("place", "chars", F.col("place.row").alias("row"), F.col("place.j").alias("j"))
    mine = one.join(places, ["row", "j"]).withColumnsRenamed({"place": "a", "chars": "a_chars"})
    theirs = places.select(F.col("row").alias("o_row"), F.col("j").alias("o_j"), F.col("place").alias("b"), F.col("chars").alias("b_chars"))
    both = mine.join(theirs, ["o_row", "o_j"])
    later = F.when(F.col("a") > F.col("b"), F.struct(F.col("a").alias("p"), F.col("a_chars").alias("chars"))).otherwise(
        F.struct(F.col("b").alias("p"), F.col("b_chars").alias("chars")))
    near = written(both.select(later.alias("x")).select("x.p.row", "x.p.j", "x.chars").distinct())
    discard(*rounds)
    return near


def line_report(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """One row per document: lines with a word, those removed as repeated and as near, characters left in such lines."""
    docs = numbered(docs.select(F.struct("doc_id", "text").alias("doc")))
    firsts = first_lines(docs, edits)
    near = near_lines(docs, firsts, edits)
    kept = firsts.select(F.col("place.row").alias("row"), "chars").groupBy("row").agg(
        F.count("*").alias("n_first"), F.sum("chars").alias("first_chars"))
    gone = near.groupBy("row").agg(F.count("*").alias("n_near"), F.sum("chars").alias("near_chars"))
    lines = F.filter(F.split("doc.text", "\n"), lambda s: F.length(without_blanks(s)) > 0)
    rows = docs.select("row", F.col("doc.doc_id").alias("doc_id"), F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n"))
    rows = rows.withColumn("n", F.greatest("n", F.lit(0).cast("long")))  # size of null is -1 in some settings
    joined = rows.join(kept, "row", "left").join(gone, "row", "left").na.fill(0, ["n_first", "first_chars", "n_near", "near_chars"])
    return joined.select("doc_id", F.col("n").alias("n_lines"), (F.col("n") - F.col("n_first")).alias("n_repeated"),
                         "n_near", (F.col("first_chars") - F.col("near_chars")).alias("n_chars_left"))


def dedup_lines(docs: DataFrame, text: str = "text", n_chars: str = "n_chars", edits: int = EDITS) -> DataFrame:
    """The documents without the removed lines; columns as they came."""
    columns, docs = docs.columns, numbered(docs.select(F.struct("*").alias("doc")))
    firsts = first_lines(docs, edits)
    near = near_lines(docs, firsts, edits).select("row", "j")
    kept = firsts.select(F.col("place.row").alias("row"), F.col("place.j").alias("j")).join(near, ["row", "j"], "left_anti")
    stay = kept.groupBy("row").agg(F.collect_list("j").alias("stay"))
    rows = docs.join(stay, "row", "left").select("doc", F.split(f"doc.{text}", "\n").alias("lines"), F.coalesce("stay", F.array().cast("array<int>")).alias("stay"))
    blank = F.filter(F.transform("lines", lambda s, i: F.when(F.length(without_blanks(s)) == 0, i)), lambda i: i.isNotNull())
    rows = rows.select("doc", "lines", F.sort_array(F.concat("stay", blank)).alias("keep"))
    clean = F.array_join(F.transform("keep", lambda j: F.get("lines", j)), "\n").alias("clean")
    fixed = {text: F.col("clean"), n_chars: F.length("clean").cast("long")}
    return rows.select("doc", clean).select(*[(fixed[c] if c in fixed else F.col("doc")[c]).alias(c) for c in columns])


#: Steps of check SQL from a table ``d`` (r, doc_id, text; r numbers the rows) to ``stays`` (r, j, l: lines that stay).
SQL_LINES = rf"""
ln AS (SELECT r, doc_id, l, j FROM (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS l,
         generate_subscripts(string_split(text, chr(10)), 1) AS j FROM d WHERE text IS NOT NULL)),
lw AS (SELECT * FROM ln WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
lo AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS LAST, r, j) AS p FROM lw),
fl AS (SELECT l, min(p) AS p, length(l) AS n FROM lo GROUP BY l),
big AS (SELECT * FROM fl WHERE n >= {LEAST}),
seg AS (SELECT l, p, m, m // 2 AS h, n > m AS probe FROM (SELECT l, p, n, n AS m FROM big UNION ALL SELECT l, p, n, n - 1 FROM big)),
halves AS (SELECT l, p, m, probe, 0 AS side, left(l, h) AS s FROM seg UNION ALL SELECT l, p, m, probe, 1, right(l, m - h) FROM seg),
close AS (SELECT DISTINCT greatest(a.p, b.p) AS p FROM halves a JOIN halves b ON a.m = b.m AND a.side = b.side AND a.s = b.s
          WHERE NOT a.probe AND a.p <> b.p AND levenshtein(a.l, b.l) <= {EDITS}),
stays AS (SELECT r, j, l FROM lo WHERE p IN (SELECT p FROM fl) AND p NOT IN (SELECT p FROM close))"""

SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents), {SQL_LINES},
firsts AS (SELECT r, count(*) AS n_first FROM lo WHERE p IN (SELECT p FROM fl) GROUP BY r),
kept AS (SELECT r, count(*) AS n_kept, sum(length(l)) AS chars FROM stays GROUP BY r),
total AS (SELECT r, count(*) AS n_lines FROM lw GROUP BY r)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, (coalesce(n_lines, 0) - coalesce(n_first, 0))::BIGINT AS n_repeated,
       (coalesce(n_first, 0) - coalesce(n_kept, 0))::BIGINT AS n_near, coalesce(chars, 0)::BIGINT AS n_chars_left
FROM d LEFT JOIN total USING (r) LEFT JOIN firsts USING (r) LEFT JOIN kept USING (r)"""
