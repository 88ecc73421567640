"""Operator 4, quality rules: line-first cleaning, with column expressions only.

Each line of a text is held against punctuation, navigation and boilerplate
rules; failing lines are removed; a document that loses too large a share of
its text is rejected, as is one that fails the base measures of the whole text.

Defined cases: a null or empty text has no words and fails the base; a line
without a word is neither judged nor removed; equal documents get equal
verdicts; extra columns pass through ``clean_documents`` untouched, also when
they bear names used here (the row travels in a struct).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetfeatures.llm.common import count_of, without_blanks, words_of

SYMBOLS = "#*$%&|<>"
MOST_LOST = 0.3
_PLACE_BITS = 27
_PLACES = (1 << _PLACE_BITS) - 1
_SEPARATORS = "|»›·"
_NAVIGATION = (r"(?i)^\W*(home|menu|next|previous|log ?in|sign (in|up)|search|subscribe|share|contact us|read more"
               r"|click here|skip to content|back to top)\W*$")
_BOILERPLATE = (r"(?i)all rights reserved|licen[sc]ed under|privacy policy|terms of (use|service)|javascript"
                r"|lorem ipsum|accept (all )?cookies|copyright (\(c\)|©)")
_MARKS = ".,;:!?…"


def bad_line(line: Column) -> Column:
    """Whether a line fails a rule.

    Punctuation: more than a tenth of its characters are symbols; three or more exclamation marks that are over a
    tenth of its characters; ten or more words without any sentence mark. Navigation: three or more separators, at
    least one for every four words; or nothing but a menu word. Boilerplate: up to 25 words with a stock phrase.
    """
    chars = F.length(without_blanks(line))
    blanks = F.length(line) - chars  # words are one more at most
    shouts, separators = count_of(line, "!"), count_of(line, _SEPARATORS)
    return ((count_of(line, SYMBOLS) * 10 > chars)
            | ((shouts >= 3) & (shouts * 10 > chars))
            | ((blanks >= 9) & (count_of(line, _MARKS) == 0))
            | ((separators >= 3) & (separators * 4 > blanks))
            | ((blanks <= 24) & (line.rlike(_BOILERPLATE) | line.rlike(_NAVIGATION))))


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """The frame's row as struct ``row``, its measures, ``base_failed``, ``kept`` and ``clean`` (the text without failing lines).

    Words in repeated 3-word windows: windows are ordered by hash with their place in the low bits (one sort of
    numbers per text); windows with an equal neighbour are candidates, which are then compared as words.
    """
    whole = F.coalesce(F.col(f"row.{text}"), F.lit(""))
    rows = df.select(F.struct("*").alias("row")).select("row", whole.alias("body"), words_of(whole).alias("words"))
    rows = rows.select("row", "body", "words", F.sort_array(F.transform(
        "words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))
        .bitwiseAND(F.lit(~_PLACES)).bitwiseOR(i.cast("long")))).alias("keys"))

    def like(k: Column, i: Column) -> Column:
        return F.coalesce(k.bitwiseXOR(F.get("keys", i)).bitwiseAND(F.lit(~_PLACES)) == 0, F.lit(False))

    def window(p: Column) -> Column:
        return F.struct(F.concat_ws(" ", F.get("words", p), F.get("words", p + 1), F.get("words", p + 2)).alias("g"),
                        p.alias("p"))

    twice = F.filter("keys", lambda k, i: like(k, i + 1) | like(k, i - 1))
    places = F.transform(twice, lambda k: k.bitwiseAND(F.lit(_PLACES)).cast("int"))
    places = F.filter(places, lambda p: p + 2 < F.size("words"))
    rows = rows.select("row", "body", "words", F.sort_array(F.transform(places, window)).alias("found"))

    def same(x: Column, i: Column) -> Column:
        return F.coalesce(x["g"] == F.get("found", i)["g"], F.lit(False))

    starts = F.sort_array(F.transform(F.filter("found", lambda x, i: same(x, i + 1) | same(x, i - 1)), lambda x: x["p"]))
    rows = rows.select("row", "body", F.size("words").cast("long").alias("n_words"), starts.alias("starts"),
                       F.filter(F.split("body", "\n"), lambda s: F.length(without_blanks(s)) > 0).alias("lines"))
    gap = F.transform("starts", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("starts", i + 1) - p, F.lit(3))).cast("long"))
    rows = rows.select(
        "row", "body", "n_words", "lines",
        F.length(without_blanks(F.col("body"))).cast("long").alias("word_chars"),
        count_of(F.col("body"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(gap, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed).withColumn(
        "good", F.when(~F.col("base_failed"), F.filter(F.split("body", "\n"), lambda s: ~bad_line(s) | (F.length(without_blanks(s)) == 0))))
    clean = F.array_join("good", "\n")
    left = F.length(without_blanks(clean))
    kept = ~F.col("base_failed") & F.coalesce(
        (F.col("word_chars") - left) * 10 <= F.col("word_chars") * int(MOST_LOST * 10), F.lit(False))
    return rows.select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       kept.alias("kept"), clean.alias("clean"), F.monotonically_increasing_id().alias("place"))


def quality_report(df: DataFrame) -> DataFrame:
    """One row per document: its measures and verdict."""
    return measured(df).select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                               "base_failed", "kept")


def clean_documents(df: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents that pass, without their failing lines; columns as they came."""
    # the place keeps the filter above the projections, whose columns would else be computed anew for each element
    good = measured(df, text).filter("kept AND place >= 0")
    fixed = {text: F.col("clean"), n_chars: F.length("clean").cast("long")}
    return good.select(*[(fixed[c] if c in fixed else F.col("row")[c]).alias(c) for c in df.columns])


_NONBLANK = r"regexp_matches(l, '[^\x20\x09-\x0D]')"


def _sql_count(x: str, characters: str) -> str:
    return f"(length({x}) - length(translate({x}, '{characters}', '')))"


_SQL_CHARS = r"length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g'))"
SQL_BAD_LINE = (
    f"({_sql_count('l', SYMBOLS)} * 10 > {_SQL_CHARS} "
    f"OR ({_sql_count('l', '!')} >= 3 AND {_sql_count('l', '!')} * 10 > {_SQL_CHARS}) "
    f"OR (length(l) - {_SQL_CHARS} >= 9 AND {_sql_count('l', _MARKS)} = 0) "
    f"OR ({_sql_count('l', _SEPARATORS)} >= 3 AND {_sql_count('l', _SEPARATORS)} * 4 > length(l) - {_SQL_CHARS}) "
    f"OR (length(l) - {_SQL_CHARS} <= 24 AND (regexp_matches(l, '{_BOILERPLATE}') OR regexp_matches(l, '{_NAVIGATION}'))))")

#: Steps of check SQL from a table ``d`` (r: number of the row, text) to ``measures`` (r, the measures, verdict, clean).
SQL_MEASURES = rf"""
w AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
      FROM (SELECT r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM d)),
g AS (SELECT r, i, [word, lead(word) OVER o, lead(word, 2) OVER o] AS tri, lead(word, 2) OVER o AS last
      FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, tri) AS n FROM g WHERE last IS NOT NULL) WHERE n > 1),
rep AS (SELECT r, count(*) AS n_repeat_words FROM (
          SELECT DISTINCT r, i + k AS i FROM twice, (SELECT unnest([0, 1, 2]) AS k)) GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS l,
                 generate_subscripts(string_split(text, chr(10)), 1) AS j FROM d WHERE text IS NOT NULL),
judged AS (SELECT r, l, j, {_NONBLANK} AS has_word, {SQL_BAD_LINE} AS bad, {_SQL_CHARS} AS chars FROM lines),
perdoc AS (SELECT r, count(*) FILTER (has_word) - count(DISTINCT l) FILTER (has_word) AS n_dup_lines,
                  coalesce(sum(chars) FILTER (has_word AND bad), 0) AS lost,
                  coalesce(string_agg(l, chr(10) ORDER BY j) FILTER (NOT (has_word AND bad)), '') AS clean FROM judged GROUP BY r),
base AS (SELECT d.r, (SELECT count(*) FROM w WHERE w.r = d.r) AS n_words,
                coalesce(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')), 0) AS word_chars,
                coalesce({_sql_count('text', SYMBOLS)}, 0) AS n_symbols,
                coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
                coalesce(lost, 0) AS lost, clean
         FROM d LEFT JOIN perdoc USING (r) LEFT JOIN rep USING (r)),
measures AS (SELECT *, NOT base_failed AND lost * 10 <= word_chars * {int(MOST_LOST * 10)} AS kept
             FROM (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base))"""

SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents), {SQL_MEASURES}
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, kept
FROM d JOIN measures USING (r)"""
