"""Phrase collocations against counting every phrase, at low thresholds and on odd rows."""

from __future__ import annotations

import random
import re
import string
from collections import Counter, defaultdict

import pytest
from test_llm import DOCS, _clashing, _odd_rows, _rows

from fleetfeatures.llm import phrases

_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def _counts(rows, longest):
    f, n = defaultdict(Counter), Counter()
    for row in rows:
        lang = row[2] if row[2] is not None else "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (row[1] or "").translate(_LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    return f, n


def _want(rows, longest, least, best):
    f, n = _counts(rows, longest)
    out = []
    for lang, counts in f.items():
        found = []
        candidates = {g: c for g, c in counts.items() if len(g) > 1 and c >= least}
        inside = defaultdict(int)
        for g, c in candidates.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    inside[g[i:i + k]] = max(inside[g[i:i + k]], c)
        for g, a in candidates.items():
            if 100 * inside[g] >= 100 * a:
                continue
            score, _, left, right = min((1000 * a * n[lang] // (counts[g[:j]] * counts[g[j:]]), j, counts[g[:j]], counts[g[j:]]) for j in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), left, right))
        for rank, (score, a, g, left, right) in enumerate(sorted(found)[:best], 1):
            out.append((lang, rank, g.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def _speech(seed: int, n: int) -> list[tuple]:
    """Rows of few words with blanks, tabs, ends of pieces, capitals, and a passage that many share."""
    dice = random.Random(seed)
    words = "a the of cat dog É ñ sat mat on-the x1 |".split()
    passage = "The long shared passage of words, that comes again and again: to the end of it"
    rows = []
    for i in range(n):
        text = "".join(dice.choice(words).upper() if dice.random() < 0.1 else dice.choice(words) + dice.choice([" ", " ", " ", "  ", "\t", " \t ", ". ", ",", "\n", "\x0b"])
                       for _ in range(dice.randint(0, 60)))
        rows.append((i, text + passage if i % 3 == 0 else text, dice.choice(["en", "fr", None, "und"]), "s", 1))
    return rows


@pytest.mark.parametrize("longest, least, best, bits", [(5, 3, 10_000, 20), (5, 20, 7, 4), (3, 2, 10_000, 16), (2, 5, 50, 16)])
def test_phrases_equal_counting(spark, monkeypatch, longest, least, best, bits):
    monkeypatch.setattr(phrases, "HELD", 500)
    rows = _speech(longest, 120) + _odd_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = sorted(map(tuple, phrases.collocations(docs, longest=longest, least=least, best=best, log_bits=bits).collect()))
    assert got == _want(rows, longest, least, best)


def test_scores_beyond_64_bits(spark):
    rows = [("en", "a b", 4 * 10 ** 14)]
    counted = spark.createDataFrame([(x, 1, "b", n) for x, _, n in rows], "lang string, k int, gram string, n long")
    counted = counted.unionAll(spark.createDataFrame([("en", 2, "a b", 4 * 10 ** 14)], "lang string, k int, gram string, n long"))
    tables = phrases.levels(counted, 2)
    assert {(r.gram, r.n) for t in tables for r in t.collect()} == {("a b", 4 * 10 ** 14), ("a", 4 * 10 ** 14), ("b", 10 ** 14 * 4)}
    assert 1000 * (4 * 10 ** 14) ** 2 > 2 ** 64
    exact = spark.createDataFrame([(4 * 10 ** 14, 9 * 10 ** 14 + 1, 5 * 10 ** 14 + 7, 6 * 10 ** 14 + 11)], "a long, n long, l long, r long")
    assert exact.selectExpr(phrases.EXACT).first()[0] == 1000 * 4 * 10 ** 14 * (9 * 10 ** 14 + 1) // ((5 * 10 ** 14 + 7) * (6 * 10 ** 14 + 11))


def test_no_rows_and_further_columns(spark):
    empty = spark.createDataFrame([], DOCS)
    assert phrases.collocations(empty).count() == 0
    docs = spark.createDataFrame(_odd_rows(), DOCS)
    assert _rows(phrases.collocations(_clashing(docs), least=2)) == _rows(phrases.collocations(docs, least=2))
    nulls = spark.createDataFrame([(None, None, None, None, None)] * 3, DOCS)
    assert phrases.collocations(nulls, least=1).count() == 0
