"""Exact duplicates against brute force: hot groups, colliding fingerprints, texts of many chunks, odd rows."""

from __future__ import annotations

import hashlib
import random
import string
from collections import defaultdict

import numpy as np
import pytest
from test_llm import DOCS, _clashing, _odd_rows, _prose, _rows

from fleetfeatures.llm import exactdedup
from fleetfeatures.llm.hashfilter import among, bit_field

_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def _want(rows) -> list[tuple]:
    groups = defaultdict(list)
    for row in rows:
        groups[(row[1] or "").translate(_LOWER)].append(row[0])
    out = []
    for text, ids in groups.items():
        top = max((i for i in ids if i is not None), default=None)
        sha, left = hashlib.sha256(text.encode()).hexdigest(), 1
        for i in ids:
            out.append((i, top, len(ids), i == top and left == 1, sha))
            left -= i == top
    return sorted(out, key=repr)


def _got(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=repr)


def _copies() -> list[tuple]:
    """A third of the rows are one text; pairs that differ in the last byte, in case, in a letter outside A-Z; long texts."""
    long = _prose(900, 3000)
    rows = [(i, "the Same text", "en", "s", 1) for i in range(60)] + [(1000 + i, _prose(i % 40, 5), "en", "s", 1) for i in range(80)]
    rows += [(2000, long, "en", "s", 1), (2001, long.upper(), "en", "s", 1), (2002, long[:-1] + "!", "en", "s", 1), (2003, long + "x", "en", "s", 1)]
    rows += [(2004, "É", "fr", "s", 1), (2005, "é", "fr", "s", 1), (2006, "AZ[@", "en", "s", 1), (2007, "az[@", "en", "s", 1), (2008, "az{`", "en", "s", 1)]
    return rows + _odd_rows()


@pytest.mark.parametrize("settings", [
    {}, {"chunk": 64, "spread_rows": 7}, {"primes": (13, 7), "chunk": 50, "spread_rows": 3}, {"primes": (2, 3)}], ids=str)
def test_groups_of_equal_texts(spark, settings):
    rows = _copies()
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    assert _got(exactdedup.duplicate_report(docs, **settings)) == _want(rows)


def test_fingerprints_compose():
    data = np.frombuffer(_prose(3, 400).encode(), np.uint8)
    whole, parts = exactdedup.Hasher(exactdedup.PRIMES, 1 << 16), exactdedup.Hasher(exactdedup.PRIMES, 100)
    for cut in (0, 1, 99, 100):
        sums = [0, 0]
        for start in ([0] if cut else []) + list(range(cut, len(data), 100)):
            piece = data[start:cut] if start < cut else data[start:start + 100]
            sums = [s + h for s, h in zip(sums, parts.shifted(piece, len(data) - start - len(piece)))]
        assert [s % p for s, p in zip(sums, exactdedup.PRIMES)] == whole.of(data)
    assert all(0 < p < 1 << 29 for p in exactdedup.PRIMES)


def test_rows_that_stay_keep_their_columns(spark):
    rows = _copies()
    docs = _clashing(spark.createDataFrame(rows, DOCS))
    kept = exactdedup.keep_one(docs, chunk=64)
    assert kept.columns == docs.columns
    want = sorted((t[0] for t in _want(rows) if t[3]), key=repr)
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == want
    assert _rows(exactdedup.duplicate_report(docs)) == _rows(exactdedup.duplicate_report(spark.createDataFrame(rows, DOCS)))


def test_no_rows_and_null_columns(spark):
    assert exactdedup.duplicate_report(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(None, None), (None, ""), (None, "x"), (None, "X")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = exactdedup.duplicate_report(docs).collect()
    assert [r.keep_id for r in got] == [None] * 4 and [r.group_size for r in got] == [2] * 4 and sum(r.kept for r in got) == 2


def test_bit_field_holds_what_was_put_in(spark):
    dice = random.Random(5)
    hashes = [dice.randrange(-2 ** 63, 2 ** 63) for _ in range(3000)] + [0, -1, 1, 2 ** 63 - 1, -2 ** 63]
    field = bit_field(spark.createDataFrame([(h,) for h in hashes], "h long"), "h", 20)
    assert among(field, np.array(hashes, np.int64), 20).all()
    others = np.array([dice.randrange(-2 ** 63, 2 ** 63) for _ in range(4000)], np.int64)
    assert among(field, others, 20).mean() < 0.02
