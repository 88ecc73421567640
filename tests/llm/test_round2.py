"""What the second round of advice asked for, each with a case that the code before it got wrong."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from test_llm import DOCS, _edits, _odd_rows, _prose

from fleetfeatures.llm import linededup, minhash, mixing, suffix, tokencounts
from fleetfeatures.llm.common import shared_path

ROW_OPERATORS = [suffix.repeat_report, minhash.class_report, minhash.keep_one, linededup.line_report, linededup.dedup_lines]


@pytest.mark.parametrize("operator", ROW_OPERATORS, ids=lambda f: f.__name__)
def test_rows_keep_their_numbers_when_files_are_cut_anew(spark, monkeypatch, tmp_path, operator):
    """Each pass packs the files into tasks another way, as happens when executors come or go."""
    texts = [r[1] for r in _odd_rows()] + [_prose(500 + i % 30, 60) for i in range(60)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    want = Counter(map(tuple, operator(spark.createDataFrame(rows, DOCS)).collect()))
    spark.createDataFrame(rows, DOCS).repartition(6).write.parquet(str(tmp_path / "docs"))
    passes = [0]

    def cut_anew(write):
        def run(*args):
            passes[0] += 1
            spark.conf.set("spark.sql.files.minPartitionNum", "1" if passes[0] % 2 else "64")
            spark.conf.set("spark.sql.files.openCostInBytes", "1g" if passes[0] % 2 else "1")
            return write(*args)
        return run

    import fleetfeatures.llm.common as common
    for module in (common, linededup, minhash, suffix):
        monkeypatch.setattr(module, "written", cut_anew(module.written))
    try:
        got = Counter(map(tuple, operator(spark.read.parquet(str(tmp_path / "docs"))).collect()))
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert passes[0] > 2 and got == want


def test_rows_of_the_mix_follow_quality(spark):
    docs = spark.createDataFrame([(i, _prose(i, 10), "en", "a" if i % 4 else "b", 1) for i in range(2000)], DOCS)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(2000)] + [(1, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    passed = Counter(r.doc_id for r in mixing.mix_rows(docs, labels).collect())
    for r in mixing.mix(docs, labels).collect():
        assert passed[r.doc_id] * r.size == r.taken
    good, poor = (sum(n for i, n in passed.items() if i % 2 == k and i % 4) for k in (1, 0))
    assert good > 2 * 1.15 * poor  # of source a two in three are good


def test_null_tokenizer_versions_are_a_group(spark):
    counts = spark.createDataFrame([("a", "en", None, 5), ("a", "_ids", None, 2), ("a", "en", "v", 3)],
                                   "source string, lang string, tokenizer string, tokens long")
    rollup = tokencounts.Rollup(spark, shared_path(spark))
    want = {("a", "en", None, 1, 5), ("a", "_ids", None, 1, 2), ("a", "en", "v", 1, 3)}
    assert rollup.commit("1", tokencounts.inserts(counts))
    for _ in range(2):
        assert {tuple(r) for r in rollup.totals().collect()} == want and rollup.committed() == {"1"}
        rollup.compact()
    assert not rollup.commit("1", tokencounts.inserts(counts)) and {tuple(r) for r in rollup.totals().collect()} == want


@pytest.mark.parametrize("edits, together", [(2, 16), (2, 2), (3, 16)])
def test_lines_a_few_edits_apart(spark, monkeypatch, edits, together):
    monkeypatch.setattr(linededup, "TOGETHER", together)
    dice, base = random.Random(edits), [_prose(600 + i, 5) for i in range(8)]
    lines = []
    for _ in range(160):
        line = dice.choice(base)
        for _ in range(dice.randint(0, edits + 1)):
            at, how = dice.randrange(len(line)), dice.random()
            line = line[:at] + ("" if how < 0.3 else dice.choice("xyz")) + line[at + (how < 0.7):]
        lines.append(line)
    distinct = list(dict.fromkeys(lines))
    want = [s for n, s in enumerate(distinct) if len(s) < 20 or not any(
        len(o) >= 20 and abs(len(o) - len(s)) <= edits and _edits(o, s) <= edits for o in distinct[:n])]
    docs = spark.createDataFrame([(i, "\n".join(lines[4 * i:4 * i + 4]), "en", "s", 1) for i in range(40)], DOCS)
    rows = sorted(linededup.dedup_lines(docs, edits=edits).collect(), key=lambda r: r.doc_id)
    assert [x for r in rows for x in r.text.split("\n") if x] == want
