"""Batch ids that hold separators count once and stay in the totals; a withdrawn batch leaves no trace."""

from __future__ import annotations

from fleetfeatures.llm import tokencounts
from fleetfeatures.llm.common import shared_path

COUNTS = "source string, lang string, tokenizer string, tokens long"


def test_ids_with_separators(spark):
    rollup = tokencounts.Rollup(spark, shared_path(spark))
    one = spark.createDataFrame([("s", "en", "t", 5), ("s", None, None, 7)], COUNTS)
    ids = ["2024/01", "2024%2F01", "a b=c:d", "../up", "plain"]
    for batch in ids:
        assert rollup.commit(batch, tokencounts.inserts(one))
        assert not rollup.commit(batch, tokencounts.inserts(one))
    want = {("s", "en", "t", 5, 25), ("s", None, None, 5, 35)}
    assert {tuple(r) for r in rollup.totals().collect()} == want
    rollup.compact()
    assert rollup.committed() == set(ids) and {tuple(r) for r in rollup.totals().collect()} == want
    assert not rollup.commit("2024/01", tokencounts.inserts(one))
    for batch in range(5):
        rollup.commit(f"gone/{batch}", tokencounts.deletes(one))
    assert rollup.totals().count() == 0
