"""Sketches are fetched once per node, however many buckets it is in."""

from __future__ import annotations

import random

import pytest

from fleetfeatures.llm import minhash


@pytest.mark.parametrize("small", [32, 4])
def test_sketches_are_held_once_per_node(spark, monkeypatch, small):
    dice, base = random.Random(6), [f"w{i}" for i in range(200)]
    texts = [" ".join(base[:100] + [f"v{dice.random()}" for _ in range(100)]) for _ in range(20)]
    texts += [texts[3] + " and a few words more", texts[3] + " or other words here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    nodes = spark.createDataFrame([(i, list(range(12))) for i in range(len(texts))], "node long, bands array<long>")
    held, write = [], minhash.written

    def written(df):
        table = write(df)
        if "sketch" in table.columns:
            held.append(table.count())
        return table

    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "written", written)
    parts = {r.node: r.component for r in minhash.linked_nodes(docs, nodes).collect()}
    assert parts == {3: 3, 20: 3, 21: 3}
    assert held and max(held) == len(texts)
