"""Pairs that sketches rule out, texts that no line of is wanted, searches of many queries at once."""

from __future__ import annotations

import random

import numpy as np

from fleetfeatures.llm import linededup, minhash, mtree


def test_sketches_rule_out_distant_pairs_and_keep_similar_ones(spark, monkeypatch):
    dice, base = random.Random(4), [f"w{i}" for i in range(200)]
    texts = [" ".join(base[:100] + [f"v{dice.random()}" for _ in range(100)]) for _ in range(24)]
    texts += [texts[9] + " and a few words more", texts[9] + " or other words here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    for many in (1, 3):  # buckets that are small, and large ones
        monkeypatch.setattr(minhash, "SMALL", 32 if many == 1 else 4)
        formed, compare = [], minhash.similar
        monkeypatch.setattr(minhash, "similar", lambda pairs, sets: formed.append(pairs.count()) or compare(pairs, sets))
        nodes = spark.createDataFrame([(i, list(range(many))) for i in range(len(texts))], "node long, bands array<long>")
        parts = {r.node: r.component for r in minhash.linked_nodes(docs, nodes).collect()}
        monkeypatch.setattr(minhash, "similar", compare)
        assert parts == {9: 9, 24: 9, 25: 9}
        assert formed[-1] <= 3  # of 325 pairs


def test_sketch_bound_is_never_below_what_sets_share():
    dice = random.Random(5)
    for size in (3, 40, 900, 6000):
        for share in (0.0, 0.5, 0.9, 1.0):
            common = [dice.getrandbits(63) for _ in range(int(size * share))]
            x, y = ({*common, *(dice.getrandbits(63) for _ in range(size - len(common)))} for _ in range(2))
            a, b = (minhash.sketch(minhash.np.array(sorted(s), minhash.U)).view(minhash.U) for s in (x, y))
            bits = [sum(int(w).bit_count() for w in s) for s in (a, b, a & b)]
            assert len(x & y) <= bits[2] + min(len(x) - bits[0], len(y) - bits[1])


def test_documents_without_wanted_lines_are_left_out(spark):
    rows = [0, 1, 7, 8, 32_767, 32_768, 32_769, 65_536, 2 ** 33, 2 ** 33 + 1, 2 ** 33 + 40_000, 5 * 2 ** 33]
    docs = spark.createDataFrame([(r, f"text {r}") for r in rows], "row long, text string")
    for wanted in (rows, rows[::2], rows[1::2], [], [3, 9, 2 ** 34]):
        found = linededup._named(docs, spark.createDataFrame([(r,) for r in wanted], "row long"))
        assert sorted(map(tuple, found.collect())) == [(r, f"text {r}") for r in rows if r in wanted]


def test_queries_that_search_a_page_together_take_few_products(monkeypatch):
    dice = np.random.default_rng(3)
    x = np.floor(dice.normal(size=(3000, 16)) * 3)
    x[100:900] = x[7]  # more equal rows than a leaf holds
    ids = dice.permutation(3000) // 2  # ids repeat
    page = mtree.Page(ids, x, float((x * x).sum(axis=1).max()))
    q, own, least = x[::20], ids[::20], np.full(150, -np.inf)
    least[::3] = 10.0
    calls, compute = [], mtree.products
    monkeypatch.setattr(mtree, "products", lambda a, b: calls.append(1) or compute(a, b))
    query, score, found = page.search_all(q, own, 5, float((x * x).sum(axis=1).max()), least)
    for n in range(150):
        best = sorted((-int(s), int(i)) for s, i in zip(x @ q[n], ids) if i != own[n])[:5]
        got = [(-s, i) for s, i in zip(score[query == n].tolist(), found[query == n].tolist())]
        assert [g for g in got if -g[0] >= least[n]] == [b for b in best if -b[0] >= least[n]]
    assert len(calls) < 1500
