"""Hard negatives against scoring every pair, with tight blocks, hot labels, equal vectors and odd rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetfeatures.llm import negatives

KIND = "vec_id long, embedding array<float>, label int"


def _random(seed: int, n: int, dim: int = 8, spread: float = 0.4) -> list[tuple]:
    """Clusters, a hot label, copies of one vector under several labels, opposite and zero vectors."""
    dice = np.random.default_rng(seed)
    centres = dice.normal(size=(6, dim))
    rows = []
    for i in range(n):
        v = centres[i % 6] + spread * dice.normal(size=dim)
        rows.append((i, [float(np.float32(x)) for x in v], 1 if i % 3 else int(dice.integers(0, 10))))
    same = [float(np.float32(x)) for x in centres[0]]
    rows += [(n + i, same, i % 4) for i in range(40)] + [(n + 40, [-x for x in same], 1), (n + 41, [0.0] * dim, 2)]
    return rows


_ODD = [(None, [1.0, 2.0, 0.5], 1), (None, [1.0, 1.0], 2), (100, None, 1), (200, [1.0, None], 1), (300, [float("nan"), 1.0], 2), (300, [float("inf")], 2),
        (400, [0.5, 0.25], None), (500, [], 1), (700, [1.0, 0.5], 1), (700, [1.0, 0.5], 1), (14, [1.0, 0.5, 0.25], 9), (None, None, None)]


def _want(rows, every, k=5):
    part = []
    for vec_id, e, label in rows:
        if label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        part.append((vec_id, [math.floor(256 * x) for x in e], (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label))

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    def first(found):
        return sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))[:k]

    out = []
    for anchor, a, label in part:
        if anchor is None or anchor % every:
            continue
        others = [(score(a, e), i, own) for i, e, own in part if i != anchor]
        for p, positive, _ in first([f for f in others if f[2] == label]):
            inside = [f for f in others if f[2] != label and 80 * p <= 100 * f[0] <= 100 * p]
            out += [(anchor, positive, rank, i, p, s) for rank, (s, i, _) in enumerate(first(inside), 1)]
    return sorted(out, key=repr)


def _got(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("settings", [{}, {"directions": 3, "block": 16, "chunk": 5}, {"directions": 1, "block": 7}], ids=str)
def test_pairs_equal_scoring_all(spark, settings):
    rows = _random(1, 300) + _ODD
    vectors = spark.createDataFrame(rows, KIND).repartition(3)
    assert _got(negatives.hard_negatives(vectors, 20, **settings)) == _want(rows, 20)


def test_a_hot_label_and_wide_spread(spark):
    rows = _random(2, 250, 16, 2.0)
    assert _got(negatives.hard_negatives(spark.createDataFrame(rows, KIND), 10, directions=8, block=32)) == _want(rows, 10)


def test_bounds_hold_every_score():
    dice = np.random.default_rng(7)
    x = np.floor(256 * np.vstack([dice.normal(size=(200, 12)), np.zeros((1, 12)), 1e6 * dice.normal(size=(20, 12))]))
    x = np.vstack([x, x[:20] * 3, -x[:20]])
    units = x[:5] / np.linalg.norm(x[:5], axis=1)[:, None]
    norms, angles = negatives.angles_to(units, x)
    for i in range(len(x)):
        low, high = negatives.row_bounds(np.ascontiguousarray(angles.T), norms, angles[i], norms[i])
        scores = x @ x[i]
        assert (low <= scores).all() and (scores <= high).all()
        low, high = negatives.group_bounds(angles.min(axis=0)[None, :], angles.max(axis=0)[None, :], (norms[:1] * 0 + norms.min(), norms[:1] * 0 + norms.max()), angles[i], norms[i])
        assert low[0] <= scores.min() and scores.max() <= high[0]


def test_no_rows_and_further_columns(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], KIND)).count() == 0
    assert negatives.hard_negatives(spark.createDataFrame([(1, None, 1), (100, [0.0, 0.0], 1), (2, [0.0], 1), (3, [0.0], 2)], KIND)).collect() == [(100, 2, 1, 3, 0, 0)]
    rows = _random(3, 60)
    vectors = spark.createDataFrame(rows, KIND)
    wide = vectors
    for name in ("row", "cell", "part", "block", "v", "norm", "ask", "low"):
        wide = wide.withColumn(name, F.lit("x"))
    assert _got(negatives.hard_negatives(wide, 10)) == _got(negatives.hard_negatives(vectors, 10))
