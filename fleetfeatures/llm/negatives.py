"""Operator 11, hard negatives: stored angles to reference directions bound scores before they are computed.

Every row stores its norm and its angles to a few reference directions. By the triangle inequality of angles, the angle
between an anchor a and a row x lies, for each direction r, between |a_r - x_r| and min(a_r + x_r, 2 pi - a_r - x_r). The
narrowest of these intervals gives an interval of cosines; times both norms it bounds the inner product. The bounds are
widened by more than doubles can be off, so no row is lost to rounding. Only rows whose interval meets the window of scores
that is asked for have their whole-number score computed.

Rows lie in blocks: dealt to the cell of their nearest direction, sorted within a cell by the angle to it, and cut into
blocks of up to ``BLOCK`` rows, written once. A question (an anchor, a window of scores, same or other label) first goes to
the cells nearest to it; the k-th score found there raises the window's lower end, and the question goes on to the other
cells and blocks whose bounds still meet the window. Questions travel to the blocks in chunks; a block is copied once for
each ``CHUNK`` questions that it gets, so vectors move in proportion to the questions they answer.

Two rounds: the positives of every anchor (same label, any score), then the negatives of every anchor and positive (other
label, a window below the positive's score).

Defined cases: rows with a null label, a null vector or a component that is null or not finite take no part; a missing
component of a shorter vector counts as 0; the rows that bear the anchor's vec_id are its own; repeated anchor rows are
answered each; a null vec_id is no anchor and comes last among equal scores; a zero vector scores 0 with every row; a window
below a negative score is empty; scores are exact up to 2^53; no rows give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetfeatures.llm.common import ship, written
from fleetfeatures.llm.mtree import NO_ID, SCALE, matrix, products

K = 5
#: Directions, a fixed number: those of rows of least hash. They shape the bounds; every row is searched.
DIRECTIONS = 16
#: Rows of a block and questions of a chunk: bound a task's memory.
BLOCK = 4096
CHUNK = 4096
#: Wider than angles of doubles are off by (an angle near 0 or pi has half the digits of its cosine).
ANGLE_SLACK = 1e-5

ROW = "vec_id long, label int, row long, v array<double>, norm double, angles array<double>, cell int, apart double"
QUESTION = "ask long, own long, label int, same boolean, low double, high double, v array<double>, norm double, angles array<double>"
HIT = "ask long, vec_id long, score long"


def angles_to(directions: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms of the vectors and their angles to unit directions (a zero vector: a right angle to all)."""
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    cosines = vectors @ directions.T / np.where(norms > 0.0, norms, 1.0)[:, None]
    return norms, np.arccos(np.clip(cosines, -1.0, 1.0))


def cosine_interval(low_angle: np.ndarray, high_angle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low_angle = np.maximum(0.0, low_angle - ANGLE_SLACK)
    high_angle = np.minimum(np.pi, high_angle + ANGLE_SLACK)
    return np.cos(high_angle), np.cos(low_angle)


def score_interval(cosines: tuple[np.ndarray, np.ndarray], norms: tuple[np.ndarray, np.ndarray], norm: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest product with a vector of length ``norm`` for cosines and lengths between the given ends."""
    low, high = cosines
    short, long = norms[0] * norm, norms[1] * norm
    slack = 1.0 + 1e-9 * long
    return np.where(low < 0.0, low * long, low * short) - slack, np.where(high < 0.0, high * short, high * long) + slack


def row_bounds(angles: np.ndarray, norms: np.ndarray, own: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """Score bounds of rows (a column each in ``angles``) against a vector with angles ``own``."""
    apart = np.abs(angles - own[:, None]).max(axis=0)
    total = angles + own[:, None]
    together = np.minimum(total, 2.0 * np.pi - total).min(axis=0)
    return score_interval(cosine_interval(apart, together), (norms, norms), norm)


def group_bounds(least: np.ndarray, most: np.ndarray, norms: tuple[np.ndarray, np.ndarray], own: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """Score bounds of groups of rows whose angles (a row each) lie between ``least`` and ``most``."""
    apart = np.maximum(0.0, np.maximum(least - own, own - most)).max(axis=1)
    # the sum of angles, or the rest of the circle, is largest where the sum comes nearest to pi
    low, high = least + own, most + own
    widest = np.where(high <= np.pi, high, np.where(low >= np.pi, 2.0 * np.pi - low, np.pi)).min(axis=1)
    return score_interval(cosine_interval(apart, widest), norms, norm)


class Block:
    """Some rows with their angles, to be asked for the best scores in a window."""

    def __init__(self, rows: pd.DataFrame, dim: int) -> None:
        order = np.argsort(rows["vec_id"].to_numpy(np.int64), kind="stable")
        self.ids = rows["vec_id"].to_numpy(np.int64)[order]
        self.labels = rows["label"].to_numpy(np.int64)[order]
        self.norms = rows["norm"].to_numpy(float)[order]
        self.x = matrix(rows["v"], dim)[order]
        self.angles = np.ascontiguousarray(np.stack(rows["angles"].to_numpy())[order].T)
        self.ends = self.angles.min(axis=1)[None, :], self.angles.max(axis=1)[None, :]
        self.lengths = np.array([self.norms.min()]), np.array([self.norms.max()])

    def best(self, own_id: int, label: int, same: bool, low: float, high: float, v: np.ndarray, norm: float, angles: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, id) within the window, at most; ties to smaller ids."""
        least, most = group_bounds(*self.ends, self.lengths, angles, norm)
        if most[0] < low or least[0] > high:
            return []
        least, most = row_bounds(self.angles, self.norms, angles, norm)
        open_ = np.flatnonzero((most >= low) & (least <= high) & ((self.labels == label) == same) & (self.ids != own_id))
        found: list[tuple[int, int]] = []
        # from the highest upper bound down: once k scores reach the next bound, the rest cannot enter
        open_ = open_[np.argsort(-most[open_], kind="stable")]
        for start in range(0, len(open_), 512):
            part = open_[start:start + 512]
            if len(found) == k and found[-1][0] > most[part[0]]:
                break
            scores = products(self.x[part], v)
            inside = (scores >= low) & (scores <= high)
            found += zip(scores[inside].tolist(), self.ids[part][inside].tolist())
            found = sorted(found, key=lambda f: (-f[0], f[1]))[:k]
        return found


def prepared(vectors: DataFrame) -> DataFrame:
    """vec_id, label, row, v (whole components) of the rows that take part."""
    good = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.filter(F.col("label").isNotNull() & F.coalesce(good, F.lit(False)))
    known = F.coalesce("vec_id", F.lit(int(NO_ID))).alias("vec_id")
    return written(rows.select(known, label.cast("int").alias("label"), F.monotonically_increasing_id().alias("row"), whole.alias("v")))


def stored_blocks(rows: DataFrame, directions: np.ndarray, dim: int, block: int = BLOCK) -> DataFrame:
    """The rows with norm, angles, cell and block, written once."""
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                norms, angles = angles_to(directions, matrix(batch["v"], dim))
                cell = angles.argmin(axis=1)
                yield batch.assign(norm=norms, angles=list(angles), cell=cell.astype("int32"), apart=angles[np.arange(len(cell)), cell])

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, int] = {}
        for batch in batches:
            place = np.zeros(len(batch), np.int64)
            for cell in batch["cell"].unique():
                at = np.flatnonzero(batch["cell"].to_numpy() == cell)
                place[at] = seen.get(cell, 0) + np.arange(len(at))
                seen[cell] = seen.get(cell, 0) + len(at)
            yield batch.assign(block=place // block)

    # equal vectors have equal angles: the row number lets them, too, be cut into ranges
    ranged = rows.mapInPandas(deal, ROW).repartitionByRange("cell", "apart", "row").sortWithinPartitions("cell", "apart", "row")
    placed = ranged.withColumn("part", F.spark_partition_id()).mapInPandas(number, ROW + ", part int, block long")
    return written(placed)


def best_in_windows(questions: DataFrame, blocks: DataFrame, directions: np.ndarray, dim: int, k: int = K, chunk: int = CHUNK) -> DataFrame:
    """ask, vec_id, score, place: the k best rows in the window of every question, all of them if fewer."""
    angle = [F.struct(F.min(F.col("angles")[i]).alias("least"), F.max(F.col("angles")[i]).alias("most")) for i in range(len(directions))]
    cells = blocks.groupBy("cell").agg(F.min("norm").alias("short"), F.max("norm").alias("long"), F.array(*angle).alias("ends")).orderBy("cell").collect()
    if not cells:
        return blocks.sparkSession.createDataFrame([], HIT + ", place int")
    number = np.array([c.cell for c in cells])
    least, most = (np.array([[e[name] for e in c.ends] for c in cells]) for name in ("least", "most"))
    lengths = np.array([c.short for c in cells]), np.array([c.long for c in cells])

    def route(first: bool):
        """The cells a question visits: those of its nearest direction; then the others that may hold something in its window."""
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                visits, to = [], []
                for i, (low, high, norm, own) in enumerate(zip(batch["low"], batch["high"], batch["norm"], batch["angles"])):
                    own = np.asarray(own, float)
                    home = own[number].argmin()
                    if first:
                        at = np.array([home])
                    else:
                        bounds = group_bounds(least, most, lengths, own, norm)
                        at = np.flatnonzero((bounds[1] >= low) & (bounds[0] <= high))
                        at = at[at != home]
                    visits += [i] * len(at)
                    to += number[at].tolist()
                yield batch.iloc[visits].assign(cell=np.array(to, "int32"))
        return run

    sizes = written(blocks.groupBy("cell", "part", "block").agg(F.count("*").alias("n_rows")))
    where = ["cell", "part", "block"]

    def answers(asked: DataFrame, first: bool) -> DataFrame:
        visits = asked.mapInPandas(route(first), QUESTION + ", cell int")
        per_cell = visits.groupBy("cell").agg(F.count("*").alias("n_visits"))
        known = F.broadcast(per_cell.select("cell", F.ceil(F.col("n_visits") / chunk).cast("long").alias("chunks")))  # a row per direction
        # every block of a cell gets the cell's questions; it decides by its own bounds what to look at
        sent = visits.join(known, "cell").withColumn("chunk", F.pmod(F.xxhash64("ask"), F.col("chunks"))).drop("chunks").join(
            sizes.select(*where), "cell")
        copies = blocks.join(known, "cell").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        return sent.groupBy(*where, "chunk").cogroup(copies.groupBy(*where, "chunk")).applyInPandas(look, HIT)

    def look(wanted: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(wanted) and len(rows):
            block = Block(rows, dim)
            asked = zip(wanted["ask"], wanted["own"], wanted["label"], wanted["same"], wanted["low"], wanted["high"], matrix(wanted["v"], dim), wanted["norm"], wanted["angles"])
            for ask, own, label, same, low, high, v, norm, angles in asked:
                out += [(ask, i, s) for s, i in block.best(own, label, same, low, high, v, norm, np.asarray(angles, float), k)]
        return pd.DataFrame(out, columns=["ask", "vec_id", "score"], dtype="int64")

    best = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id")
    near = written(answers(questions, True))
    kth = near.withColumn("place", F.row_number().over(best)).filter(F.col("place") == k).select("ask", F.col("score").cast("double").alias("kth"))
    raised = questions.join(kth, "ask", "left").withColumn("low", F.greatest("low", "kth")).drop("kth")
    found = near.unionAll(answers(raised, False))
    return written(found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k))


def hard_negatives(vectors: DataFrame, every: int = 100, k: int = K, *, directions: int = DIRECTIONS, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by ``every``, positives their k best of the same label; the negatives of
    a pair are the k best of other labels that score between four fifths of the positive's score and all of it.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = prepared(vectors)
    dim = rows.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]
    chosen = rows.filter(F.exists("v", lambda x: x != 0)).select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(directions)
    units = matrix([r.v for r in chosen.collect()], dim)
    units = units / np.sqrt(np.einsum("ij,ij->i", units, units))[:, None] if len(units) else np.zeros((1, dim))
    blocks = stored_blocks(rows, units, dim, block)

    anchors = blocks.filter((F.col("vec_id") % every == 0) & (F.col("vec_id") != int(NO_ID)))
    anchors = written(anchors.select(F.col("row").alias("ask"), F.col("vec_id").alias("own"), "label", "v", "norm", "angles"))
    order = [c.split()[0] for c in QUESTION.split(", ")]
    whole = anchors.withColumns({"same": F.lit(True), "low": F.lit(float("-inf")), "high": F.lit(float("inf"))}).select(*order)
    positives = best_in_windows(whole, blocks, units, dim, k, chunk).select(
        F.col("ask").alias("anchor"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), "place")
    pairs = written(positives.withColumn("pair", F.monotonically_increasing_id()))
    windows = pairs.join(anchors, F.col("anchor") == F.col("ask")).withColumns({
        "ask": F.col("pair"), "same": F.lit(False), "low": F.expr("positive_score - positive_score div 5").cast("double"), "high": F.col("positive_score").cast("double")})
    windows = written(windows.filter("positive_score >= 0").select(*order))
    negatives = best_in_windows(windows, blocks, units, dim, k, chunk)
    named = pairs.join(anchors.select(F.col("ask").alias("anchor"), F.col("own").alias("anchor_id")), "anchor")
    out = negatives.join(named.drop("place"), F.col("ask") == F.col("pair"))

    def shown(c: str):
        return F.when(F.col(c) != int(NO_ID), F.col(c))

    return out.select("anchor_id", shown("positive_id").alias("positive_id"), F.col("place").cast("int").alias("rank"),
                      shown("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


SQL = f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})) AS e FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS anchor, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
             coalesce(list_sum(list_transform(list_zip(a.e, c.e), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0)::BIGINT AS score
      FROM v a, v c WHERE a.vec_id % 100 = 0 AND c.vec_id IS DISTINCT FROM a.vec_id),
p AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) AS place FROM s WHERE same),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.vec_id NULLS LAST)::INT AS rank
      FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same WHERE p.place <= {K} AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {K}"""
