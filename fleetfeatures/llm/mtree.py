"""Operator 7, exact top-k inner products: M-trees over pages of vectors, best-first search.

A vector x with one more component sqrt(M^2 - |x|^2), M the largest norm, lies
on a sphere; there the largest inner product with a query is the smallest
distance to it, so a metric tree applies. Rows are dealt to pivots (the nearest
one) and these cells into pages of bounded size; each page is an M-tree: nodes
with a centre, a covering radius and each entry's distance to its parent's
centre. A search takes nodes by their least possible distance and passes over
entries whose stored parent distance already rules them out by the triangle
inequality, without computing theirs. Queries search a page together: each takes
nodes in its own order, those at the same node compute in one product. Scores are computed in whole
numbers and are exact; bounds have a slack above rounding.

A query first searches the cell next to it; its k-th score then rules out cells
by their covering radius, and the others are searched. Queries meet pages by
their cell, in chunks of bounded size; per query and page k rows are left.

Defined cases: vectors that are null, or hold a null or a number that is not
finite, take no part; the missing components of a shorter vector count as 0;
equal scores go to the smaller vec_id, a null vec_id comes last; rows that bear
the query's id are its own; repeated query rows are answered each; with fewer
candidates than k all are returned; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetfeatures.llm.common import ship, written

K = 5
SCALE = 256
#: Mean rows of a page and queries of a chunk: bound a task's memory.
PAGE = 4096
CHUNK = 4096
#: Pivots are this many rows of least hash at most; they shape the cells, every row is indexed and searched.
PIVOTS = 512
FANOUT = 32
LEAF = 256
#: Queries that search a page together.
TOGETHER = 256
NO_ID = np.iinfo(np.int64).max
NO_SCORE = np.iinfo(np.int64).min
HIT = "query_row long, query_id long, vec_id long, score long"


def whole_numbers(vectors: DataFrame) -> DataFrame:
    """vec_id, row and v (components as whole doubles) of the vectors that take part."""
    good = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    rows = vectors.filter(F.coalesce(good, F.lit(False))).select("vec_id", whole.alias("v"))
    return written(rows.withColumn("row", F.monotonically_increasing_id()))


def matrix(vectors, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def raised(x: np.ndarray, top: float) -> np.ndarray:
    """The vectors on the sphere of radius sqrt(top)."""
    last = np.sqrt(np.maximum(0.0, top - np.einsum("ij,ij->i", x, x)))
    return np.hstack([x, last[:, None]])


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact whole inner products: doubles while sums stay below 2^53, else 64-bit integers."""
    if not len(x) or np.abs(x).max() * np.abs(q).max(initial=0.0) * x.shape[1] < 2.0 ** 53:
        return (x @ q).astype(np.int64)
    return x.astype(np.int64) @ q.astype(np.int64)


class Page:
    """An M-tree over the vectors of one page, built top-down around spread-out centres."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, top: float) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self.up = raised(self.x, top)
        # a node: centre, radius, children (numbers of nodes, or rows), their distances to the centre, their centres and radii
        self.nodes: list[tuple] = []
        self.root = self._node(np.arange(len(ids)))

    def _node(self, rows: np.ndarray) -> int:
        up = self.up[rows]
        centre = up.mean(axis=0)
        away = np.linalg.norm(up - centre, axis=1)
        node = (centre, away.max(initial=0.0), rows, away, None)
        if len(rows) > LEAF and (self.x[rows] != self.x[rows[0]]).any():
            seeds = [int(away.argmax())]
            nearest = np.linalg.norm(up - up[seeds[0]], axis=1)
            group = np.zeros(len(rows), int)
            while len(seeds) < FANOUT and nearest.max() > 0.0:
                seeds.append(int(nearest.argmax()))
                d = np.linalg.norm(up - up[seeds[-1]], axis=1)
                closer = d < nearest
                nearest[closer], group[closer] = d[closer], len(seeds) - 1
            if len(seeds) > 1:
                children = [self._node(rows[group == g]) for g in range(len(seeds)) if (group == g).any()]
                centres = np.array([self.nodes[c][0] for c in children])
                radii = np.array([self.nodes[c][1] for c in children])
                node = (centre, away.max(), np.array(children), np.linalg.norm(centres - centre, axis=1), (centres, radii))
        self.nodes.append(node)
        return len(self.nodes) - 1

    def search(self, q: np.ndarray, own: int, k: int, top: float, least: float) -> list[tuple[int, int]]:
        """The k best (score, id) for a query, at least those that reach ``least``."""
        _, scores, ids = self.search_all(q[None, :], np.array([own]), k, top, np.array([least]))
        return list(zip(scores.tolist(), ids.tolist()))

    def search_all(self, q: np.ndarray, own: np.ndarray, k: int, top: float, least: np.ndarray) -> tuple[np.ndarray, ...]:
        """Query (its place in ``q``), score and id of the k best rows of each query, at least those that reach its ``least``.

        In a round each query takes its nearest nodes, twice as many as in the round before; queries that take the same node compute
        their distances or scores together.
        """
        high = np.hstack([q, np.zeros((len(q), 1))])
        reach = np.einsum("ij,ij->i", q, q) + top
        slack = 1e-6 * (1.0 + np.sqrt(reach))
        best, ids = np.full((len(q), k), NO_SCORE), np.full((len(q), k), NO_ID)
        limit = np.full(len(q), np.inf)

        def lower(who: np.ndarray, score: np.ndarray) -> None:
            limit[who] = np.minimum(limit[who], np.sqrt(np.maximum(0.0, reach[who] - 2.0 * score)) + slack[who])

        told = np.flatnonzero(np.isfinite(least))
        lower(told, least[told])
        here = np.full((len(q), len(self.nodes)), np.inf)
        bound = here.copy()
        here[:, self.root] = np.linalg.norm(high - self.nodes[self.root][0], axis=1)
        bound[:, self.root] = here[:, self.root] - self.nodes[self.root][1]
        take = 1
        while True:
            near = np.argpartition(bound, min(take, len(self.nodes)) - 1, axis=1)[:, :take]
            nearest = np.take_along_axis(bound, near, 1)
            query, place = np.nonzero(np.isfinite(nearest) & (nearest <= limit[:, None]))
            if not len(query):
                break
            node = near[query, place]
            order = np.argsort(node, kind="stable")
            take *= 2
            for who in np.split(order, np.flatnonzero(np.diff(node[order])) + 1):
                at, who = node[who[0]], query[who]
                who = who[bound[who, at] <= limit[who]]
                bound[who, at] = np.inf
                if not len(who):
                    continue
                _, _, entries, apart, below = self.nodes[at]
                gap = np.abs(here[who, at][:, None] - apart)
                if below is None:
                    rows = entries[(gap <= limit[who, None]).any(axis=0)]
                    if len(rows):
                        self._score(q, own, who, rows, best, ids)
                        full = who[best[who, -1] > NO_SCORE]
                        lower(full, best[full, -1])
                    continue
                centres, radii = below
                some = np.flatnonzero((gap - radii <= limit[who, None]).any(axis=0))
                distances = _distances(high[who], centres[some])
                least_possible = distances - radii[some]
                here[np.ix_(who, entries[some])] = distances
                bound[np.ix_(who, entries[some])] = np.where(least_possible <= limit[who, None], least_possible, np.inf)
        query, place = np.nonzero(best > NO_SCORE)
        return query, best[query, place], ids[query, place]

    def _score(self, q: np.ndarray, own: np.ndarray, who: np.ndarray, rows: np.ndarray, best: np.ndarray, ids: np.ndarray) -> None:
        """Put the scores of ``rows`` (in the order of their ids) among the best of the queries ``who``."""
        k = best.shape[1]
        score = products(self.x[rows], q[who].T).T
        score[self.ids[rows] == own[who][:, None]] = NO_SCORE
        known = np.hstack([best[who], score])
        worst = np.partition(known, -k, axis=1)[:, -k:].min(axis=1)[:, None]
        even = known == worst  # of equal scores k of the least ids are enough
        even[:, k:] &= np.cumsum(even[:, k:], axis=1) <= k
        mine, column = np.nonzero((known > NO_SCORE) & ((known > worst) | even))
        found = known[mine, column]
        named = np.where(column < k, ids[who[mine], np.minimum(column, k - 1)], self.ids[rows[np.maximum(column - k, 0)]])
        order = np.lexsort((named, -found, mine))
        mine, found, named = mine[order], found[order], named[order]
        place = np.arange(len(mine)) - np.searchsorted(mine, mine)
        first = place < k
        best[who], ids[who] = NO_SCORE, NO_ID
        best[who[mine[first]], place[first]], ids[who[mine[first]], place[first]] = found[first], named[first]


def top_k(vectors: DataFrame, every: int = 50, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score for the queries, the rows whose vec_id is divisible by ``every``."""
    spark = vectors.sparkSession
    ship(spark)
    rows = whole_numbers(vectors)
    queries = F.col("vec_id") % every == 0
    size = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.count(F.when(queries, 1)), F.max(F.aggregate(
        "v", F.lit(0.0), lambda a, x: a + x * x))).first()
    n, dim, n_queries, top = size[0], size[1], size[2], float(size[3] or 0.0)
    chunks = max(1, -(-n_queries // CHUNK))
    pivot_rows = rows.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(min(PIVOTS, max(1, n // PAGE)))
    pivots = raised(matrix([r.v for r in pivot_rows.collect()], dim), top) if n else np.zeros((1, 1))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                away = _distances(raised(matrix(batch["v"], dim), top), pivots)
                cell = away.argmin(axis=1)
                yield batch.assign(cell=cell.astype("int32"), away=away[np.arange(len(cell)), cell])

    known = rows.select(F.coalesce("vec_id", F.lit(int(NO_ID))).alias("vec_id"), "row", "v")
    dealt = written(known.mapInPandas(deal, "vec_id long, row long, v array<double>, cell int, away double"))
    cells = dealt.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()  # one row per pivot
    pages = {c.cell: max(1, -(-c.n // PAGE)) for c in cells}
    radius = np.full(len(pivots), -np.inf)
    for c in cells:
        radius[c.cell] = c.radius
    count = F.element_at(F.create_map(*[F.lit(x) for item in pages.items() for x in item]) if pages else F.create_map(F.lit(0), F.lit(1)), F.col("cell"))
    paged = dealt.select("cell", F.pmod(F.xxhash64("row"), count).cast("int").alias("page"), "vec_id", "v")
    asked = dealt.filter((F.col("vec_id") % every == 0) & (F.col("vec_id") != int(NO_ID)))

    def choose(nearest: bool):
        """The cells a query visits: the nearest first; then the others that may hold something as good."""
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                q = matrix(batch["v"], dim)
                away = _distances(np.hstack([q, np.zeros((len(q), 1))]), pivots)
                bound = np.where(np.isfinite(radius), away - radius, np.inf)
                first = np.where(np.isfinite(radius), away, np.inf).argmin(axis=1)
                reach = np.einsum("ij,ij->i", q, q) + top
                least = batch["least"].to_numpy(float)
                limit = np.where(np.isfinite(least), np.sqrt(np.maximum(0.0, reach - 2 * np.where(np.isfinite(least), least, 0.0))), np.inf)
                limit = limit + 1e-6 * (1 + np.sqrt(reach))
                inside = np.isfinite(radius)
                visit = np.zeros((len(batch), len(pivots)), bool)
                visit[np.arange(len(batch)), first] = True
                if not nearest:
                    visit = (bound <= limit[:, None]) & inside & ~visit
                query, cell = np.nonzero(visit & inside)
                number = np.array([pages.get(c, 0) for c in range(len(pivots))])[cell]
                page = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
                query, cell = np.repeat(query, number), np.repeat(cell, number)
                chosen = batch.iloc[query]
                yield pd.DataFrame({"cell": cell.astype("int32"), "page": page.astype("int32"), "query_row": chosen["row"].to_numpy(),
                                    "query_id": chosen["vec_id"].to_numpy(), "least": least[query], "v": chosen["v"].to_numpy()})
        return run

    def look(key: tuple, wanted: pd.DataFrame, page: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame(columns=["query_row", "query_id", "vec_id", "score"], dtype="int64")]
        if len(wanted) and len(page):
            tree = Page(page["vec_id"].to_numpy(np.int64), matrix(page["v"], dim), top)
            for at in range(0, len(wanted), TOGETHER):
                some = wanted.iloc[at:at + TOGETHER]
                own = some["query_id"].to_numpy(np.int64)
                query, score, found = tree.search_all(matrix(some["v"], dim), own, k, top, some["least"].to_numpy(float))
                out.append(pd.DataFrame({"query_row": some["query_row"].to_numpy(np.int64)[query], "query_id": own[query],
                                         "vec_id": found, "score": score}))
        return pd.concat(out)

    visit_kind = "cell int, page int, query_row long, query_id long, least double, v array<double>"

    def hits(bounded: DataFrame, nearest: bool) -> DataFrame:
        visits = bounded.mapInPandas(choose(nearest), visit_kind).withColumn("chunk", F.pmod(F.xxhash64("query_row"), F.lit(chunks)))
        copies = paged.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
        return visits.groupBy("cell", "page", "chunk").cogroup(copies.groupBy("cell", "page", "chunk")).applyInPandas(look, HIT)

    near = written(hits(asked.withColumn("least", F.lit(float("-inf"))), True))
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    kth = near.withColumn("place", F.row_number().over(best)).filter(F.col("place") == k).select("query_row", F.col("score").alias("kth"))
    bounded = asked.join(kth, F.col("row") == F.col("query_row"), "left").withColumn(
        "least", F.coalesce(F.col("kth").cast("double"), F.lit(float("-inf")))).select("vec_id", "row", "v", "least")
    found = near.unionAll(hits(bounded, False)).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"),
                        F.when(F.col("vec_id") != int(NO_ID), F.col("vec_id")).alias("vec_id"), "score")


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    square = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", y, y)[None, :] - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(square, 0.0))


SQL = f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE})) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e),
             lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))::BIGINT AS score
      FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id),
o AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM o WHERE rank <= {K}"""
