"""Exact quantiles of columns of any size (used by C7, A7, A9)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = 2048
#: Size of the sketch, and how far from a rank its answer may lie, as a share of the rows (five times its usual error).
SKETCH = 4096
REACH = 0.004
#: Rows of a cell whose values are fetched; a cell with more is divided again.
FETCHED = 20_000


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], *,
                    cells: int = CELLS) -> dict[str, list[float] | None]:
    """Linearly interpolated quantiles per column; None for a column without values.

    Nulls and not-a-number are missing; infinities are values with a rank. One
    algorithm at every size, three scans as a rule: a sketch of fixed size says
    between which values each rank lies, a count of cells between them narrows it
    to few rows, and those are fetched. Every answer is checked by the counts, so
    results are exact whatever the sketch says. Values are never sorted or
    shuffled (Spark's ``percentile`` keeps every distinct value in one buffer).
    """
    columns = list(columns)
    as_double = [(c, F.col(c).cast("double")) for c in columns]
    values = df.select(*[F.when(~F.isnan(v), v).alias(c) for c, v in as_double])
    finite = [(c, F.when(F.abs(c) < math.inf, F.col(c))) for c in columns]
    marks = F.array(*[F.lit(min(1.0, max(0.0, p + side * REACH))) for p in probs for side in (-1, 1)])
    shape = values.agg(*[F.struct(F.count(c).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"),
                                  F.count(F.when(F.col(c) == -math.inf, 1)).alias("below"),
                                  F.count(v).alias("n_finite"),
                                  F.kll_sketch_agg_double(v, SKETCH).alias("sketch")).alias(c) for c, v in finite])
    shape = shape.select(*[F.col(f"`{c}`").withField("sketch", F.when(F.col(f"`{c}`")["n_finite"] > 0, F.kll_sketch_get_quantile_double(
        F.col(f"`{c}`")["sketch"], marks))).alias(c) for c in columns]).first()
    known = [c for c in columns if shape[c]["n"]]
    places = {c: [(shape[c]["n"] - 1) * p for p in probs] for c in known}
    ranks = {c: {r for place in places[c] for r in (math.floor(place), math.ceil(place))} for c in known}
    inner = {c: {r - shape[c]["below"] for r in ranks[c] if 0 <= r - shape[c]["below"] < shape[c]["n_finite"]} for c in known}
    searched = [c for c in known if inner[c]]
    near = {c: list(zip(shape[c]["sketch"][::2], shape[c]["sketch"][1::2])) for c in searched}
    at = _values_at_ranks(values.select(*[v.alias(c) for c, v in finite if c in searched]), {c: inner[c] for c in searched},
                          {c: (shape[c]["lo"], shape[c]["hi"]) for c in searched}, near, cells) if searched else {}

    def value(c: str, rank: int) -> float:
        inside = rank - shape[c]["below"]
        return -math.inf if inside < 0 else at[c][inside] if inside < shape[c]["n_finite"] else math.inf

    found = {c: [_between(value(c, math.floor(place)), value(c, math.ceil(place)), place % 1) for place in places[c]]
             for c in known}
    return {c: found.get(c) for c in columns}


def _between(low: float, high: float, share: float) -> float:
    """The value ``share`` of the way; next to an infinity it is that infinity."""
    if low == high or share == 0.0:
        return low
    if math.isinf(low) or math.isinf(high):
        return low if math.isinf(low) else high
    return low + (high - low) * share if math.isfinite(high - low) else low * (1.0 - share) + high * share


def _values_at_ranks(values: DataFrame, ranks: dict[str, set[int]], ends: dict[str, tuple[float, float]],
                     near: dict[str, list[tuple[float, float]]], cells: int) -> dict[str, dict[int, float]]:
    """The values at the given 0-based ranks of each sorted column.

    Each rank has a bracket of values that must hold it. The first pass cuts
    each column into the spans of ``near``, in cells, and the gaps between them,
    and counts rows; that tells in which span or gap a rank lies. A bracket of
    few rows has its values fetched. Else one pass counts the rows in equal
    cells of every open bracket (at most ``cells`` rows per rank come back); the
    bracket shrinks to the real minimum and maximum of the cell that holds the
    rank, and is done when they are equal. The ends of a bracket fall in
    different cells, so every pass shrinks it. All columns share the passes.
    """
    # bracket: column, smallest value, largest value, rows of the column below it, rows in it
    brackets = {}
    for c, rows in _count_spans(values, {c: _spans(near[c], *ends[c]) for c in ranks}, cells).items():
        for rank in ranks[c]:
            below = 0
            for row in rows:
                if rank < below + row["n"]:
                    brackets[c, rank] = (c, row["lo"], row["hi"], below, row["n"])
                    break
                below += row["n"]
    while True:
        wanted = sorted({b for b in brackets.values() if b[1] < b[2]})
        if not wanted:
            return {c: {rank: brackets[c, rank][1] for rank in ranks[c]} for c in ranks}
        few = [b for b in wanted if b[4] <= FETCHED]
        many = [b for b in wanted if b[4] > FETCHED]
        # values that are fetched are cells of one value each
        counted = _count_cells(values, few, None) if few else {}
        counted |= _count_cells(values, many, cells) if many else {}
        for key, bracket in brackets.items():
            if bracket in counted:
                below = bracket[3]
                for row in counted[bracket]:
                    if key[1] < below + row["n"]:
                        brackets[key] = (bracket[0], row["lo"], row["hi"], below, row["n"])
                        break
                    below += row["n"]


def _spans(near: list[tuple[float, float]], low: float, high: float) -> list[tuple[float, float]]:
    """The spans in order, those that overlap as one."""
    merged: list[tuple[float, float]] = []
    for a, b in sorted((max(low, a), min(high, b)) for a, b in near):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _count_spans(values: DataFrame, spans: dict[str, list[tuple[float, float]]], cells: int) -> dict[str, list]:
    """Per column the counted rows of its gaps and of the cells of its spans, from the least value up."""
    columns, places = list(spans), []
    for i, c in enumerate(columns):
        # gap 0, span 1, gap 2, span 3, ...: from the last to the first, so that the least that fits remains
        part, cell = F.lit(2 * len(spans[c])), F.lit(0)
        for k, (low, high) in reversed(list(enumerate(spans[c]))):
            inside = F.least(F.floor(_share(c, low, high) * cells).cast("int"), F.lit(cells - 1))
            part = F.when(F.col(c) < low, 2 * k).when(F.col(c) <= high, 2 * k + 1).otherwise(part)
            cell = F.when(F.col(c) < low, 0).when(F.col(c) <= high, inside).otherwise(cell)
        places.append(F.struct(F.lit(i).alias("column"), part.alias("part"), cell.alias("cell"), F.col(c).alias("v")))
    placed = values.select(F.inline(F.array(*places))) if len(places) > 1 else values.select(places[0].alias("p")).select("p.*")
    rows = placed.where("v IS NOT NULL").groupBy("column", "part", "cell").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    found: dict[str, list] = {c: [] for c in columns}
    for row in sorted(rows, key=lambda r: (r["column"], r["part"], r["cell"])):
        found[columns[row["column"]]].append(row)
    return found


def _share(c: str, low: float, high: float) -> Column:
    """How far a value is on the way from ``low`` to ``high``."""
    # halves, as the distance itself may be too large for a double; between the least doubles it may be none
    distance = high / 2 - low / 2
    return (F.col(c) / 2 - low / 2) / distance if distance > 0 else F.when(F.col(c) > low, 1.0).otherwise(0.0)


def _count_cells(values: DataFrame, brackets: list[tuple], cells: int | None) -> dict:
    """Per bracket its non-empty cells in order, with row count and extreme values; without ``cells``, its values."""
    columns = sorted({b[0] for b in brackets})
    if len(columns) == 1:
        # reaches the scan, which then skips what lies outside all brackets
        values = values.where(F.col(columns[0]).between(min(b[1] for b in brackets), max(b[2] for b in brackets)))
    places = []
    for c in columns:
        bracket_no, cell_no = F.lit(None).cast("int"), F.lit(None).cast("int" if cells else "double")
        for i, (name, low, high, *_) in enumerate(brackets):
            if name == c:
                here = F.col(c).between(low, high)
                cell = F.least(F.floor(_share(c, low, high) * cells).cast("int"), F.lit(cells - 1)) if cells else F.col(c)
                bracket_no, cell_no = F.when(here, i).otherwise(bracket_no), F.when(here, cell).otherwise(cell_no)
        places.append(F.struct(bracket_no.alias("bracket"), cell_no.alias("cell"), F.col(c).alias("v")))
    placed = values.select(F.inline(F.array(*places))) if len(places) > 1 else values.select(
        places[0].alias("p")).select("p.*")
    rows = (placed.where("bracket IS NOT NULL").groupBy("bracket", "cell")
            .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
    found: dict = {b: [] for b in brackets}
    for row in sorted(rows, key=lambda r: (r["bracket"], r["cell"])):
        found[brackets[row["bracket"]]].append(row)
    return found
