"""Compare a registered query with its check SQL, value by value."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

from fleetfeatures.catalogue.views import BASE


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple, dict)):
        return repr(value)
    return value


def count_rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def run_duckdb(sql: str, folder: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in BASE:
        path = Path(folder) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    try:
        result = con.execute(sql)
        return [d[0] for d in result.description], result.fetchall()
    finally:
        con.close()


def differences(frame: DataFrame, sql: str, folder: str) -> str | None:
    """None if equal, else what differs."""
    columns, rows = run_duckdb(sql, folder)
    if sorted(frame.columns) != sorted(columns):
        return f"columns: {sorted(set(frame.columns) ^ set(columns))}"
    ours, theirs = count_rows(frame.columns, frame.collect()), count_rows(columns, rows)
    kinds = [[sorted({type(v).__name__ for v in column if v is not None}) for column in zip(*side)]
             for side in (ours, theirs)]
    if ours == theirs and kinds[0] == kinds[1]:
        return None
    first = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
    return (f"rows {sum(ours.values())} vs {sum(theirs.values())}, unequal {sum((ours - theirs).values())}\n"
            f"{sorted(columns)}\n spark {first[0]}\n sql   {first[1]}\n types {kinds}")
