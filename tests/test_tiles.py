"""Joins of keys with many rows on both sides, done by arrays of rows."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from fleetfeatures import catalogue
from fleetfeatures.operators.joins import gather_tiles, join_on, spread_tiles

catalogue.load()


def test_tiles_hold_every_row_and_no_more_than_their_size(spark):
    rows = [(k, i, None if i % 5 == 0 else f"t{i % 3}") for k in (1, 2, None) for i in range(23)] * 2
    df = spark.createDataFrame(rows, "k int, n int, t string").repartition(7)
    tiles = gather_tiles(df, ["k"], 10)
    assert sorted(len(r["tile"]) for r in tiles.collect()) == [6] * 3 + [10] * 12
    assert Counter(map(tuple, spread_tiles(tiles, {"tile": ""}).collect())) == Counter(rows)


def test_joined_tiles_are_the_joined_rows(spark):
    rows = [(k, h, i, None if i % 4 == 0 else i / 2) for k, n in ((1, 30), (2, 11), (None, 7)) for h in (0, None) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, h int, n int, v double")
    ends = spark.createDataFrame([("a", 1, 2), ("b", 2, 2), ("c", None, 1), ("d", 5, 1), ("b", 2, 2)], "route string, o int, d int")

    def joined(hours):
        return join_on(join_on(ends, hours, [("o", "k")], "inner"), hours, [("d", "k"), "h"], "inner", suffixes=("_x", "_y"))

    plain = joined(df)
    spread = spread_tiles(joined(gather_tiles(df, ["k", "h"], 8)), {"tile_x": "_x", "tile_y": "_y"})
    assert sorted(spread.columns) == sorted(plain.columns)
    assert Counter(map(tuple, spread.select(*plain.columns).collect())) == Counter(map(tuple, plain.collect()))
    assert plain.count() == 2 * (30 * 11 + 2 * 11 * 11 + 7 * 30)


def test_pairs_of_busy_hours_are_whole_and_written_in_few_bytes(spark, tmp_path):
    at = tmp_path / "events.parquet"
    duckdb.sql(f"""COPY (SELECT i AS event_id, TIMESTAMP '2024-01-01 05:00:00' + to_microseconds(i * 800_000) AS ts,
        (i * 7919) % 1501 AS user_id, ['click', 'view', 'error', 'signup'][i % 4 + 1] AS event_type,
        CAST((i * 7907) % 17_791 AS DOUBLE) / 100 AS value, '' AS props FROM range(4000) t(i)) TO '{at}' (FORMAT parquet)""")
    catalogue.QUERIES["suffix_rename"](spark, str(tmp_path)).write.parquet(str(tmp_path / "out"))
    sums = ["count(*)", "sum(rowindex_origin * rowindex_destination)", "sum(rowindex_origin * temp_destination)",
            "sum(temp_origin * rowindex_destination)", "sum(CASE WHEN origin_description = destination_description THEN rowindex_origin END)"]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{at}'")
    expected = con.execute(f"SELECT route_id, {', '.join(sums)} FROM ({catalogue.ORACLES['suffix_rename']}) GROUP BY 1 ORDER BY 1").fetchall()
    out = spark.read.parquet(str(tmp_path / "out"))
    found = [tuple(r) for r in out.groupBy("route_id").agg(*map(F.expr, sums)).orderBy("route_id").collect()]
    assert [r[0] for r in found] == [r[0] for r in expected] and len(found) == 4
    for ours, theirs in zip(found, expected):
        assert ours[1:] == pytest.approx(theirs[1:], rel=1e-9)
    size = sum(p.stat().st_size for p in (tmp_path / "out").glob("*.parquet"))
    assert size < 0.4 * sum(r[1] for r in found)
