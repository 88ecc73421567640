"""Key buckets: what an upsert rewrites, snapshots, broken writes, two writers, wider types, removal."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fleetfeatures.sources import feature_store
from fleetfeatures.sources.bucket_store import BucketTable, SnapshotTaken, bucket_of

KIND = "k long, v string, t string"


def _batch(spark, rows, kind=KIND):
    return spark.createDataFrame(rows, kind).withColumn("t", F.col("t").cast("timestamp"))


def _table(spark, tmp_path, rows=None, **more):
    store = BucketTable(spark, str(tmp_path), "things", 3)
    rows = rows if rows is not None else [(i, f"old {i}", "2024-01-01") for i in range(60)] + [(None, "null key", "2024-01-01")]
    store.write(_batch(spark, rows), primary_key=["k"], event_time="t", buckets=8, **more)
    return store


def _files(tmp_path):
    return {str(p.relative_to(tmp_path)) for p in Path(tmp_path).rglob("*.parquet")}


def _rows(df):
    return {(r.k, r.v) for r in df.collect()}


def test_an_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    store = _table(spark, tmp_path)
    before = _files(tmp_path)
    first, old = store.manifest(), store.read()
    batch = _batch(spark, [(5, "new", "2024-02-01"), (5, "older", "2023-01-01"), (6, "same time", "2024-01-01"), (7, "earlier", "2020-01-01"), (500, "added", "2020-01-01")])
    assert store.write(batch) == 1
    touched = {r[0] for r in batch.select(bucket_of(batch, ["k"], 8)).collect()}
    second = store.manifest()
    assert 0 < len(touched) < 8 and {b for b in first.writes if first.writes[b] != second.writes[b]} == touched
    added = _files(tmp_path) - before
    assert before <= _files(tmp_path) and {int(f.split("bucket=")[1].split("/")[0]) for f in added} == touched
    want = {(i, f"old {i}") for i in range(60)} | {(None, "null key"), (500, "added")}
    want = want - {(5, "old 5"), (6, "old 6")} | {(5, "new"), (6, "same time")}
    assert _rows(store.read()) == want
    assert len(_rows(old)) == 61 and _rows(store.read(0)) == _rows(old)
    assert store.write(_batch(spark, [(None, "newer null", "2025-01-01")])) == 2
    assert (None, "newer null") in _rows(store.read()) and store.read().count() == 62
    assert store.write(_batch(spark, [])) == 3 and store.read().count() == 62
    assert not list(Path(tmp_path).glob("*/batches/*"))


def test_a_broken_write_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    store = _table(spark, tmp_path)
    old = _rows(store.read())

    def broken(*_):
        raise RuntimeError("executor folder is gone")

    with monkeypatch.context() as patch:
        patch.setattr(BucketTable, "_swap", broken)
        with pytest.raises(RuntimeError):
            store.write(_batch(spark, [(5, "new", "2024-02-01")]))
    assert _rows(store.read()) == old and store.snapshots() == [0]
    fails = F.when(F.col("k") == 5, F.raise_error(F.lit("bad row"))).otherwise(F.col("v"))
    with pytest.raises(Exception, match="bad row"):
        store.write(_batch(spark, [(4, "x", "2025-01-01"), (5, "new", "2025-01-01")]).withColumn("v", fails))
    assert _rows(store.read()) == old
    assert store.vacuum(older_than=3600.0) == 0  # may belong to a running writer
    assert store.vacuum(older_than=0.0) > 0 and _rows(store.read()) == old


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    store, other = _table(spark, tmp_path), BucketTable(spark, str(tmp_path), "things", 3)
    swap, done = BucketTable._swap, []

    def late(self, manifest, number):
        if not done:
            done.append(1)
            other.write(_batch(spark, [(5, "other", "2024-03-01"), (900, "other", "2024-03-01")]))
        return swap(self, manifest, number)

    monkeypatch.setattr(BucketTable, "_swap", late)
    assert store.write(_batch(spark, [(5, "mine", "2024-02-01"), (901, "mine", "2024-02-01")])) == 2
    got = _rows(store.read())
    assert {(5, "other"), (900, "other"), (901, "mine")} <= got and len(got) == 63
    with pytest.raises(SnapshotTaken):
        swap(store, store.manifest(), 2)


def test_wider_types_new_columns_and_texts(spark, tmp_path):
    store = _table(spark, tmp_path, [(i, "x", "2024-01-01") for i in range(20)], description="it's a table", comments={"v": "a value"})
    small = _batch(spark, [(3, "y", 1.5, "2024-02-01")], "k int, v string, extra double, t string")
    store.write(small)
    held = store.read()
    assert dict(held.dtypes) == {"k": "bigint", "v": "string", "t": "timestamp", "extra": "double"} and held.count() == 20
    assert [r.extra for r in held.where("k = 3").collect()] == [1.5] and held.where("extra IS NULL").count() == 19
    manifest = store.manifest()
    assert manifest.description == "it's a table" and manifest.schema["v"].metadata["comment"] == "a value"
    assert held.schema["v"].metadata["comment"] == "a value"
    with pytest.raises(ValueError, match="column v"):
        store.write(_batch(spark, [(1, "x", "2024-01-01")]).withColumn("v", F.lit(True)))
    with pytest.raises(ValueError, match="key"):
        store.write(_batch(spark, [(1, "x", "2024-01-01")]).withColumn("k", F.lit(1.5)))
    with pytest.raises(ValueError, match="no columns"):
        store.write(spark.createDataFrame([(1,)], "k long"))
    store.write(_batch(spark, [(4, "z", "2026-01-01")]).withColumn("extra", F.lit(7)))
    assert store.rebucket(3) == 3 and max(store.manifest().writes) < 3
    assert store.read().count() == 20 and [(r.v, r.extra) for r in store.read().where("k = 4").collect()] == [("z", 7.0)]
    store.write(_batch(spark, [(4, "zz", "2027-01-01")]))
    assert [r.v for r in store.read().where("k = 4").collect()] == ["zz"] and store.read().count() == 20
    assert store.vacuum(keep=1, older_than=0.0) > 0 and store.snapshots() == [4] and store.read().count() == 20
    store.drop()
    assert store.read() is None and store.manifest() is None and store.snapshots() == []


def test_digits_and_decimals(spark):
    assert feature_store.common_type("a", "decimal(10,2)", "decimal(12,2)") == "decimal(12,2)"
    assert feature_store.common_type("a", "decimal(10,2)", "decimal(9,4)") == "decimal(12,4)"
    assert feature_store.common_type("a", "int", "decimal(9,4)") == "decimal(14,4)"
    with pytest.raises(ValueError):
        feature_store.common_type("a", "decimal(38,2)", "decimal(38,30)")
    large = spark.createDataFrame([(1152921504606846977,)], "n long")
    with pytest.raises(ValueError, match="round"):
        feature_store.reconcile(large, spark.createDataFrame([(0.5,)], "n double"))
    one, other = feature_store.reconcile(spark.createDataFrame([(2 ** 53,)], "n long"), spark.createDataFrame([(0.5,)], "n double"))
    assert one.dtypes == other.dtypes == [("n", "double")]


def test_description_survives_a_wider_type(spark, tmp_path):
    spark.sql(f"CREATE DATABASE described LOCATION '{tmp_path}/db'")
    options = {"primary_key": ["k"], "event_time": "t", "database": "described"}
    feature_store.write_feature_table(_batch(spark, [(1, "a", "2024-01-01")], "k int, v string, t string"), "d", 1, str(tmp_path / "s"), description="what it's for", **options)
    table = feature_store.write_feature_table(_batch(spark, [(2, "b", "2024-01-01")]), "d", 1, str(tmp_path / "s"), **options)
    assert spark.catalog.getTable(table).description == "what it's for" and spark.table(table).count() == 2
