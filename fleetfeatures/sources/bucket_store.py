"""Feature tables in key buckets, with a manifest per snapshot.

A row's key decides its bucket. An upsert reads and rewrites the buckets that its batch touches and leaves the files of all
others alone, so it costs what the batch touches. What a table holds is told by its newest manifest: the schema, key, event
time and description, and for each bucket the write it is in. Manifests are numbered; a new one is written beside and then
renamed to the next number, which fails if that number is taken. So readers see one snapshot or the next, a broken write
leaves only files that no manifest names, and of two writers that start from one snapshot the second one begins again on the
first one's result.

Layout below ``<location>/<name>_v<version>``: ``data/<write>/bucket=<number>/*.parquet`` and ``manifests/<number>.json``.
The driver holds a manifest (a few bytes per bucket) and the numbers of touched buckets, never rows or keys.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetfeatures.operators.rows import latest_per_key
from fleetfeatures.schemas import with_comments
from fleetfeatures.sources.feature_store import reconcile

BUCKETS = 64
#: Files that no kept manifest names are left alone until they are this old: a running writer may have made them.
DAY = 24 * 3600.0
_BUCKET = "bucket"
_WHOLE = ("tinyint", "smallint", "int", "bigint")


class SnapshotTaken(RuntimeError):
    """Another writer published the next snapshot first."""


@dataclass(frozen=True)
class Manifest:
    """One snapshot of a table."""

    number: int
    schema: T.StructType
    primary_key: list[str]
    event_time: str
    buckets: int
    description: str = ""
    #: The write that holds each bucket; empty buckets are not named.
    writes: dict[int, str] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps({"schema": json.loads(self.schema.json()), "primary_key": self.primary_key, "event_time": self.event_time,
                           "buckets": self.buckets, "description": self.description, "writes": {str(k): w for k, w in sorted(self.writes.items())}})

    @classmethod
    def from_json(cls, number: int, text: str) -> Manifest:
        held = json.loads(text)
        return cls(number, T.StructType.fromJson(held["schema"]), held["primary_key"], held["event_time"], held["buckets"], held["description"],
                   {int(k): w for k, w in held["writes"].items()})


class BucketTable:
    """One version of a feature table in key buckets."""

    def __init__(self, spark: SparkSession, location: str, name: str, version: int) -> None:
        self.spark, self.home = spark, f"{location.rstrip('/')}/{name}_v{version}"
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.home).getFileSystem(self._conf)

    # --- snapshots ------------------------------------------------------------

    def snapshots(self) -> list[int]:
        """Numbers of the published snapshots, the oldest first."""
        folder = self._path(f"{self.home}/manifests")
        if not self._fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, number: int | None = None) -> Manifest | None:
        """A snapshot's manifest, the newest by default; None without one."""
        known = self.snapshots()
        if not known or (number is not None and number not in known):
            return None
        number = known[-1] if number is None else number
        source = self._fs.open(self._path(f"{self.home}/manifests/{number:012d}.json"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()
        return Manifest.from_json(number, text)

    def read(self, number: int | None = None) -> DataFrame | None:
        """The rows of a snapshot, the newest by default; later writes do not change the frame. None without a table."""
        found = self.manifest(number)
        return None if found is None else self._rows(found, found.writes)

    def _rows(self, manifest: Manifest, buckets: Sequence[int] | Mapping[int, str]) -> DataFrame:
        paths = [f"{self.home}/data/{manifest.writes[b]}/{_BUCKET}={b}" for b in sorted(buckets) if b in manifest.writes]
        if not paths:
            return self.spark.createDataFrame([], manifest.schema)
        return self.spark.read.schema(manifest.schema).parquet(*paths)

    # --- writing --------------------------------------------------------------

    def write(self, df: DataFrame, *, primary_key: Sequence[str] | None = None, event_time: str | None = None, buckets: int = BUCKETS,
              description: str | None = None, comments: Mapping[str, str] | None = None, tries: int = 5) -> int:
        """Create the table, or upsert into it: one row per key, the one with the latest event time, of equal times
        the new row. Returns the number of the new snapshot.

        Key, event time and number of buckets count at creation only. New columns and wider types enter the schema; a changed
        type rewrites all buckets. After another writer's snapshot the upsert is done again on that, ``tries`` times at most.
        """
        for _ in range(tries):
            base = self.manifest()
            try:
                if base is None:
                    if not primary_key or not event_time:
                        raise ValueError("a new table needs a primary key and an event time")
                    return self._create(df, list(primary_key), event_time, buckets, description or "", comments or {})
                return self._upsert(base, df, description, comments or {})
            except SnapshotTaken:
                continue
        raise SnapshotTaken(f"{self.home}: {tries} tries, each time another writer was first")

    def rebucket(self, buckets: int) -> int:
        """The newest snapshot dealt into another number of buckets."""
        base = self.manifest()
        rows = self._rows(base, base.writes)
        return self._publish(replace(base, buckets=buckets, writes={}), rows, base.primary_key, set())

    def _create(self, df: DataFrame, keys: list[str], event_time: str, buckets: int, description: str, comments: Mapping[str, str]) -> int:
        rows = with_comments(latest_per_key(df, keys, [event_time]), dict(comments))
        return self._publish(Manifest(-1, rows.schema, keys, event_time, buckets, description), rows, keys, set())

    def _upsert(self, base: Manifest, df: DataFrame, description: str | None, comments: Mapping[str, str]) -> int:
        keys, time_ = base.primary_key, base.event_time
        missing = [c for c in [*keys, time_] if c not in df.columns]
        if missing:
            raise ValueError(f"the batch has no columns {missing}")
        stored, batch = reconcile(self._rows(base, base.writes), df)
        before, after = {f.name: f.dataType.simpleString() for f in base.schema}, dict(stored.dtypes)
        if any(before[k] != after.get(k) and after.get(k) not in _WHOLE for k in keys):
            raise ValueError("the type of a key decides its bucket; it can only widen among whole numbers")
        # the batch is read three times: it is written once, and goes when the snapshot is made
        held_at = f"{self.home}/batches/{uuid.uuid4().hex}"
        latest = latest_per_key(batch, keys, [time_])
        latest.withColumn(_BUCKET, bucket_of(latest, keys, base.buckets)).write.parquet(held_at)
        try:
            return self._merge(base, self.spark.read.parquet(held_at), before, after, description, comments)
        finally:
            self._fs.delete(self._path(held_at), True)

    def _merge(self, base: Manifest, incoming: DataFrame, before: Mapping[str, str], after: Mapping[str, str], description: str | None,
               comments: Mapping[str, str]) -> int:
        keys, time_ = base.primary_key, base.event_time
        touched = {r[0] for r in incoming.select(_BUCKET).distinct().collect()}  # at most one number per bucket
        if any(before[c] != after[c] for c in before):
            touched |= set(base.writes)
        held = self._rows(base, touched & set(base.writes))
        held = held.select(*[F.col(c).cast(after[c]).alias(c) for c in held.columns]).withColumn("__new", F.lit(0))
        rival = held.unionByName(incoming.drop(_BUCKET).withColumn("__new", F.lit(1)), allowMissingColumns=True)
        texts = {f.name: f.metadata["comment"] for f in base.schema if "comment" in f.metadata} | dict(comments)
        schema = with_comments(rival.drop("__new"), texts).schema
        kept = replace(base, schema=schema, description=base.description if description is None else description,
                       writes={b: w for b, w in base.writes.items() if b not in touched})
        return self._publish(kept, rival, keys, touched, winners=[time_, "__new"])

    def _publish(self, manifest: Manifest, rows: DataFrame, keys: Sequence[str], touched: set[int], winners: Sequence[str] = ()) -> int:
        """Write the rows by bucket, then publish ``manifest`` with these buckets added."""
        write = uuid.uuid4().hex
        folder = f"{self.home}/data/{write}"
        # one shuffle: what is dealt by bucket is also dealt by bucket and key
        dealt = rows.withColumn(_BUCKET, bucket_of(rows, keys, manifest.buckets)).repartition(_BUCKET)
        if winners:
            rest = [c for c, kind in rows.dtypes if c not in keys and c not in winners and "map<" not in kind]
            order = Window.partitionBy(_BUCKET, *keys).orderBy(*[F.col(c).desc() for c in [*winners, *rest]])
            dealt = dealt.withColumn("__place", F.row_number().over(order)).where("__place = 1").drop("__place", "__new")
        dealt.write.partitionBy(_BUCKET).parquet(folder)
        made = [f.getPath().getName() for f in self._fs.listStatus(self._path(folder)) if f.isDirectory()]
        added = {int(n.split("=")[1]): write for n in made if n.startswith(f"{_BUCKET}=")}
        try:
            return self._swap(replace(manifest, writes={**manifest.writes, **added}), manifest.number + 1)
        except SnapshotTaken:
            self._fs.delete(self._path(folder), True)
            raise

    def _swap(self, manifest: Manifest, number: int) -> int:
        """The one step that changes what readers see: a rename that does not replace."""
        target, draft = (self._path(f"{self.home}/manifests/{n}") for n in (f"{number:012d}.json", f"{uuid.uuid4().hex}.draft"))
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(manifest.to_json().encode()))
        finally:
            out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(target), none)
        except Py4JJavaError as error:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise SnapshotTaken(f"{self.home}: snapshot {number} is there already") from None
            raise
        return number

    # --- removal --------------------------------------------------------------

    def vacuum(self, keep: int = 1, older_than: float = DAY) -> int:
        """Delete all manifests but the ``keep`` newest, and the buckets that none of those names, if they are older than
        ``older_than`` seconds. Returns how many bucket folders went."""
        known = self.snapshots()
        manifests = [self.manifest(n) for n in known[-keep:]]
        named = {f"{w}/{_BUCKET}={b}" for m in manifests for b, w in m.writes.items()}
        for number in known[:-keep]:
            self._fs.delete(self._path(f"{self.home}/manifests/{number:012d}.json"), False)
        gone, limit = 0, (time.time() - older_than) * 1000
        data = self._path(f"{self.home}/data")
        for write in self._fs.listStatus(data) if self._fs.exists(data) else []:
            # a writer makes its folder last modified as it goes on, so a young folder may belong to a running one
            if write.getModificationTime() > limit:
                continue
            folders = [f for f in self._fs.listStatus(write.getPath()) if f.isDirectory()]
            old = [f for f in folders if f"{write.getPath().getName()}/{f.getPath().getName()}" not in named]
            for f in old:
                self._fs.delete(f.getPath(), True)
            if len(old) == len(folders):
                self._fs.delete(write.getPath(), True)
            gone += len(old)
        return gone

    def drop(self) -> None:
        """Remove the table."""
        self._fs.delete(self._path(self.home), True)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)


def bucket_of(df: DataFrame, keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row; whole numbers of any width, and nulls, always go to the same one."""
    kinds = dict(df.dtypes)
    parts = [F.col(k).cast("bigint") if kinds[k] in _WHOLE else F.col(k) for k in keys]
    return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")
