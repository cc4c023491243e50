"""Size-tiered sharding: small immutable shards, merged by size, under a versioned manifest.

An arrival is appended as shards of a bounded number of rows. Shards fall into
tiers, each FAN_IN times the size of the one below. Compaction merges a tier as
soon as FAN_IN shards stand in it: its shards, alike in size, are read together
and written as files of about the target size, without a shuffle. Rounds go on
until no tier is full; shards of half the target or more are final.

No file is ever changed. A manifest lists the shards of a version; a version
exists once its commit file does, and that is put in place by a rename that
fails if another writer was first. The loser takes the newer version and tries
again, so readers see whole versions only. A merge is committed only if it holds
as many rows as the shards it replaces. Only paths, sizes and counts of shards
reach the driver.

Edge cases: nulls, repeated rows, very long texts and any further columns are
stored as they are (a column named like a manifest's is no clash: manifests are
tables of their own); an empty arrival commits a version without new shards; a
store without versions cannot be read; arrivals must share their columns.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import scratch

ROWS_PER_SHARD = 2000
TARGET_BYTES = 64 << 20
FAN_IN = 4
#: Upper size of the lowest tier.
TIER_BYTES = 1 << 20
RETRIES = 8
MANIFEST = "shard string, rows long, bytes long, added long"


class Conflict(Exception):
    """Another writer has replaced shards that this change relies on."""


def tier_of(size: int, base: int = TIER_BYTES, fan_in: int = FAN_IN) -> int:
    return 0 if size < base else 1 + int(math.log(size / base, fan_in))


@dataclass
class Version:
    number: int
    manifest: str
    schema: T.StructType


class ShardStore:
    """A sharded table below root, in a store whose renames are atomic and refuse to replace a file: HDFS, local and mounted file systems."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._hadoop = jvm.org.apache.hadoop.fs
        self._rename = getattr(self._hadoop, "Options$Rename")
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path(self.root).getFileSystem(conf)
        self._files.mkdirs(self._path(f"{self.root}/commits"))
        self._context = self._hadoop.FileContext.getFileContext(self._files.makeQualified(self._path(self.root)).toUri(), conf)

    def _path(self, name: str):
        return self._hadoop.Path(name)

    def latest(self) -> Version | None:
        names = [s.getPath().getName() for s in self._files.listStatus(self._path(f"{self.root}/commits"))]
        done = sorted(n for n in names if n.endswith(".json") and not n.startswith((".", "_")))
        return self.version(int(done[-1].removesuffix(".json"))) if done else None

    def version(self, number: int) -> Version:
        stream = self._files.open(self._path(f"{self.root}/commits/{number:012d}.json"))
        try:
            told = json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()
        return Version(number, told["manifest"], T.StructType.fromJson(told["schema"]))

    def manifest(self, version: Version | None = None) -> DataFrame:
        """The shards of a version (default: the latest): shard, rows, bytes, and the version that added them."""
        version = version or self.latest()
        if version is None:
            raise LookupError(f"{self.root} has no version")
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/{version.manifest}")

    def read(self, version: Version | None = None) -> DataFrame:
        """The rows of a version."""
        version = version or self.latest()
        paths = [f"{self.root}/{r.shard}" for r in self.manifest(version).select("shard").collect()]
        return self._rows(paths, version.schema)

    def _rows(self, paths: list[str], schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _measured(self, folder: str, schema: T.StructType, number: int) -> DataFrame:
        """Manifest rows of the files below a data folder; empty files are left out."""
        files = self.spark.read.schema(schema).parquet(f"{self.root}/{folder}")
        name = F.concat(F.lit(f"{folder}/"), F.element_at(F.split("_metadata.file_path", "/"), -1))
        return files.groupBy(name.alias("shard"), F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("rows")).select("shard", "rows", "bytes", F.lit(number).cast("long").alias("added"))

    def _commit(self, number: int, shards: DataFrame, schema: T.StructType) -> bool:
        """Make version `number` of these shards; False if another writer has made it."""
        manifest = f"manifests/{number:012d}-{uuid.uuid4().hex}"
        shards.write.parquet(f"{self.root}/{manifest}")
        draft, final = self._path(f"{self.root}/commits/.{uuid.uuid4().hex}"), self._path(f"{self.root}/commits/{number:012d}.json")
        stream = self._files.create(draft, False)
        try:
            stream.write(bytearray(json.dumps({"manifest": manifest, "schema": schema.jsonValue()}).encode()))
        finally:
            stream.close()
        try:
            self._context.rename(draft, final, self.spark.sparkContext._gateway.new_array(self._rename, 0))
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in str(e.java_exception.toString()):
                raise
            self._files.delete(draft, False)
            return False
        return True

    def append(self, rows: DataFrame, rows_per_shard: int = ROWS_PER_SHARD) -> Version:
        """Add an arrival; the version that holds it."""
        folder = f"data/{uuid.uuid4().hex}"
        rows.write.option("maxRecordsPerFile", rows_per_shard).parquet(f"{self.root}/{folder}")
        for _ in range(RETRIES):
            old = self.latest()
            number = old.number + 1 if old else 1
            shards = self._measured(folder, rows.schema, number)
            if self._commit(number, self.manifest(old).unionByName(shards) if old else shards, old.schema if old else rows.schema):
                return self.version(number)
        raise Conflict(f"{RETRIES} other writers were first")

    def compact(self, target_bytes: int = TARGET_BYTES, fan_in: int = FAN_IN) -> Version | None:
        """Merge full tiers until there is none; the version after it."""
        while True:
            old = self.latest()
            if old is None:
                return None
            tiers: dict[int, list] = {}
            for r in self.manifest(old).where(F.col("bytes") < target_bytes / 2).collect():
                tiers.setdefault(tier_of(r.bytes, fan_in=fan_in), []).append(r)
            runs = [run for _, run in sorted(tiers.items()) if len(run) >= fan_in]
            if not runs:
                return old
            self._merge(old, runs, target_bytes)

    def _merge(self, old: Version, runs: list[list], target_bytes: int) -> None:
        """Replace each run of shards by files of about the target size, in one new version."""
        made = None
        for run in runs:
            folder, files = f"data/{uuid.uuid4().hex}", max(1, round(sum(r.bytes for r in run) / target_bytes))
            self._rows([f"{self.root}/{r.shard}" for r in run], old.schema).coalesce(files).write.parquet(f"{self.root}/{folder}")
            new = self._measured(folder, old.schema, old.number + 1)
            rows = new.agg(F.sum("rows")).first()[0] or 0
            if rows != sum(r.rows for r in run):
                raise RuntimeError(f"a merge holds {rows} rows, its shards {sum(r.rows for r in run)}")
            made = new if made is None else made.unionByName(new)
        gone = self.spark.createDataFrame([(r.shard,) for run in runs for r in run], "gone string")
        for _ in range(RETRIES):
            now = self.latest()
            shards = self.manifest(now)
            if shards.join(gone, shards.shard == gone.gone, "left_semi").count() != sum(map(len, runs)):
                raise Conflict("another writer has merged some of these shards")
            if self._commit(now.number + 1, shards.join(gone, shards.shard == gone.gone, "left_anti").unionByName(made), now.schema):
                return
        raise Conflict(f"{RETRIES} other writers were first")

    def expire(self, keep: int = 1) -> int:
        """Delete the files that none of the last `keep` versions lists; how many."""
        last = self.latest()
        if last is None:
            return 0
        kept, first = set(), max(1, last.number - keep + 1)
        for n in range(first, last.number + 1):
            kept |= {r.shard for r in self.manifest(self.version(n)).select("shard").collect()}
        for n in range(1, first):
            self._files.delete(self._path(f"{self.root}/commits/{n:012d}.json"), False)
        gone = 0
        for folder in self._files.listStatus(self._path(f"{self.root}/data")):
            for f in self._files.listStatus(folder.getPath()):
                name = f.getPath().getName()
                if name.startswith("part-") and f"data/{folder.getPath().getName()}/{name}" not in kept:
                    gone += self._files.delete(f.getPath(), False)
        return gone


def shard_documents(docs: DataFrame, root: str | None = None, rows_per_shard: int = ROWS_PER_SHARD, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Append docs as an arrival, compact, and return every row of the committed version."""
    store = ShardStore(docs.sparkSession, root or scratch(docs.sparkSession, "shards"))
    store.append(docs, rows_per_shard)
    store.compact(target_bytes)
    return store.read()
