"""A store of immutable shards with size-tiered compaction and versioned manifests.

Arrivals are appended as small Parquet files and never changed. Files whose sizes fall into one tier (powers of FAN_IN)
are merged once FAN_IN of them are there, into files of about the target size, without a shuffle. The files that make up
the table are those of the newest manifest, a small JSON file whose exclusive renaming into place is the commit: of two
writers that start from one version the second fails and can try again, and readers of older versions keep their files
until they are removed by `vacuum`. A renaming that fails if the name is taken is one step of the file system on HDFS. On a
local disk Hadoop checks and renames in two steps, and in an object store it copies; there the commit is safe only with one
writer at a time, or a lock. A lock of this object keeps its own threads apart in any case.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass
from threading import Lock

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TARGET_BYTES, FAN_IN = 128 << 20, 4


class Conflict(Exception):
    """Another writer has committed in the meantime."""


@dataclass(frozen=True)
class Shard:
    path: str
    size: int


class ShardStore:
    """A table of shards under `root`, a folder of any file system that Spark can write to.

    Rows are kept as they come: nulls, empty and very long texts, repeated rows and any columns. An empty table is a version
    without rows, which remembers its columns. All arrivals have the columns of the first; ties in size go by path.
    """

    def __init__(self, spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, fan_in: int = FAN_IN):
        self.spark, self.root, self.target, self.fan_in = spark, root.rstrip("/"), target_bytes, fan_in
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
        self._fs = self._path(self.root).getFileSystem(conf)
        self._files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)
        self._no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        self._fs.mkdirs(self._path(f"{self.root}/manifests"))
        self._one_at_a_time = Lock()

    def _list(self, folder: str, suffix: str) -> list[Shard]:
        if not self._fs.exists(self._path(folder)):
            return []
        found = [Shard(str(s.getPath().toString()), s.getLen()) for s in self._fs.listStatus(self._path(folder)) if s.isFile()]
        return sorted((s for s in found if s.path.endswith(suffix)), key=lambda s: s.path)

    def versions(self) -> list[int]:
        """Numbers of all manifests, oldest first."""
        return sorted(int(s.path.rpartition("-")[2].removesuffix(".json")) for s in self._list(f"{self.root}/manifests", ".json"))

    def manifest(self, version: int | None = None) -> dict:
        """A version's number, schema and shards; of the newest one by default."""
        found = self.versions()
        if not found:
            return {"version": 0, "schema": "", "shards": []}
        name = f"{self.root}/manifests/manifest-{version if version is not None else found[-1]:010d}.json"
        return json.loads("".join(r[0] for r in self.spark.read.text(name).collect()))

    def shards(self, version: int | None = None) -> list[Shard]:
        """The files of a version, of the newest one by default; none before the first commit."""
        return [Shard(**s) for s in self.manifest(version)["shards"]]

    def commit(self, base: int, shards: list[Shard], schema: str) -> int:
        """Makes the given files the next version after `base`."""
        if (self.versions() or [0])[-1] != base:
            raise Conflict(f"version {base} is not the newest")
        text = json.dumps({"version": base + 1, "schema": schema, "shards": [{"path": s.path, "size": s.size} for s in shards]})
        name, draft = self._path(f"{self.root}/manifests/manifest-{base + 1:010d}.json"), self._path(f"{self.root}/manifests/.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            with self._one_at_a_time:
                self._files.rename(draft, name, self._no_options)  # fails if the name is taken; a writer that dies before leaves only its draft
        except Py4JJavaError as e:
            self._fs.delete(draft, False)
            if not self._fs.exists(name):
                raise
            raise Conflict(f"version {base + 1} is taken") from e
        return base + 1

    def _newest(self) -> int:
        return (self.versions() or [0])[-1]

    def _added(self, folder: str, schema: str) -> int:
        """Commits the files of a folder beside those of the newest version."""
        now = self.manifest()
        return self.commit(now["version"], [*(Shard(**s) for s in now["shards"]), *self._list(folder, ".parquet")], now["schema"] or schema)

    def append(self, df: DataFrame) -> int:
        """Adds the rows of `df` as new shards."""
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(folder)
        return self._added(folder, df.schema.json())

    def append_arrivals(self, df: DataFrame, arrival: str) -> int:
        """Adds each value of the column `arrival`, in its order, as an arrival with a commit of its own, written in one pass."""
        folder, schema = f"{self.root}/data/{uuid.uuid4().hex}", df.drop(arrival).schema.json()
        df.write.option("compression", "zstd").partitionBy(arrival).parquet(folder)
        parts = [s.getPath().toString() for s in self._fs.listStatus(self._path(folder)) if s.isDirectory()]
        value = lambda part: part.rpartition("=")[2]
        numbers = all(value(p).lstrip("-").isdigit() for p in parts)
        for part in sorted(parts, key=(lambda p: int(value(p))) if numbers else value):
            self._added(part, schema)
        return self._newest() if parts else self._added(folder, schema)

    def tier(self, size: int) -> int:
        """0 for files of about the target size and more, else how many times FAN_IN smaller they are."""
        return max(0, math.ceil(math.log(self.target / 2 / max(size, 1), self.fan_in)))

    def compact(self) -> int:
        """Merges the fullest tier that has FAN_IN files, smallest files first, until none has; returns the newest version."""
        while True:
            now = self.manifest()
            base, own = now["version"], [Shard(**s) for s in now["shards"]]
            tiers: dict[int, list[Shard]] = {}
            for s in own:
                tiers.setdefault(self.tier(s.size), []).append(s)
            full = [k for k, v in tiers.items() if k and len(v) >= self.fan_in]
            if not full:
                return base
            run = tiers[max(full)]
            folder = f"{self.root}/data/{uuid.uuid4().hex}"
            files = max(1, round(sum(s.size for s in run) / self.target))
            self.spark.read.parquet(*(s.path for s in run)).coalesce(files).write.option("compression", "zstd").parquet(folder)
            gone = {s.path for s in run}
            self.commit(base, [*(s for s in own if s.path not in gone), *self._list(folder, ".parquet")], now["schema"])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, of the newest one by default; fails before the first commit."""
        now = self.manifest(version)
        schema = StructType.fromJson(json.loads(now["schema"]))
        return self.spark.read.schema(schema).parquet(*(s["path"] for s in now["shards"])) if now["shards"] else self.spark.createDataFrame([], schema)

    def vacuum(self) -> None:
        """Removes all versions but the newest and the files that only they use; no reader or writer may still use them.

        Manifests go first: if this ends halfway, files are left over, but no version names a file that is missing.
        """
        *old, last = self.versions() or [0]
        used = {s.path for s in self.shards(last)} if last else set()
        gone = {s.path for version in old for s in self.shards(version)} - used
        for version in old:
            self._fs.delete(self._path(f"{self.root}/manifests/manifest-{version:010d}.json"), False)
        for path in sorted(gone):
            self._fs.delete(self._path(path), False)
