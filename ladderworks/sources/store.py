"""A stored table whose changes rewrite only the files that hold a changed key, with versions that appear at once.

Rows are clustered by the key into Parquet files. A manifest, itself a small table, has a row for each file of a version: its
least and greatest key and its rows. A change reads the files whose ranges may hold one of its keys, then of these only the
key column to see which really do; only those are read in full, merged and written again beside the others. A version is
committed by renaming its manifest to the next number, which fails if another writer has taken it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files of a table whose manifest is read by the driver (some 100 bytes each); with the default size that is 50 TB.
FILES, FILE_BYTES = 100_000, 512 << 20


class Conflict(RuntimeError):
    """Another writer has committed the version."""


@dataclass(frozen=True)
class Change:
    """What a change did: its version, files that were looked into, rewritten, kept as they were, and written."""

    version: int
    looked_into: int
    rewritten: int
    kept: int
    written: int


class KeyedTable:
    """A table at `path`, clustered by the number or text in column `key`."""

    def __init__(self, spark: SparkSession, path: str, key: str) -> None:
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        context = spark.sparkContext
        self._java_path = context._jvm.org.apache.hadoop.fs.Path
        self._fs = self._java_path(path).getFileSystem(context._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Committed versions, in order."""
        folder = self._java_path(f"{self.path}/manifests")
        if not self._fs.exists(folder):
            return []
        return sorted(int(f.getPath().getName()) for f in self._fs.listStatus(folder) if f.getPath().getName().isdigit())

    def manifest(self, version: int | None = None) -> DataFrame:
        """file, low, high and rows of each file of a version, the newest by default."""
        known = self.versions()
        if not known:
            raise FileNotFoundError(f"no version of {self.path}")
        return self.spark.read.parquet(f"{self.path}/manifests/{known[-1] if version is None else version:08d}")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version."""
        return self._rows(self.manifest(version).select("file").limit(FILES + 1).collect())

    def _rows(self, files: list) -> DataFrame:
        if len(files) > FILES:
            raise ValueError(f"more than {FILES} files")
        schema = self.spark.read.parquet(f"{self.path}/schema").schema
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{r['file']}" for r in files)) if files else self.spark.createDataFrame([], schema)

    def _write(self, rows: DataFrame, files: int | None) -> DataFrame:
        """Data files of some rows, clustered by key, and their manifest."""
        folder = f"data/{uuid.uuid4().hex}"
        spread = rows.repartitionByRange(files, self.key) if files else rows.repartitionByRange(self.key)
        spread.sortWithinPartitions(self.key).write.parquet(f"{self.path}/{folder}")
        written = self.spark.read.schema(rows.schema).parquet(f"{self.path}/{folder}")
        name = F.concat(F.lit(f"{folder}/"), F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
        return written.groupBy(name.alias("file")).agg(F.min(self.key).alias("low"), F.max(self.key).alias("high"), F.count("*").alias("rows"))

    def _commit(self, manifest: DataFrame, version: int) -> None:
        part = f"{self.path}/manifests/_{uuid.uuid4().hex}"
        manifest.coalesce(1).write.parquet(part)  # a row for each file
        target = self._java_path(f"{self.path}/manifests/{version:08d}")
        # A rename onto a folder that is there would move into it on some file systems, so both are asked.
        if self._fs.exists(target) or not self._fs.rename(self._java_path(part), target):
            self._fs.delete(self._java_path(part), True)
            raise Conflict(f"version {version} is there already")

    def create(self, rows: DataFrame, files: int | None = None) -> Change:
        """The first version."""
        if self.versions():
            raise Conflict("the table is there already")
        rows.limit(0).write.parquet(f"{self.path}/schema")
        manifest = self._write(rows, files)
        self._commit(manifest, 1)
        return Change(1, 0, 0, 0, self.manifest(1).count())

    def _candidates(self, files: list, keys: DataFrame) -> list:
        """Files whose range holds one of the keys, which are compared with all ranges in batches, sorted by their ends."""
        low, high = [r.low for r in files], [r.high for r in files]

        def hit(batches):  # noqa: ANN001, ANN202  record batches
            order = sorted((i for i in range(len(low)) if low[i] is not None), key=lambda i: low[i])
            starts = np.array([low[i] for i in order], dtype=object if low and isinstance(low[order[0]] if order else "", str) else None)
            # Ranges of one write don't overlap; those of several may, so each key is followed back to the furthest end before it.
            furthest, top = [], None
            for i in order:
                top = high[i] if top is None or high[i] > top else top
                furthest.append(top)
            found = set()
            for batch in batches:
                for k in batch.column(0).to_pylist():
                    j = int(np.searchsorted(starts, k, "right")) - 1 if k is not None else -1
                    while j >= 0 and furthest[j] >= k:
                        if high[order[j]] >= k:
                            found.add(order[j])
                        j -= 1
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int64())], ["i"])

        numbers = keys.select(self.key).distinct().mapInArrow(hit, "i long").distinct().collect()
        return [files[r.i] for r in numbers]

    def change(self, keys: DataFrame, merge: Callable[[DataFrame], DataFrame], files: int | None = None) -> Change:
        """Rewrites the files that hold one of `keys` (a column of the key's name) as what `merge` makes of their rows, which may
        add rows with other keys. `merge` must leave rows with other keys as they are, since not all of them are given to it."""
        version = self.versions()[-1]
        known = self.manifest(version).limit(FILES + 1).collect()
        if len(known) > FILES:
            raise ValueError(f"more than {FILES} files")
        asked = keys.select(self.key).distinct().persist()
        maybe = self._candidates(known, asked) if known else []
        path = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
        holding = self._rows(maybe).select(self.key, path.alias("_name")).join(asked, self.key, "left_semi").select("_name").distinct().collect() if maybe else []
        names = {r["_name"] for r in holding}
        touched = [r for r in maybe if r.file.rpartition("/")[2] in names]
        fresh = self._write(merge(self._rows(touched)), files)
        stay = {r.file for r in known} - {r.file for r in touched}
        kept = self.spark.createDataFrame([r for r in known if r.file in stay], self.manifest(version).schema)
        self._commit(kept.unionByName(fresh), version + 1)
        asked.unpersist()
        return Change(version + 1, len(maybe), len(touched), len(stay), self.manifest(version + 1).count() - len(stay))

    def replace(self, fresh: DataFrame, files: int | None = None) -> Change:
        """Rows with the keys of `fresh` give way to them."""
        keys = fresh.select(self.key).distinct()
        return self.change(keys, lambda old: old.join(keys, self.key, "left_anti").unionByName(fresh), files)

    def update(self, where: Column, columns: dict[str, Column], files: int | None = None) -> Change:
        """New values in the rows for which `where` holds; files without such a row stay."""
        keys = self.read().where(where).select(self.key)
        return self.change(keys, lambda old: old.withColumns({c: F.when(where, v).otherwise(F.col(c)) for c, v in columns.items()}), files)

    def vacuum(self, keep: int = 2) -> int:
        """Removes all but the newest `keep` versions and the folders that none of these uses; how many folders went."""
        known = self.versions()
        used = {r.file.rpartition("/")[0] for v in known[-keep:] for r in self.manifest(v).select("file").collect()}
        for v in known[:-keep]:
            self._fs.delete(self._java_path(f"{self.path}/manifests/{v:08d}"), True)
        gone = [f.getPath() for f in self._fs.listStatus(self._java_path(f"{self.path}/data")) if f"data/{f.getPath().getName()}" not in used]
        for folder in gone:
            self._fs.delete(folder, True)
        return len(gone)
