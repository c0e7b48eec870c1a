"""Versioned tables in hash buckets of their patient.

A version is a manifest: for each table, which version's folder holds each bucket. Writing a version rewrites the buckets that its
rows touch and names the older files of all others, so a small batch costs a small read and a small write. The manifest is
written last and thereby commits the version; doing a version again overwrites its own files and nothing else. Files and manifests
that neither of the last two versions names are removed.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.session import drop_paths

#: Small for tests and small tables; a production table takes as many as bring a bucket to some hundred MB.
BUCKETS = 32

BUCKET, VERSION = "bucket", "v"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def touched_buckets(rows: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets of a batch: at most ``buckets`` numbers."""
    found = rows.select(bucket_of(F.col(key), buckets).alias(BUCKET)).distinct().collect()
    return sorted(r[BUCKET] for r in found)


class BucketStore:
    """Tables (name: key column and schema) under one folder."""

    def __init__(
        self, spark: SparkSession, root: str, tables: Mapping[str, tuple[str, T.StructType]], buckets: int = BUCKETS
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = dict(tables)
        self.buckets = buckets
        # Manifests read or written by this object; one stream writes a folder, so they stay as they are.
        self._known: dict[int, dict] = {}

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifest/v={version}"

    def _folders(self, path: str) -> list[str]:
        """Names of the sub-folders of a path."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(folder):
            return []
        return [f.getPath().getName() for f in system.listStatus(folder) if f.isDirectory()]

    def latest(self) -> int:
        """The last committed version, -1 if there is none."""
        return max((int(name.split("=")[1]) for name in self._folders(f"{self.root}/manifest")), default=-1)

    def manifest(self, version: int) -> dict:
        """``files``: {table: {bucket: version}}; ``facts``: what the caller stored with the version."""
        if version < 0:
            return {"files": {name: {} for name in self.tables}, "facts": {}}
        if version not in self._known:
            text = self.spark.read.text(self._manifest_path(version), wholetext=True).first()[0]
            self._known[version] = json.loads(text)
        return self._known[version]

    def read(self, name: str, version: int, buckets: Iterable[int] | None = None) -> DataFrame:
        """A table, or some of its buckets, with the version that wrote each row in column ``v``."""
        schema = T.StructType([*self.tables[name][1].fields, T.StructField(VERSION, T.IntegerType())])
        files = self.manifest(version)["files"][name]
        wanted = files if buckets is None else {str(b) for b in buckets} & set(files)
        paths = [f"{self.root}/{name}/{VERSION}={files[b]}/{BUCKET}={b}" for b in sorted(wanted, key=int)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        whole = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        reader = self.spark.read.schema(whole).option("basePath", f"{self.root}/{name}")
        return reader.parquet(*paths).select(*schema.fieldNames())

    def written(self, name: str, version: int) -> DataFrame:
        """The rows that a version itself wrote."""
        return self.spark.read.schema(self.tables[name][1]).parquet(f"{self.root}/{name}/{VERSION}={version}")

    def commit(
        self, version: int, frames: Mapping[str, DataFrame], touched: Iterable[int], facts: Callable[[], dict] = dict
    ) -> None:
        """Write the rows of the touched buckets (all of their rows) and the manifest; ``facts`` is asked once the rows are written."""
        before = self.manifest(version - 1)
        gone = {str(b) for b in touched}
        files = {}
        for name, (key, schema) in self.tables.items():
            kept = {b: v for b, v in before["files"][name].items() if name not in frames or b not in gone}
            if name in frames:
                path = f"{self.root}/{name}/{VERSION}={version}"
                rows = frames[name].select(*schema.fieldNames(), bucket_of(F.col(key), self.buckets).alias(BUCKET))
                # Rows of a bucket meet in one task unless it is a large one: then the hint lets Spark split it.
                rows.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)
                kept |= {f.split("=")[1]: version for f in self._folders(path) if f.startswith(f"{BUCKET}=")}
            files[name] = kept
        text = json.dumps({"files": files, "facts": facts()})
        self.spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(
            self._manifest_path(version)
        )
        self._known[version] = json.loads(text)
        self._forget(version)

    def _forget(self, version: int) -> None:
        """Remove the manifest two versions back and the files that only it named."""
        if version < 2 or f"v={version - 2}" not in self._folders(f"{self.root}/manifest"):
            return
        old = self.manifest(version - 2)["files"]
        live = [self.manifest(v)["files"] for v in (version - 1, version)]
        self._known.pop(version - 2)
        drop_paths(
            self.spark,
            [
                f"{self.root}/{name}/{VERSION}={v}/{BUCKET}={b}"
                for name in old
                for b, v in old[name].items()
                if all(files[name].get(b) != v for files in live)
            ]
            + [self._manifest_path(version - 2)],
        )
