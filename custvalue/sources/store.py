"""A keyed store of rows in a folder: upserts, point lookups and whole replacement.

Rows lie in Parquet files by hash bucket of their key. A change writes new files for the buckets
that it touches and then a manifest, which names the files of every bucket; a version counts once
its manifest is in its place, where it comes by one rename. Readers see the last version that
counts, so a write that fails leaves the old state, and of two writers from one version the
second is refused. Untouched buckets are not read or written.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64


class Conflict(RuntimeError):
    """Another writer has made the next version."""


class KeyedStore:
    """Rows by key; the schema and the number of buckets are fixed by the first write.

    Of rows that repeat a key within one change the one with the greatest other columns counts.
    A null key is a key. The driver holds the names of a file folder for each bucket.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    # Files

    def _files(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path, hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, folder: str) -> list[str]:
        path, files = self._files(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []

    def version(self) -> int:
        """Number of the last version; 0 before the first write."""
        found = [re.fullmatch(r"(\d+)\.json", name) for name in self._listed("manifests")]
        return max((int(m[1]) for m in found if m), default=0)

    def _manifest(self, version: int) -> dict:
        if not version:
            return {"buckets": self.buckets, "schema": None, "folders": {}}
        lines = self.spark.read.text(f"{self.path}/manifests/{version}.json", wholetext=True)
        return json.loads(lines.first()[0])

    def _commit(self, version: int, manifest: dict) -> None:
        """Put a manifest in its place, which is free or a conflict."""
        draft, files = self._files(f"{self.path}/drafts/{uuid.uuid4().hex}.json")
        out = files.create(draft, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        place, _ = self._files(f"{self.path}/manifests/{version}.json")
        files.mkdirs(place.getParent())
        if files.exists(place) or not files.rename(draft, place):
            raise Conflict(f"version {version} of {self.path} is there already")

    # Rows

    def _bucket(self, key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def _single(self, rows: DataFrame, buckets: int) -> DataFrame:
        """One row for each key, with its bucket."""
        others = [c for c in rows.columns if c != self.key]
        best = F.max(F.struct(F.lit(0).alias("_"), *others)).alias("_best")
        chosen = rows.groupBy(self.key).agg(best).select(self.key, *(F.col(f"_best.{c}").alias(c) for c in others))
        return chosen.select(*rows.columns, self._bucket(F.col(self.key), buckets).alias("_bucket"))

    def _read(self, manifest: dict, buckets: list[int]) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        folders = [manifest["folders"][str(b)] for b in buckets if str(b) in manifest["folders"]]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{f}" for f in folders))

    def _write(self, rows: DataFrame, buckets: list[int]) -> dict[str, str]:
        """Write whole buckets; the folder of each that has rows."""
        name = f"data/{uuid.uuid4().hex}"
        rows.repartition(len(buckets) or 1, "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{name}")
        found = (re.fullmatch(r"_bucket=(\d+)", n) for n in self._listed(name))
        return {m[1]: f"{name}/{m[0]}" for m in found if m}

    def upsert(self, rows: DataFrame) -> int:
        """Insert rows or replace those of the same key; the number of the new version."""
        before = self.version()
        manifest = self._manifest(before)
        if manifest["schema"] is None:
            manifest["schema"] = json.loads(rows.schema.json())
        schema = T.StructType.fromJson(manifest["schema"])
        if [(f.name, f.dataType) for f in rows.schema] != [(f.name, f.dataType) for f in schema]:
            raise ValueError(f"the columns of the store are {schema.simpleString()}")
        new = self._single(rows, manifest["buckets"]).persist()
        try:
            touched = sorted(r[0] for r in new.select("_bucket").distinct().collect())
            old = self._read(manifest, touched)
            old = old.withColumn("_bucket", self._bucket(F.col(self.key), manifest["buckets"]))
            keys = new.select(F.col(self.key).alias("_key"))
            stays = old.join(keys, old[self.key].eqNullSafe(keys["_key"]), "left_anti")
            manifest["folders"] |= self._write(stays.unionByName(new), touched)
        finally:
            new.unpersist()
        self._commit(before + 1, manifest)
        return before + 1

    def replace(self, rows: DataFrame) -> int:
        """Make rows the whole content, at once; the number of the new version."""
        before = self.version()
        manifest = self._manifest(before) | {"schema": json.loads(rows.schema.json())}
        single = self._single(rows, manifest["buckets"])
        manifest["folders"] = self._write(single, list(range(manifest["buckets"])))
        self._commit(before + 1, manifest)
        return before + 1

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of the last version, or of an earlier one that is kept."""
        manifest = self._manifest(self.version() if version is None else version)
        if manifest["schema"] is None:
            raise FileNotFoundError(f"nothing was written to {self.path}")
        return self._read(manifest, list(range(manifest["buckets"])))

    def lookup(self, value) -> DataFrame:
        """The row of a key, from the files of its bucket alone."""
        manifest = self._manifest(self.version())
        if manifest["schema"] is None:
            raise FileNotFoundError(f"nothing was written to {self.path}")
        kind = T.StructType.fromJson(manifest["schema"])[self.key].dataType
        wanted = F.lit(value).cast(kind)
        bucket = self.spark.range(1).select(self._bucket(wanted, manifest["buckets"])).first()[0]
        return self._read(manifest, [bucket]).where(F.col(self.key).eqNullSafe(wanted))

    def prune(self, keep: int = 1) -> None:
        """Remove what only versions before the last ``keep`` refer to; for the store's owner."""
        last = self.version()
        kept = [v for v in range(max(1, last - keep + 1), last + 1)]
        used = {f.split("/")[1] for v in kept for f in self._manifest(v)["folders"].values()}
        for name in self._listed("manifests"):
            if (m := re.fullmatch(r"(\d+)\.json", name)) and int(m[1]) not in kept:
                path, files = self._files(f"{self.path}/manifests/{name}")
                files.delete(path, False)
        for name in self._listed("data"):
            if name not in used:
                path, files = self._files(f"{self.path}/data/{name}")
                files.delete(path, True)
