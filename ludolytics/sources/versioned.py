"""Keyed tables in committed versions.

Rows lie in buckets by a hash of their key. A load writes only the buckets that its keys fall into, below a folder of its
own, and then a manifest that names the folders of every bucket; the greatest manifest is the table. Writing the manifest
is one rename, so a reader sees all of a load or nothing of it, and a load that dies leaves a folder that nobody reads and
the next attempt replaces. The manifest also holds the schema, the high-water mark and the last batch number, which spares
a load the scan of the stored rows.

A load reads the keys alone of the buckets that it touches. A bucket without a clash gets one folder more; one with a
clash, or with MOST_FOLDERS of them, is written anew without the replaced rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludolytics.sources.writers import batch_keys, staged

BUCKETS = 64
#: Folders of a bucket before a load joins them into one.
MOST_FOLDERS = 8


@dataclass(frozen=True)
class Manifest:
    """One version: its folders (bucket to versions), the rows' schema, the high-water mark as text, the last batch."""

    version: int
    buckets: int
    schema: T.StructType
    folders: dict[int, list[int]] = field(default_factory=dict)
    high: str | None = None
    batch_no: int | None = None

    def text(self) -> str:
        folders = {str(b): versions for b, versions in self.folders.items()}
        rest = {"version": self.version, "buckets": self.buckets, "high": self.high, "batch_no": self.batch_no}
        return json.dumps({**rest, "schema": json.loads(self.schema.json()), "folders": folders})

    @staticmethod
    def of(text: str) -> Manifest:
        x = json.loads(text)
        folders = {int(b): versions for b, versions in x["folders"].items()}
        return Manifest(x["version"], x["buckets"], T.StructType.fromJson(x["schema"]), folders, x["high"], x["batch_no"])


class VersionedTable:
    """A table of one row per key; ``path`` is a folder that all executors reach.

    Rows with a NULL key replace nothing and are never replaced; they are dealt to buckets by their content.
    One load runs at a time; a second one that ends later fails.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self._files, self._root = fs.FileSystem.from_uri(self.path)

    # ---- manifests

    def manifest(self) -> Manifest | None:
        """The committed version; None if nothing was ever loaded."""
        selector = fs.FileSelector(f"{self._root}/manifests", allow_not_found=True)
        names = [f.base_name for f in self._files.get_file_info(selector) if f.base_name.endswith(".json")]
        if not names:
            return None
        with self._files.open_input_stream(f"{self._root}/manifests/{max(names)}") as stream:
            return Manifest.of(stream.read().decode())

    def _commit(self, manifest: Manifest) -> None:
        folder = f"{self._root}/manifests"
        final, own = f"{folder}/{manifest.version:012d}.json", f"{folder}/.{uuid.uuid4().hex}"
        self._files.create_dir(folder, recursive=True)
        if self._files.get_file_info(final).type != fs.FileType.NotFound:
            raise RuntimeError(f"another load has committed version {manifest.version} of {self.path}")
        with self._files.open_output_stream(own) as stream:
            stream.write(manifest.text().encode())
        self._files.move(own, final)

    # ---- rows

    def _bucket(self, columns: list[str], buckets: int) -> Column:
        content = F.xxhash64(*(F.col(f"`{c}`") for c in columns))
        return F.pmod(F.coalesce(F.when(F.col(self.key).isNotNull(), F.xxhash64(self.key)), content), F.lit(buckets)).cast("int")

    def _rows(self, manifest: Manifest, buckets: list[int] | None = None) -> DataFrame:
        """Stored rows with ``_bucket``, of some buckets or all; only their folders are listed and read."""
        kept = manifest.folders if buckets is None else {b: manifest.folders[b] for b in buckets if b in manifest.folders}
        folders = [f"{self.path}/data/_version={v}/_bucket={b}" for b, versions in kept.items() for v in versions]
        schema = T.StructType([*manifest.schema, T.StructField("_version", T.LongType()), T.StructField("_bucket", T.IntegerType())])
        if not folders:
            return self.spark.createDataFrame([], schema).drop("_version")
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*folders).drop("_version")

    def read(self) -> DataFrame | None:
        """The rows of the committed version; None if nothing was ever loaded."""
        manifest = self.manifest()
        return None if manifest is None else self._rows(manifest).select(*(f"`{c}`" for c in manifest.schema.names))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The stored rows of ``keys`` (its column of the key's name); only their buckets are read."""
        manifest = self.manifest()
        if manifest is None:
            raise ValueError(f"nothing is stored at {self.path}")
        wanted = staged(keys.select(self.key).where(F.col(self.key).isNotNull()).distinct())
        found = wanted.select(self._bucket([self.key], manifest.buckets).alias("b")).distinct().collect()  # at most BUCKETS
        rows = self._rows(manifest, sorted(r["b"] for r in found)).drop("_bucket")
        return rows.join(batch_keys(wanted, self.key), self.key, "left_semi")

    # ---- loads

    def merge(
        self,
        new: DataFrame,
        mark: str | None = None,
        resolve: Callable[[DataFrame], DataFrame] | None = None,
        on_schema_change: str = "ignore",
        batch_no: int | None = None,
    ) -> int:
        """Store rows, which replace stored ones of the same key; returns the committed version.

        With ``mark`` only rows above the largest mark stored are taken (all by the first load, none if the table is there
        but has no mark). ``resolve`` makes them one row per key. A batch number that is not above the last one is a
        repeated batch and changes nothing. Columns that the table lacks are added with ``on_schema_change="append"`` and
        left out with ``"ignore"``; columns that the rows lack are NULL.
        """
        if on_schema_change not in ("ignore", "append"):
            raise ValueError(f"unknown schema change mode: {on_schema_change}")
        old = self.manifest()
        if old is not None and batch_no is not None and old.batch_no is not None and batch_no <= old.batch_no:
            return old.version
        if old is not None and mark:
            if old.high is None:
                return old.version
            new = new.where(F.col(mark) > F.lit(old.high).cast(new.schema[mark].dataType))
        rows = (resolve or (lambda df: df))(new)
        schema = rows.schema if old is None else old.schema
        if old is not None:
            added = [f for f in rows.schema if f.name not in schema.names]
            if on_schema_change == "append":
                schema = T.StructType([*schema, *added])
            rows = rows.select(*(f"`{c}`" for c in rows.columns if c in schema.names))
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        buckets = self.buckets if old is None else old.buckets
        batch = staged(rows.withColumn("_bucket", self._bucket(rows.columns, buckets)))
        # at most one row for each bucket
        touched = sorted(r[0] for r in batch.select("_bucket").distinct().collect())
        folders = {} if old is None else dict(old.folders)
        version = 1 if old is None else old.version + 1
        out, anew = batch, set()
        if old is not None and touched:
            keys = batch_keys(batch, self.key)
            stored = self._rows(old, touched)
            anew = {r[0] for r in stored.join(keys, self.key, "left_semi").select("_bucket").distinct().collect()}
            anew |= {b for b in touched if len(folders.get(b, [])) >= MOST_FOLDERS}
            if anew:
                kept = self._rows(old, sorted(anew)).join(keys, self.key, "left_anti")
                out = kept.unionByName(batch, allowMissingColumns=True)
        if touched:
            target = f"{self.path}/data/_version={version}"
            out.hint("rebalance", "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(target)
        for b in touched:
            folders[b] = [version] if b in anew else [*folders.get(b, []), version]
        high = old.high if old is not None else None
        if mark and touched:
            high = batch.agg(F.max(mark).cast("string")).first()[0] or high
        last = batch_no if batch_no is not None else (old.batch_no if old is not None else None)
        self._commit(Manifest(version, buckets, schema, folders, high, last))
        return version

    def vacuum(self) -> list[str]:
        """Delete folders of versions that the committed one does not name; for when no reader of an older one is left."""
        manifest = self.manifest()
        live = {v for versions in manifest.folders.values() for v in versions} if manifest else set()
        gone = []
        for info in self._files.get_file_info(fs.FileSelector(f"{self._root}/data", allow_not_found=True)):
            version = int(info.base_name.partition("=")[2] or 0)
            if manifest and version <= manifest.version and version not in live:
                self._files.delete_dir(info.path)
                gone.append(info.base_name)
        return sorted(gone)
