"""Partitioned Parquet tables whose partitions are replaced atomically."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.sources.files import Files

NONE = "none"


class VersionedTable:
    """Every partition is a folder of Parquet files under a fresh name; ``manifest.json`` names the folders that are valid.

    A write puts the new partitions under new names and then replaces the manifest in one atomic rename: readers see all of a
    write or nothing of it, and a job that dies halfway leaves only unreferenced folders (``vacuum`` removes them). The file
    system must rename a file over another atomically (local, NFS, HDFS do). One writer at a time. Readers prune by partition through the
    manifest, so a read of one partition lists one folder.
    """

    def __init__(self, spark: SparkSession, root: str, partition: Column, schema: T.StructType | None = None):
        self.spark, self.root, self.partition, self.schema, self.files = spark, root, partition, schema, Files(spark)

    def manifest(self) -> dict:
        text = self.files.read(f"{self.root}/manifest.json")
        return json.loads(text) if text else {"version": 0, "parts": {}}

    def partitions(self) -> list[str]:
        return sorted(self.manifest()["parts"])

    def read(self, only: Iterable[str] | None = None) -> DataFrame | None:
        """The rows of all or some partitions; an empty frame of the table's schema, or None without one, if there are none."""
        parts = self.manifest()["parts"]
        paths = [f"{self.root}/{parts[p]}" for p in (parts if only is None else only) if p in parts]
        if not paths:
            return None if self.schema is None else self.spark.createDataFrame([], self.schema)
        reader = self.spark.read if self.schema is None else self.spark.read.schema(self.schema)
        return reader.parquet(*paths)

    def part(self) -> Column:
        return F.coalesce(self.partition.cast("string"), F.lit(NONE))

    def replace(self, df: DataFrame, partitions: Iterable[str] | None = None) -> list[str]:
        """Write ``df`` as the whole content of the partitions it holds; those listed beyond them become empty."""
        m = self.manifest()
        folder = f"v{m['version'] + 1}-{uuid.uuid4().hex[:8]}"
        # one writer task per partition and slice of it: no task holds a file open for every partition
        df.withColumn("_folder", self.part()).repartition("_folder").write.partitionBy("_folder").parquet(f"{self.root}/{folder}")
        new = {n.removeprefix("_folder="): f"{folder}/{n}" for n in self.files.names(f"{self.root}/{folder}") if n.startswith("_folder=")}
        for p in set(partitions or ()) - set(new):
            m["parts"].pop(p, None)
        m["parts"] |= new
        self._commit(m)
        return sorted(new)

    def drop(self, partitions: Iterable[str]) -> list[str]:
        """Forget partitions (retention); returns those that existed."""
        m = self.manifest()
        gone = [p for p in partitions if m["parts"].pop(p, None)]
        if gone:
            self._commit(m)
        return gone

    def vacuum(self) -> list[str]:
        """Remove folders that no partition refers to."""
        used = {f.split("/")[0] for f in self.manifest()["parts"].values()}
        gone = [n for n in self.files.names(self.root) if n.startswith("v") and n not in used]
        for n in gone:
            self.files.delete(f"{self.root}/{n}")
        return gone

    def _commit(self, m: dict) -> None:
        m["version"] += 1
        self.files.write(f"{self.root}/manifest.json", json.dumps(m))
