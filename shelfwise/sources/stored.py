"""Stored tables loaded by key, in versions.

A table is a folder of versions, each a Parquet table bucketed by the key. A load joins its rows, which
are shuffled into as many buckets, with the current version, which is read bucket by bucket and
not shuffled, and writes the next version. That counts once its commit marker is there: a load
that fails leaves the version before as the current one, and readers never see half a load. Loads
are the rules of `operators.loading`, so a feed that is loaded again changes nothing. One
writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfwise.operators import loading

MARKER = "_SUCCESS"


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, buckets: int):
        self.spark, self.root, self.schema, self.key, self.buckets = spark, root.rstrip("/"), schema, key, buckets

    def versions(self) -> list[str]:
        """Folders of the versions that were written whole, oldest first."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        whole = [s.getPath() for s in files.listStatus(path) if files.exists(s.getPath().suffix(f"/{MARKER}"))]
        return sorted((str(p.toString()) for p in whole), key=lambda p: int(p.rsplit("/", 1)[1].split("-")[1]))

    def read(self, version: int = -1) -> DataFrame:
        """The current version, or an earlier one; empty before the first load."""
        found = self.versions()
        if not found:
            return self.spark.createDataFrame([], self.schema)
        name = f"stored_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS "
            f"LOCATION '{found[version]}'")
        return self.spark.table(name)

    def insert_ignore(self, new: DataFrame, order: Sequence[str], required: Sequence[str] = ()) -> KeyedTable:
        return self._load(lambda old: loading.loaded_ignore(old, new, self.key, order, required))

    def replace(self, new: DataFrame, order: Sequence[str]) -> KeyedTable:
        return self._load(lambda old: loading.replace_rows(old, new, self.key, order))

    def upsert(self, new: DataFrame) -> KeyedTable:
        """`new` holds one row per key; NULL keeps what is stored."""
        return self._load(lambda old: loading.upsert_coalesce(old, new, [self.key]))

    def _load(self, rule: Callable[[DataFrame], DataFrame]) -> KeyedTable:
        done = self.versions()
        number = int(done[-1].rsplit("/", 1)[1].split("-")[1]) + 1 if done else 0
        rows = rule(self.read()).select(*[f.name for f in self.schema])
        if not done:
            rows = rows.repartition(self.buckets, self.key)
        rows.write.bucketBy(self.buckets, self.key).format("parquet").option(
            "path", f"{self.root}/version-{number}-{uuid.uuid4().hex}").saveAsTable(f"stored_{uuid.uuid4().hex}")
        return self
