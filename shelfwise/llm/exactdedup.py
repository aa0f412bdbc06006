"""Exact deduplication as a stream with keyed state on disk.

Method: documents arrive in micro-batches. Each row's normalised text is reduced to a digest, and a
streaming aggregation keeps, per digest and for ever, in RocksDB: the content locator of the first
text that came with it (file and row of the source), the stable identifier of the row that stays,
and how many rows there are. A batch's rows whose digest is known already, or comes twice, are
hits: their texts are fetched by locator, together with the first one's, and compared on all
bytes. Texts that share a digest and differ are noted, and grouped by their bytes instead.

Equal digests are summed in the map tasks before they are shuffled, so a text with a third of all
rows costs one state row per task. Only hits move with their texts. The stream continues where it
stopped: `Store.advance` takes the files that are new since the last call, and a replayed batch
overwrites what it wrote. Source files have to stay as they are, as locators point into them.

Defined results: null text counts as empty; equal means the same after lower-casing A-Z; the row
with the largest doc_id stays, a null doc_id being less than any; of rows that repeat both id and
text the first one read stays; a group without ids has keep_id null and keeps its first row; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import materialise, scratch_path

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Each partition's store would set aside megabytes that it never fills.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
# A locator is a file's number and a row's place in it; with an id before it, it fits 38 digits.
PLACE_BITS, LOCATOR_BITS = 32, 62
ARRIVALS = "doc_id long, path string, place long, sha string, batch long"
FILES = "path string, file long, batch long"
DIGESTS = "digest string, first long, keep decimal(38,0), keep_id long, n long, oldest long, newest long, run long"
CLASHES = "digest string, run long"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def own_digest(sha: Column) -> Column:
    return sha


class Store:
    """The documents of `source`, a Parquet file or folder that may get more files, deduplicated.

    Everything it knows lies below `root`, in the folder that all executors share.
    """

    def __init__(
        self, spark: SparkSession, source: str, root: str | None = None, digest: Callable[[Column], Column] = own_digest,
        files_per_batch: int | None = None,
    ):
        self.spark, self.source, self.digest, self.files_per_batch = spark, source.rstrip("/"), digest, files_per_batch
        self.root = root or scratch_path(spark, "exact")
        for name, schema in (("arrivals", ARRIVALS), ("files", FILES), ("digests", DIGESTS), ("clashes", CLASHES)):
            fields, part = schema.rsplit(", ", 1)[0], schema.rsplit(", ", 1)[1].split()[0]
            spark.createDataFrame([], fields).write.mode("ignore").parquet(f"{self.root}/{name}/{part}=-1")

    def table(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def advance(self) -> Store:
        """Take in the files that are new since the last call."""
        before = {key: self.spark.conf.get(key, None) for key in ROCKSDB}
        for key, value in ROCKSDB.items():
            self.spark.conf.set(key, value)
        try:
            self._run(self._arriving(), self._note_arrivals, "arrivals", "append")
            self._run(self._state(), self._note_state, "state", "update")
        finally:
            for key, value in before.items():
                if value is None:
                    self.spark.conf.unset(key)
                else:
                    self.spark.conf.set(key, value)
        return self

    def _run(self, stream: DataFrame, note, name: str, mode: str) -> None:
        (stream.writeStream.outputMode(mode).foreachBatch(note).option("checkpointLocation", f"{self.root}/checkpoints/{name}")
         .trigger(availableNow=True).start().awaitTermination())

    # ---- arrivals: digest and place of every row

    def _arriving(self) -> DataFrame:
        schema = self.spark.read.parquet(self.source).schema
        reader = self.spark.readStream.schema(schema)
        if self.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)
        # as a pattern, a single file is taken too
        return reader.parquet(f"{self.source[:-1]}[{self.source[-1]}]").select(
            F.col("doc_id").cast("long"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("place"),
            F.sha2(normalised(F.col("text")).cast("binary"), 256).alias("sha"))

    def _note_arrivals(self, batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.root}/arrivals/batch={number}")
        files = self.table("files", FILES)
        known = files.where(F.col("batch") < number).count()
        # One row per source file, as many as the driver lists anyway.
        (self.table("arrivals", ARRIVALS).where(F.col("batch") == number).select("path").distinct()
         .coalesce(1).sortWithinPartitions("path").select("path", (F.monotonically_increasing_id() + known).alias("file"))
         .write.mode("overwrite").parquet(f"{self.root}/files/batch={number}"))

    def _located(self, arrivals: DataFrame) -> DataFrame:
        """Adds digest, locator, and rank: the id, then the earlier locator, in one number that a hash aggregate can hold."""
        files = self.table("files", FILES).select("path", "file")
        place = F.when(F.col("place") < 1 << PLACE_BITS, F.col("place")).otherwise(F.raise_error(F.lit("too many rows in a file")).cast("long"))
        locator = F.shiftleft(F.col("file"), PLACE_BITS) + place
        shifted = F.col("doc_id").cast("decimal(20,0)") * F.lit(1 << LOCATOR_BITS).cast("decimal(19,0)")
        return (
            arrivals.join(files, "path").withColumn("locator", locator).withColumn("digest", self.digest(F.col("sha")))
            .withColumn("rank", (shifted + (F.lit((1 << LOCATOR_BITS) - 1) - F.col("locator"))).cast("decimal(38,0)")))

    # ---- state: what is kept per digest

    def _state(self) -> DataFrame:
        arrivals = self.spark.readStream.schema(ARRIVALS).parquet(f"{self.root}/arrivals")
        return self._located(arrivals).groupBy("digest").agg(
            F.min("locator").alias("first"), F.max("rank").alias("keep"), F.max("doc_id").alias("keep_id"),
            F.count(F.lit(1)).alias("n"), F.min("batch").alias("oldest"), F.max("batch").alias("newest"))

    def _note_state(self, updates: DataFrame, number: int) -> None:
        updates.write.mode("overwrite").parquet(f"{self.root}/digests/run={number}")
        digests = self.table("digests", DIGESTS)
        since = digests.where(F.col("run") < number).agg(F.max("newest")).first()[0]
        since = -1 if since is None else since
        hits = digests.where((F.col("run") == number) & (F.col("n") > 1)).select("digest", "first", "oldest")
        new = self._located(self.table("arrivals", ARRIVALS).where(F.col("batch") > since))
        rows = new.select("digest", "locator").join(hits.select("digest"), "digest")
        older = hits.where(F.col("oldest") <= since).select("digest", F.col("first").alias("locator"))
        contents = self._contents(rows.unionByName(older)).select("digest", "content").distinct()
        (contents.groupBy("digest").count().where(F.col("count") > 1).select("digest")
         .write.mode("overwrite").parquet(f"{self.root}/clashes/run={number}"))

    def _contents(self, places: DataFrame) -> DataFrame:
        """places(locator, ...) -> the same with the whole normalised text at the locator."""
        texts = self.spark.read.parquet(self.source).select(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("place"), normalised(F.col("text")).alias("content"))
        files = self.table("files", FILES).select("path", "file")
        texts = texts.join(files, "path").select((F.shiftleft(F.col("file"), PLACE_BITS) + F.col("place")).alias("locator"), "content")
        return places.join(texts, "locator")

    # ---- result

    def members(self) -> DataFrame:
        """Every row taken in so far: doc_id, keep_id, group_size, kept, text_sha256."""
        rows = self._located(self.table("arrivals", ARRIVALS))
        # All of these only grow or only fall, so the latest state is the extreme one. Stored, so
        # that a hot digest of the join can be split.
        latest = materialise(self.table("digests", DIGESTS).groupBy("digest").agg(
            F.min("first").alias("first"), F.max("keep").alias("keep"), F.max("keep_id").alias("keep_id"), F.max("n").alias("n")), "exact-latest")
        clashes = self.table("clashes", CLASHES).select("digest").distinct()
        if clashes.isEmpty():
            return self._judged(rows.join(latest, "digest"))
        shared = self._contents(rows.join(clashes, "digest", "left_semi"))
        groups = materialise(shared.groupBy("content").agg(
            F.min("locator").alias("first"), F.max("rank").alias("keep"), F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")), "exact-texts")
        return self._judged(rows.join(clashes, "digest", "left_anti").join(latest, "digest")).unionByName(
            self._judged(shared.join(groups, "content")))

    def _judged(self, rows: DataFrame) -> DataFrame:
        kept = F.when(F.col("keep").isNull(), F.col("locator") == F.col("first")).otherwise(F.col("rank").eqNullSafe(F.col("keep")))
        return rows.select("doc_id", "keep_id", F.col("n").alias("group_size"), kept.alias("kept"), F.col("sha").alias("text_sha256"))


def duplicates(spark: SparkSession, source: str, **options) -> DataFrame:
    """All documents of the Parquet file or folder `source` -> doc_id, keep_id, group_size, kept, text_sha256."""
    return Store(spark, source, **options).advance().members()
