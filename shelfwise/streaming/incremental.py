"""Incremental feed load: run files arrive, tables grow, repeated records add nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.loading import insert_ignore
from shelfwise.session import scratch_path
from shelfwise.sources.schema import empty


def stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Table written by batches so far; empty before the first one."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return empty(spark, schema)
    return spark.read.schema(schema).parquet(path)


def load_new_keys(batch: DataFrame, batch_id: int, path: str, key: str, order: list[str]) -> None:
    """Append the batch's new keys to its own folder; a replayed batch overwrites just that.

    Folders of later or equal batch ids are left out of the comparison, so a replay sees the
    same target as the first try.
    """
    spark = batch.sparkSession
    schema = T.StructType(batch.schema.fields + [T.StructField("batch", T.LongType())])
    target = stored(spark, path, schema).filter(F.col("batch") < batch_id)
    added = insert_ignore(target, batch, key, order)
    added.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def load_facts(batch: DataFrame, batch_id: int, path: str) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def run_available(
    spark: SparkSession, feed_dir: str, schema: T.StructType, loader, checkpoint: str, bytes_per_batch: str | None = None,
) -> None:
    """Load the files that are new since the last call with this checkpoint, and stop.

    One batch takes all of them, unless the caller sets a size ("10g").
    """
    reader = spark.readStream.schema(schema)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    query = (
        reader.json(feed_dir).writeStream.foreachBatch(loader).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())
    query.awaitTermination()


def load_feed(
    spark: SparkSession, feed_dir: str, schema: T.StructType, key: str, order: list[str],
    fact_columns: list[str], target: str, checkpoint: str, bytes_per_batch: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(dimension rows, fact rows) in the folder `target` after loading what is new below `feed_dir`.

    Target and checkpoint are the caller's and stay: the next call adds only new files.
    """
    dim_path, fact_path = f"{target}/dim", f"{target}/facts"
    dim_columns = [f.name for f in schema.fields if f.name not in fact_columns or f.name in (key, *order)]

    def loader(batch: DataFrame, batch_id: int) -> None:
        good = batch.filter(F.col(key).isNotNull())
        load_new_keys(good.select(*dim_columns), batch_id, dim_path, key, order)
        load_facts(good.select(*dict.fromkeys([key, *fact_columns])), batch_id, fact_path)

    run_available(spark, feed_dir, schema, loader, checkpoint, bytes_per_batch)
    return spark.read.parquet(dim_path).drop("batch"), spark.read.parquet(fact_path).drop("batch")


def first_seen(spark: SparkSession, feed_dir: str, schema: T.StructType, key: str) -> DataFrame:
    """Keys of all run files, each once: stateful de-duplication within the stream.

    The state holds one entry per key. Rows of a key are interchangeable here, so which
    one the stream meets first does not matter.
    """
    out = scratch_path(spark, "keys")
    stream = spark.readStream.schema(schema).json(feed_dir).select(key).dropDuplicates([key])
    query = (
        stream.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "stream"))
        .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(out)
