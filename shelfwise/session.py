"""Session helpers: reading tables, shared scratch space, cutting lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings the plans rely on. All of them react to measured sizes.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key of a join even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def compile_wide_rows(spark: SparkSession) -> SparkSession:
    """For plans that compute many columns in one step: the JVM never compiles a generated method of more than 8,000
    bytes, so Spark is told to generate one per column group instead of one for the step.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scan for work that is heavy per row: used as it is, unless fewer of its partitions hold rows
    than there are cores. So only inputs smaller than the cluster are shuffled, never large ones.

    For plain scans with filters and projections only. A file is cut by bytes, and a cut in which no row group
    begins is an empty partition. The rows are counted behind the shuffle, where the count must see all of them: a
    filter of a later step else moves before the shuffle, with all that it computes, into the few tasks of the scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores and df.select(F.spark_partition_id()).distinct().count() >= cores:
        return df
    return df.repartition(cores).observe(f"spread-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names for checkpoints.

    Only a local session without that setting gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    own = tempfile.mkdtemp(prefix="shelfwise-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path not used before, below the shared folder."""
    return f"{shared_dir(spark)}/shelfwise/{name}-{uuid.uuid4().hex}"


# Parquet looks at sizes after 100 rows only, and is read a row group at a time: rows of megabytes need both bounded by bytes.
WIDE_ROWS = {"parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}


def materialise(df: DataFrame, name: str, wide: bool = False) -> DataFrame:
    """Write once and read back: cuts lineage, and survives the loss of executors. wide: rows may have megabytes."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").options(**WIDE_ROWS if wide else {}).parquet(path)
    return df.sparkSession.read.parquet(path)


def bucketed(df: DataFrame, key: str, name: str, wide: bool = False) -> DataFrame:
    """Write once, dealt into buckets by the key: joins and sums by it do not shuffle these rows again."""
    spark = df.sparkSession
    buckets, made = int(spark.conf.get("spark.sql.shuffle.partitions")), f"{name}_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.options(**WIDE_ROWS if wide else {}).bucketBy(buckets, key).format("parquet").option("path", scratch_path(spark, name)).saveAsTable(made)
    return spark.table(made)
