"""What the operators share: tables, folds, global order, word tokens, linked groups."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.session import materialise, table, tune

# Rows handed to Python at once: whole texts, so the bound is on rows of usual length.
BATCH_ROWS = "1000"
BATCH_BYTES = "64m"
BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepared(spark: SparkSession) -> SparkSession:
    spark = tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set(BYTES_SETTING, BATCH_BYTES)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def fold(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo parts; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts


def text_bytes(value: bytes | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, cut at the six ASCII white-space characters."""
    return value.lower().split() if value else []


def counted(texts: Iterable[list], most: int = 400_000) -> Iterator[Counter]:
    """Sums of the texts' words, given up whenever more than `most` different ones are held."""
    held: Counter = Counter()
    for words in texts:
        held.update(words)
        if len(held) > most:
            yield held
            held = Counter()
    if held:
        yield held


def global_index(df: DataFrame, order: list[Column], group: list[str], name: str, to: str) -> DataFrame:
    """Number the rows of each group from 1 in the given order, in long column `to`.

    Rows are range-partitioned on the whole order, so a hot group spreads over many tasks; only
    one row per partition and group meets in a window. `order` has to begin with the group.
    """
    placed = materialise(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()), name)
    runs = placed.groupBy("_part", *group).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).select(
        F.col("_part").alias("_run_part"), "_first", "_before", *[F.col(g).alias(f"_run_{g}") for g in group])
    same = F.col("_part") == F.col("_run_part")
    for g in group:
        same &= F.col(g).eqNullSafe(F.col(f"_run_{g}"))
    return (
        placed.join(runs, same)
        .withColumn(to, (F.col("_before") + F.col("_row") - F.col("_first") + 1).cast("long"))
        .select(*df.columns, to))


def components(edges: DataFrame, name: str, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable from each node of `edges` (a, b).

    Alternates large-star and small-star steps: each step is a minimum per node, reduced before
    the shuffle, and a join with one row per node on one side, so a hub is never gathered.
    Each round is written, so that lost executors cost one round at most.
    """
    links = materialise(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{name}-links")
    before = None
    for _ in range(rounds):
        links = materialise(_small_star(_large_star(links)), f"{name}-round")
        now = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    found = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.union(links.select("v", "v").distinct())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        both.where("v > u").join(least, "u").where("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(least, "u")
    return (
        joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", "m")).where("u <> v").distinct())


def rows_to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
