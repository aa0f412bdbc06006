"""Mixing sources to target weights by systematic sampling. DataFrame operations only.

Method: documents of a source stand in a fixed order; the running sum of their expected copies,
plus one random offset of the source, crosses an integer boundary once per emitted copy.
Within a source every document expects the same number of copies, so the running sum is that
rate times the document's place. The order is by size, which also spreads the copies evenly
over sizes: the words taken stay within a few of the largest documents' sizes of the target.

Defined results: null text has size 0; null source is a source of its own, last; a source
without words takes nothing; repeated rows count as rows of their own; ties of size are ordered
by a hash of the id; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import global_index
from shelfwise.session import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
SEED = "mix-1"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """sizes(source, source_size), one row per source -> also target, rate (copies per document).

    Targets are level * weight up to most * size. The level rises as sources reach their limit,
    found by a few sums over all sources; only those sums reach the driver.
    """
    ranked = global_index(
        sizes.withColumn("_all", F.lit(1)), [F.col("_all"), F.col("source").asc_nulls_last()], ["_all"], "mix-sources", "_place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_place") - 1) % len(weights) + 1).cast("int"))
    ranked = materialise(
        ranked.withColumn("_weight", weight).withColumn("_most", F.col("source_size") * F.lit(float(most))).drop("_all"), "mix-weights")
    level, held = None, None
    while True:
        full = F.lit(False) if level is None else F.col("_most") <= F.lit(level) * F.col("_weight")
        total, stopped, open_weight = ranked.agg(
            F.sum("source_size"), F.sum(F.when(full, F.col("_most"))), F.sum(F.when(~full, F.col("_weight")))).first()
        if not open_weight or stopped == held and level is not None:
            break
        held, level = stopped, (share * (total or 0) - (stopped or 0.0)) / open_weight
    level = level or 0.0
    full = F.col("_most") <= F.lit(level) * F.col("_weight")
    target = F.when(full, F.col("_most")).otherwise(F.lit(level) * F.col("_weight"))
    rate = F.when(full, F.lit(float(most))).otherwise(target / F.col("source_size"))
    return ranked.select(
        "source", "source_size", target.alias("target"),
        F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(rate).alias("rate"))


def offset(source: Column, seed: str) -> Column:
    """A number in [0, 1) from the seed and the source."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("="), source), F.lit("-"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(
    docs: DataFrame, key: str = "doc_id", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
    most: float = MOST, seed: str = SEED,
) -> DataFrame:
    """docs(key, text, source) -> key, source, size, source_size, target, copies, taken."""
    thin = materialise(docs.select(
        F.col(key).alias("key"), "source", size_of(F.col("text")).alias("size"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary")).alias("tie")), "mix-sizes")
    sizes = thin.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(materialise(sizes, "mix-source-sizes"), weights, share, most).withColumnRenamed("source", "_source")
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("tie"), F.col("key").asc_nulls_last()]
    placed = global_index(thin, order, ["source"], "mix-order", "place")
    joined = placed.join(goal, F.col("source").eqNullSafe(F.col("_source")))
    step = lambda k: F.floor(k * F.col("rate") + offset(F.col("source"), seed))
    copies = (step(F.col("place")) - step(F.col("place") - 1)).cast("long")
    return joined.select(
        F.col("key").alias(key), "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"))


def emit(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of docs as often as its copies say, with its own columns.

    Rows are read twice, so their numbers are written with them: numbers given to a scan change
    with its splits, which follow the cores there are when it is planned.
    """
    numbered = materialise(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "mix-docs")
    copies = mix(numbered.select("_mix_row", "text", "source"), key="_mix_row", **options).where("copies > 0")
    return (
        numbered.join(copies.select("_mix_row", F.col("copies").alias("_mix_copies")), "_mix_row")
        .withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(*docs.columns))
