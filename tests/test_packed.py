"""First and last rows as packed numbers against the same choice by structs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import loading, packed

COLUMNS = "k int, day date, run long, at timestamp, flag boolean, cents long"


def snapshots(n, wide, seed=3):
    """A third under one key, some without; nulls anywhere; many ties in day and run, some whole rows twice."""
    r = random.Random(seed)
    big = 1 << 40 if wide else 50
    out = []
    for i in range(n):
        row = (
            None if i % 13 == 0 else 0 if i % 3 == 0 else r.randrange(25),
            r.choice([None, dt.date(2024, 1, 1 + r.randrange(5)), dt.date(1969, 12, 30)]),
            r.choice([None, -r.randrange(big), r.randrange(big)]),
            r.choice([None, dt.datetime(2024, 1, 1, 0, 0, r.randrange(60), r.randrange(1000))]),
            r.choice([None, True, False]), r.choice([None, -5, r.randrange(1 << (30 if wide else 9))]))
        out += [row] * r.choice([1, 1, 2])
    return out


def same(a, b):
    return a.schema.simpleString() == b.schema.simpleString() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("wide, words", [(False, 1), (True, 2)])
def test_equals_structs(spark, wide, words):
    df = spark.createDataFrame(snapshots(700, wide), COLUMNS)
    df = df if wide else df.drop("at")
    order = ["day", "run"]
    assert len(packed.measure(df, [c for c in df.columns if c != "k"]).words) == words
    assert same(packed.last_per_key(df, ["k"], order), loading.last_per_key(df, ["k"], order))
    assert same(packed.first_per_key(df, ["k"], order), loading.first_per_key(df, ["k"], order))


def test_hash_aggregation_only(spark):
    df = spark.createDataFrame(snapshots(50, True), COLUMNS)
    plan = packed.last_per_key(df, ["k"], ["day", "run"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert "SortAggregate" in loading.last_per_key(df, ["k"], ["day", "run"])._jdf.queryExecution().executedPlan().toString()


def test_rows_that_do_not_fit(spark):
    texts = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, None, None)], "k int, run long, v string")
    assert packed.measure(texts, ["run", "v"]) is None
    assert same(packed.last_per_key(texts, ["k"], ["run"]), loading.last_per_key(texts, ["k"], ["run"]))
    far = spark.createDataFrame([(1, -(1 << 63), 1), (1, (1 << 63) - 1, 2)], "k int, run long, v long")
    assert packed.measure(far, ["run", "v"]) is None
    assert packed.last_per_key(far, ["k"], ["run"]).first()["v"] == 2


def test_empty_and_all_null(spark):
    none = spark.createDataFrame([], COLUMNS)
    assert packed.last_per_key(none, ["k"], ["day"]).count() == 0
    nulls = spark.createDataFrame([(1, None, None, None, None, None)] * 3, COLUMNS)
    assert packed.first_per_key(nulls, ["k"], ["day"]).collect() == [(1, None, None, None, None, None)]


def test_a_source_that_grows_meanwhile_is_noticed(spark, tmp_path):
    path = str(tmp_path / "grows")
    spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("run")).write.parquet(path)
    chosen = packed.measure(spark.read.parquet(path), ["run"])
    later = spark.createDataFrame([(1, 10)], "k long, run long")
    with pytest.raises(Exception, match="measured range"):
        later.select(chosen.number()).collect()
