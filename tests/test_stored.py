"""Stored tables: loads by key, again, failed, and their plans."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import scratch_path
from shelfwise.sources.stored import KeyedTable

SCHEMA = T.StructType().add("k", "long").add("line", "long").add("name", "string").add("price", "long")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def rows(table):
    return sorted((tuple(r) for r in table.collect()), key=str)


@pytest.fixture
def made(spark):
    return KeyedTable(spark, scratch_path(spark, "stored"), SCHEMA, "k", 4)


FIRST = [(i, i, f"n{i}", 10 * i) for i in range(20)] + [(3, 99, "later", 0)]


def test_loads_and_loads_again(spark, made):
    assert rows(made.read()) == []
    first = frame(spark, FIRST)
    want = sorted(FIRST[:20], key=str)
    assert rows(made.insert_ignore(first, ["line"]).read()) == want
    assert rows(made.insert_ignore(first, ["line"]).read()) == want
    changed = frame(spark, [(2, 1, "two", None), (2, 2, "zwei", 5), (50, 3, "new", 1)])
    want = sorted([r for r in want if r[0] != 2] + [(2, 2, "zwei", 5), (50, 3, "new", 1)], key=str)
    assert rows(made.replace(changed, ["line"]).read()) == want
    assert rows(made.replace(changed, ["line"]).read()) == want
    partly = frame(spark, [(2, None, None, 6), (60, 1, "sixty", None)])
    want = sorted([r for r in want if r[0] != 2] + [(2, 2, "zwei", 6), (60, 1, "sixty", None)], key=str)
    assert rows(made.upsert(partly).read()) == want
    assert rows(made.upsert(partly).read()) == want
    assert len(made.versions()) == 6 and rows(made.read(0)) == sorted(FIRST[:20], key=str)
    again = KeyedTable(spark, made.root, SCHEMA, "k", 4)
    assert rows(again.read()) == want


def test_failed_load_leaves_the_version_before(spark, made):
    made.insert_ignore(frame(spark, FIRST), ["line"])
    broken = frame(spark, [(7, 7, "x", 1)]).withColumn("price", F.raise_error(F.lit("broken feed")).cast("long"))
    with pytest.raises(Exception, match="broken feed"):
        made.replace(broken, ["line"])
    assert rows(made.read()) == sorted(FIRST[:20], key=str) and len(made.versions()) == 1
    assert len(made.replace(frame(spark, [(7, 7, "x", 1)]), ["line"]).versions()) == 2


def test_the_target_is_not_shuffled(spark, made):
    made.insert_ignore(frame(spark, FIRST), ["line"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        from shelfwise.operators import loading

        plan = loading.upsert_coalesce(made.read(), frame(spark, FIRST[:20]), ["k"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    scan = plan.index("Bucketed: true")
    # Only the feed's side has an exchange by key.
    assert plan.count("Exchange hashpartitioning(k") == 1 and plan.index("Exchange hashpartitioning(k") > scan
