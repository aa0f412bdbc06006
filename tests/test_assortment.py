"""Assortment of pairs: the same counts as by listings, with one map of pairs a task."""

from pyspark.sql import functions as F

from shelfwise.catalog.registry import QUERIES, load_all
from shelfwise.plans import compare

load_all()

LINES = [(1, 1), (1, 1), (1, 2), (2, 1), (2, 3), (None, 1), (None, 1), (3, None), (4, 9)]


def _parts(spark):
    return spark.createDataFrame(
        [(1, "b1", "t1"), (2, "b1", "t2"), (3, None, "t1")], "p_partkey long, p_brand string, p_type string")


def test_pairs_count_as_distinct_listings_do(spark):
    rows = spark.createDataFrame(LINES, "competitor_id int, product_no long")
    got = compare.assortment(rows, _parts(spark), pairs=True)
    assert got.schema == compare.assortment(rows.distinct(), _parts(spark)).schema
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 2, 2, 1, 2), (2, 2, 2, 1, 1), (None, 1, 1, 1, 1)]


def test_pairs_are_summed_up_once(spark, tmp_path):
    spark.createDataFrame(LINES, "l_suppkey long, l_partkey long").write.parquet(str(tmp_path / "lineitem.parquet"))
    _parts(spark).write.parquet(str(tmp_path / "part.parquet"))
    found = QUERIES["assortment"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert sum("product_no" in line for line in plan.splitlines() if "Aggregate [" in line) == 1, plan
    assert sorted(map(tuple, found.where(F.col("competitor_id") < 3).collect())) == [(1, 2, 1, 2), (2, 2, 1, 1)]
