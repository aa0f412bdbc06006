"""Heavy work per row stays behind the shuffle that deals the rows to all cores."""

from pyspark.sql import functions as F

from shelfwise.catalog.registry import QUERIES, load_all
from shelfwise.session import spread

load_all()


def _below_shuffle(df):
    """The executed plan from the first exchange on down."""
    return df._jdf.queryExecution().executedPlan().toString().partition("Exchange RoundRobin")[2]


def _stored(spark, path, n, **options):
    spark.range(n).select(F.col("id").alias("k"), F.col("id").cast("string").alias("t")).coalesce(1).write.options(**options).parquet(path)
    return spark.read.parquet(path)


def test_a_later_filter_is_not_moved_before_the_shuffle(spark, tmp_path):
    rows = spread(_stored(spark, str(tmp_path / "t"), 100)).select("k", F.regexp_replace("t", "1", "one").alias("named"))
    kept = rows.where(F.col("named").contains("one"))
    below = _below_shuffle(kept)
    assert below and "contains" not in below.lower()
    assert kept.count() == 19 and rows.count() == 100


def test_a_file_cut_finer_than_its_row_groups_is_dealt(spark, tmp_path):
    """One row group, and a cut every few bytes: many partitions, one of them with rows."""
    cores, name, cost = spark.sparkContext.defaultParallelism, "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name), spark.conf.get(cost)
    one = _stored(spark, str(tmp_path / "t"), 5000)
    spark.conf.set(name, "256b")
    spark.conf.set(cost, "1b")
    try:
        assert one.rdd.getNumPartitions() >= cores
        dealt = spread(one)
        assert dealt.select(F.spark_partition_id()).distinct().count() == cores and dealt.count() == 5000
    finally:
        spark.conf.set(name, before[0])
        spark.conf.set(cost, before[1])


def test_pages_of_a_filtered_shop_are_read_after_dealing(spark, tmp_path):
    spark.createDataFrame(
        [(n, "cold bolt", "Brand#1", "LARGE", n % 50, 900.0) for n in range(20)],
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    below = _below_shuffle(QUERIES["extract_products_bol"](spark, str(tmp_path)))
    assert below and "parse_json" not in below.lower() and "variant" not in below.lower()
    crumbs = QUERIES["jsonld_breadcrumb_rows"](spark, str(tmp_path))
    plan = crumbs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count('{"@type":"BreadcrumbList"') == 1
    assert sorted(map(tuple, crumbs.where("p_partkey < 2").collect())) == [
        (n, i, name) for n in (0, 1) for i, name in enumerate(("Brand#1", "LARGE"))]
