"""Feeds are split by type without a sort of their rows."""

from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.sources import feeds

NAME = "spark.sql.maxConcurrentOutputFileWriters"


def test_types_are_written_side_by_side_and_the_setting_is_put_back(spark, tmp_path):
    def with_setting(batches):
        for batch in batches:
            yield batch.assign(files=TaskContext.get().getLocalProperty(NAME))

    rows = spark.range(400).select(F.col("id"), F.concat(F.lit("T"), F.col("id") % 40).alias("type")).coalesce(1)
    schema = T.StructType([*rows.schema.fields, T.StructField("files", T.StringType())])
    before = spark.conf.get(NAME)
    feeds.route(rows.mapInPandas(with_setting, schema), str(tmp_path / "feed"))
    assert spark.conf.get(NAME) == before
    back = spark.read.parquet(str(tmp_path / "feed"))
    assert {r.files for r in back.select("files").distinct().collect()} == {str(feeds._OPEN_FILES)}
    # More types than files at once: the rest is sorted, nothing is lost.
    assert sorted((r.id, r.type) for r in back.collect()) == [(i, f"T{i % 40}") for i in range(400)]
