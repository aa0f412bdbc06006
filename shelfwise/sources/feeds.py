"""Typed record feeds: JSON lines, JSON arrays, CSV work lists, run headers, sinks."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import keys, text, url
from shelfwise.session import compile_wide_rows
from shelfwise.sources import layouts
from shelfwise.sources.schema import empty, feed_schema

BAD_LINE, RECORD = "_bad_line", "_record"
# Types a task writes side by side; feeds have some ten.
_OPEN_FILES = 16
MODES = {"quarantine": "PERMISSIVE", "drop": "DROPMALFORMED", "fail": "FAILFAST"}


def read_feed(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    bad_lines: str = "quarantine",
    missing: str = "raise",
    layout: str = "lines",
) -> DataFrame:
    """JSON lines, or an array with one object per line; blank lines are skipped.

    `layout`: 'any' reads arrays in every layout, pretty-printed or on one line, many tasks per file;
    it quarantines bad records.

    `bad_lines`: 'quarantine' keeps them in `_bad_line`, 'drop' leaves them out,
    'fail' stops. The brackets of an array feed are no records and are left out.
    `missing`: 'raise', or 'empty' for an empty feed with the schema.
    """
    schema = schema or feed_schema()
    if layout == "any":
        return layouts.read(spark, path, schema, BAD_LINE)
    reader = spark.read.option("mode", MODES[bad_lines])
    full = schema
    if bad_lines == "quarantine":
        full = T.StructType(schema.fields + [T.StructField(BAD_LINE, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", BAD_LINE)
    try:
        df = reader.schema(full).json(path)
    except AnalysisException as e:
        if missing != "empty" or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, full)
    if bad_lines == "quarantine":
        bracket = F.coalesce(F.trim(F.col(BAD_LINE)).isin("[", "]", "[]"), F.lit(False))
        return df.filter(~bracket)
    return df


def read_records(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """JSON lines with the whole record kept as VARIANT in `_record`, beside the typed columns.

    So a key that stands there with null is told from one that is absent (`stated`). A value that does not
    fit its column is NULL there and whole in the record. Lines that are no object go to `_bad_line`; blank
    lines and the brackets of an array are left out, and so is a comma that ends a line.
    """
    line = F.regexp_replace(F.trim("value"), r",\s*$", "")
    lines = compile_wide_rows(spark).read.text(path).select(line.alias("_line")).filter(~F.col("_line").isin("", "[", "]", "[]"))
    parsed = lines.withColumn(RECORD, F.when(F.col("_line").startswith("{"), F.try_parse_json("_line")))
    return parsed.select(
        *[F.try_variant_get(RECORD, f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema or feed_schema()],
        RECORD, F.when(F.col(RECORD).isNull(), F.col("_line")).alias(BAD_LINE))


def stated(*names: str) -> Column:
    """Whether the record has one of these keys, whatever its value; a line that is no record has none."""
    return reduce(or_, [F.try_variant_get(RECORD, f"$.{n}", "variant").isNotNull() for n in names])


def read_array(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A file that is one JSON array, in any layout. One task reads one file."""
    return spark.read.schema(schema or feed_schema()).option("multiLine", True).json(path)


def read_csv_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').csv(path)


def good(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE)


def quarantined(feed: DataFrame) -> DataFrame:
    """Lines that did not parse.

    The JSON reader refuses plans that read nothing but the bad line, so the filter also
    names an ordinary column, in a way that holds for every row.
    """
    any_type = F.col("type").isNull() | (F.length("type") >= 0)
    return feed.filter(F.col(BAD_LINE).isNotNull() & any_type).select("type", BAD_LINE)


def route(feed: DataFrame, path: str) -> None:
    """Split a feed by record type in one pass; a reader of one type opens only its folder.

    A task keeps a file open for each type it meets, so rows are not sorted by type first; a feed of more types than
    that is sorted from there on, as Spark does by itself.
    """
    conf, name = feed.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, str(_OPEN_FILES))
    try:
        feed.write.mode("errorifexists").partitionBy("type").parquet(path)
    finally:
        conf.set(name, before)


def of_type(feed: DataFrame, *types: str) -> DataFrame:
    return feed.filter(F.col("type").isin(*types))


def run_header(spark: SparkSession, run_id: str, started_at: str, version: str, notes: str) -> DataFrame:
    """The record that opens a feed."""
    return spark.createDataFrame(
        [("run", run_id, started_at, version, notes)],
        "type STRING, scrape_run_id STRING, started_at STRING, crawler_version STRING, notes STRING",
    )


def stamped(records: DataFrame, type_: str, scraped_at: str) -> DataFrame:
    """Type and time on records that carry none; the time is given, so reruns agree."""
    out = records
    if "type" not in out.columns:
        out = out.withColumn("type", F.lit(type_))
    if "scraped_at" not in out.columns:
        out = out.withColumn("scraped_at", F.lit(scraped_at))
    return out


def write_feed(records: DataFrame, path: str, run_id: str | Column | None = None) -> None:
    """One JSON object per line; with a run id, one for all records or one of each, into that
    run's own partition, in one pass over the records. A run that is written again replaces its
    partition and no other, so a header and records of one run are given together."""
    if run_id is None:
        records.write.mode("errorifexists").json(path)
    else:
        run = run_id if isinstance(run_id, Column) else F.lit(run_id)
        (records.withColumn("run_id", run).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id").json(path))


def work_list(feed: DataFrame, type_: str | None, url_column: str, domain: str) -> DataFrame:
    """Product urls of one shop, with their keys; untyped rows count when a type is asked for."""
    u: Column = F.trim(F.col(url_column))
    rows = feed
    if type_ and "type" in feed.columns:
        rows = rows.filter((F.col("type") == type_) | F.col("type").isNull() | (F.col("type") == ""))
    return rows.filter(url.on_domain(u, domain)).select(
        text.blank_to_null(u).alias("product_url"),
        keys.md5_key(u).alias("listing_key"),
        keys.sha1_key(u).alias("short_key"),
    )
