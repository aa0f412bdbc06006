"""Feed queries: the given events and listings written as feeds, then read as any feed is."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.catalog.registry import ORACLES, query
from shelfwise.plans import normalise
from shelfwise.plans.reskin import listing_url
from shelfwise.session import materialise, scratch_path, table
from shelfwise.sources import feeds
from shelfwise.sources.schema import empty, feed_schema

EVENT_FEED = (
    T.StructType().add("type", "string").add("event_id", "long").add("user_id", "long").add("props", "string"))
# One task writes a file, many read it.
RECORDS_A_FILE = 2_000_000


def _records(spark, d):
    return table(spark, d, "events").select(F.col("event_type").alias("type"), "event_id", "user_id", "props")


def _json(records):
    return F.to_json(F.struct(*records.columns))


def _line_feed(spark, d) -> str:
    """JSON lines with blank and broken ones in between."""
    path = scratch_path(spark, "feed")
    r = _records(spark, d)
    n = F.col("event_id")
    line = F.when(n % 50 == 0, F.concat(F.lit('{"type": "view", "event_id": '), n)).otherwise(_json(r))
    r.select(F.when(n % 51 == 0, F.concat(line, F.lit("\n\n"))).otherwise(line).alias("value")).write.text(path)
    return path


@query("feed_quarantine", """
    SELECT CASE WHEN event_id % 50 = 0 THEN 'bad' ELSE event_type END AS kind, count(*) AS n,
      sum(CASE WHEN event_id % 50 = 0 THEN length('{"type": "view", "event_id": ' || event_id) ELSE user_id END)::BIGINT AS total
    FROM events GROUP BY 1""")
def feed_quarantine(spark, d):
    feed = feeds.read_feed(spark, _line_feed(spark, d), EVENT_FEED)
    good = feeds.good(feed).groupBy(F.col("type").alias("kind")).agg(
        F.count("*").alias("n"), F.sum("user_id").alias("total"))
    bad = feeds.quarantined(feed).agg(
        F.count("*").alias("n"), F.sum(F.length(F.trim(feeds.BAD_LINE))).alias("total"))
    return good.unionByName(bad.withColumn("kind", F.lit("bad")))


@query("feed_drop_bad", """
    SELECT event_id, event_type AS type, user_id FROM events WHERE event_id % 50 <> 0""")
def feed_drop_bad(spark, d):
    feed = feeds.read_feed(spark, _line_feed(spark, d), EVENT_FEED, bad_lines="drop")
    return feed.select("event_id", "type", "user_id")


@query("feed_array_detect", """SELECT event_id, event_type AS type, user_id FROM events""")
def feed_array_detect(spark, d):
    """An array feed with one object per line is read like a line feed."""
    path = scratch_path(spark, "array")
    r = _records(spark, d)
    body = r.select(F.concat(_json(r), F.lit(",")).alias("value"))
    brackets = r.filter("event_id = 0").select(F.explode(F.array(F.lit("["), F.lit("]"))).alias("value"))
    body.unionByName(brackets).write.text(path)
    feed = feeds.read_feed(spark, path, EVENT_FEED)
    return feeds.good(feed).select("event_id", "type", "user_id")


@query("feed_array_layouts", """
    SELECT layout, event_type AS type, count(*) AS n, sum(event_id)::BIGINT AS ids, sum(length(props))::BIGINT AS props_length
    FROM events, (SELECT unnest(['one line', 'array of lines', 'pretty', 'lines']) AS layout) WHERE event_id % 50 <> 7 GROUP BY 1, 2
    UNION ALL SELECT layout, 'bad', count(*), NULL, NULL
    FROM events, (SELECT unnest(['array of lines', 'pretty', 'lines']) AS layout) WHERE event_id % 50 = 7 GROUP BY 1""")
def feed_array_layouts(spark, d):
    """A feed in each of four layouts; all but the one on a single line hold broken records too."""
    r = _records(spark, d)
    json = _json(r)
    broken = (F.col("event_id") % 50 == 7) & (F.col("layout") != "one line")
    pretty = F.regexp_replace(F.regexp_replace(json, r'^\{(?=")', '  {\n    '), r"\}$", "\n  }")
    body = F.when(F.col("layout") == "pretty", pretty).otherwise(json)
    cut = F.when(broken, F.substring_index(body, '"props"', 1)).otherwise(body)
    begins = file_begins(r, "event_id", RECORDS_A_FILE)
    number = F.size(F.filter(F.array(*map(F.lit, begins)).cast("array<bigint>"), lambda b: b <= F.col("event_id")))
    parts = []
    for name in ("one line", "array of lines", "pretty", "lines"):
        here = r.withColumns({"layout": F.lit(name), "number": number}).where((F.col("event_id") % 50 != 7) | (F.col("layout") != "one line"))
        ends = here.groupBy("number").agg(F.min("event_id").alias("low"), F.max("event_id").alias("high"))
        first, last = F.col("event_id") == F.col("low"), F.col("event_id") == F.col("high")
        before, after = {
            "one line": (F.when(first, "[").otherwise(""), F.when(last, "]").otherwise(",")), "lines": (F.lit(""), F.lit("")),
        }.get(name, (F.when(first, "[\n").otherwise(""), F.when(last, "\n]").otherwise(",")))
        path = scratch_path(spark, "layout")
        (here.join(F.broadcast(ends), "number").select("number", "event_id", F.concat(before, cut, after).alias("value"))
         .repartitionByRange(len(begins) + 1, "number").sortWithinPartitions("number", "event_id").select("number", "value")
         .write.partitionBy("number").option("lineSep", " " if name == "one line" else "\n").text(path))
        feed = materialise(feeds.read_feed(spark, path, EVENT_FEED, layout="any"), "layout-feed")
        good = feeds.good(feed).groupBy("type").agg(
            F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.sum(F.length("props")).cast("long").alias("props_length"))
        bad = feeds.quarantined(feed).groupBy(F.lit("bad").alias("type")).agg(F.count("*").alias("n")).withColumns(
            {"ids": F.lit(None).cast("long"), "props_length": F.lit(None).cast("long")})
        parts.append(good.unionByName(bad).withColumn("layout", F.lit(name)))
    return reduce(DataFrame.unionByName, parts)


def file_begins(records: DataFrame, key: str, most: int) -> list[int]:
    """Keys at which a new file begins, so that files of consecutive records hold about `most`; none if one file holds all."""
    files = -(-records.count() // most)
    if files < 2:
        return []
    return sorted(set(records.agg(F.percentile_approx(key, [i / files for i in range(1, files)])).first()[0]))


@query("feed_route", """
    SELECT event_type AS target, event_id, (props->>'$.k')::BIGINT AS k FROM events
    WHERE event_type IN ('purchase', 'view', 'click', 'signup', 'error')""")
def feed_route(spark, d):
    """One pass writes a folder per type; each target then reads its own folder only."""
    path = scratch_path(spark, "routed")
    feeds.route(_records(spark, d), path)
    routed = spark.read.schema(EVENT_FEED).parquet(path)
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    parts = [
        feeds.of_type(routed, t).select(F.lit(t).alias("target"), "event_id", k.alias("k"))
        for t in ("purchase", "view", "click", "signup", "error")
    ]
    return reduce(DataFrame.unionByName, parts)


@query("feed_counts", """SELECT event_type AS type, count(*) AS n FROM events GROUP BY 1""")
def feed_counts(spark, d):
    return _records(spark, d).groupBy("type").agg(F.count("*").alias("n"))


@query("feed_runs", """
    SELECT 'run-' || (event_id % 3) AS run_id, event_type AS type, count(*) AS n, min('2024-05-01T00:00:00+00:00') AS scraped_at
    FROM events GROUP BY 1, 2
    UNION ALL SELECT DISTINCT 'run-' || (event_id % 3), 'run', 1, NULL FROM events""")
def feed_runs(spark, d):
    """Each run writes its header and its stamped records into its own partition."""
    path = scratch_path(spark, "runs")
    feeds.write_feed(_run_records(spark, d, 3), path, F.col("run"))
    return _runs_read(spark, path)


@query("feed_runs_again", ORACLES["feed_runs"])
def feed_runs_again(spark, d):
    """All runs written, and two of them once more: a run that is repeated replaces itself only."""
    path = scratch_path(spark, "runs")
    for runs in (3, 2):
        feeds.write_feed(_run_records(spark, d, runs), path, F.col("run"))
    return _runs_read(spark, path)


def _run_records(spark, d, runs):
    """Headers and records of the first runs, with the run each belongs to."""
    at = "2024-05-01T00:00:00+00:00"
    headers = [feeds.run_header(spark, f"run-{i}", at, "1", "daily").withColumn("run", F.lit(f"run-{i}")) for i in range(runs)]
    records = feeds.stamped(_records(spark, d), "item", at).withColumn("run", F.concat(F.lit("run-"), F.col("event_id") % 3))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*headers, records.where(F.col("event_id") % 3 < runs)])


def _runs_read(spark, path):
    schema = T.StructType(EVENT_FEED.fields + [T.StructField("scraped_at", T.StringType())])
    feed = spark.read.schema(T.StructType(schema.fields + [T.StructField("run_id", T.StringType())])).json(path)
    return feed.groupBy("run_id", "type").agg(F.count("*").alias("n"), F.min("scraped_at").alias("scraped_at"))


@query("feed_work_list", """
    SELECT DISTINCT u AS product_url, ('0x' || substr(md5(u), 1, 12))::BIGINT AS listing_key,
      ('0x' || substr(sha1(u), 1, 12))::BIGINT % 2000000000 AS short_key
    FROM (SELECT 'https://shop' || l_suppkey || '.example.com/p/' || l_partkey AS u, l_suppkey, l_partkey FROM lineitem)
    WHERE l_suppkey % 10 = 7 AND l_partkey % 4 <> 0""")
def feed_work_list(spark, d):
    """CSV product feed to the work list of shops whose domain ends in '7.example.com'."""
    path = scratch_path(spark, "worklist")
    pairs = table(spark, d, "lineitem").select("l_suppkey", "l_partkey").distinct()
    kind = F.when(F.col("l_partkey") % 4 == 0, "CATEGORY").when(F.col("l_partkey") % 4 == 1, "PRODUCTLISTING")
    pairs.select(
        kind.alias("type"), F.concat(F.lit(" "), listing_url(F.col("l_suppkey"), F.col("l_partkey"))).alias("product_url"),
    ).write.option("header", True).csv(path)
    return feeds.work_list(feeds.read_csv_list(spark, path), "PRODUCTLISTING", "product_url", "7.example.com")


def _listing_feed(spark, d):
    """Untyped shop records: listings with and without price fields, and bare pages."""
    n = F.col("l_orderkey") + F.col("l_linenumber")
    rows = table(spark, d, "lineitem").select(
        F.when(n % 2 == 0, "item").otherwise("productlisting").alias("type"),
        F.when(n % 5 != 0, F.concat(listing_url(F.col("l_suppkey"), F.col("l_partkey")), F.lit("/"), F.col("l_orderkey"),
                                    F.lit("/"), F.col("l_linenumber"))).alias("product_url"),
        F.when(n % 3 == 0, F.concat(F.lit("Cat "), F.col("l_returnflag"))).when(n % 3 == 1, "").alias("category_name"),
        F.concat(F.lit("Alt "), F.col("l_linestatus")).alias("category"),
        F.when(n % 4 == 0, F.col("l_extendedprice")).alias("current_price"),
        F.when(n % 5 == 0, F.concat(F.lit("https://page/"), F.col("l_orderkey"))).alias("url"))
    return empty(spark, feed_schema()).unionByName(rows, allowMissingColumns=True)


_LISTING_FEED_SQL = """
    WITH f AS (SELECT *, l_orderkey + l_linenumber AS n, CASE WHEN (l_orderkey + l_linenumber) % 5 <> 0 THEN
        'https://shop' || l_suppkey || '.example.com/p/' || l_partkey || '/' || l_orderkey || '/' || l_linenumber END AS u FROM lineitem),
      g AS (SELECT *, CASE WHEN n % 3 = 0 THEN 'Cat ' || l_returnflag ELSE 'Alt ' || l_linestatus END AS cat FROM f)
"""


@query("feed_by_fields", f"""{_LISTING_FEED_SQL}
    SELECT 'category' AS target, count(DISTINCT cat) AS n, 0::DOUBLE AS total FROM g WHERE u IS NOT NULL
    UNION ALL SELECT 'productlisting', count(*), 0 FROM g WHERE u IS NOT NULL
    UNION ALL SELECT 'pricesnapshot', count(*), round(sum(round(l_extendedprice * 100)::BIGINT) / 100, 0) FROM g WHERE u IS NOT NULL AND n % 4 = 0
    UNION ALL SELECT 'pageraw', count(*), 0 FROM g WHERE u IS NULL AND n % 2 = 0""")
def feed_by_fields(spark, d):
    parts = normalise.maxiaxi_rows(_listing_feed(spark, d), 3)
    counts = [
        parts[t].agg(F.count("*").alias("n"), F.lit(0.0).alias("total")).withColumn("target", F.lit(t))
        for t in ("category", "productlisting", "pageraw")
    ]
    whole_cents = F.sum(F.round(F.col("current_price") * 100).cast("bigint"))
    counts.append(parts["pricesnapshot"].agg(
        F.count("*").alias("n"), F.round(whole_cents / 100, 0).alias("total")).withColumn("target", F.lit("pricesnapshot")))
    return reduce(DataFrame.unionByName, counts).select("target", "n", "total")


@query("feed_key_presence", """
    WITH f AS (SELECT l_orderkey + l_linenumber AS n, l_orderkey, l_linenumber, l_extendedprice,
      'https://shop/' || l_orderkey || '/' || l_linenumber AS u FROM lineitem)
    SELECT ('0x' || substr(md5(u), 1, 12))::BIGINT AS listing_key, CASE WHEN n % 5 = 0 THEN CAST(round(l_extendedprice * 100) AS BIGINT) END AS cents,
      CASE WHEN n % 5 = 2 THEN false END AS in_stock FROM f WHERE n % 5 IN (0, 1, 2) AND n % 11 <> 0
    UNION ALL SELECT -1, count(*), NULL FROM f WHERE n % 11 = 0""")
def feed_key_presence(spark, d):
    """Price rows of records with a price key, null or not; records without one have none, broken ones are counted."""
    n = F.col("l_orderkey") + F.col("l_linenumber")
    price_part = (
        F.when(n % 5 == 0, F.concat(F.lit(',"current_price":'), F.col("l_extendedprice").cast("decimal(12,2)")))
        .when(n % 5 == 1, ',"current_price": null').when(n % 5 == 2, ',"in_stock":false,"price_texts":"x"').when(n % 5 == 3, ',"note":"current_price"')
        .otherwise(""))
    ending = F.when(n % 11 == 0, ',"brok').when(n % 2 == 0, "},").otherwise("}")
    path = scratch_path(spark, "presence")
    table(spark, d, "lineitem").select(F.concat(
        F.lit('{"type":"item","product_url":"https://shop/'), "l_orderkey", F.lit("/"), "l_linenumber", F.lit('"'), price_part, ending)).write.text(path)
    records = feeds.read_records(spark, path)
    prices = normalise.maxiaxi_rows(records, 3)["pricesnapshot"].select(
        "listing_key", F.round(F.col("current_price") * 100).cast("bigint").alias("cents"), "in_stock")
    broken = feeds.quarantined(records).agg(
        F.lit(-1).cast("bigint").alias("listing_key"), F.count("*").alias("cents"), F.lit(None).cast("boolean").alias("in_stock"))
    return prices.unionByName(broken)


@query("feed_price_rows", f"""{_LISTING_FEED_SQL}
    SELECT ('0x' || substr(md5(u), 1, 12))::BIGINT AS listing_key, 3 AS competitor_id, CASE WHEN n % 4 = 0 THEN CAST(round(l_extendedprice * 100) AS BIGINT) END AS cents,
      CASE WHEN n % 4 = 1 THEN CAST(round(l_extendedprice * 100) AS BIGINT) END AS base_cents, CASE WHEN n % 7 = 0 THEN 'EUR' END AS currency,
      CASE WHEN n % 4 = 2 THEN 'op voorraad' END AS stock_status_text, 'run' AS scraped_at
    FROM g WHERE u IS NOT NULL AND (n % 4 < 3 OR n % 7 = 0)""")
def feed_price_rows(spark, d):
    """Price rows of one shop with all the fields that its records state, from records with any of them."""
    n = F.col("l_orderkey") + F.col("l_linenumber")
    rows = table(spark, d, "lineitem").select(
        F.lit("item").alias("type"), F.lit("run").alias("scraped_at"),
        F.when(n % 5 != 0, F.concat(listing_url(F.col("l_suppkey"), F.col("l_partkey")), F.lit("/"), F.col("l_orderkey"),
                                    F.lit("/"), F.col("l_linenumber"))).alias("product_url"),
        F.when(n % 4 == 0, F.col("l_extendedprice")).alias("current_price"), F.when(n % 4 == 1, F.col("l_extendedprice")).alias("base_price"),
        F.when(n % 7 == 0, "EUR").alias("currency"), F.when(n % 4 == 2, "op voorraad").alias("stock_status_text"))
    found = normalise.maxiaxi_rows(empty(spark, feed_schema()).unionByName(rows, allowMissingColumns=True), 3)["pricesnapshot"]
    cents = lambda c: F.round(F.col(c) * 100).cast("bigint")
    return found.select(
        "listing_key", "competitor_id", cents("current_price").alias("cents"), cents("base_price").alias("base_cents"), "currency",
        "stock_status_text", "scraped_at")


@query("feed_category_keys", f"""{_LISTING_FEED_SQL}
    SELECT DISTINCT ('0x' || substr(md5('3|' || cat), 1, 12))::BIGINT AS category_key, cat AS name FROM g WHERE u IS NOT NULL""")
def feed_category_keys(spark, d):
    return normalise.maxiaxi_rows(_listing_feed(spark, d), 3)["category"]
