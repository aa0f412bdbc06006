"""The given tables seen as the shop model: suppliers are shops, parts are products,
line items are price snapshots of (supplier, part) listings, orders are scrape runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import keys, price, text, url
from shelfwise.operators.packed import last_per_key
from shelfwise.session import table
from shelfwise.sources.schema import empty, feed_schema

RUN_TIME = "2024-01-01 00:00:00"


def cents(c: Column) -> Column:
    return F.round(c * 100).cast("bigint")


def money(cents_: Column) -> Column:
    return (cents_ / F.lit(100).cast("decimal(3,0)")).cast(price.MONEY)


def shops(spark: SparkSession, d: str) -> DataFrame:
    nations = table(spark, d, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("country"))
    return table(spark, d, "supplier").join(nations, "s_nationkey").select(
        F.col("s_suppkey").cast("int").alias("competitor_id"), F.col("s_name").alias("name"), "country",
        F.concat(F.lit("https://shop"), F.col("s_suppkey"), F.lit(".example.com")).alias("base_url"))


def gtin(partkey: Column) -> Column:
    """Two of three products state a code."""
    return F.when(partkey % 3 != 0, F.lpad((F.lit(8710000000000) + partkey).cast("string"), 13, "0"))


def products(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(
        "p_partkey", "p_name", "p_brand", "p_type",
        text.canonical_strict(F.col("p_brand"), F.col("p_name"), F.col("p_type")).alias("canonical_name"),
        gtin(F.col("p_partkey")).alias("gtin"))


def listing_url(supp: Column, part: Column) -> Column:
    return F.concat(F.lit("https://shop"), supp, F.lit(".example.com/p/"), part)


def snapshots(spark: SparkSession, d: str) -> DataFrame:
    """One row per line item; money in whole cents, so no double is ever rounded."""
    li = table(spark, d, "lineitem")
    base = cents(F.col("l_extendedprice"))
    pct = cents(F.col("l_discount"))
    return li.select(
        F.col("l_suppkey").cast("int").alias("competitor_id"),
        F.col("l_partkey").alias("product_no"),
        F.col("l_orderkey").alias("run_no"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_shipdate").alias("scraped_at"),
        base.alias("base_cents"),
        F.call_function("div", base * (100 - pct) + 50, F.lit(100)).alias("current_cents"),
        pct.alias("discount_percent"),
        F.when(F.col("l_returnflag") == "R", False).when(F.col("l_linestatus") == "F", True).alias("in_stock"),
    )


LATEST_ORDER = ["scraped_at", "run_no", "line_no"]
LISTING = ["competitor_id", "product_no"]


def latest(snaps: DataFrame, *values: str) -> DataFrame:
    """Latest snapshot per listing, reduced in hash maps before the shuffle.

    Naming the values needed keeps the other columns out of scan and shuffle.
    """
    if values:
        snaps = snaps.select(*LISTING, *LATEST_ORDER, *values)
    return last_per_key(snaps, LISTING, LATEST_ORDER)


def listings(spark: SparkSession, d: str) -> DataFrame:
    """Distinct (shop, product) with the url as fed and its cleaned key."""
    pairs = table(spark, d, "lineitem").select("l_suppkey", "l_partkey").distinct()
    fed = F.concat(listing_url(F.col("l_suppkey"), F.col("l_partkey")), F.lit("?utm_source=feed"))
    named = pairs.select(
        F.col("l_suppkey").cast("int").alias("competitor_id"), F.col("l_partkey").alias("product_no"),
        url.strip_tracking(fed, "bax").alias("product_url"))
    return named.withColumn("listing_key", keys.md5_key(F.col("product_url")))


PRODUCT_FACTS = ["p_name", "p_brand", "p_type", "canonical_name", "gtin"]


def wide_records(spark: SparkSession, d: str, product_facts: bool = True) -> DataFrame:
    """Line items with their part as wide product records, as a shop's feed carries them.

    Without `product_facts` the part is not joined and its columns are NULL: enough for facts.
    """
    s = snapshots(spark, d)
    if product_facts:
        p = products(spark, d)
        joined = s.join(p, s.product_no == p.p_partkey)
    else:
        joined = s.select("*", *[F.lit(None).cast("string").alias(c) for c in PRODUCT_FACTS])
    src = listing_url(F.col("competitor_id"), F.col("product_no"))
    return joined.select(
        F.lit("product").alias("type"), "competitor_id", "run_no", "line_no", "product_no", "scraped_at",
        src.alias("source_url"), F.col("p_name").alias("title"), F.col("p_brand").alias("brand"),
        F.col("p_type").alias("model"), "canonical_name", "gtin",
        F.lit("EUR").alias("currency"), money(F.col("current_cents")).alias("current_price"),
        money(F.col("base_cents")).alias("base_price"),
        F.col("discount_percent").cast("decimal(5,2)").alias("discount_percent"), "in_stock",
        F.when(F.col("line_no") % 3 == 0, ((F.col("base_cents") % 41 + 10) / F.lit(10).cast("decimal(2,0)")).cast("decimal(3,1)")).alias("rating_value"),
        F.when(F.col("line_no") % 3 == 0, (F.col("run_no") % 50 + 1).cast("int")).alias("review_count"),
    )


def categories(spark: SparkSession, d: str) -> DataFrame:
    """Brands are root categories, types within a brand their children; with feed positions."""
    p = table(spark, d, "part")
    roots = p.groupBy("p_brand").agg(F.min("p_partkey").alias("pos")).select(
        F.col("p_brand").alias("name"), F.lit(None).cast("string").alias("parent_name"), "pos",
        F.col("p_brand").alias("path"))
    kids = p.groupBy("p_brand", "p_type").agg(F.min("p_partkey").alias("pos")).select(
        F.col("p_type").alias("name"), F.col("p_brand").alias("parent_name"), "pos",
        F.concat_ws("|", "p_brand", "p_type").alias("path"))
    return roots.unionByName(kids).select(
        "name", "pos", keys.md5_key(F.col("path")).alias("category_key"),
        keys.md5_key(F.col("path")).alias("category_id"),
        keys.md5_key(F.col("parent_name")).alias("parent_key"))


def typed_feed_schema():
    return feed_schema().add("pos", "long")


def typed_feed(spark: SparkSession, d: str) -> DataFrame:
    """The given tables as a feed of normalised records, with repeats, gaps and dangling keys.

    Every fifth run and the listings of every seventh part are missing, every tenth product
    has no name, and every product comes a second time under another name. A type's parent is the brand
    it is first seen with, which the feed lacks for the brands that end in 3. Page links come under
    either pair of names; some have only one end.
    """
    c = F.col
    li, part = table(spark, d, "lineitem"), table(spark, d, "part")
    key = keys.md5_key(listing_url(c("l_suppkey"), c("l_partkey")))
    iso = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss+00:00")
    line_pos = c("l_orderkey") * 16 + c("l_linenumber")
    pairs = li.select("l_suppkey", "l_partkey").distinct()
    listing, other = listing_url(c("l_suppkey"), c("l_partkey")), F.concat(F.lit("https://page/"), c("l_partkey"))
    typed = {
        "SCRAPERUN": table(spark, d, "orders").filter("o_orderkey % 5 <> 0").select(
            c("o_orderkey").alias("scrape_run_key"), iso("o_orderdate").alias("started_at"), F.lit("abc").alias("git_commit_hash"),
            c("o_orderkey").alias("pos")),
        "CATEGORY": part.select(
            c("p_type").alias("name"), keys.md5_key(c("p_type")).cast("string").alias("category_key"),
            keys.md5_key(c("p_brand")).cast("string").alias("parent_category_key"), c("p_partkey").alias("pos")).unionByName(
            part.filter("p_brand NOT LIKE '%3'").select(
                c("p_brand").alias("name"), keys.md5_key(c("p_brand")).cast("string").alias("category_key"), c("p_partkey").alias("pos")),
            allowMissingColumns=True),
        "PAGELINK": li.select(
            F.when(line_pos % 2 == 0, listing).alias("from_url"), F.when(line_pos % 2 == 1, listing).alias("source_url"),
            F.when(c("l_linenumber") != 4, other).alias("to_url"), F.when(c("l_linenumber") == 4, F.when(c("l_orderkey") % 2 == 0, other).otherwise("")).alias("target_url"),
            c("l_orderkey").cast("string").alias("scrape_run_id"), iso("l_shipdate").alias("scraped_at"), line_pos.alias("pos")),
        "PRODUCT": part.withColumn("again", F.explode(F.array(F.lit(0), F.lit(1)))).select(
            c("p_partkey").alias("product_key"),
            F.when(c("p_partkey") % 10 != 0, F.concat("p_name", F.repeat(F.lit(" again"), c("again")))).alias("canonical_name"),
            c("p_brand").alias("brand"), c("p_type").alias("model"), (c("p_partkey") * 2 + c("again")).alias("pos")),
        "PRODUCTLISTING": pairs.filter("l_partkey % 7 <> 0").join(part, c("l_partkey") == c("p_partkey")).select(
            key.alias("listing_key"), listing_url(c("l_suppkey"), c("l_partkey")).alias("product_url"), c("p_name").alias("title_on_page"),
            F.when(c("p_partkey") % 4 != 0, keys.md5_key(c("p_type")).cast("string")).alias("category_key"), c("l_suppkey").alias("pos")),
        "PRICESNAPSHOT": li.select(
            key.alias("listing_key"), c("l_orderkey").alias("scrape_run_key"), iso("l_shipdate").alias("scraped_at"), F.lit("EUR").alias("currency"),
            c("l_extendedprice").alias("base_price"), line_pos.alias("pos")),
        "REVIEW": li.select(
            key.alias("listing_key"), F.when(c("l_linenumber") % 3 == 0, "4.5").alias("rating_value"), F.lit(5).alias("rating_scale"), line_pos.alias("pos")),
        "PRODUCTMATCH": pairs.select(
            key.alias("listing_key"), c("l_partkey").alias("product_key"), F.lit("gtin").alias("match_method"), F.lit(1.0).alias("match_score")),
        "CUSTOMER_SERVICE": table(spark, d, "supplier").select(
            F.when(c("s_suppkey") % 3 != 2, keys.md5_key(listing_url(c("s_suppkey"), c("s_suppkey")))).alias("listing_key"),
            c("s_suppkey").cast("int").alias("cooling_off_days"), F.when(c("s_suppkey") % 2 == 0, True).alias("free_returns"), c("s_suppkey").alias("pos")),
        "EXPERT_SUPPORT": table(spark, d, "supplier").select(
            c("s_name").alias("source_url"), F.lit(False).alias("in_store_support"), c("s_suppkey").alias("pos")),
    }
    feed = empty(spark, typed_feed_schema())
    for type_, rows in typed.items():
        feed = feed.unionByName(rows.withColumn("type", F.lit(type_)), allowMissingColumns=True)
    return feed
