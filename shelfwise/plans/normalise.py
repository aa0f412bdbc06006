"""Wide product records to rows of the model tables.

The record plan is shared by all targets. Dimensions take the first record of a key,
facts get a key of their own from (listing, run, time), so loading a feed again adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import keys
from shelfwise.operators.loading import first_per_key
from shelfwise.sources import feeds

FEED_ORDER = ["run_no", "line_no", "competitor_id", "product_no"]


def keyed(records: DataFrame) -> DataFrame:
    """Records that have a url, with listing and product keys from it."""
    with_url = records.filter(F.col("source_url").isNotNull() & (F.col("source_url") != ""))
    k = keys.md5_key(F.col("source_url"))
    return with_url.withColumn("listing_key", k).withColumn("product_key", k)


def split(records: DataFrame) -> dict[str, DataFrame]:
    r = keyed(records)
    product = first_per_key(
        r.filter(F.col("canonical_name").isNotNull()).select("product_key", "canonical_name", "brand", "model", *FEED_ORDER),
        ["product_key"], FEED_ORDER)
    listing = first_per_key(
        r.select("listing_key", F.col("source_url").alias("product_url"), F.col("title").alias("title_on_page"),
                 F.col("gtin").alias("gtin_ean_upc_on_page"), *FEED_ORDER),
        ["listing_key"], FEED_ORDER)
    snapshot_key = keys.composite_key(F.col("listing_key"), F.col("run_no"), F.col("line_no"))
    snapshot = r.select(
        snapshot_key.alias("price_snapshot_id"), F.col("listing_key").alias("listing_id"),
        F.col("run_no").alias("scrape_run_id"), "scraped_at", "currency", "current_price", "base_price",
        "discount_percent", "in_stock")
    review = r.filter(F.col("rating_value").isNotNull() | F.col("review_count").isNotNull()).select(
        snapshot_key.alias("review_id"), F.col("listing_key").alias("listing_id"),
        F.col("scraped_at").alias("created_at"), "rating_value", F.lit(5).alias("rating_scale"), "review_count")
    return {
        "product": product.drop(*FEED_ORDER),
        "productlisting": listing.drop("run_no", "line_no", "product_no"),
        "pricesnapshot": snapshot,
        "review": review,
        "productmatch": matches(listing),
    }


def matches(listing: DataFrame) -> DataFrame:
    """Each listing with the product of its url."""
    return listing.select(
        F.col("listing_key").alias("product_id"), F.col("listing_key").alias("listing_id"),
        F.lit("auto").alias("match_method"), F.lit(1.0).cast("decimal(3,2)").alias("match_score"))


PRICE_FIELDS = [
    "current_price", "base_price", "discount_amount", "discount_percent", "currency", "price_text", "in_stock", "stock_status_text"]


def maxiaxi_rows(feed: DataFrame, competitor_id: int) -> dict[str, DataFrame]:
    """Listing records that are typed 'item' or 'productlisting', told apart by their fields.

    A category key comes from shop and category name. Price rows need any price field: a key that
    the record has, its value null or not, where the feed keeps the records, else a value.
    """
    name = F.coalesce(F.nullif(F.col("category_name"), F.lit("")), F.nullif(F.col("category"), F.lit("")))
    rows = feed.filter(F.col("type").isin("item", "productlisting") & (F.col("product_url") != ""))
    rows = rows.withColumn("category_label", name).withColumn(
        "category_key", F.when(name.isNotNull(), keys.composite_key(F.lit(competitor_id), name)))
    rows = rows.withColumn("listing_key", keys.md5_key(F.col("product_url")))
    has_price = feeds.stated(*PRICE_FIELDS) if feeds.RECORD in feed.columns else F.coalesce(
        *[F.when(F.col(c).isNotNull(), True) for c in PRICE_FIELDS], F.lit(False))
    return {
        "category": rows.filter("category_key is not null").groupBy("category_key").agg(
            F.min("category_label").alias("name")),
        "productlisting": rows.select("listing_key", "category_key", "product_url", "product_name"),
        "pricesnapshot": rows.filter(has_price).select(
            "listing_key", "scrape_run_key", "scraped_at", "currency", "current_price", "base_price", "discount_amount",
            "discount_percent", "price_text", "in_stock", "stock_status_text", F.lit(competitor_id).alias("competitor_id")),
        "pageraw": feed.filter((F.col("type") == "item") & F.col("product_url").isNull()
                               | (F.col("type") == "pageraw")).select("url"),
    }
