"""Feeds of normalised records, one type per table, to the model tables.

Dimensions take the first record of a key. Facts find their ids by key: price, review and
match rows are dropped when a listing, run or product is missing; a listing without known
category, a category without known parent and a service row without known listing stay, with a
NULL id. Page links need both ends and a known run. A parent may stand anywhere in the feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import keys, text
from shelfwise.operators import integrity, loading, resolve
from shelfwise.sources.feeds import of_type
from shelfwise.sources.schema import coerce

ORDER = ["pos"]


def _dimension(feed: DataFrame, type_: str, key: str, columns: dict[str, Column], required: list[str] = ()) -> DataFrame:
    """First complete record per key; the surrogate id is the key itself."""
    rows = of_type(feed, type_).select(F.col(key).cast("bigint").alias(key), *[c.alias(n) for n, c in columns.items()], *ORDER)
    for c in [key, *required]:
        rows = rows.filter(F.col(c).isNotNull())
    return loading.first_per_key(rows, [key], ORDER).drop(*ORDER)


def _fact_id(*parts: str) -> Column:
    return keys.composite_key(*[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts])


def load(feed: DataFrame, competitor_id: int, run_time: str) -> dict[str, DataFrame]:
    c = F.col
    shop = F.lit(competitor_id)
    runs = _dimension(feed, "SCRAPERUN", "scrape_run_key", {
        "started_at": c("started_at"), "gpt_context_hash": F.coalesce("gpt_context_hash", "git_commit_hash"),
        "crawler_version": c("crawler_version"), "notes": c("notes")}).withColumn("scrape_run_id", c("scrape_run_key"))
    category = _dimension(feed, "CATEGORY", "category_key", {
        "name": c("name"), "url": c("url"), "parent_key": c("parent_category_key").try_cast("bigint")}
    ).withColumns({"category_id": c("category_key"), "competitor_id": shop})
    product = _dimension(feed, "PRODUCT", "product_key", {
        "canonical_name": c("canonical_name"), "brand": c("brand"), "model": c("model")}, ["canonical_name"]
    ).withColumn("product_id", c("product_key"))
    listing = _dimension(feed, "PRODUCTLISTING", "listing_key", {
        "category_id": c("category_id"), "category_key": c("category_key").cast("bigint"), "product_url": c("product_url"),
        "title_on_page": c("title_on_page"), "image_url_src": c("image_url_on_page"),
        "gtin_ean_upc_on_page": c("gtin_on_page"), "description_clean": c("description_clean")}, ["product_url"]
    ).withColumns({"listing_id": c("listing_key"), "competitor_id": shop})
    listing = resolve.resolve_left(listing, category, ["category_key"], "category_id")

    prices = of_type(feed, "PRICESNAPSHOT").select(
        "listing_key", "scrape_run_key", "scraped_at", "currency", "current_price", "base_price", "discount_amount",
        "discount_percent", "price_text", "in_stock", "stock_status_text", *ORDER)
    prices = resolve.resolve_inner(prices, listing, ["listing_key"], "listing_id")
    prices = resolve.resolve_inner(prices, runs, ["scrape_run_key"], "scrape_run_id")
    reviews = resolve.resolve_inner(
        of_type(feed, "REVIEW").filter(c("rating_value").isNotNull() | c("review_count").isNotNull()).select(
            "listing_key", "created_at", "rating_value", "rating_scale", "review_count", "review_url", *ORDER),
        listing, ["listing_key"], "listing_id")
    matches = resolve.resolve_inner(
        of_type(feed, "PRODUCTMATCH").select("product_key", "listing_key", "match_method", "match_score", "matched_at"),
        listing, ["listing_key"], "listing_id")
    matches = resolve.resolve_inner(matches, product, ["product_key"], "product_id")

    service = of_type(feed, "CUSTOMER_SERVICE").select(
        "listing_key", "scraped_at", "shipping_included", "free_shipping_threshold_amt", "pickup_point_available",
        "delivery_shipping_available", "delivery_courier_available", "cooling_off_days", "free_returns", "warranty_provider",
        "warranty_duration_months", "customer_service_url", *ORDER)
    service = resolve.resolve_left(service, listing, ["listing_key"], "listing_id")
    links = of_type(feed, "PAGELINK").select(
        text.first_text(c("from_url"), c("source_url")).alias("from_url"), text.first_text(c("to_url"), c("target_url")).alias("to_url"),
        F.coalesce(c("scrape_run_id").try_cast("bigint"), c("scrape_run_key")).alias("scrape_run_key"), "scraped_at", *ORDER)
    links = resolve.resolve_inner(
        links.filter(c("from_url").isNotNull() & c("to_url").isNotNull()), runs, ["scrape_run_key"], "scrape_run_id")
    expert = of_type(feed, "EXPERT_SUPPORT").select(
        "scraped_at", "source_url", "expert_chat_available", "phone_support_available", "email_support_available",
        "in_store_support", "expert_support_text", *ORDER)
    timed = integrity.with_default_time
    tables = {
        "scraperun": timed(runs, "started_at", run_time),
        "category": resolve.resolve_parent(category),
        "product": product,
        "productlisting": listing,
        "pricesnapshot": timed(prices, "scraped_at", run_time).withColumn(
            "price_snapshot_id", _fact_id("listing_id", "scrape_run_id", "scraped_at", *ORDER)),
        "review": reviews.withColumn("review_id", _fact_id("listing_id", "created_at", *ORDER)),
        "productmatch": matches.withColumn("match_id", _fact_id("product_id", "listing_id", "match_method")),
        "pagelink": links.withColumns({
            "page_id": _fact_id("scrape_run_id", "from_url", "to_url", *ORDER), "competitor_id": shop, "url": c("to_url")}),
        "customer_service": timed(service, "scraped_at", run_time).withColumns({
            "customer_service_id": _fact_id("listing_key", "scraped_at", *ORDER), "competitor_id": shop}),
        "expert_support": timed(expert, "scraped_at", run_time).withColumns({
            "expert_support_id": _fact_id("source_url", "scraped_at", *ORDER), "competitor_id": shop}),
    }
    # Key columns stay on the dimensions, where the next load looks them up.
    return {name: coerce(df, name) for name, df in tables.items()}
