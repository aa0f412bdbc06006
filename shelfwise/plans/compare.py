"""Comparison of shops over the model: assortment, price, discount, stock, service, reviews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.session import materialise

# Prices fall into buckets of this many cents; a group has at most this many in one bucket.
MEDIAN_BUCKET = 10_000


def _ratio(a: Column, b: Column) -> Column:
    """a / b as a double, NULL for b = 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def price_by_shop(latest: DataFrame, shops: DataFrame) -> DataFrame:
    """Assortment, price and discount per shop over the latest snapshot of each listing.

    The line items are reduced per listing, then per shop; only shop rows meet the dimension.
    """
    per_shop = latest.groupBy("competitor_id").agg(
        F.count("*").alias("n_listings"),
        F.min("current_cents").alias("min_cents"),
        F.max("current_cents").alias("max_cents"),
        F.sum("current_cents").alias("sum_cents"),
        F.count_if(F.col("current_cents") < F.col("base_cents")).alias("n_discounted"),
        F.max("discount_percent").alias("max_discount_percent"),
    )
    return per_shop.join(shops, "competitor_id").select(
        "competitor_id", "name", "country", "n_listings", "min_cents", "max_cents",
        _ratio(F.col("sum_cents"), F.col("n_listings")).alias("avg_cents"),
        _ratio(F.col("n_discounted"), F.col("n_listings")).alias("discounted_share"),
        "max_discount_percent")


def assortment(listings: DataFrame, products: DataFrame, pairs: bool = False) -> DataFrame:
    """Listings, products, brands, categories per shop.

    Listings are reduced to (shop, product) first, so a product has one row a shop; the distinct counts
    of brands and categories run over rows reduced to (shop, brand, category). `pairs`: a listing is a (shop, product),
    however many rows state it; making them distinct is then the reduction, and a task holds them in one map.
    """
    return _assortment(listings, products, ["competitor_id"], pairs)


def assortment_of_all(listings: DataFrame, products: DataFrame) -> DataFrame:
    """The same counts over all shops together, a product of several shops once."""
    return _assortment(listings, products, [])


def _assortment(listings: DataFrame, products: DataFrame, by: list[str], pairs: bool = False) -> DataFrame:
    if pairs:
        per_product = listings.select(*by, "product_no").distinct().withColumn("n", F.lit(1))
    else:
        per_product = listings.groupBy(*by, "product_no").agg(F.count("*").alias("n"))
    per_group = (
        per_product.join(products, per_product.product_no == products.p_partkey)
        .groupBy(*by, F.col("p_brand").alias("brand"), F.col("p_type").alias("category"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("n_products")))
    return per_group.groupBy(*by).agg(
        F.sum("n").alias("n_listings"), F.sum("n_products").alias("n_products"),
        F.countDistinct("brand").alias("n_brands"), F.countDistinct("category").alias("n_categories"))


def price_stats(latest: DataFrame, products: DataFrame, group: str) -> DataFrame:
    """Min, max, mean and median price per group, e.g. brand or category."""
    rows = latest.join(products, latest.product_no == products.p_partkey).select(
        F.col(group).alias("grp"), F.col("current_cents").alias("cents"))
    # The histogram is read three times; it is far smaller than the prices it sums up.
    counts = materialise(rows.groupBy("grp", "cents").agg(F.count("*").alias("n")), "prices")
    basic = counts.groupBy("grp").agg(
        F.sum("n").alias("n_prices"), F.min("cents").alias("min_cents"), F.max("cents").alias("max_cents"),
        F.sum(F.col("cents") * F.col("n")).alias("sum_cents"))
    return basic.join(medians(counts), "grp").select(
        "grp", "n_prices", "min_cents", "max_cents",
        _ratio(F.col("sum_cents"), F.col("n_prices")).alias("avg_cents"), "median_cents")


def medians(counts: DataFrame) -> DataFrame:
    """Exact median per group from (grp, cents, n), in two steps of bounded windows.

    First the bucket that holds the middle ranks is found among coarse bucket totals, then
    the value inside it. No window sees more rows than a group has buckets, or a bucket
    has distinct prices, so a group with a third of all prices needs no large task.
    """
    bucket = F.call_function("div", F.col("cents"), F.lit(MEDIAN_BUCKET))
    fine = counts.withColumn("bucket", bucket)
    coarse = fine.groupBy("grp", "bucket").agg(F.sum("n").alias("bn"))
    by_group = Window.partitionBy("grp")
    upto = by_group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = coarse.select(
        "grp", "bucket", (F.sum("bn").over(upto) - F.col("bn")).alias("before"),
        F.sum("bn").over(by_group).alias("total"), "bn")
    lo = F.call_function("div", F.col("total") + 1, F.lit(2))
    hi = F.call_function("div", F.col("total"), F.lit(2)) + 1
    ranks = placed.withColumn("rank", F.explode(F.array(lo, hi))).filter(
        (F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("bn")))
    # The two middle ranks may share a bucket; pos tells them apart.
    wanted = ranks.groupBy("grp", "bucket", "before").agg(
        F.min("rank").alias("r1"), F.max("rank").alias("r2"), F.count("*").alias("n_ranks"))
    in_bucket = Window.partitionBy("grp", "bucket").orderBy("cents").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    running = fine.join(wanted, ["grp", "bucket"]).withColumn(
        "cum", F.col("before") + F.sum("n").over(in_bucket))

    def covers(r: str) -> Column:
        return (F.col(r) <= F.col("cum")) & (F.col(r) > F.col("cum") - F.col("n"))

    hits = running.select("grp", "cents", (
        covers("r1").cast("int") + F.when(F.col("n_ranks") == 2, covers("r2").cast("int")).otherwise(0)).alias("w"))
    return hits.filter("w > 0").groupBy("grp").agg(
        _ratio(F.sum(F.col("cents") * F.col("w")), F.sum("w")).alias("median_cents"))


def discounts(latest: DataFrame) -> DataFrame:
    cut = F.col("current_cents") < F.col("base_cents")
    return latest.groupBy("competitor_id").agg(
        F.count("*").alias("n"), F.count_if(cut).alias("n_cut"),
        F.sum(F.when(cut, F.col("discount_percent"))).alias("sum_percent"),
        F.max(F.when(cut, F.col("discount_percent"))).alias("max_percent"),
    ).select(
        "competitor_id", _ratio(F.col("n_cut"), F.col("n")).alias("discounted_share"),
        _ratio(F.col("sum_percent"), F.col("n_cut")).alias("mean_percent"), "max_percent")


def availability(latest: DataFrame) -> DataFrame:
    """Share in stock among known states; unknown is counted apart."""
    known = F.count("in_stock")
    yes = F.count_if(F.col("in_stock"))
    return latest.groupBy("competitor_id").agg(
        F.count("*").alias("n_listings"), known.alias("n_known"), yes.alias("n_in_stock")).select(
        "competitor_id", "n_listings", (F.col("n_listings") - F.col("n_known")).alias("n_unknown"),
        _ratio(F.col("n_in_stock"), F.col("n_known")).alias("in_stock_rate"))


def service_matrix(service: DataFrame, flags: list[str], numbers: list[str]) -> DataFrame:
    """One row per shop: any / known count per flag, range per number."""
    aggs = []
    for f in flags:
        aggs += [F.bool_or(f).alias(f), F.count(f).alias(f"{f}_known")]
    for n in numbers:
        aggs += [F.min(n).alias(f"{n}_min"), F.max(n).alias(f"{n}_max")]
    return service.groupBy("competitor_id").agg(F.count("*").alias("n_rows"), *aggs)


def reviews_weighted(reviews: DataFrame, scale: int = 5) -> DataFrame:
    """Mean rating per shop weighted by review count, on one scale. Exact: tenths are integers.

    reviews(competitor_id, rating_tenths, rating_scale, review_count)
    """
    n = F.col("review_count")
    onto = F.col("rating_tenths") * scale * n / F.col("rating_scale")
    return reviews.filter(n.isNotNull() & F.col("rating_tenths").isNotNull()).groupBy("competitor_id").agg(
        F.sum(n).alias("n_reviews"), F.sum(onto).alias("_w")).select(
        "competitor_id", "n_reviews", _ratio(F.col("_w"), F.col("n_reviews") * 10).alias("rating"))


def price_gap(latest: DataFrame, base_shop: int) -> DataFrame:
    """Each shop's prices against those of the base shop for the same product.

    Prices are first reduced to one row per (product, shop), in one pass; a window over a
    product then sees one row per shop.
    """
    best = latest.groupBy("product_no", "competitor_id").agg(F.min("current_cents").alias("cents"))
    is_base = F.col("competitor_id") == base_shop
    base = F.min(F.when(is_base, F.col("cents"))).over(Window.partitionBy("product_no"))
    gap = best.withColumn("base", base).filter(~is_base & F.col("base").isNotNull()).withColumn("gap", F.col("cents") - F.col("base"))
    return gap.groupBy("competitor_id").agg(
        F.count("*").alias("n_matched"), F.sum("gap").alias("_sum"), F.min("gap").alias("min_gap_cents"),
        F.max("gap").alias("max_gap_cents"), F.count_if(F.col("gap") < 0).alias("n_cheaper"),
    ).select(
        "competitor_id", "n_matched", _ratio(F.col("_sum"), F.col("n_matched")).alias("avg_gap_cents"),
        "min_gap_cents", "max_gap_cents", "n_cheaper")


def preview(df: DataFrame, key: str, n: int) -> DataFrame:
    """First n rows by key, each with the total row count."""
    total = df.agg(F.count("*").alias("n_total"))
    return df.orderBy(key).limit(n).join(F.broadcast(total))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    from functools import reduce

    return reduce(DataFrame.unionByName, [
        t.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
        for n, t in tables.items()])
