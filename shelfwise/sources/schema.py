"""The eleven tables and the typed feed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import lexicon

# Column definitions of the tables; each also carries the key columns of the loaders.
TABLES = {
    "competitor": "competitor_id INT NOT NULL, name STRING NOT NULL, country STRING, base_url STRING",
    "scraperun": "scrape_run_id BIGINT NOT NULL, started_at TIMESTAMP NOT NULL, "
    "gpt_context_hash STRING, crawler_version STRING, notes STRING, scrape_run_key BIGINT",
    "category": "category_id BIGINT NOT NULL, competitor_id INT NOT NULL, name STRING, url STRING, "
    "parent_category_id BIGINT, category_key BIGINT",
    "productlisting": "listing_id BIGINT NOT NULL, competitor_id INT NOT NULL, category_id BIGINT, "
    "product_url STRING NOT NULL, title_on_page STRING, image_url_src STRING, img_url_cdn STRING, "
    "gtin_ean_upc_on_page STRING, description_clean STRING, listing_key BIGINT",
    "pricesnapshot": "price_snapshot_id BIGINT NOT NULL, listing_id BIGINT NOT NULL, "
    "scrape_run_id BIGINT NOT NULL, scraped_at TIMESTAMP NOT NULL, currency STRING, "
    "current_price DECIMAL(10,2), base_price DECIMAL(10,2), discount_amount DECIMAL(10,2), "
    "discount_percent DECIMAL(5,2), price_text STRING, in_stock BOOLEAN, stock_status_text STRING",
    "product": "product_id BIGINT NOT NULL, canonical_name STRING NOT NULL, brand STRING, "
    "model STRING, product_key BIGINT",
    "productmatch": "match_id BIGINT NOT NULL, product_id BIGINT NOT NULL, listing_id BIGINT NOT NULL, "
    "match_method STRING, match_score DECIMAL(3,2), matched_at TIMESTAMP",
    "review": "review_id BIGINT NOT NULL, listing_id BIGINT NOT NULL, created_at TIMESTAMP, "
    "rating_value DECIMAL(3,1), rating_scale INT, review_count INT, review_text STRING, "
    "reviewer_name STRING, verified BOOLEAN, verified_purchase BOOLEAN, review_url STRING",
    "pagelink": "page_id BIGINT NOT NULL, competitor_id INT NOT NULL, page_type STRING, url STRING, "
    "scrape_run_id BIGINT, from_url STRING, to_url STRING, scraped_at TIMESTAMP",
    "customer_service": "customer_service_id BIGINT NOT NULL, competitor_id INT NOT NULL, "
    "listing_id BIGINT, scraped_at TIMESTAMP NOT NULL, shipping_included BOOLEAN, "
    "free_shipping_threshold_amt DECIMAL(10,2), pickup_point_available BOOLEAN, "
    "delivery_shipping_available BOOLEAN, delivery_courier_available BOOLEAN, cooling_off_days INT, "
    "free_returns BOOLEAN, warranty_provider STRING, warranty_duration_months INT, "
    "customer_service_url STRING",
    "expert_support": "expert_support_id BIGINT NOT NULL, competitor_id INT NOT NULL, "
    "scraped_at TIMESTAMP NOT NULL, source_url STRING, expert_chat_available BOOLEAN, "
    "phone_support_available BOOLEAN, email_support_available BOOLEAN, in_store_support BOOLEAN, "
    "expert_support_text STRING",
}

# child table, child column, parent table, parent column
FOREIGN_KEYS = [
    ("category", "competitor_id", "competitor", "competitor_id"),
    ("category", "parent_category_id", "category", "category_id"),
    ("productlisting", "competitor_id", "competitor", "competitor_id"),
    ("productlisting", "category_id", "category", "category_id"),
    ("pricesnapshot", "listing_id", "productlisting", "listing_id"),
    ("pricesnapshot", "scrape_run_id", "scraperun", "scrape_run_id"),
    ("productmatch", "product_id", "product", "product_id"),
    ("productmatch", "listing_id", "productlisting", "listing_id"),
    ("review", "listing_id", "productlisting", "listing_id"),
    ("pagelink", "competitor_id", "competitor", "competitor_id"),
    ("customer_service", "competitor_id", "competitor", "competitor_id"),
    ("customer_service", "listing_id", "productlisting", "listing_id"),
    ("expert_support", "competitor_id", "competitor", "competitor_id"),
]

UNIQUE_KEYS = {
    "scraperun": "scrape_run_key",
    "product": "product_key",
    "productlisting": "listing_key",
    "category": "category_key",
}

# Superset of all record shapes on the wire; an absent field reads as NULL.
FEED_FIELDS = (
    "type STRING, scrape_run_id STRING, scrape_run_key BIGINT, started_at STRING, "
    "git_commit_hash STRING, gpt_context_hash STRING, crawler_version STRING, notes STRING, "
    "competitor_id INT, competitor_key STRING, category STRING, category_name STRING, "
    "category_id BIGINT, category_key STRING, parent_category_key STRING, name STRING, url STRING, "
    "seed_category STRING, product_key BIGINT, listing_key BIGINT, canonical_name STRING, "
    "brand STRING, model STRING, title STRING, title_on_page STRING, product_name STRING, "
    "source_url STRING, product_url STRING, target_url STRING, from_url STRING, to_url STRING, "
    "gtin STRING, gtin_on_page STRING, ean STRING, mpn STRING, sku STRING, image_url STRING, "
    "image_url_on_page STRING, image_url_on_pdp STRING, description STRING, "
    "description_clean STRING, scraped_at STRING, currency STRING, current_price DOUBLE, "
    "base_price DOUBLE, discount_amount DOUBLE, discount_percent DOUBLE, price_text STRING, "
    "in_stock BOOLEAN, stock_status_text STRING, rating_value STRING, rating_scale INT, "
    "review_count STRING, review_url STRING, created_at STRING, match_method STRING, "
    "match_score DOUBLE, matched_at STRING, breadcrumb_category STRING, breadcrumb_parent STRING, "
    "breadcrumb_url STRING, shipping_included BOOLEAN, free_shipping_threshold_amt DOUBLE, "
    "pickup_point_available BOOLEAN, delivery_shipping_available BOOLEAN, "
    "delivery_courier_available BOOLEAN, cooling_off_days INT, free_returns BOOLEAN, "
    "warranty_provider STRING, warranty_duration_months INT, customer_service_url STRING, "
    "expert_chat_available BOOLEAN, phone_support_available BOOLEAN, "
    "email_support_available BOOLEAN, in_store_support BOOLEAN, expert_support_text STRING"
)


def feed_schema() -> T.StructType:
    return T.StructType.fromDDL(FEED_FIELDS)


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[name])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def create_missing(spark: SparkSession, database: str | None = None) -> list[str]:
    """Create the tables that do not exist yet; returns their names."""
    made = []
    for name, columns in TABLES.items():
        full = f"{database}.{name}" if database else name
        if not spark.catalog.tableExists(full):
            spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet")
            made.append(full)
    return made


def competitors(spark: SparkSession) -> DataFrame:
    """The constant dimension; four rows, so joining it by broadcast is always safe."""
    return spark.createDataFrame(lexicon.COMPETITORS, table_schema("competitor"))


def add_column(df: DataFrame, name: str, sql_type: str) -> DataFrame:
    """Add a NULL column unless the table has it."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(sql_type))


def align(df: DataFrame, target: list[str]) -> DataFrame:
    """Keep only the columns the target has, in the target's order."""
    return df.select(*[c for c in target if c in df.columns])


def coerce(df: DataFrame, name: str) -> DataFrame:
    """All columns of a table in its types; values that do not fit become NULL."""
    have = set(df.columns)

    def column(f: T.StructField) -> Column:
        source = F.col(f.name) if f.name in have else F.lit(None)
        return source.try_cast(f.dataType).alias(f.name)

    return df.select(*[column(f) for f in table_schema(name)])


def only_where_known(df: DataFrame, column: str, value: object) -> DataFrame:
    """Filter on a column if the table has it, otherwise leave the table as it is."""
    return df.filter(F.col(column) == value) if column in df.columns else df
