"""Whole product pages to records, one query per shop, compared with the part columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.catalog.registry import query
from shelfwise.plans import extract, rendered

_P = """
    WITH p AS (SELECT *, p_partkey % 4 AS shape, CAST(round(p_retailprice * 100) AS BIGINT) AS c,
        CASE WHEN p_partkey % 3 <> 0 THEN lpad((8710000000000 + p_partkey)::VARCHAR, 13, '0') END AS gtin,
        lower(replace(p_name, ' ', '-')) AS slug FROM part),
      q AS (SELECT *, c + c // 4 AS b, (c // 100) || '.' || lpad((c % 100)::VARCHAR, 2, '0') AS plain,
        '€ ' || replace(format('{:,}', c // 100), ',', '.') || ',' || lpad((c % 100)::VARCHAR, 2, '0') AS euro,
        trim(regexp_replace(lower(p_brand || ' ' || p_name || ' ' || p_type), '[^a-z0-9]+', ' ', 'g')) AS full_name,
        trim(regexp_replace(lower(p_brand || ' ' || p_name), '[^a-z0-9]+', ' ', 'g')) AS short_name FROM p)
"""
_PCT = "((b - c) * 20000 + b) // (2 * b)"


def _doubles(df, *names):
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def _ints(df, *names):
    return df.withColumns({n: F.col(n).cast("int") for n in names})


@query("extract_products_bax", f"""{_P}
    SELECT p_partkey, 'https://www.bax-shop.nl/studiomicrofoons/grootmembraan_set/' || slug || '-' || p_partkey AS source_url,
      p_name AS title, p_brand AS brand, p_type AS model, full_name AS canonical_name, gtin,
      'SKU-' || p_partkey AS sku, 'MPN' || p_partkey AS mpn, CASE WHEN shape IN (0, 1) THEN 'https://img.example.com/' || p_partkey || '.jpg' END AS image_url,
      CASE WHEN shape IN (0, 1) THEN 'Over ' || p_name ELSE 'Over dit product' END AS description,
      c::DOUBLE / 100 AS current_price, CASE WHEN shape = 2 THEN b::DOUBLE / 100 END AS base_price,
      CASE WHEN shape = 2 THEN (b - c)::DOUBLE / 100 END AS discount_amount, CASE WHEN shape = 2 THEN ({_PCT})::DOUBLE / 100 END AS discount_percent,
      (p_size % 3 <> 0)::INT AS in_stock,
      CASE WHEN shape IN (0, 1) THEN (p_size % 50)::DOUBLE / 10 END AS rating_value,
      CASE WHEN shape IN (0, 1) THEN (p_size * 3)::VARCHAR END AS review_count,
      CASE shape WHEN 1 THEN p_type WHEN 2 THEN p_brand ELSE 'grootmembraan set' END AS breadcrumb_category,
      CASE shape WHEN 1 THEN p_brand WHEN 2 THEN 'Home' ELSE 'studiomicrofoons' END AS breadcrumb_parent,
      CASE shape WHEN 1 THEN 'https://www.bax-shop.nl/' || lower(p_type) || '.html' WHEN 2 THEN 'https://www.bax-shop.nl/merken/x'
        ELSE 'https://www.bax-shop.nl/studiomicrofoons/grootmembraan_set' END AS breadcrumb_url,
      (p_size + 0.5)::DOUBLE AS free_shipping_threshold_amt, p_size AS cooling_off_days, 36 AS warranty_duration_months,
      'Bax Music' AS warranty_provider, 1 AS shipping_included, 1 AS delivery_courier_available, 1 AS free_returns,
      'https://www.bax-shop.nl/klantenservice/contact' AS customer_service_url
    FROM q WHERE shape <> 3
    UNION ALL
    SELECT p_partkey, 'https://www.bax-shop.nl/studiomicrofoons/grootmembraan_set/' || slug || '-' || p_partkey, p_name, p_brand, p_type, full_name, gtin,
      'SKU-' || p_partkey, 'MPN' || p_partkey, NULL, 'Over dit product', NULL, NULL, NULL, NULL, (p_size % 3 <> 0)::INT, NULL, NULL, 'grootmembraan set', 'studiomicrofoons',
      'https://www.bax-shop.nl/studiomicrofoons/grootmembraan_set', (p_size + 0.5)::DOUBLE, p_size, 36, 'Bax Music', 1, 1, 1,
      'https://www.bax-shop.nl/klantenservice/contact'
    FROM q WHERE shape = 3""")
def extract_products_bax(spark, d):
    """A lone aggregate offer has no price for this shop; everything else comes back."""
    r = extract.bax(rendered.bax_pages(spark, d))
    r = _doubles(r, "current_price", "base_price", "discount_amount", "discount_percent")
    r = _ints(r, "in_stock", "shipping_included", "delivery_courier_available", "free_returns")
    return r.select(
        "p_partkey", "source_url", "title", "brand", "model", "canonical_name", "gtin", "sku", "mpn", "image_url", "description", "current_price", "base_price",
        "discount_amount", "discount_percent", "in_stock", "rating_value", "review_count", "breadcrumb_category", "breadcrumb_parent",
        "breadcrumb_url", "free_shipping_threshold_amt", "cooling_off_days", "warranty_duration_months", "warranty_provider",
        "shipping_included", "delivery_courier_available", "free_returns", "customer_service_url")


@query("extract_products_thomann", f"""{_P}
    SELECT p_partkey, (p_partkey + 100000)::VARCHAR AS listing_number, 'https://www.thomann.nl/' || slug || '_' || p_partkey || '.htm?x=1' AS source_url,
      CASE WHEN shape = 2 THEN p_name ELSE p_name END AS title, CASE WHEN shape <> 2 THEN p_brand END AS brand,
      CASE WHEN shape IN (0, 1) THEN p_type END AS model,
      CASE shape WHEN 0 THEN full_name WHEN 1 THEN full_name WHEN 3 THEN short_name ELSE trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) END AS canonical_name,
      CASE WHEN shape <> 2 THEN gtin END AS gtin, 'https://img.example.com/' || p_partkey || '.jpg' AS image_url,
      CASE WHEN shape IN (0, 1) THEN 'SKU-' || p_partkey END AS sku, CASE WHEN shape IN (0, 1) THEN 'Over ' || p_name END AS description,
      c::DOUBLE / 100 AS current_price, CASE WHEN shape IN (2, 3) THEN b::DOUBLE / 100 END AS base_price,
      CASE WHEN shape IN (2, 3) THEN (b - c)::DOUBLE / 100 END AS discount_amount,
      CASE WHEN shape IN (2, 3) THEN ({_PCT})::DOUBLE / 100 END AS discount_percent,
      CASE WHEN shape IN (0, 1) THEN plain END AS price_text, (p_size % 3 <> 0)::INT AS in_stock,
      CASE WHEN shape IN (0, 1) THEN (p_size % 50)::DOUBLE / 10 END AS rating_value,
      CASE WHEN shape IN (1, 2) THEN p_type END AS breadcrumb_category, CASE WHEN shape IN (1, 2) THEN p_brand END AS breadcrumb_parent,
      CASE shape WHEN 1 THEN 'https://www.thomann.nl/' || lower(p_type) || '.html?utm_source=x' WHEN 2 THEN 'https://www.thomann.nl/type.html' END AS breadcrumb_url
    FROM q""")
def extract_products_thomann(spark, d):
    r = extract.thomann(rendered.thomann_pages(spark, d))
    r = _ints(_doubles(r, "current_price", "base_price", "discount_amount", "discount_percent"), "in_stock")
    return r.select(
        "p_partkey", "listing_number", "source_url", "title", "brand", "model", "canonical_name", "gtin", "image_url", "sku", "description", "current_price",
        "base_price", "discount_amount", "discount_percent", "price_text", "in_stock", "rating_value", "breadcrumb_category",
        "breadcrumb_parent", "breadcrumb_url")


@query("extract_products_bol", f"""{_P}
    SELECT p_partkey, 'https://www.bol.com/nl/nl/p/' || slug || '/' || p_partkey || '/' AS source_url, p_name || ' microfoon' AS title, p_brand AS brand,
      CASE WHEN shape IN (0, 1) THEN p_type END AS model,
      p_brand || ' ' || p_name || ' microfoon' || CASE WHEN shape IN (0, 1) THEN ' ' || p_type ELSE '' END AS canonical_name, gtin,
      CASE WHEN shape = 2 THEN 'https://img.example.com/a.jpg' ELSE 'https://img.example.com/' || p_partkey || '.jpg' END AS image_url,
      c::DOUBLE / 100 AS current_price, CASE WHEN shape IN (2, 3) THEN b::DOUBLE / 100 END AS base_price,
      CASE WHEN shape IN (2, 3) THEN (b - c)::DOUBLE / 100 END AS discount_amount, CASE WHEN shape IN (2, 3) THEN ({_PCT})::DOUBLE / 100 END AS discount_percent,
      CASE WHEN shape = 2 THEN replace(plain, '.', ',') ELSE '€ ' || plain END AS price_text, (p_size % 3 <> 0)::INT AS in_stock,
      CASE shape WHEN 2 THEN 4.5 WHEN 3 THEN NULL ELSE (p_size % 50)::DOUBLE / 10 END::DOUBLE AS rating_value,
      CASE WHEN shape IN (0, 1) THEN (p_size * 3)::VARCHAR END AS review_count,
      CASE WHEN shape IN (0, 1) THEN 'SKU-' || p_partkey END AS sku, CASE WHEN shape IN (0, 1) THEN 'Over ' || p_name END AS description
    FROM q WHERE p_partkey % 5 <> 4 AND p_partkey % 7 <> 6""")
def extract_products_bol(spark, d):
    """Pages of other categories and items that are no microphones are left out."""
    r = extract.bol(rendered.bol_pages(spark, d))
    r = _ints(_doubles(r, "current_price", "base_price", "discount_amount", "discount_percent"), "in_stock")
    return r.select(
        "p_partkey", "source_url", "title", "brand", "model", "canonical_name", "gtin", "image_url", "current_price", "base_price",
        "discount_amount", "discount_percent", "price_text", "in_stock", "rating_value", "review_count", "sku", "description")


@query("extract_products_maxiaxi", f"""{_P}
    SELECT p_partkey, 'https://www.maxiaxi.com/' || slug || '-' || p_partkey || '.html#top' AS source_url, p_name AS title, p_brand AS brand,
      'SKU-' || p_partkey AS sku, 'SKU-' || p_partkey AS model, gtin, 'https://img.example.com/og.jpg' AS image_url,
      'Over ' || p_name AS description, p_brand || ' SKU-' || p_partkey AS canonical_name FROM q""")
def extract_products_maxiaxi(spark, d):
    return extract.maxiaxi(rendered.maxiaxi_pages(spark, d))
