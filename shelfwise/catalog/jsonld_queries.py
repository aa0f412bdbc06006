"""JSON-LD queries over pages written from the part table."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.catalog.extract_queries import _P
from shelfwise.catalog.registry import query
from shelfwise.functions import jsonld as L
from shelfwise.plans import rendered


def _nodes(spark, d, html):
    """Parts with the node array of the page that `html` writes."""
    return rendered.parts(spark, d).withColumn("html", html).withColumn("nodes", L.nodes(L.blocks(F.col("html"))))


def _page_url():
    return F.concat(F.lit("https://shop.example.com/"), F.col("p_partkey"))


def _product_html():
    broken = F.lit('<script type="application/ld+json">{"@type": "Product", </script>')
    org = F.lit('<script type="application/ld+json">{"@type": ["Organization", "Store"], "name": "x"}</script>')
    # up to six graphs around it, each in a list of a list
    n = (F.col("p_partkey") % 7).cast("int")
    nested = F.concat(F.repeat(F.lit('{"@graph": [ [ '), n), rendered.product_json(_page_url()), F.repeat(F.lit("]]}"), n))
    return F.concat(broken, org, F.coalesce(rendered._script(nested), F.lit("")))


@query("jsonld_product", f"""{_P}
    SELECT p_partkey, CASE WHEN shape <> 2 THEN p_name END AS title, CASE WHEN shape <> 2 THEN p_brand END AS brand,
      CASE WHEN shape IN (0, 1) THEN p_type END AS model, CASE WHEN shape <> 2 THEN gtin END AS gtin,
      CASE WHEN shape IN (0, 1) THEN 'SKU-' || p_partkey END AS sku, CASE WHEN shape IN (0, 1) THEN 'MPN' || p_partkey END AS mpn,
      CASE WHEN shape <> 2 THEN 'https://img.example.com/' || p_partkey || '.jpg' END AS image,
      CASE WHEN shape IN (0, 1) THEN (p_size * 3)::VARCHAR END AS review_count, (CASE shape WHEN 2 THEN 0 ELSE 1 END)::INT AS n_products
    FROM q""")
def jsonld_product(spark, d):
    staged = _nodes(spark, d, _product_html()).withColumn("p", L.first_product(F.col("nodes"), "bol"))
    f = L.product_fields(F.col("p"), "bol")
    return staged.select(
        "p_partkey", f["title"].alias("title"), f["brand"].alias("brand"), f["model"].alias("model"), f["gtin"].alias("gtin"),
        f["sku"].alias("sku"), f["mpn"].alias("mpn"), f["image_url"].alias("image"), f["review_count"].alias("review_count"),
        F.size(L.of_type(F.col("nodes"), "Product")).alias("n_products"))


@query("jsonld_offers", f"""{_P}
    SELECT p_partkey, CASE WHEN shape <> 2 THEN c::DOUBLE / 100 END AS cur, CASE WHEN shape = 3 THEN b::DOUBLE / 100 END AS base,
      CASE WHEN shape <> 2 THEN 'EUR' END AS currency,
      CASE WHEN shape <> 2 THEN 'https://schema.org/' || CASE WHEN p_size % 3 = 0 THEN 'OutOfStock' ELSE 'InStock' END END AS availability
    FROM q""")
def jsonld_offers(spark, d):
    staged = _nodes(spark, d, _product_html()).withColumn("p", L.first_product(F.col("nodes"), "bol"))
    prices = L.offer_prices(F.col("p"))
    f = L.product_fields(F.col("p"), "bol")
    return staged.select(
        "p_partkey", prices["current"].alias("cur"), prices["base"].alias("base"), f["currency"].alias("currency"),
        f["availability"].alias("availability"))


@query("jsonld_breadcrumb", """
    SELECT p_partkey, p_brand || '>' || p_type AS names, p_type AS category, p_brand AS parent,
      'https://shop.example.com/' || replace(p_brand, '#', '-') || '.html' AS first_url FROM part""")
def jsonld_breadcrumb(spark, d):
    html = rendered._script(rendered.crumb_json("https://shop.example.com"))
    staged = _nodes(spark, d, html).withColumn("c", L.crumbs(F.col("nodes")))
    n = F.size("c")
    return staged.select(
        "p_partkey", F.array_join(F.transform("c", lambda x: x["name"]), ">").alias("names"),
        F.get("c", n - 1)["name"].alias("category"), F.get("c", n - 2)["name"].alias("parent"), F.get("c", F.lit(0))["url"].alias("first_url"))


def _list_html():
    """An item list of products, bare pages and textual items, and a lone product."""
    def el(body):
        return F.concat(F.lit('{"@type":"ListItem",'), body, F.lit("}"))

    n = F.col("p_partkey").cast("string")
    elements = [
        el(F.concat(F.lit('"url":"/a/'), n, F.lit('","item":{"@type":"Product","@id":"/ida/'), n, F.lit('"}'))),
        el(F.concat(F.lit('"item":{"@type":["Thing","Product"],"url":"/b/'), n, F.lit('"}'))),
        el(F.concat(F.lit('"item":{"@type":"WebPage","@id":"/c/'), n, F.lit('"}'))),
        el(F.concat(F.lit('"item":"/d/'), n, F.lit('"'))),
        F.lit('"no object"'),
    ]
    listing = F.concat(F.lit('{"@context":"x","@type":"ItemList","itemListElement":['), F.concat_ws(",", *elements), F.lit("]}"))
    product = F.concat(F.lit('{"@type":"Product","@id":"/p/'), n, F.lit('"}'))
    return F.concat(rendered._script(F.concat(F.lit('{"@graph":['), listing, F.lit(","), product, F.lit("]}"))))


@query("jsonld_itemlist", """
    SELECT p_partkey, '/a/' || p_partkey || ' /b/' || p_partkey || ' /c/' || p_partkey AS all_urls,
      '/a/' || p_partkey || ' /b/' || p_partkey AS product_only,
      '/ida/' || p_partkey || ' /b/' || p_partkey || ' /c/' || p_partkey || ' /d/' || p_partkey AS targets,
      '/p/' || p_partkey AS products FROM part""")
def jsonld_itemlist(spark, d):
    s = _nodes(spark, d, _list_html())
    n = F.col("nodes")
    return s.select(
        "p_partkey", F.array_join(L.itemlist_urls(n), " ").alias("all_urls"),
        F.array_join(L.itemlist_urls(n, only_products=True), " ").alias("product_only"),
        F.array_join(L.itemlist_targets(n), " ").alias("targets"), F.array_join(L.product_urls(n), " ").alias("products"))


@query("json_url_harvest", """
    SELECT p_partkey, '/deep/' || p_partkey || '|/img/' || p_partkey || '.png|/u/' || p_partkey AS urls, 3 AS n_urls FROM part""")
def json_url_harvest(spark, d):
    """Link values of application-state scripts at any depth; links inside text values do not count."""
    n = F.col("p_partkey").cast("string")
    state = F.concat(
        F.lit('window.__NUXT__={"page":{"list":[{"productUrl":"/u/'), n, F.lit('"},{"inner":{"canonical_url":"/deep/'), n,
        F.lit('","name":"url"}}],"imageHref":"/img/'), n, F.lit('.png","title":"no url here","price":3}};'))
    html = F.concat(F.lit('<script id="__NUXT__">'), state, F.lit('</script><script type="application/json">{"url": broken}</script>'))
    urls = F.array_sort(L.state_urls(F.col("html")))
    return rendered.parts(spark, d).withColumn("html", html).select(
        "p_partkey", F.array_join(urls, "|").alias("urls"), F.size(urls).alias("n_urls"))


@query("jsonld_breadcrumb_rows", """
    SELECT p_partkey, 0 AS pos, p_brand AS name FROM part UNION ALL SELECT p_partkey, 1, p_type FROM part""")
def jsonld_breadcrumb_rows(spark, d):
    """Names zipped with links and unfolded to one row per crumb."""
    html = rendered._script(rendered.crumb_json("https://shop.example.com"))
    staged = _nodes(spark, d, html).withColumn("c", L.crumbs(F.col("nodes")))
    # The outer form, as the plain one filters on the crumbs first and so reads every page twice.
    unfolded = staged.select("p_partkey", F.posexplode_outer("c").alias("pos", "x")).where("pos is not null")
    return unfolded.select("p_partkey", "pos", "x.name")
