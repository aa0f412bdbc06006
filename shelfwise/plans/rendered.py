"""Product pages written from the part table, in the shapes the shops publish.

The given pages hold no product data, so extraction is exercised on pages whose facts are
known: each part becomes a page, and what is read back must equal the part's columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.plans.reskin import cents, gtin
from shelfwise.session import spread, table

SHAPES = 4


def parts(spark: SparkSession, d: str, more_cents: int = 0) -> DataFrame:
    """`more_cents`: what a shop asks beyond the part's price."""
    n = F.col("p_partkey")
    return spread(table(spark, d, "part")).select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", (cents(F.col("p_retailprice")) + more_cents).alias("c"),
        (n % SHAPES).alias("shape"), gtin(n).alias("gtin"),
        F.lower(F.replace("p_name", F.lit(" "), F.lit("-"))).alias("slug"))


def plain_price(c: Column) -> Column:
    """129950 as '1299.50'."""
    return F.concat(F.call_function("div", c, F.lit(100)), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"))


def euro_price(c: Column) -> Column:
    """129950 as '€ 1.299,50'."""
    whole = F.replace(F.format_number(F.call_function("div", c, F.lit(100)), 0), F.lit(","), F.lit("."))
    return F.concat(F.lit("€ "), whole, F.lit(","), F.lpad((c % 100).cast("string"), 2, "0"))


def _script(json_text: Column) -> Column:
    return F.concat(F.lit('<script type="application/ld+json">'), json_text, F.lit("</script>"))


def base_cents() -> Column:
    """A former price one quarter above the current one."""
    return F.col("c") + F.call_function("div", F.col("c"), F.lit(4))


def product_json(page_url: Column) -> Column:
    """Product node by shape: text or object brand, one offer or a list, graph, aggregate offer."""
    price = plain_price(F.col("c"))
    avail = F.when(F.col("p_size") % 3 == 0, "https://schema.org/OutOfStock").otherwise("https://schema.org/InStock")
    one_offer = F.struct(price.alias("price"), F.lit("EUR").alias("priceCurrency"), avail.alias("availability"))
    rating = F.struct(
        (F.col("p_size") % 50 / F.lit(10.0)).cast("decimal(3,1)").cast("string").alias("ratingValue"),
        (F.col("p_size") * 3).alias("reviewCount"))
    common = [
        F.lit("Product").alias("@type"), F.concat(F.lit("  "), F.col("p_name")).alias("name"),
        F.concat(F.lit("Over "), F.col("p_name")).alias("description"), F.col("gtin").alias("gtin13"),
        F.concat(F.lit("SKU-"), F.col("p_partkey")).alias("sku"), F.concat(F.lit("MPN"), F.col("p_partkey")).alias("mpn"),
        page_url.alias("url"), rating.alias("aggregateRating"),
    ]
    brand_text, brand_obj = F.col("p_brand").alias("brand"), F.struct(F.col("p_brand").alias("name")).alias("brand")
    image = F.concat(F.lit("https://img.example.com/"), F.col("p_partkey"), F.lit(".jpg"))
    shape0 = F.to_json(F.struct(*common, brand_text, F.col("p_type").alias("model"), image.alias("image"), one_offer.alias("offers")))
    shape1 = F.to_json(F.struct(F.array(F.struct(
        *common, brand_obj, F.struct(F.col("p_type").alias("name")).alias("model"), F.array(image).alias("image"),
        F.array(one_offer).alias("offers"))).alias("@graph")))
    agg_offer = F.struct(
        price.alias("lowPrice"), plain_price(base_cents()).alias("highPrice"), F.lit("EUR").alias("priceCurrency"), avail.alias("availability"))
    shape3 = F.to_json(F.array(F.struct(
        F.lit("Product").alias("@type"), F.col("p_name").alias("name"), brand_obj, F.col("gtin").alias("gtin"),
        F.struct(image.alias("url")).alias("image"), agg_offer.alias("offers"))))
    s = F.col("shape")
    return F.when(s == 0, shape0).when(s == 1, shape1).when(s == 3, shape3)


def crumb_json(root: str) -> Column:
    """Shop, brand and type as a breadcrumb list; links as text or as objects."""
    def element(pos: int, name: Column, link: Column, as_object: bool) -> Column:
        item = F.struct(link.alias("@id")) if as_object else link
        return F.to_json(F.struct(F.lit("ListItem").alias("@type"), F.lit(pos).alias("position"), name.alias("name"), item.alias("item")))

    brand_link = F.concat(F.lit(root + "/"), F.replace("p_brand", F.lit("#"), F.lit("-")), F.lit(".html"))
    type_link = F.concat(F.lit(root + "/"), F.lower("p_type"), F.lit(".html?utm_source=x"))
    return F.concat(
        F.lit('{"@type":"BreadcrumbList","itemListElement":['), element(1, F.col("p_brand"), brand_link, False), F.lit(","),
        element(2, F.col("p_type"), type_link, True), F.lit("]}"))


def spec_html() -> Column:
    """Specifications as table rows, definition list and 'label: value' items."""
    code = F.coalesce(F.concat(F.lit("<tr><th>EAN Code<td>"), F.col("gtin")), F.lit(""))
    return F.concat(
        F.lit("<table><tr><th>Merk</th><td><b>"), F.col("p_brand"), F.lit("</b></td></tr>"), code,
        F.lit("<tr><th>SKU</th><td>SKU-"), F.col("p_partkey"), F.lit("</td></tr></table><dl><dt>Modelnummer<dd>"), F.col("p_type"),
        F.lit("<dt>Merk</dt><dd>later</dd></dl><ul><li>Onderdeelnummer: MPN"), F.col("p_partkey"),
        F.lit("<li>Kleur : zwart</li></ul>"))


def _head(extra: Column) -> Column:
    return F.concat(
        F.lit("<!DOCTYPE html><html><head><title>"), F.col("p_name"), F.lit(" | Bax Shop</title>"), extra,
        F.lit("<script>var t='</p>';</script></head><body><h1>"), F.col("p_name"), F.lit("</h1>"))


def bax_pages(spark: SparkSession, d: str, more_cents: int = 0) -> DataFrame:
    root = "https://www.bax-shop.nl"
    u = F.concat(F.lit(root + "/studiomicrofoons/grootmembraan_set/"), F.col("slug"), F.lit("-"), F.col("p_partkey"), F.lit("?utm_source=feed"))
    ld = F.coalesce(_script(product_json(u)), F.lit("<script type='application/ld+json'>{broken</script>"))
    crumbs = F.when(F.col("shape") == 1, _script(crumb_json(root))).otherwise("")
    nav = F.when(F.col("shape") == 2, F.concat(
        F.lit("<nav aria-label='breadcrumb'><a href='/'>Home</a><a href='/merken/x?ref=1'>"), F.col("p_brand"), F.lit("</a></nav>"))).otherwise("")
    stock = F.when(F.col("p_size") % 3 == 0, "Niet leverbaar").otherwise("Op voorraad")
    buy = F.when(F.col("shape") == 2, F.concat(
        F.lit("<div class='buy-box'>Van <span class='price-old'><s>"), euro_price(base_cents()), F.lit("</s></span> voor <span class='price'><b>"),
        euro_price(F.col("c")), F.lit("</b></span> <i>"), stock, F.lit("</i></div>"))).otherwise("")
    service = F.concat(
        F.lit("<footer><p>Gratis verzending vanaf € "), F.col("p_size"), F.lit(",50</p><p>"), F.col("p_size"),
        F.lit(" dagen bedenktijd, 3 jaar garantie bij Bax Music. PostNL. Gratis retour.</p><a href='/klantenservice/contact'>Contact</a></footer>"))
    html = F.concat(_head(F.lit("<meta name='description' content='Over dit product'>")), ld, crumbs, nav, buy, spec_html(), service, F.lit("</body></html>"))
    return parts(spark, d, more_cents).select("p_partkey", u.alias("url"), html.alias("html"))


def thomann_pages(spark: SparkSession, d: str, more_cents: int = 0) -> DataFrame:
    root = "https://www.thomann.nl"
    u = F.concat(F.lit(root + "/"), F.col("slug"), F.lit("_"), F.col("p_partkey"), F.lit(".htm?ref=a&x=1"))
    ld = F.coalesce(_script(product_json(u)), F.lit(""))
    crumbs = F.when(F.col("shape") == 1, _script(crumb_json(root))).when(F.col("shape") == 2, F.concat(
        F.lit("<ol itemtype='https://schema.org/BreadcrumbList'><li itemtype='https://schema.org/ListItem'><a itemprop='item' href='/brand.html'>"
              "<span itemprop='name'>"), F.col("p_brand"), F.lit("</span></a><li itemtype='https://schema.org/ListItem'><a itemprop='item' href='/type.html'>"
              "<span itemprop='name'>"), F.col("p_type"), F.lit("</span></a></li></ol>"))).otherwise("")
    box = F.when(F.col("shape").isin(2, 3), F.concat(
        F.lit("<div class='price-and-availability'><div class='price'>"), euro_price(F.col("c")),
        F.lit("</div><p>30-Dagen-Beste-Prijs: "), euro_price(base_cents()), F.lit("</p></div>"))).otherwise("")
    badge = F.when(F.col("shape") == 2, F.concat(
        F.lit("<span class='fx-availability "), F.when(F.col("p_size") % 3 == 0, "fx-availability--out-of-stock").otherwise("x"),
        F.lit("'>Direct leverbaar</span>"))).otherwise("")
    html = F.concat(
        _head(F.concat(F.lit("<meta property='og:image' content='https://img.example.com/"), F.col("p_partkey"), F.lit(".jpg'>"))), ld, crumbs, box, badge,
        F.lit("<p>Artikelnummer: "), F.col("p_partkey") + 100000, F.lit("</p></body></html>"))
    return parts(spark, d, more_cents).select("p_partkey", u.alias("url"), html.alias("html"))


def bol_pages(spark: SparkSession, d: str, more_cents: int = 0) -> DataFrame:
    u = F.concat(F.lit("https://www.bol.com/nl/nl/p/"), F.col("slug"), F.lit("/"), F.col("p_partkey"), F.lit("/?bltgh=x&Referrer=y"))
    ld = F.coalesce(_script(product_json(u)), F.lit(""))
    category = F.when(F.col("p_partkey") % 5 == 4, "statieven").otherwise("microfoons")
    kind = F.when(F.col("p_partkey") % 7 == 6, " statief").otherwise(" microfoon")
    nav = F.concat(F.lit("<nav><a href='/nl/nl/l/"), category, F.lit("/7119/?promo=1'>cat</a></nav>"))
    stock = F.when(F.col("p_size") % 3 == 0, "Uitverkocht").otherwise("Op voorraad")
    buy = F.concat(
        F.lit("<div data-test='buy-block'><span data-test='price'>"), F.replace(plain_price(F.col("c")), F.lit("."), F.lit(",")),
        F.lit("</span><del data-test='was-price'>"), euro_price(base_cents()), F.lit("</del><p data-test='stock-info'>"), stock,
        F.lit("</p></div><span data-test='rating'>4,5</span><a data-test='brand-link' href='/nl/nl/b/x/'>"), F.col("p_brand"), F.lit("</a>"))
    html = F.concat(
        F.lit("<html><head><title>t</title></head><body>"), nav, F.lit("<h1 data-test='title'>"), F.col("p_name"), kind, F.lit("</h1>"), ld,
        F.when(F.col("shape") == 2, buy).otherwise(""), F.lit("<p>EAN : "), F.coalesce("gtin", F.lit("-")),
        F.lit("</p><img data-test='product-image' src='//img.example.com/a.jpg'></body></html>"))
    return parts(spark, d, more_cents).select("p_partkey", u.alias("url"), html.alias("html"))


def maxiaxi_pages(spark: SparkSession, d: str, more_cents: int = 0) -> DataFrame:
    u = F.concat(F.lit("https://www.maxiaxi.com/"), F.col("slug"), F.lit("-"), F.col("p_partkey"), F.lit(".html?gclid=1#top"))
    html = F.concat(
        _head(F.lit("<meta property='og:image' content='https://img.example.com/og.jpg'>")), spec_html(),
        F.lit("<div class='product attribute description'><p>Over <i>"), F.col("p_name"), F.lit("</i></p></div></body></html>"))
    return parts(spark, d, more_cents).select("p_partkey", u.alias("url"), html.alias("html"))
