"""Page classification and quality filters, as boolean columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import lexicon
from shelfwise.functions import html as H
from shelfwise.functions import jsonld as L
from shelfwise.functions import keys, url
from shelfwise.functions.text import bind, has_any, squeezed


def _under(size: Column, least: int | None) -> Column:
    return F.lit(False) if least is None else size < least


def is_bad_html(html: Column, least_bytes: int | None = None) -> Column:
    """A block notice anywhere in the document. `least_bytes`: shorter documents are bad as well."""
    return html.isNull() | _under(F.octet_length(html), least_bytes) | has_any(html, lexicon.BLOCK_NEEDLES)


def is_shell(html: Column, least_chars: int | None = None) -> Column:
    """A consent shell or block page: a marker anywhere. `least_chars`: shorter documents count too."""
    return html.isNull() | has_any(html, lexicon.SHELL_MARKERS) | _under(F.length(html), least_chars)


def is_blocked(
    html: Column, status: Column | None = None, least_bytes: int | None = None, untitled_bytes: int | None = None,
) -> Column:
    """A blocking status, or a needle in title or body. `least_bytes`: shorter documents are
    blocked; `untitled_bytes`: so are documents without title that are shorter than that."""
    size = F.octet_length(html)
    by_title = bind(
        H.leading_text(html, "title"),
        lambda t: has_any(t, lexicon.BLOCK_TITLE_NEEDLES) | (t.isNull() & _under(size, untitled_bytes)))
    rules = html.isNull() | by_title | _under(size, least_bytes) | has_any(html, lexicon.BLOCK_BODY_NEEDLES)
    if status is not None:
        rules = F.coalesce(status.isin(lexicon.BLOCK_STATUS), F.lit(False)) | rules
    return F.coalesce(rules, F.lit(True))


def without_consent(c: Column) -> Column:
    """Texts about cookies and consent say nothing about support: NULL."""
    return F.when(~has_any(c, lexicon.CONSENT_PHRASES + ["datalayer"]), c)


def without_dialog(c: Column) -> Column:
    return F.when(~has_any(c, ["modal window", "dialog window"]), c)


def is_relevant(title: Column, page_url: Column) -> Column:
    """Is the item a microphone: excluded words, then included, then known lines, then url."""

    def judged(t: Column) -> Column:
        return (
            F.when(has_any(t, lexicon.IRRELEVANT_WORDS), False)
            .when(has_any(t, lexicon.RELEVANT_WORDS + lexicon.KNOWN_LINES), True)
            .otherwise(has_any(page_url, lexicon.RELEVANT_URL_PARTS)))

    # Bound, as a filter on this is pushed down with the whole title expression in it.
    return bind(F.coalesce(squeezed(title), F.lit("")), judged)


def has_allowed_crumb(crumb_urls: Column) -> Column:
    """Pages without category crumbs pass; with crumbs, one must be allowed."""
    return bind(
        F.filter(crumb_urls, lambda u: u.contains("/nl/nl/l/")),
        lambda found: (F.size(found) == 0) | F.exists(found, url.is_microphone_category))


_TILE = (
    r'itemtype=["\'][^"\']*Product|data-product-id|data-sku|data-test=["\'][^"\']*product|'
    r'data-testid=["\'][^"\']*product'
)


def page_signals(pages: DataFrame) -> DataFrame:
    """pages(url, html) with the evidence columns and the decision product / listing / other."""
    h = F.col("html")
    staged = pages.withColumns({"_nodes": L.nodes(L.blocks(h)), "_metas": H.metas(h)}).withColumn(
        "_products", L.of_type(F.col("_nodes"), "Product"))
    product = L.first_node(F.col("_products"))
    og_type = F.lower(F.coalesce(H.meta(F.col("_metas"), "og:type"), F.lit("")))
    signals = staged.select(
        *pages.columns,
        F.size("_products").alias("n_products"),
        F.size(L.itemlist_urls(F.col("_nodes"), only_products=True)).alias("n_list_items"),
        H.count_tags(h, _TILE).alias("n_tiles"),
        H.has_next(h).alias("has_next"),
        og_type.contains("product").alias("og_product"),
        h.rlike(r'(?is)itemprop=["\']price["\']|property=["\']product:price:amount["\']').alias("has_price"),
        h.rlike(r'(?is)<form[^>]*action=["\'][^"\']*cart|data-test=["\'][^"\']*add-to-cart').alias("has_cart"),
        L.scalar(L.offer(product), "$.price").isNotNull().alias("has_offer_price"),
    )
    commerce = F.col("has_price") | F.col("has_cart")
    evidence = (
        (F.col("n_products") == 1).cast("int")
        + F.col("og_product").cast("int")
        + commerce.cast("int")
        + F.col("has_offer_price").cast("int")
    )
    listing = (
        (F.col("n_list_items") >= 5)
        | (F.col("n_tiles") >= 6)
        | F.col("has_next")
        | (F.col("n_products") > 1)
    )
    plain_product = (F.col("n_products") == 1) | F.col("og_product") | commerce
    is_product = F.when(~listing, plain_product).otherwise((evidence >= 3) & ~F.col("has_next"))
    return (
        signals.withColumn("evidence", evidence)
        .withColumn("listing_signals", listing)
        .withColumn("is_product", is_product)
        .withColumn(
            "page_kind",
            F.when(F.col("is_product"), "product").when(F.col("listing_signals"), "listing").otherwise("other"))
    )


def looks_like_product_page(html: Column, page_url: Column) -> Column:
    """An article number or a JSON-LD Product, on a product url."""
    has_product = F.size(L.of_type(L.nodes(L.blocks(html)), "Product")) > 0
    return (keys.article_number(html).isNotNull() | has_product) & url.is_product(page_url, "thomann")


def listing_has_content(html: Column) -> Column:
    titles = F.regexp_count(html, F.lit(r'(?is)<a\b[^>]*data-test=["\']product-title["\']'))
    links = F.regexp_count(html, F.lit(r'(?is)<a\b[^>]*href=["\'][^"\']*/nl/nl/p/'))
    return (titles >= 6) | (links >= 10)


def product_has_content(html: Column) -> Column:
    """A title and at least one sign of commerce."""
    sign = (
        r'(?is)data-test=["\'](?:buy-block|price|product-price)["\']|<meta\b[^>]*itemprop=["\']price["\']'
        r'|class=["\'][^"\']*promo-price|aria-label=["\'][^"\']*€|type=["\']application/ld\+json["\']'
    )
    return H.leading_text(html, "h1").isNotNull() & html.rlike(sign)
