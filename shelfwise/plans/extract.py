"""Stored product pages to typed records, one plan per shop.

pages(url, html) in, one wide row per product page out, without a shuffle. A shop is a list
of stages. Each stage adds columns that later ones read more than once, so Catalyst keeps
the stages apart and computes every column once per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import blocks as B
from shelfwise.functions import html as H
from shelfwise.functions import jsonld as L
from shelfwise.functions import keys, price, stock, text, url
from shelfwise.functions import structure as S
from shelfwise.operators import classify, support

Stage = Callable[[], dict[str, Column] | list[dict[str, Column]]]
_CRUMBS = "array<struct<name:string,url:string>>"
_BUILT: dict[tuple, list[dict[str, Column]]] = {}


def _built(stage: Stage) -> list[dict[str, Column]]:
    """Columns of a stage, in the steps they need. They name their inputs and nothing else, so they are built once
    per driver process and serve every later plan; building them takes seconds.
    """
    key = (stage, id(SparkContext._gateway))
    if key not in _BUILT:
        made = stage()
        _BUILT[key] = made if isinstance(made, list) else [made]
    return _BUILT[key]


def _run(df: DataFrame, stages: list[Stage]) -> DataFrame:
    for stage in stages:
        df = S.staged(df, _built(stage))
    return df


def _kept(pages: DataFrame) -> list[str]:
    return [c for c in pages.columns if c not in ("html", "url")]


def _c(name: str) -> Column:
    return F.col(name)


def _page_facts(shop: str) -> dict[str, Column]:
    h = _c("html")
    return {
        "source_url": url.strip_tracking(_c("url"), shop), "_m": B.marks(h),
        "_nodes": L.nodes(L.blocks(h)), "_metas": H.metas(h)}


def _product_facts(shop: str) -> dict[str, Column]:
    """Columns of the Product node, with the prefix ld_."""
    return {f"ld_{k}": v for k, v in L.product_fields(_c("_p"), shop).items()}


def _resolved(crumbs: Column, shop: str) -> Column:
    return F.transform(crumbs, lambda c: F.struct(
        c["name"].alias("name"),
        url.strip_tracking(url.resolve(_c("url"), c["url"]), shop).alias("url")))


def _first_filled(*arrays: Column) -> Column:
    """First array with an element; the sources further down are tried only if needed."""
    chain = F.array().cast(_CRUMBS)
    for a in reversed(arrays):
        chain = F.when(F.size(a) > 0, a.cast(_CRUMBS)).otherwise(chain)
    return chain


def _crumb_columns() -> dict[str, Column]:
    c = _c("_crumbs")
    n = F.size(c)
    return {
        "breadcrumb_path": F.transform(c, lambda x: x["name"]),
        "breadcrumb_urls": F.transform(c, lambda x: x["url"]),
        "breadcrumb_category": F.when(n >= 1, F.element_at(c, -1)["name"]),
        "breadcrumb_url": F.when(n >= 1, F.element_at(c, -1)["url"]),
        "breadcrumb_parent": F.when(n >= 2, F.get(c, n - 2)["name"]),
    }


def _specs():
    return S.spec_steps("html", "_specs")


def _shown_crumbs():
    return S.crumb_steps("html", "_shown_crumbs")


def _item_crumbs():
    return S.item_crumb_steps("html", "_item_crumbs")


def _no_crumbs() -> dict[str, Column]:
    return {"_crumbs": F.array().cast(_CRUMBS)}


def _amount(strict: bool) -> dict[str, Column]:
    return {"discount_amount": price.discount_amount(
        price.money(_c("base_price")), price.money(_c("current_price")), strict)}


def _strict_amount() -> dict[str, Column]:
    return _amount(strict=True)


def _percent() -> dict[str, Column]:
    return {"discount_percent": price.percent_of(_c("discount_amount"), price.money(_c("base_price")))}


# ---- first shop: everything from one page, service facts included --------

def _bax_page():
    return {**_page_facts("bax"), "page_text": H.body_text(_c("html"))}


def _bax_product():
    return {"_p": L.first_product(_c("_nodes"), "bax"), "buy_text": B.all_text(_c("_m"), "buy"),
            "_rating_text": F.coalesce(B.all_text(_c("_m"), "rating"), F.lit(""))}


def _bax_json():
    return {**_product_facts("bax"), "_ld_price": L.scalar(L.offer(_c("_p")), "$.price")}


def _bax_crumbs():
    def not_self(a):
        return F.filter(a, lambda c: c["url"] != _c("source_url"))

    listed = F.transform(L.crumbs(_c("_nodes")), lambda c: F.struct(
        c["name"].alias("name"), url.strip_tracking(c["url"], "bax").alias("url")))
    shown = _resolved(_c("_shown_crumbs"), "bax")
    return {"_crumbs": text.bind(not_self(listed), lambda a: _first_filled(
        a, not_self(shown), url.breadcrumbs(_c("source_url"))))}


def _bax_identity():
    h, m, metas, spec, body = (_c(n) for n in ("html", "_m", "_metas", "_specs", "page_text"))
    return {
        "title": F.coalesce(_c("ld_title"), text.without_shop_suffix(H.title(h, metas, "bax"))),
        "brand": F.coalesce(
            _c("ld_brand"), B.own_text(m, "brand"), H.meta(metas, "product:brand"),
            S.spec_value(spec, "merk", "brand", "fabrikant")),
        "image_url": F.coalesce(_c("ld_image_url"), H.meta(metas, "og:image")),
        "description": F.coalesce(_c("ld_description"), H.meta(metas, "description", "og:description")),
        "sku": F.coalesce(_c("ld_sku"), S.spec_value(spec, "sku")),
        "mpn": F.coalesce(
            _c("ld_mpn"), S.spec_value(spec, "mpn", "part number", "onderdeelnummer"), text.part_number_in_text(body)),
        "gtin": F.coalesce(_c("ld_gtin"), S.spec_value(spec, "ean", "gtin"), text.gtin_in_text(body)),
        "model": text.model_name(F.coalesce(
            _c("ld_model"), S.spec_value(spec, "model", "modelnummer", "typenummer"),
            text.model_in_text(body, needs_digit=True)), "bax"),
        "currency": F.coalesce(_c("ld_currency"), F.lit("EUR")),
    }


def _bax_price_sources():
    m, metas = _c("_m"), _c("_metas")
    item_text = B.own_text(m, "item_price")
    return {
        "_box": price.buy_block_prices(_c("buy_text")),
        "_in_box": price.first_price_text(B.texts_within(m, "price", "buy")),
        "_stated": F.coalesce(
            H.meta(metas, "product:price:amount", "og:price:amount"), text.clean(B.shown_attribute(m, "item_price")),
            text.bind(item_text, lambda t: F.when(price.looks_like_price(t), t))),
        "_stated_percent": price.discount_in_text(_c("buy_text")),
    }


def _bax_first_price():
    """A text from the buy block must look like a price; it then goes before the other sources."""
    box = _c("_in_box")
    found = F.when(box.isNull(), _c("_stated")).when(price.looks_like_price(box), box)
    return {"_found": found}


def _bax_price_text():
    return {
        "price_text": F.coalesce(text.clean(_c("_ld_price")), _c("_found")),
        "_first_price": F.coalesce(price.parse_eu(_c("_ld_price")), price.parse_eu(_c("_found"))),
    }


def _bax_current():
    cur, alt, base = _c("_first_price"), _c("_box.current"), _c("_box.base")
    return {"current_price": F.when(cur.isNull(), alt).when((cur >= base) & (alt < cur), alt).otherwise(cur)}


def _bax_base():
    cur, base = _c("current_price"), _c("_box.base")
    return {"base_price": F.when(cur.isNull() | (base >= cur), base)}


def _bax_amount():
    return _amount(strict=False)


def _bax_percent():
    derived = _percent()["discount_percent"]
    return {"discount_percent": F.coalesce(_c("_stated_percent").cast("decimal(7,2)"), derived)}


def _bax_rest():
    rating = F.coalesce(
        price.parse_number(_c("ld_rating_value")), price.rating_in_text(_c("_rating_text"), r"\b(\d(?:[.,]\d)?)\b"))
    return {
        "in_stock": F.coalesce(
            stock.from_availability(_c("ld_availability"), "bax"), stock.from_text(_c("buy_text"), "bax")),
        "stock_status_text": F.coalesce(_c("ld_availability"), _c("buy_text")),
        "rating_value": text.bind(rating, price.rating_within_scale),
        "review_count": F.coalesce(_c("ld_review_count"), text.first_group(_c("_rating_text"), r"\b(\d+)\b")),
        "canonical_name": text.canonical_strict(_c("brand"), _c("title"), _c("model")),
        **support.service_columns(_c("page_text"), "bax"),
        "customer_service_url": H.support_link(_c("url"), _c("html"), "bax"),
    }


def bax(pages: DataFrame) -> DataFrame:
    stages = [
        _bax_page, _specs, _shown_crumbs, _bax_product, _bax_json, _bax_crumbs, _bax_identity, _bax_price_sources, _bax_first_price, _bax_price_text,
        _bax_current, _bax_base, _bax_amount, _bax_percent, _crumb_columns, _bax_rest]
    return _run(pages, stages).select(*_kept(pages), *_RECORD, *_SERVICE)


# ---- shop with article numbers and reference prices ----------------------

def _thomann_page():
    return _page_facts("thomann")


def _thomann_product():
    m = _c("_m")
    return {
        "_p": L.first_product(_c("_nodes"), "thomann"),
        "_price_box": B.all_text(m, "price_box"),
        "_ref": price.reference_price(B.all_text(m, "price_or_stock_box")),
        "_badge_text": text.clean(F.get(B.texts(m, "badge", 0, 0), F.lit(0))),
        "_badge_class": B.shown_attribute(m, "badge"),
        "_link_stock": H.first_attribute(_c("html"), "link", r"""itemprop=["']availability""", "href"),
    }


def _thomann_json():
    listed = L.scalar(L.offer(_c("_p")), "$.price")
    return {**_product_facts("thomann"), "_ld_price": text.bind(
        listed, lambda t: F.struct(price.sane(price.parse_plain(t)).alias("price"), text.clean(t).alias("text")))}


def _thomann_crumbs():
    def categories(a):
        return F.filter(a, lambda c: url.is_category(c["url"]))

    return {"_crumbs": text.bind(categories(L.crumbs(_c("_nodes"))), lambda a: _first_filled(
        a, _resolved(_c("_item_crumbs"), "thomann"), categories(_resolved(_c("_shown_crumbs"), "thomann"))))}


def _thomann_identity():
    h, m, metas = _c("html"), _c("_m"), _c("_metas")
    candidates = F.array_compact(F.array(
        H.item_meta(metas, "price"), H.meta(metas, "product:price:amount"), H.meta(metas, "og:price:amount"),
        B.shown_attribute(m, "item_price"), B.own_text(m, "item_price")))
    return {
        "listing_number": keys.article_number(h),
        "title": F.coalesce(_c("ld_title"), H.title(h, metas, "thomann")),
        "brand": _c("ld_brand"),
        "image_url": F.coalesce(_c("ld_image_url"), H.meta(metas, "og:image")),
        "description": F.coalesce(_c("ld_description"), H.meta(metas, "description", "og:description")),
        "sku": _c("ld_sku"), "mpn": _c("ld_mpn"), "gtin": _c("ld_gtin"),
        "model": text.model_name(_c("ld_model"), "thomann"),
        "currency": F.coalesce(_c("ld_currency"), F.lit("EUR")),
        "_meta": price.first_sane(candidates),
        "_lowest": price.lowest_sane_price(_c("_price_box")),
    }


def _thomann_price():
    listed = _c("_ld_price")
    return {
        "current_price": F.coalesce(listed["price"], _c("_meta.price"), _c("_lowest")),
        "price_text": F.coalesce(F.when(listed["price"].isNotNull(), listed["text"]), _c("_meta.text")),
    }


def _thomann_base():
    return {"base_price": F.when(_c("_ref") > _c("current_price"), _c("_ref"))}


def _thomann_rest():
    return {
        "in_stock": F.coalesce(
            stock.from_availability(_c("ld_availability"), "thomann"),
            stock.from_badge(_c("_badge_class"), _c("_badge_text"), _c("_link_stock"))),
        "stock_status_text": F.coalesce(
            _c("ld_availability"), _c("_badge_text"), text.first_group(_c("_link_stock"), "(InStock|OutOfStock)")),
        "rating_value": price.parse_number(_c("ld_rating_value")),
        "review_count": _c("ld_review_count"),
        "canonical_name": text.canonical_strict(_c("brand"), _c("title"), _c("model")),
    }


def thomann(pages: DataFrame) -> DataFrame:
    stages = [
        _thomann_page, _shown_crumbs, _item_crumbs, _thomann_product, _thomann_json, _thomann_crumbs, _thomann_identity, _thomann_price, _thomann_base,
        _strict_amount, _percent, _crumb_columns, _thomann_rest]
    return _run(pages, stages).select(*_kept(pages), "listing_number", *_RECORD)


# ---- shop whose pages are first filtered for category and relevance ------

def _bol_page():
    facts = _page_facts("bol")
    facts.pop("_m")  # only for the pages that pass the filter, below
    return facts


def _bol_marks():
    return {"_m": B.marks(_c("html"))}


def _bol_filter_facts():
    links = F.transform(H.nav_links(_c("html")), lambda u: url.strip_tracking(url.resolve(_c("url"), u), "bol"))
    product = L.first_product(_c("_nodes"), "bol")
    return {"_p": product, "_crumb_urls": links,
            "title": F.coalesce(H.leading_text(_c("html"), "h1"), L.text(product, "$.name"))}


def _bol_product():
    h, m = _c("html"), _c("_m")
    prices = L.offer_prices(_c("_p"))
    box_price = F.filter(F.transform(B.texts_within(m, "price", "buy_block"), text.clean), lambda t: t.isNotNull())
    return {
        "page_text": F.coalesce(classify.without_dialog(H.body_text(h)), F.lit("")),
        "_badge": F.coalesce(B.own_text(m, "stock"), B.all_text(m, "stock")),
        "_block": F.coalesce(B.all_text(m, "delivery"), B.all_text(m, "buy_block")),
        "_ld_current": prices["current"], "_ld_base": prices["base"],
        "_shown": F.coalesce(B.own_text(m, "price_exact"), F.get(box_price, F.lit(0)), text.joined_text(B.texts(m, "price_exact", 1))),
        "_was": F.coalesce(B.own_text(m, "was_price"), text.joined_text(B.texts(m, "was_price", 1))),
        **_product_facts("bol"),
    }


def _bol_stock_text():
    return {"_stock_text": F.coalesce(_c("_badge"), _c("_block"))}


def _bol_rest():
    h, m, metas, body = (_c(n) for n in ("html", "_m", "_metas", "page_text"))
    image = F.coalesce(
        _c("ld_image_url"),
        text.clean(H.first_attribute(h, "img", r"""data-test=["']product-image["']""", "src")),
        text.clean(H.first_attribute(h, "img", r"(?i)\ssrcset=", "src")),
        text.clean(H.first_attribute(h, "img", r"(?i)\ssrc=", "src")))
    meta_price = F.coalesce(H.item_meta(metas, "price"), H.meta(metas, "product:price:amount"))
    return {
        "brand": F.coalesce(B.own_text(m, "brand"), _c("ld_brand")),
        "description": classify.without_dialog(F.coalesce(_c("ld_description"), B.all_text(m, "description"))),
        "image_url": text.bind(image, url.https_if_scheme_less),
        "sku": _c("ld_sku"), "mpn": _c("ld_mpn"),
        "gtin": F.coalesce(_c("ld_gtin"), text.gtin_in_text(body)),
        "model": text.model_name(F.coalesce(_c("ld_model"), text.model_in_text(body, needs_digit=False)), "bol"),
        "currency": F.coalesce(_c("ld_currency"), F.lit("EUR")),
        "current_price": F.coalesce(
            _c("_ld_current"), price.parse_first(meta_price), price.parse_first(_c("_shown")), price.embedded_price(L.script_texts(h))),
        "base_price": F.coalesce(_c("_ld_base"), price.parse_first(_c("_was"))),
        "in_stock": F.coalesce(
            stock.from_availability(_c("ld_availability"), "bol"), stock.from_text(_c("_stock_text"), "bol")),
        "stock_status_text": stock.status_text(_c("_stock_text")),
        "rating_value": F.coalesce(
            price.parse_number(_c("ld_rating_value")), price.rating_in_text(B.own_text(m, "rating_exact"), r"(\d+(?:[.,]\d+)?)")),
        "review_count": F.coalesce(
            price.review_count(_c("ld_review_count")), price.review_count_in_text(B.own_text(m, "rating_count"))).cast("string"),
    }


def _bol_names():
    return {
        "price_text": F.coalesce(_c("_shown"), price.price_label(_c("current_price"))),
        "canonical_name": text.canonical_loose(_c("brand"), _c("title"), _c("model")),
    }


def bol(pages: DataFrame) -> DataFrame:
    facts = _run(pages, [_bol_page, _bol_filter_facts])
    wanted = facts.filter(classify.has_allowed_crumb(_c("_crumb_urls")) & classify.is_relevant(_c("title"), _c("url")))
    stages = [
        _bol_marks, _bol_product, _bol_stock_text, _bol_rest, _bol_names, _strict_amount, _percent, _no_crumbs, _crumb_columns]
    return _run(wanted, stages).select(*_kept(pages), *_RECORD)


# ---- shop whose facts stand in the specification table -------------------

def _maxiaxi_page():
    h = _c("html")
    return {"_m": B.marks(h), "_metas": H.metas(h), "source_url": url.strip_tracking(_c("url"), "maxiaxi")}


def _maxiaxi_facts():
    h, metas = _c("html"), _c("_metas")
    return {
        "title": H.title(h, metas, "maxiaxi"),
        "image_url": text.first_text(
            H.first_attribute(h, "img", r"fotorama__img|product-image-photo", "src"), H.meta(metas, "og:image")),
        "description": B.all_text(_c("_m"), "description"),
    }


def _maxiaxi_identity():
    def exact(label):
        return F.try_element_at(_c("_specs"), F.lit(label))

    return {"brand": exact("merk"), "sku": exact("sku"), "model": exact("sku"), "gtin": exact("ean code")}


def maxiaxi(pages: DataFrame) -> DataFrame:
    s = _run(pages, [_maxiaxi_page, _specs, _maxiaxi_facts, _maxiaxi_identity])
    return s.select(
        *_kept(pages), "source_url", "title", "brand", "sku", "model", "gtin", "image_url", "description",
        text.canonical_pair(_c("brand"), _c("model"), _c("title")).alias("canonical_name"))


_RECORD = [
    "source_url", "title", "brand", "model", "canonical_name", "gtin", "mpn", "sku", "description",
    "image_url", "currency", "current_price", "base_price", "discount_amount", "discount_percent",
    "price_text", "in_stock", "stock_status_text", "rating_value", "review_count",
    "breadcrumb_category", "breadcrumb_parent", "breadcrumb_url", "breadcrumb_path", "breadcrumb_urls",
]
_SERVICE = [
    "shipping_included", "free_shipping_threshold_amt", "pickup_point_available",
    "delivery_shipping_available", "delivery_courier_available", "cooling_off_days", "free_returns",
    "warranty_provider", "warranty_duration_months", "customer_service_url",
]

SHOPS = {"bax": bax, "bol": bol, "maxiaxi": maxiaxi, "thomann": thomann}
