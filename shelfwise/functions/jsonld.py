"""JSON-LD columns over VARIANT. Everything stays in the page's own row: no explode, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise import lexicon
from shelfwise.functions.text import bind, clean, first_nonblank

_NO_NODES = "array<variant>"
# A list inside a list, and a graph: what makes nodes lie deeper.
_LIST_IN_LIST, _GRAPH = r"[\[,]\[", r'"@graph":'

_LD_BLOCK = r'(?is)<script\b[^>]*type\s*=\s*["\']application/ld\+json["\'][^>]*>(.*?)</script\s*>'
_STATE_BLOCK = (
    r'(?is)<script\b[^>]*(?:type\s*=\s*["\']application/json["\']|id\s*=\s*["\']__(?:NEXT_DATA|NUXT)__["\'])'
    r'[^>]*>(.*?)</script\s*>'
)
_ANY_SCRIPT = r"(?is)<script\b[^>]*>(.*?)</script\s*>"


def script_texts(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(_ANY_SCRIPT), F.lit(1))


def blocks(html: Column) -> Column:
    """Parsed JSON-LD blocks; malformed ones are left out."""
    texts = F.regexp_extract_all(html, F.lit(_LD_BLOCK), F.lit(1))
    return F.filter(F.transform(texts, F.try_parse_json), lambda v: v.isNotNull())


def state_blocks(html: Column) -> Column:
    """Parsed application-state scripts, an assignment in front of the JSON removed."""
    texts = F.regexp_extract_all(html, F.lit(_STATE_BLOCK), F.lit(1))
    bare = F.transform(
        texts,
        lambda t: F.regexp_replace(
            F.trim(t), r"(?s)^window\.__(?:NUXT|INITIAL_STATE)__=\s*(.*?);?\s*$", "$1"))
    return F.filter(F.transform(bare, F.try_parse_json), lambda v: v.isNotNull())


def kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, ... of a variant; NULL for an absent one."""
    return F.substring_index(F.substring_index(F.schema_of_variant(v), "<", 1), "(", 1)


def sub(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def _elements(v: Column) -> Column:
    return F.coalesce(F.try_variant_get(v, "$", _NO_NODES), F.array(v))


# Up to so many levels the count of brackets is bound enough.
_FEW_LEVELS = 4


def nodes(blocks_: Column) -> Column:
    """All objects, through lists and @graph of any depth, in document order."""
    return F.flatten(F.transform(blocks_, _nodes_of))


def _nodes_of(block: Column) -> Column:
    """Each step opens one level of lists or graphs; the block's own brackets bound their number.

    Where the whole text counts many, brackets in texts are left out (texts are emptied, but for the key of a
    graph), and the depth of the brackets is a bound too, by a fold over them.
    """
    opened_by = lambda t: 1 + F.regexp_count(t, F.lit(_LIST_IN_LIST)) + 2 * F.regexp_count(t, F.lit(_GRAPH))

    def bound(text: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(text, r"\\.", ""), r'("@graph")|"[^"]*"', "$1")
        exact = bind(bare, lambda b: F.least(opened_by(b), _bracket_depth(b)))
        return bind(opened_by(text), lambda n: F.when(n <= _FEW_LEVELS, n).otherwise(exact))

    levels = bind(F.to_json(block), bound)
    start = F.transform(_elements(block), _unopened)
    opened = F.aggregate(F.sequence(F.lit(1), levels), start, lambda level, _: F.flatten(F.transform(level, _opened)))
    return F.transform(F.filter(opened, lambda e: kind(e["v"]) == "OBJECT"), lambda e: e["v"])


def _bracket_depth(text: Column) -> Column:
    """Most brackets that are open at once."""
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(state: Column, bracket: Column) -> Column:
        now = state["now"] + F.when(bracket.isin("[", "{"), 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

    return F.aggregate(F.regexp_extract_all(text, F.lit(r"[\[\]{}]"), F.lit(0)), start, step, lambda state: state["most"])


def _unopened(v: Column) -> Column:
    return F.struct(v.alias("v"), F.lit(False).alias("opened"))


def _opened(e: Column) -> Column:
    """A list's elements, or a node followed by its graph, unless that was done before."""
    listed = F.try_variant_get(e["v"], "$", _NO_NODES)
    graph = F.try_variant_get(e["v"], '$["@graph"]', "variant")
    itself = F.array(F.struct(e["v"].alias("v"), F.lit(True).alias("opened")))
    return (
        F.when(e["opened"], itself).when(listed.isNotNull(), F.transform(listed, _unopened))
        .when(graph.isNull(), itself).otherwise(F.concat(itself, F.array(_unopened(graph)))))


def types(v: Column) -> Column:
    listed = F.try_variant_get(v, '$["@type"]', "array<string>")
    return F.coalesce(listed, F.array(F.try_variant_get(v, '$["@type"]', "string")))


def is_type(v: Column, name: str) -> Column:
    return F.coalesce(F.array_contains(types(v), name), F.lit(False))


def of_type(nodes_: Column, name: str) -> Column:
    return F.filter(nodes_, lambda v: is_type(v, name))


def first_node(nodes_: Column) -> Column:
    return F.get(nodes_, F.lit(0))


def first_product(nodes_: Column, shop: str) -> Column:
    """First Product; one shop also takes any node that has a gtin or offers."""
    if shop == "bol":
        return first_node(F.filter(nodes_, lambda v: is_type(v, "Product")
                                   | is_type(v, "IndividualProduct")
                                   | sub(v, "$.gtin").isNotNull() | sub(v, "$.offers").isNotNull()))
    return first_node(of_type(nodes_, "Product"))


def scalar(v: Column, path: str) -> Column:
    """Text of a scalar field; objects and lists give NULL, not their JSON text."""
    return bind(sub(v, path), _scalar_text)


def _scalar_text(x: Column) -> Column:
    return F.when(~F.schema_of_variant(x).rlike("^(?:OBJECT|ARRAY)"), F.try_variant_get(x, "$", "string"))


def text(v: Column, path: str) -> Column:
    return clean(scalar(v, path))


def string_only(v: Column, path: str) -> Column:
    return bind(sub(v, path), lambda x: F.when(
        F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string")))


def _first_or_self(v: Column, path: str) -> Column:
    """A field that may be one object or a list of them."""
    return F.when(
        kind(sub(v, path)) == "ARRAY", F.try_variant_get(v, path + "[0]", "variant")
    ).otherwise(sub(v, path))


def offer(product: Column) -> Column:
    return _first_or_self(product, "$.offers")


def name_or_text(v: Column, field: str, *inner: str) -> Column:
    """A brand or model: plain text, or an object holding it under one of `inner`."""
    return first_nonblank(*[text(v, f"$.{field}{i}") for i in inner], text(v, f"$.{field}"))


def image(product: Column, shop: str) -> Column:
    direct = F.coalesce(scalar(product, "$.image[0]"), string_only(product, "$.image"))
    if shop == "bol":
        inner = [scalar(product, p) for p in (
            "$.image.url", "$.image.contentUrl", "$.image[0].url", "$.image[0].contentUrl")]
        return clean(first_nonblank(*inner, direct))
    return clean(direct)


def product_fields(product: Column, shop: str) -> dict[str, Column]:
    """Identity and content columns of a Product node."""
    from shelfwise.functions.text import gtin_preference

    gtins = {k: text(product, f"$.{k}") for k in ("gtin13", "gtin14", "gtin12", "gtin8", "gtin")}
    model_inner = [".name", '["@id"]', ".url"] if shop == "bol" else [".name", ".model"]
    o = offer(product)
    return {
        "title": text(product, "$.name"),
        "description": text(product, "$.description"),
        "brand": name_or_text(product, "brand", ".name"),
        "model": name_or_text(product, "model", *model_inner),
        "gtin": gtin_preference(gtins, shop),
        "mpn": text(product, "$.mpn"),
        "sku": text(product, "$.sku"),
        "image_url": image(product, shop),
        "currency": text(o, "$.priceCurrency"),
        "availability": string_only(o, "$.availability"),
        "rating_value": text(product, "$.aggregateRating.ratingValue"),
        "review_count": first_nonblank(
            text(product, "$.aggregateRating.reviewCount"),
            text(product, "$.aggregateRating.ratingCount"),
        ),
    }


def offer_prices(product: Column) -> dict[str, Column]:
    """Current price from price, lowPrice or the price specification; highPrice as base."""
    from shelfwise.functions.price import parse_number

    o = offer(product)
    spec = _first_or_self(o, "$.priceSpecification")
    return {
        "current": F.coalesce(
            parse_number(scalar(o, "$.price")),
            parse_number(scalar(o, "$.lowPrice")),
            parse_number(scalar(spec, "$.price")),
        ),
        "base": parse_number(scalar(o, "$.highPrice")),
        "price_text": text(o, "$.price"),
    }


# ---- lists of links ------------------------------------------------------

def _list_elements(nodes_: Column, list_type: str) -> Column:
    return F.flatten(F.transform(
        of_type(nodes_, list_type),
        lambda n: F.coalesce(F.try_variant_get(n, "$.itemListElement", _NO_NODES),
                             F.array().cast(_NO_NODES))))


def itemlist_urls(nodes_: Column, only_products: bool = False) -> Column:
    """Urls of all ItemList elements, optionally only those typed Product."""
    elements = _list_elements(nodes_, "ItemList")
    if only_products:
        elements = F.filter(
            elements, lambda e: is_type(e, "Product") | is_type(sub(e, "$.item"), "Product"))
    urls = F.transform(
        elements,
        lambda e: first_nonblank(
            string_only(e, "$.url"), string_only(e, "$.item.url"), string_only(e, '$.item["@id"]')))
    return F.filter(urls, lambda u: u.isNotNull())


def itemlist_targets(nodes_: Column) -> Column:
    """Variant used by the shop whose items may also be plain urls; the item wins."""
    urls = F.transform(
        _list_elements(nodes_, "ItemList"),
        lambda e: first_nonblank(
            string_only(e, '$.item["@id"]'), string_only(e, "$.item.url"),
            string_only(e, "$.item"), string_only(e, "$.url")))
    return F.filter(urls, lambda u: u.isNotNull())


def product_urls(nodes_: Column) -> Column:
    urls = F.transform(
        of_type(nodes_, "Product"),
        lambda n: first_nonblank(string_only(n, "$.url"), string_only(n, '$["@id"]')))
    return F.filter(urls, lambda u: u.isNotNull())


def crumbs(nodes_: Column) -> Column:
    """array<struct(name, url)> of the first BreadcrumbList."""
    first = F.slice(of_type(nodes_, "BreadcrumbList"), 1, 1)
    pairs = F.transform(
        _list_elements(first, "BreadcrumbList"),
        lambda e: F.struct(
            text(e, "$.name").alias("name"),
            clean(F.coalesce(string_only(e, "$.item"), string_only(e, '$.item["@id"]'))).alias("url"),
        ),
    )
    return F.filter(pairs, lambda p: p["name"].isNotNull() & p["url"].isNotNull())


def urls_in_json(json_text: Column) -> Column:
    """String values under a link key, or a key ending in url or href, at any depth."""
    exact = [k for k in lexicon.URL_JSON_KEYS if not k.endswith(("url", "href"))]
    keys = r"[^\"]*url|[^\"]*href|" + "|".join(exact)
    pattern = r'(?i)"(?:' + keys + r')"\s*:\s*"((?:[^"\\]|\\.)*)"'
    raw = F.regexp_extract_all(json_text, F.lit(pattern), F.lit(1))
    return F.transform(raw, lambda t: F.replace(t, F.lit("\\/"), F.lit("/")))


def state_urls(html: Column) -> Column:
    return F.flatten(F.transform(state_blocks(html), lambda v: urls_in_json(F.to_json(v))))
