"""Url columns, built on the generic RFC 3986 split so that odd urls never raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise import lexicon
from shelfwise.functions.text import bind, blank_to_null, first_group, has_any, quoted, slug_label

_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def scheme(u: Column) -> Column:
    return F.lower(F.regexp_extract(u, _SPLIT, 1))


def host(u: Column) -> Column:
    return F.regexp_extract(u, _SPLIT, 2)


def path(u: Column) -> Column:
    return F.regexp_extract(u, _SPLIT, 3)


def query(u: Column) -> Column:
    return F.regexp_extract(u, _SPLIT, 4)


def fragment(u: Column) -> Column:
    return F.regexp_extract(u, _SPLIT, 5)


def build(scheme_: Column, host_: Column, path_: Column, query_: Column, fragment_: Column) -> Column:
    def prefixed(mark: str, c: Column) -> Column:
        return F.when(c != "", F.concat(F.lit(mark), c)).otherwise(F.lit(""))

    root = F.when(scheme_ != "", F.concat(scheme_, F.lit(":"))).otherwise(F.lit(""))
    return F.concat(root, prefixed("//", host_), path_, prefixed("?", query_), prefixed("#", fragment_))


# ---- query strings -------------------------------------------------------

def _decoded(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(c), F.translate(c, "+", " "))


def _encoded(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def query_pairs(q: Column) -> Column:
    """array<struct(k, v)> in order of appearance, decoded."""
    parts = F.filter(F.split(q, "&"), lambda p: p != "")
    return F.transform(
        parts,
        lambda p: F.struct(
            _decoded(F.regexp_extract(p, r"^([^=]*)", 1)).alias("k"),
            _decoded(F.regexp_extract(p, r"^[^=]*=(.*)$", 1)).alias("v"),
        ),
    )


def grouped_pairs(pairs: Column) -> Column:
    """Values of a repeated key move next to its first appearance."""
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.flatten(F.transform(keys, lambda k: F.filter(pairs, lambda p: p["k"] == k)))


def encode_pairs(pairs: Column) -> Column:
    return F.array_join(
        F.transform(pairs, lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")


def parts(u: Column) -> Column:
    """struct(scheme, host, path, query, fragment), to be bound where several are read."""
    return F.struct(
        scheme(u).alias("scheme"), host(u).alias("host"), path(u).alias("path"),
        query(u).alias("query"), fragment(u).alias("fragment"))


def strip_tracking(u: Column, shop: str) -> Column:
    """Drop the shop's tracking parameters.

    Shops differ: one compares keys case-sensitively and drops the fragment; one
    keeps blank values, drops fragment and trailing slash; the others keep the
    fragment. Urls without a query keep their text and skip the query work.
    """
    return bind(u, lambda x: bind(parts(x), lambda p: _without_tracking(p, shop)))


def _without_tracking(p: Column, shop: str) -> Column:
    drop = lexicon.TRACKING_KEYS[shop]
    pairs = query_pairs(p["query"])
    if shop == "thomann":
        prefix = lexicon.TRACKING_PREFIX[shop]
        kept = F.filter(
            pairs,
            lambda q: ~F.lower(q["k"]).isin(drop) & ~F.startswith(F.lower(q["k"]), F.lit(prefix)))
        where = F.regexp_replace(F.regexp_replace(p["path"], r";[^/]*$", ""), r"/+$", "")
    else:
        key = (lambda k: k) if shop == "bol" else F.lower
        kept = bind(
            F.filter(pairs, lambda q: (q["v"] != "") & ~key(q["k"]).isin(drop)), grouped_pairs)
        where = p["path"]
    new_query = F.when(p["query"] != "", encode_pairs(kept)).otherwise(F.lit(""))
    frag = p["fragment"] if shop in ("bax", "maxiaxi") else F.lit("")
    return bind(new_query, lambda q: build(p["scheme"], p["host"], where, q, frag))


# ---- resolving links -----------------------------------------------------

def resolve(base: Column, href: Column) -> Column:
    """Absolute form of a link found on the page `base`."""
    pair = F.struct(parts(base).alias("b"), F.trim(href).alias("h"), base.alias("page"))
    return bind(pair, lambda x: _resolved(x["page"], x["b"], x["h"]))


def _resolved(page: Column, b: Column, h: Column) -> Column:
    none = F.lit("")
    root = build(b["scheme"], b["host"], none, none, none)
    folder = F.regexp_replace(b["path"], r"[^/]*$", "")
    joined = F.when(F.startswith(h, F.lit("/")), h).otherwise(
        F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), h))
    return (
        F.when(h == "", page)
        .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), h)
        .when(F.startswith(h, F.lit("//")), F.concat(b["scheme"], F.lit(":"), h))
        .when(F.startswith(h, F.lit("?")), F.concat(root, b["path"], h))
        .when(F.startswith(h, F.lit("#")), F.concat(F.regexp_replace(page, "#.*$", ""), h))
        .otherwise(F.concat(root, without_dot_segments(joined)))
    )


def without_dot_segments(p: Column) -> Column:
    """Fold '.' and '..' segments; paths without them are left as they are."""
    return bind(p, _folded)


def _folded(p: Column) -> Column:
    tail = F.regexp_extract(p, r"([?#].*)$", 1)
    body = F.regexp_replace(p, r"[?#].*$", "")

    def step(acc: Column, s: Column) -> Column:
        parent = F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))
        return F.when(s == ".", acc).when(s == "..", parent).otherwise(F.concat(acc, F.array(s)))

    folded = F.aggregate(F.split(body, "/"), F.array().cast("array<string>"), step)
    open_end = F.when(body.rlike(r"/\.{1,2}$"), F.lit("/")).otherwise(F.lit(""))
    return F.when(
        body.rlike(r"(?:^|/)\.{1,2}(?:/|$)"), F.concat(F.array_join(folded, "/"), open_end, tail)
    ).otherwise(p)


def https_if_scheme_less(u: Column) -> Column:
    return F.when(F.startswith(u, F.lit("//")), F.concat(F.lit("https:"), u)).otherwise(u)


# ---- classification ------------------------------------------------------

def segments(u: Column) -> Column:
    return F.filter(F.split(path(u), "/"), lambda s: s != "")


def low_segments(u: Column) -> Column:
    return F.filter(F.split(F.lower(path(u)), "/"), lambda s: s != "")


def on_domain(u: Column, domain: str) -> Column:
    return F.coalesce(F.endswith(host(u), F.lit(domain)), F.lit(False))


def _any_segment(u: Column, words: list[str]) -> Column:
    return F.arrays_overlap(low_segments(u), F.array(*[F.lit(w) for w in words]))


def is_product(u: Column, shop: str) -> Column:
    if shop == "thomann":
        p = F.lower(path(u))
        return F.endswith(p, F.lit(".htm")) & ~p.rlike(quoted(lexicon.INFO_PAGE_PARTS_THOMANN))
    return F.size(segments(u)) >= 2


def is_followed(u: Column, shop: str) -> Column:
    p = F.lower(path(u))
    if shop == "thomann":
        return (
            on_domain(u, lexicon.SHOP_DOMAIN[shop])
            & ~p.rlike(quoted(lexicon.BLOCKED_URL_PARTS_THOMANN))
            & p.rlike(r"\.html?$")
        )
    blocked = has_any(u, lexicon.BLOCKED_URL_PARTS) | p.rlike(r"\.(pdf|zip|jpe?g|png|svg)$")
    return F.coalesce((u != "") & ~blocked, F.lit(False))


def in_accessories(u: Column) -> Column:
    return _any_segment(u, lexicon.ACCESSORY_SEGMENTS)


def in_non_product(u: Column) -> Column:
    return _any_segment(u, lexicon.NON_PRODUCT_SEGMENTS)


def about_microphones(u: Column) -> Column:
    return has_any(path(u), lexicon.MICRO_KEYWORDS)


def is_category_allowed(u: Column) -> Column:
    return (F.size(segments(u)) > 0) & ~in_non_product(u)


def is_listing_allowed(u: Column) -> Column:
    return is_followed(u, "bax") & is_category_allowed(u) & ~in_accessories(u)


def is_probable_product(u: Column, needs_keyword: bool = True) -> Column:
    base = is_listing_allowed(u)
    return base & about_microphones(u) if needs_keyword else base


def in_sitemap_scope(u: Column) -> Column:
    return ~in_non_product(u) & about_microphones(u)


def is_category(u: Column) -> Column:
    return F.endswith(F.lower(path(u)), F.lit(".html"))


def bol_category_code(u: Column) -> Column:
    return F.coalesce(
        first_group(path(u), r"/l/([^/?#]+/[^/?#]+)/?"), first_group(path(u), r"/l/([^/?#]+)/?"))


def bol_category_slug(u: Column) -> Column:
    return blank_to_null(F.lower(F.trim(F.get(F.split(bol_category_code(u), "/"), F.lit(0)))))


def is_microphone_category(u: Column) -> Column:
    slug = bol_category_slug(u)
    allowed = slug.isin(lexicon.BOL_CATEGORY_ALLOWED) & ~slug.isin(lexicon.BOL_CATEGORY_EXCLUDED)
    return F.coalesce(allowed, F.lit(False))


def is_maxiaxi_product_link(u: Column) -> Column:
    return has_any(u, ["maxiaxi.com"]) & ~has_any(u, lexicon.BLOCKED_URL_PARTS_MAXIAXI)


def category_priority(u: Column) -> Column:
    """100, 90, ... by the first listed slug in the path, else 0."""
    p = F.lower(path(u))
    chain = None
    for i, word in enumerate(lexicon.PRIORITY_CATEGORIES):
        hit = p.contains(word)
        chain = F.when(hit, 100 - 10 * i) if chain is None else chain.when(hit, 100 - 10 * i)
    return F.coalesce(chain.otherwise(0), F.lit(0))


# ---- breadcrumbs and paging ---------------------------------------------

def breadcrumbs(u: Column) -> Column:
    """array<struct(name, url)> of the folders above the page itself."""
    return bind(u, _breadcrumbs)


def _breadcrumbs(u: Column) -> Column:
    return bind(segments(u), lambda segs: _folders_above(u, segs))


def _folders_above(u: Column, segs: Column) -> Column:
    is_leaf = F.endswith(F.element_at(segs, -1), F.lit(".html"))
    folders = F.when(is_leaf, F.slice(segs, 1, F.size(segs) - 1)).otherwise(segs)
    above = F.when(F.size(folders) > 1, F.slice(folders, 1, F.size(folders) - 1)).otherwise(
        F.array().cast("array<string>"))
    root = build(scheme(u), host(u), F.lit(""), F.lit(""), F.lit(""))

    def with_links(above_: Column) -> Column:
        return F.transform(above_, lambda s, i: F.struct(
            slug_label(s).alias("name"),
            F.concat(root, F.lit("/"), F.array_join(F.slice(above_, 1, i + 1), "/")).alias("url")))

    crumbs = bind(above, with_links)
    named = F.filter(crumbs, lambda c: c["name"].isNotNull())
    return F.when(F.size(segs) > 0, named).otherwise(
        F.array().cast("array<struct<name:string,url:string>>"))


def next_page(u: Column, shop: str, last_page: int | None = None) -> Column:
    """Url of the following page; one shop only continues an existing page number.

    `last_page`: no page follows this one, if the caller sets an end.
    """
    pairs = grouped_pairs(F.filter(query_pairs(query(u)), lambda p: p["v"] != ""))
    shown = F.get(F.filter(pairs, lambda p: p["k"] == "page"), F.lit(0))["v"].try_cast("bigint")
    has_page = F.exists(pairs, lambda p: p["k"] == "page")

    def with_page(n: Column) -> Column:
        one = F.struct(F.lit("page").alias("k"), n.cast("string").alias("v"))
        firsts = F.array_distinct(F.transform(pairs, lambda p: F.when(p["k"] == "page", one).otherwise(p)))
        return encode_pairs(F.when(has_page, firsts).otherwise(F.concat(pairs, F.array(one))))

    if shop == "bax":
        return F.when(
            shown.isNotNull(),
            build(scheme(u), host(u), path(u), with_page(shown + 1), fragment(u)))
    n = F.when(has_page, shown).otherwise(F.lit(1))
    following = build(scheme(u), host(u), path(u), with_page(n + 1), F.lit(""))
    return following if last_page is None else F.when(n < last_page, following)


# ---- subcategory links ---------------------------------------------------

def is_subcategory_link(current: Column, to_url: Column, label: Column, depth: Column) -> Column:
    """Which anchors of a hub page lead to a subcategory: by label at the seed, by url below."""
    from shelfwise.functions.text import category_label

    read = F.struct(F.lower(path(to_url)).alias("path"), category_label(label).alias("name"))
    return bind(read, lambda x: _is_subcategory(current, to_url, x["path"], x["name"], depth))


def _is_subcategory(current: Column, to_url: Column, p: Column, name: Column, depth: Column) -> Column:
    seeds = [w.replace("-", " ").replace("/", " ").replace("  ", " ") for w in lexicon.SEED_SUBCATEGORIES]
    open_to_all = (
        is_followed(to_url, "thomann")
        & is_category(to_url)
        & (to_url != current)
        & ~p.rlike(quoted(lexicon.SUBCATEGORY_BLOCKED_PATHS))
        & ~has_any(p, lexicon.SUBCATEGORY_EXCLUDED)
        & ~has_any(name, lexicon.SUBCATEGORY_EXCLUDED)
    )
    below = (
        ~F.endswith(p, F.lit("microfoons.html"))
        & ~p.rlike(r"_[a-z0-9]+_microfoons?")
        & has_any(to_url, lexicon.SUBCATEGORY_KEYWORDS)
    )
    return open_to_all & F.when(depth == 0, name.isin(seeds)).otherwise(below)
