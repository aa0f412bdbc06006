"""Url queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise import lexicon
from shelfwise.catalog.registry import query
from shelfwise.catalog.text_queries import sql_words
from shelfwise.functions import url
from shelfwise.session import table

# Page urls with a tail of parameters whose fate per shop is known.
_TAIL = "utm_Medium=Mail&q=a%20b&gclid=1&empty=&q=z"


def _tracked(spark, d):
    u = F.col("url")
    frag = url.fragment(u)
    q = F.when(url.query(u) != "", F.concat(url.query(u), F.lit("&"))).otherwise("")
    return table(spark, d, "pages").select(
        "page_id", u.alias("plain"),
        F.concat(F.regexp_replace(u, r"[?#].*$", ""), F.lit("?"), q, F.lit(_TAIL),
                 F.when(frag != "", F.concat(F.lit("#"), frag)).otherwise("")).alias("tracked"))


_PARTS = r"""
    WITH p AS (SELECT page_id, url, regexp_extract(url, '^[^?#]*') AS head,
        regexp_extract(url, '\?([^#]*)', 1) AS q, regexp_extract(url, '(#.*)$', 1) AS frag FROM pages)
"""


def _strip_oracle(keep_orig: str, tail: str, frag: str, head: str = "head") -> str:
    return f"""{_PARTS}, k AS (SELECT *, {keep_orig} AS kept FROM p)
    SELECT page_id, {head} || CASE WHEN kept <> '' THEN '?' || kept ELSE '' END || {frag} AS plain,
      {head} || '?' || CASE WHEN kept <> '' THEN kept || '&' ELSE '' END || '{tail}' || {frag} AS tracked FROM k"""


_PAGE_ONLY = "CASE WHEN q LIKE 'page=%' THEN 'page=2' ELSE '' END"
_STRIP = {
    "bax": _strip_oracle(_PAGE_ONLY, "q=a+b&q=z&gclid=1", "frag"),
    "bol": _strip_oracle("CASE WHEN q LIKE 'page=%' THEN q ELSE '' END", "utm_Medium=Mail&q=a+b&q=z", "''"),
    "maxiaxi": _strip_oracle(_PAGE_ONLY, "q=a+b&q=z", "frag"),
    "thomann": _strip_oracle(_PAGE_ONLY, "q=a+b&empty=&q=z", "''", "rtrim(head, '/')"),
}


def _register_strip(shop: str) -> None:
    @query(f"strip_tracking_{shop}", _STRIP[shop])
    def strip(spark, d):
        return _tracked(spark, d).select(
            "page_id", url.strip_tracking(F.col("plain"), shop).alias("plain"),
            url.strip_tracking(F.col("tracked"), shop).alias("tracked"))


for _shop in _STRIP:
    _register_strip(_shop)


@query("url_resolve", r"""
    WITH p AS (SELECT page_id, url, regexp_extract(url, '^(https?):', 1) AS s,
        regexp_extract(url, '^(https?://[^/?#]*)', 1) AS root, regexp_extract(url, '^[^?#]*') AS head,
        regexp_extract(url, '^[^#]*') AS nofrag FROM pages),
      f AS (SELECT *, regexp_replace(head, '[^/]*$', '') AS folder FROM p)
    SELECT page_id, root || '/abs/x' AS absolute, s || '://cdn.example.com/a' AS schemeless, 'http://o.example/' AS full_url,
      head || '?p=1' AS query_only, nofrag || '#f' AS fragment_only, folder || 'leaf.html' AS relative,
      folder || 'b/c?x=1' AS dotted, 'https://img.example.com/i.png' AS image
    FROM f""")
def url_resolve(spark, d):
    def r(h: str):
        return url.resolve(F.col("url"), F.lit(h))

    return table(spark, d, "pages").select(
        "page_id", r(" /abs/x").alias("absolute"), r("//cdn.example.com/a").alias("schemeless"),
        r("http://o.example/").alias("full_url"), r("?p=1").alias("query_only"), r("#f").alias("fragment_only"),
        r("leaf.html").alias("relative"), r("./b/z/../c?x=1").alias("dotted"),
        url.https_if_scheme_less(F.lit("//img.example.com/i.png")).alias("image"))


def _shop_urls(spark, d):
    """Urls of all kinds the shops have, from the part table."""
    kinds = F.array(*[F.lit(k) for k in _KINDS])
    n = F.col("p_partkey")
    pick = F.element_at(kinds, (n % len(_KINDS) + 1).cast("int"))
    slug = F.replace(F.lower("p_name"), F.lit(" "), F.lit("-"))
    return table(spark, d, "part").select("p_partkey", F.replace(F.replace(pick, F.lit("{s}"), slug), F.lit("{n}"), n.cast("string")).alias("u"))


_KINDS = [
    "https://www.bax-shop.nl/studiomicrofoons/{s}-{n}",
    "https://www.bax-shop.nl/usb-microfoons/{s}.html?page={n}",
    "https://www.bax-shop.nl/windkappen/{s}-{n}",
    "https://www.bax-shop.nl/aanbiedingen/microfoon/{s}",
    "https://www.bax-shop.nl/blog/{s}",
    "https://www.bax-shop.nl/Microfoon/{s}/handleiding.PDF",
    "https://www.bax-shop.nl/",
    "https://www.thomann.nl/{s}_{n}.htm",
    "https://www.thomann.nl/zangmicrofoons.html",
    "https://www.thomann.nl/compinfo_contact.htm",
    "https://images.thomann.nl/{s}.jpg",
    "https://www.bol.com/nl/nl/l/microfoons/7119/?page=3",
    "https://www.bol.com/nl/nl/l/statieven/{n}/",
    "https://www.bol.com/nl/nl/p/{s}/{n}/",
    "https://www.maxiaxi.com/{s}.html",
    "https://www.maxiaxi.com/klantenservice/{s}",
]
_KIND_CASE = "CASE p_partkey % {n} ".format(n=len(_KINDS)) + " ".join(
    f"WHEN {i} THEN '{k}'" for i, k in enumerate(_KINDS)) + " END"
_SHOP_URL_SQL = f"""
    WITH u AS (SELECT p_partkey, replace(replace({_KIND_CASE}, '{{s}}', replace(lower(p_name), ' ', '-')),
        '{{n}}', p_partkey::VARCHAR) AS u FROM part),
      s AS (SELECT *, lower(regexp_extract(u, '^https://[^/?#]*([^?#]*)', 1)) AS path, lower(u) AS low FROM u),
      g AS (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS segs,
        regexp_extract(u, '^https://([^/?#]*)', 1) AS host FROM s)
"""


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


@query("url_classify", f"""{_SHOP_URL_SQL}, c AS (SELECT *,
        NOT regexp_matches(low, '/blog/|/wishlist|/checkout|/basket|/login|/account') AND NOT regexp_matches(path, '\\.(pdf|zip|jpe?g|png|svg)$') AS follow,
        list_has_any(segs, {_sql_list(lexicon.ACCESSORY_SEGMENTS)}) AS acc,
        list_has_any(segs, {_sql_list(lexicon.NON_PRODUCT_SEGMENTS)}) AS non,
        regexp_matches(path, 'micro|mic') AS mic FROM g)
    SELECT p_partkey, (len(segs) >= 2)::INT AS product_bax, follow::INT AS follow_bax, acc::INT AS accessory,
      (len(segs) > 0 AND NOT non)::INT AS category_allowed,
      (follow AND len(segs) > 0 AND NOT non AND NOT acc)::INT AS listing_allowed,
      (follow AND len(segs) > 0 AND NOT non AND NOT acc AND mic)::INT AS probable_product,
      (NOT non AND mic)::INT AS sitemap_scope,
      (path LIKE '%.htm' AND path NOT LIKE '%compinfo%')::INT AS product_thomann,
      (host LIKE '%thomann.nl' AND regexp_matches(path, '\\.html?$') AND path NOT LIKE '%compinfo%')::INT AS follow_thomann,
      (path LIKE '%.html')::INT AS category_page,
      (low LIKE '%maxiaxi.com%' AND low NOT LIKE '%/klantenservice%')::INT AS product_maxiaxi,
      (host LIKE '%bol.com')::INT AS on_bol, (host LIKE '%thomann.nl')::INT AS on_thomann
    FROM c""")
def url_classify(spark, d):
    u = F.col("u")
    flags = {
        "product_bax": url.is_product(u, "bax"), "follow_bax": url.is_followed(u, "bax"),
        "accessory": url.in_accessories(u), "category_allowed": url.is_category_allowed(u),
        "listing_allowed": url.is_listing_allowed(u), "probable_product": url.is_probable_product(u),
        "sitemap_scope": url.in_sitemap_scope(u), "product_thomann": url.is_product(u, "thomann"),
        "follow_thomann": url.is_followed(u, "thomann"), "category_page": url.is_category(u),
        "product_maxiaxi": url.is_maxiaxi_product_link(u), "on_bol": url.on_domain(u, "bol.com"),
        "on_thomann": url.on_domain(u, "thomann.nl"),
    }
    return _shop_urls(spark, d).select("p_partkey", *[c.cast("int").alias(n) for n, c in flags.items()])


@query("bol_category", f"""{_SHOP_URL_SQL}
    SELECT p_partkey, CASE WHEN path LIKE '%/l/%' THEN segs[4] || '/' || segs[5] END AS code,
      CASE WHEN path LIKE '%/l/%' THEN segs[4] END AS slug, coalesce(segs[4] = 'microfoons', false)::INT AS is_microphone
    FROM g""")
def bol_category(spark, d):
    u = F.col("u")
    return _shop_urls(spark, d).select(
        "p_partkey", url.bol_category_code(u).alias("code"), url.bol_category_slug(u).alias("slug"),
        url.is_microphone_category(u).cast("int").alias("is_microphone"))


@query("category_priority", f"""{_SHOP_URL_SQL}
    SELECT p_partkey, CASE WHEN path LIKE '%studiomicrofoons%' THEN 100 WHEN path LIKE '%usb-microfoons%' THEN 70
      ELSE 0 END AS priority FROM g""")
def category_priority(spark, d):
    return _shop_urls(spark, d).select("p_partkey", url.category_priority(F.col("u")).alias("priority")).orderBy(
        F.desc("priority"), "p_partkey")


@query("url_breadcrumbs", r"""
    WITH p AS (SELECT page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS root,
        list_filter(string_split(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS segs FROM pages),
      f AS (SELECT *, CASE WHEN segs[-1] LIKE '%.html' THEN segs[:-2] ELSE segs END AS folders FROM p)
    SELECT page_id, CASE WHEN len(folders) > 1 THEN folders[1] END AS first_name,
      CASE WHEN len(folders) > 1 THEN root || '/' || folders[1] END AS first_url,
      greatest(len(folders) - 1, 0)::INT AS n_crumbs,
      CASE WHEN len(folders) > 1 THEN root || '/' || array_to_string(folders[:-2], '/') ELSE '' END AS last_url
    FROM f""")
def url_breadcrumbs(spark, d):
    staged = table(spark, d, "pages").withColumn("c", url.breadcrumbs(F.col("url")))
    first = F.get("c", F.lit(0))
    return staged.select(
        "page_id", first["name"].alias("first_name"), first["url"].alias("first_url"), F.size("c").alias("n_crumbs"),
        F.coalesce(F.get("c", F.size("c") - 1)["url"], F.lit("")).alias("last_url"))


@query("url_next_page", r"""
    WITH p AS (SELECT page_id, url, regexp_extract(url, '^[^?#]*') AS head, regexp_extract(url, '\?([^#]*)', 1) AS q FROM pages)
    SELECT page_id, CASE WHEN q LIKE 'page=%' THEN head || '?page=3&ref=x' END AS next_bax,
      head || '?' || CASE WHEN q LIKE 'page=%' THEN 'page=3&ref=x' WHEN q <> '' THEN q || '&page=2' ELSE 'page=2' END AS next_bol,
      regexp_extract(url, '^[^?#]*') || '?page=121' AS after_120, NULL::VARCHAR AS beyond_last
    FROM p""")
def url_next_page(spark, d):
    u = F.col("url")
    last = F.concat(F.regexp_replace(u, r"[?#].*$", ""), F.lit("?page=120"))
    return table(spark, d, "pages").select(
        "page_id", url.next_page(u, "bax").alias("next_bax"), url.next_page(u, "bol").alias("next_bol"),
        url.next_page(last, "bol").alias("after_120"), url.next_page(last, "bol", 120).alias("beyond_last"))
