"""Html columns for flat tags: regular expressions inside the JVM, one row in, one row out."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.text import bind, blank_to_null, clean, first_text

# All named character references of HTML; a no-break space counts as a blank.
NAMED_ENTITIES = {name[:-1]: char for name, char in html5.items() if name.endswith(";")} | {"nbsp": " "}
# A map is searched from its start, so the names lie in groups of a first letter and a length: some ten each, not 2,125.
_ENTITY_GROUPS: dict[str, dict[str, dict[str, str]]] = {}
for _name, _char in NAMED_ENTITIES.items():
    _ENTITY_GROUPS.setdefault(_name[0], {}).setdefault(str(len(_name)), {})[_name] = _char


def _code_point(n: Column) -> Column:
    four_bytes = F.lpad(F.hex(n), 8, "0")
    return F.decode(F.unhex(four_bytes), "UTF-32")


def _character(name: Column) -> Column:
    """What a reference stands for, given what is between '&' and ';'; NULL if nothing."""
    dec = F.regexp_extract(name, r"^#(\d{1,7})$", 1)
    hexa = F.regexp_extract(name, r"^#[xX]([0-9a-fA-F]{1,6})$", 1)
    n = F.coalesce(dec.try_cast("bigint"), F.conv(F.nullif(hexa, F.lit("")), 16, 10).try_cast("bigint"))
    valid = (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    groups = F.from_json(F.lit(json.dumps(_ENTITY_GROUPS)), "map<string,map<string,map<string,string>>>")
    group = F.try_element_at(F.try_element_at(groups, F.substring(name, 1, 1)), F.length(name).cast("string"))
    return F.when(name.startswith("#"), F.when(valid, _code_point(n))).otherwise(F.try_element_at(group, name))


def unescape(c: Column) -> Column:
    """Decode character references in one pass, so that no text is decoded twice."""

    def piece(p: Column, i: Column) -> Column:
        name = F.regexp_extract(p, r"^(#?[A-Za-z0-9]+);", 1)
        rest = F.substring(p, F.length(name) + 2, F.length(p))
        decoded = F.when(name != "", F.concat(_character(name), rest))
        return F.when(i == 0, p).otherwise(F.coalesce(decoded, F.concat(F.lit("&"), p)))

    def decoded(t: Column) -> Column:
        return F.when(t.contains("&"), F.array_join(F.transform(F.split(t, "&"), piece), "")).otherwise(t)

    return bind(c, decoded)


def strip_tags(c: Column) -> Column:
    return clean(unescape(F.regexp_replace(c, r"(?s)<[^>]*>", " ")))


_HIDDEN = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<noscript\b[^>]*>.*?</noscript\s*>"


def body(html: Column) -> Column:
    inner = F.regexp_extract(html, r"(?is)<body\b[^>]*>(.*)$", 1)
    return F.when(inner != "", inner).otherwise(html)


def visible_text(html: Column) -> Column:
    """Text of the body without script, style, noscript and comments."""
    return F.coalesce(strip_tags(F.regexp_replace(body(html), _HIDDEN, " ")), F.lit(""))


def body_text(html: Column) -> Column:
    """Text of the body with script and style text kept, as most shops' rules read it."""
    no_comments = F.regexp_replace(body(html), r"(?s)<!--.*?-->", " ")
    return F.coalesce(strip_tags(no_comments), F.lit(""))


# ---- tags and attributes -------------------------------------------------

def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute within one tag's text, NULL when absent."""
    pattern = rf"""(?is)[\s"']{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    quoted_value = blank_to_null(F.regexp_extract(tag, pattern, 1))
    return unescape(F.regexp_replace(quoted_value, r"""^["']|["']$""", ""))


def tags(html: Column, names: str) -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)<(?:{names})\b[^>]*>"), F.lit(0))


def first_attribute(html: Column, tag: str, wanted: str, name: str) -> Column:
    """Attribute `name` of the first `tag` whose text matches `wanted`."""
    hits = F.filter(tags(html, tag), lambda t: t.rlike(wanted))
    return attribute(F.get(hits, F.lit(0)), name)


def metas(html: Column) -> Column:
    """array<struct(property, name, content)> of the meta tags; stage it, then ask `meta`."""
    return F.transform(tags(html, "meta"), lambda t: F.struct(
        attribute(t, "property").alias("property"), attribute(t, "name").alias("name"),
        attribute(t, "itemprop").alias("itemprop"), clean(attribute(t, "content")).alias("content")))


def meta(metas_: Column, *names: str) -> Column:
    """Content of the first named meta tag; property before name, names in order."""
    found = []
    for n in names:
        for attr in ("property", "name"):
            hits = F.filter(metas_, lambda m: (m[attr] == n) & m["content"].isNotNull())
            found.append(F.get(hits, F.lit(0))["content"])
    return F.coalesce(*found)


def item_meta(metas_: Column, itemprop: str) -> Column:
    return F.get(F.filter(metas_, lambda m: m["itemprop"] == itemprop), F.lit(0))["content"]


def leading_text(html: Column, tag: str) -> Column:
    """Text directly after the first opening tag."""
    return clean(unescape(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>([^<]*)", 1)))


def title(html: Column, metas_: Column, shop: str) -> Column:
    """Heading, social title, document title: first one with text."""
    h1, doc = leading_text(html, "h1"), leading_text(html, "title")
    if shop == "bol":
        return h1
    if shop == "maxiaxi":
        return F.coalesce(h1, doc)
    return F.coalesce(h1, meta(metas_, "og:title"), doc)


# ---- links ---------------------------------------------------------------

def anchors(html: Column) -> Column:
    """array<struct(href, label)> of all anchors with a link, in document order."""
    whole = F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*>.*?(?:</a\s*>|$)"), F.lit(0))
    found = F.transform(
        whole,
        lambda a: F.struct(
            attribute(F.regexp_extract(a, r"(?is)^<a\b[^>]*>", 0), "href").alias("href"),
            strip_tags(F.regexp_replace(a, r"(?is)^<a\b[^>]*>", " ")).alias("label"),
        ),
    )
    return F.filter(found, lambda a: a["href"].isNotNull() & (a["href"] != ""))


_NAV_EDGE = r"(?i)(?=</?(?:nav|ol)\b)"
_NAV_TAG = r"(?is)^<(/?)(nav|ol)\b[^>]*>"
# Stands before each outermost block; a control character that no page text holds.
_CUT = "\x01"


def nav_blocks(html: Column) -> Column:
    """Outermost navigation elements and ordered lists, whole, with all that is nested in them.

    The page is cut before each start and end tag of these kinds; a fold over the cuts counts how many
    of each kind are open. An end tag without a start is passed over, an open element ends with the page.
    """
    cuts = F.split(F.regexp_replace(html, _CUT, " "), _NAV_EDGE)
    start = F.struct(F.lit(0).alias("nav"), F.lit(0).alias("ol"), F.array().cast("array<string>").alias("kept"))

    def step(state: Column, cut: Column) -> Column:
        kind = F.lower(F.regexp_extract(cut, _NAV_TAG, 2))
        move = F.when(F.regexp_extract(cut, _NAV_TAG, 1) == "/", -1).otherwise(1)
        now = {k: F.greatest(state[k] + F.when(kind == k, move).otherwise(0), F.lit(0)) for k in ("nav", "ol")}
        before, after = state["nav"] + state["ol"] > 0, now["nav"] + now["ol"] > 0
        part = (
            F.when(after & ~before, F.concat(F.lit(_CUT), cut)).when(after, cut)
            .when(before, F.regexp_extract(cut, _NAV_TAG, 0)).otherwise(""))
        return F.struct(now["nav"].alias("nav"), now["ol"].alias("ol"), F.array_append(state["kept"], part).alias("kept"))

    joined = F.aggregate(cuts, start, step, lambda state: F.array_join(state["kept"], ""))
    return F.filter(F.split(joined, _CUT), lambda block: block != "")


def nav_links(html: Column) -> Column:
    """Links of the anchors in navigation and ordered lists, as written on the page."""
    return F.transform(anchors(F.array_join(nav_blocks(html), " ")), lambda a: a["href"])


NEXT_LINK = {
    "bax": [r'rel=["\']next["\']', "aria-label=[^>]*Volgende", "aria-label=[^>]*Next",
            "data-test=[^>]*pagination-next"],
    "bol": [r'rel=["\']next["\']', "data-test=[\"']pagination-next[\"']", "pagination__item--next",
            "aria-label=[^>]*Volgende", "aria-label=[^>]*Next"],
    "maxiaxi": [r'class=["\'][^"\']*action[^"\']*next'],
}


def next_link(html: Column, shop: str) -> Column:
    """Link of the first pagination anchor, by the shop's order of preference."""
    found = [first_attribute(html, "a", p, "href") for p in NEXT_LINK[shop]]
    return first_text(*found)


def has_next(html: Column) -> Column:
    return html.rlike(
        r'(?is)<a\b[^>]*(?:rel=["\']next["\']|aria-label=[^>]*(?:Volgende|Next)|data-test=[^>]*pagination)')


def support_link(base: Column, html: Column, shop: str) -> Column:
    """First anchor on the shop's domain that leads to a service page, else the default."""
    from shelfwise import lexicon
    from shelfwise.functions import url as U

    targets = F.transform(anchors(html), lambda a: U.resolve(base, a["href"]))
    domain = lexicon.SHOP_DOMAIN[shop]

    def wanted(u: Column) -> Column:
        here = F.lower(u).contains(domain) if shop == "bax" else U.on_domain(u, domain)
        return here & F.lower(u).rlike(lexicon.SUPPORT_LINK_PATTERN[shop])

    default = lexicon.SUPPORT_LINK_DEFAULT[shop]
    return F.coalesce(F.get(F.filter(targets, wanted), F.lit(0)), F.lit(default).cast("string"))


def count_tags(html: Column, attribute_pattern: str) -> Column:
    return F.regexp_count(html, F.lit(rf"(?is)<[a-z][^>]*\s(?:{attribute_pattern})"))
