"""Link and sitemap queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise import lexicon
from shelfwise.catalog.registry import query
from shelfwise.functions import url
from shelfwise.operators import links
from shelfwise.plans import rendered
from shelfwise.session import materialise, spread, table
from shelfwise.sources import sitemaps


def _shop_links(spark, d):
    """Home to brands, brand to types, type to products, product to the next product."""
    p = table(spark, d, "part")
    one = p.select(F.explode(F.array(
        F.struct(F.lit("/").alias("from_url"), F.concat(F.lit("/b/"), "p_brand").alias("to_url")),
        F.struct(F.concat(F.lit("/b/"), "p_brand").alias("from_url"), F.concat(F.lit("/b/"), "p_brand", F.lit("/"), "p_type").alias("to_url")),
        F.struct(F.concat(F.lit("/b/"), "p_brand", F.lit("/"), "p_type").alias("from_url"), F.concat(F.lit("/p/"), "p_partkey").alias("to_url")),
        F.struct(F.concat(F.lit("/p/"), "p_partkey").alias("from_url"), F.concat(F.lit("/p/"), (F.col("p_partkey") * 2 + 1)).alias("to_url")),
        F.struct(F.concat(F.lit("/p/"), "p_partkey").alias("from_url"), F.lit("/").alias("to_url")),
    )).alias("l"))
    return one.select("l.from_url", "l.to_url")


_LINKS_SQL = """
    links AS (SELECT DISTINCT from_url, to_url FROM (
      SELECT '/' AS from_url, '/b/' || p_brand AS to_url FROM part UNION ALL SELECT '/b/' || p_brand, '/b/' || p_brand || '/' || p_type FROM part
      UNION ALL SELECT '/b/' || p_brand || '/' || p_type, '/p/' || p_partkey FROM part UNION ALL SELECT '/p/' || p_partkey, '/p/' || (p_partkey * 2 + 1) FROM part
      UNION ALL SELECT '/p/' || p_partkey, '/' FROM part))
"""


@query("link_reach", f"""
    WITH RECURSIVE {_LINKS_SQL},
      r(url, depth) AS (SELECT '/b/Brand#1', 0 UNION SELECT to_url, depth + 1 FROM r JOIN links ON from_url = url
        WHERE depth < 4 AND NOT (depth = 2 AND to_url LIKE '%7'))
    SELECT url, min(depth)::INT AS depth FROM r GROUP BY 1""")
def link_reach(spark, d):
    """Four hops from one brand page; at the third hop links ending in 7 are not followed."""
    all_links = _shop_links(spark, d).distinct()
    seeds = all_links.filter("from_url = '/' and to_url = '/b/Brand#1'").select(F.col("to_url").alias("url"))
    def follow(depth):
        return ~((depth == 2) & F.endswith("to_url", F.lit("7")))

    return links.reach(all_links, seeds, 4, follow)


@query("link_reach_pages", r"""
    WITH a AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*\shref="([^"]*)"', 1)) AS h FROM pages)
    SELECT url, 0 AS depth FROM pages
    UNION ALL SELECT DISTINCT regexp_extract(url, '^(https?://[^/?#]*)', 1) || replace(h, '&amp;', '&'), 1 FROM a
    WHERE regexp_extract(url, '^(https?://[^/?#]*)', 1) || replace(h, '&amp;', '&') NOT IN (SELECT url FROM pages)""")
def link_reach_pages(spark, d):
    """Everything the given pages link to, from all of them as seeds."""
    pages = spread(table(spark, d, "pages"))
    found = links.page_links(pages).select("from_url", "to_url")
    return links.reach(found, pages.select("url"))


_HUBS = [
    ("Zangmicrofoons (123)", "zangmicrofoons.html"), ("USB/Podcast Microfoons", "usb_podcast.html"), ("Statieven", "statieven.html"),
    ("Ribbon", "ribbon_mics.html?ref=1"), ("Microfoons", "alle_microfoons.html"), ("Sale", "sale_usb.html"), ("Info", "usb.pdf"),
    ("Lavalier", "set_abc_microfoon.html"), ("Zelf", "hub.html"),
]


def _hub_links(spark, d):
    n = len(_HUBS)
    k = (F.col("p_partkey") % n + 1).cast("int")
    label, target = (F.element_at(F.array(*[F.lit(h[i]) for h in _HUBS]), k) for i in (0, 1))
    here = F.concat(F.lit("https://www.thomann.nl/"), F.call_function("div", F.col("p_partkey"), F.lit(n)), F.lit("/hub.html"))
    return spread(table(spark, d, "part")).select(
        here.alias("from_url"), url.resolve(here, target).alias("to_url"), label.alias("label"), F.col("p_partkey").alias("pos"))


@query("subcategory_urls", f"""
    WITH h AS (SELECT p_partkey AS pos, p_partkey % {len(_HUBS)} AS k, 'https://www.thomann.nl/' || (p_partkey // {len(_HUBS)}) || '/' AS root FROM part)
    SELECT root || 'hub.html' AS from_url, root || CASE k WHEN 0 THEN 'zangmicrofoons.html' ELSE 'usb_podcast.html' END AS to_url, pos, 0 AS depth FROM h WHERE k IN (0, 1)
    UNION ALL SELECT root || 'hub.html', root || CASE k WHEN 1 THEN 'usb_podcast.html' ELSE 'ribbon_mics.html' END, pos, 1 FROM h WHERE k IN (1, 3)""")
def subcategory_urls(spark, d):
    """At the seed the label decides, below it the url; accessories, sales and the page itself never count."""
    hubs = _hub_links(spark, d)
    both = [links.subcategories(hubs, depth).withColumn("depth", F.lit(depth)) for depth in (0, 1)]
    return both[0].unionByName(both[1])


@query("subcategories_excluded", f"""
    SELECT 'https://www.thomann.nl/' || (p_partkey // {len(_HUBS)}) || '/hub.html' AS from_url, count(*) AS n
    FROM part WHERE p_partkey % {len(_HUBS)} NOT IN (0, 1, 3, 8) GROUP BY 1""")
def subcategories_excluded(spark, d):
    """Set difference: links that are neither subcategories at either depth nor the page itself."""
    hubs = materialise(_hub_links(spark, d).withColumn("to_url", url.strip_tracking(F.col("to_url"), "thomann")), "hub-links")
    found = links.subcategories(hubs, 0).unionByName(links.subcategories(hubs, 1))
    return links.category_only(hubs, found).groupBy("from_url").agg(F.count("*").alias("n"))


@query("link_union", """
    SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '/s/' || p_partkey || ' /x' ELSE '/x /h/' || p_size END AS links FROM part""")
def link_union(spark, d):
    """Structured links first, tile links only without them, joined without repeats."""
    structured = F.when(F.col("p_partkey") % 3 == 0, F.array(F.concat(F.lit("/s/"), "p_partkey"), F.lit("/x"))).otherwise(F.array().cast("array<string>"))
    tiles = F.array(F.lit("/x"), F.concat(F.lit("/h/"), "p_size"), F.lit("/x"))
    chosen = F.when(F.size(structured) > 0, F.array_distinct(F.concat(structured, structured))).otherwise(F.array_distinct(tiles))
    return table(spark, d, "part").select("p_partkey", F.array_join(chosen, " ").alias("links"))


def _sitemaps(spark, d):
    """A root document naming one sitemap per brand; each names its parts' pages."""
    parts = rendered.parts(spark, d)
    page = F.concat(F.lit("https://s.example/microfoons/"), F.col("slug"), F.lit("-"), F.col("p_partkey"), F.lit("?a=1&amp;b=2"))
    # One document per hundred parts of a brand keeps documents small however large a brand is.
    part_no = F.call_function("div", F.col("p_partkey"), F.lit(100))
    doc = F.concat(F.lit("https://s.example/sitemap-"), F.replace("p_brand", F.lit("#"), F.lit("")), F.lit("-"), part_no, F.lit(".xml"))
    entry = F.concat(F.lit("<ns:url><ns:loc> "), page, F.lit(" </ns:loc><ns:lastmod>x</ns:lastmod></ns:url>"))
    docs = parts.groupBy(doc.alias("url")).agg(F.array_join(F.collect_list(entry), "").alias("body"))
    nested = docs.select(F.col("url").alias("to_doc"))
    number = F.abs(F.hash("to_doc")) % 16
    names = [F.concat(F.lit(f"https://s.example/{level}-"), number, F.lit(".xml")) for level in ("root", "upper", "lower")]
    steps = list(zip(names, [*names[1:], F.col("to_doc")]))
    named = nested.select(F.explode(F.array(*[F.struct(a.alias("url"), b.alias("loc")) for a, b in steps])).alias("s")).select("s.*").distinct()
    roots = named.select("url", F.concat(F.lit("<sitemap><loc>"), "loc", F.lit("</loc></sitemap>")).alias("body"))
    return docs.unionByName(roots).select("url", F.concat(F.lit("<?xml version='1.0'?><x>"), "body", F.lit("</x>")).alias("xml"))


@query("sitemap_urls", """
    SELECT 'https://s.example/microfoons/' || lower(replace(p_name, ' ', '-')) || '-' || p_partkey || '?a=1&b=2' AS to_url,
      'https://s.example/sitemap-' || replace(p_brand, '#', '') || '-' || (p_partkey // 100) || '.xml' AS from_url FROM part""")
def sitemap_urls(spark, d):
    found = sitemaps.entries(_sitemaps(spark, d), "url", "xml").filter("kind = 'page'")
    return found.filter(url.in_sitemap_scope(F.col("to_url"))).select("from_url", "to_url")


@query("nested_sitemaps", """
    SELECT 'https://s.example/microfoons/' || lower(replace(p_name, ' ', '-')) || '-' || p_partkey || '?a=1&b=2' AS url, 4 AS depth FROM part
    UNION ALL SELECT DISTINCT 'https://s.example/sitemap-' || replace(p_brand, '#', '') || '-' || (p_partkey // 100) || '.xml', 3 FROM part""")
def nested_sitemaps(spark, d):
    """Sitemaps name sitemaps, four levels here; expanding from the roots visits every document once."""
    entries = materialise(sitemaps.entries(_sitemaps(spark, d), "url", "xml"), "sitemap")
    roots = entries.filter("from_url LIKE '%/root-%'").select(F.col("from_url").alias("url"))
    return links.reach(entries.select("from_url", "to_url"), roots).filter("depth > 2")


@query("word_dimension", f"""
    SELECT doc_id, list_sum([{", ".join(f"(contains(lower(text), '{w}'))::INT" for w in lexicon.KNOWN_LINES + lexicon.CONSENT_PHRASES)}])::BIGINT AS n_words FROM documents""")
def word_dimension(spark, d):
    """Word lists as data: how many listed words each document holds."""
    words = F.array(*[F.lit(w) for w in lexicon.KNOWN_LINES + lexicon.CONSENT_PHRASES])
    low = F.array(F.lower("text"))
    hits = F.transform(low, lambda t: F.size(F.filter(words, lambda w: t.contains(w))))
    return spread(table(spark, d, "documents")).select("doc_id", F.get(hits, F.lit(0)).cast("bigint").alias("n_words"))
