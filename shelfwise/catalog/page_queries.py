"""Queries over the given web pages, and over pages with nested blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise import lexicon
from shelfwise.catalog.registry import query
from shelfwise.catalog.text_queries import sql_clean, sql_words
from shelfwise.functions import html as H
from shelfwise.functions import jsonld as L
from shelfwise.functions import structure as S
from shelfwise.operators import classify, links
from shelfwise.plans import rendered
from shelfwise.session import spread, table

# The references that the given pages hold, written out; '&amp;' last.
_ENTITIES = [("nbsp", " "), ("middot", "·"), ("copy", "©"), ("lt", "<"), ("gt", ">"), ("quot", chr(34)), ("eacute", "é"), ("euro", "€"), ("amp", "&")]


def sql_unescape(x: str) -> str:
    for name, char in _ENTITIES:
        quoted = char.replace("'", "''")
        x = f"replace({x}, '&{name};', '{quoted}')"
    return x


def sql_text(x: str) -> str:
    return sql_clean(sql_unescape(f"regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g')"))


_HIDDEN = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<noscript\b[^>]*>.*?</noscript\s*>"
_BODY = r"regexp_extract(html, '(?is)<body\b[^>]*>(.*)$', 1)"


@query("page_title", rf"""
    SELECT page_id, {sql_clean(sql_unescape("regexp_extract(html, '(?is)<h1[^>]*>([^<]*)', 1)"))} AS title,
      {sql_clean(sql_unescape("regexp_extract(html, '(?is)<title[^>]*>([^<]*)', 1)"))} AS doc_title FROM pages""")
def page_title(spark, d):
    h = F.col("html")
    staged = spread(table(spark, d, "pages")).withColumn("m", H.metas(h))
    return staged.select(
        "page_id", H.title(h, F.col("m"), "bax").alias("title"), H.leading_text(h, "title").alias("doc_title"))


@query("page_meta", """
    SELECT page_id, 'Og ' || page_id || ' & co' AS og_title, CASE WHEN page_id % 2 = 0 THEN 'by property' ELSE 'by name' END AS description,
      'utf-8' AS charset, page_id::VARCHAR || '.50' AS price FROM pages""")
def page_meta(spark, d):
    """Attribute order, quotes and blank contents vary; the first filled name in order counts."""
    n = F.col("page_id").cast("string")
    extra = F.concat(
        F.lit("<head><META content='Og "), n, F.lit(" &amp; co' property=og:title><meta name=\"description\" content=\"by name\">"),
        F.when(F.col("page_id") % 2 == 0, "<meta property='description' content='by property'>").otherwise(
            "<meta property='description' content=' '>"),
        F.lit("<meta itemprop=price content="), n, F.lit(".50>"))
    staged = spread(table(spark, d, "pages")).withColumn("html", F.regexp_replace("html", "(?i)<head>", F.lit("<head>")))
    staged = staged.withColumn("html", F.concat(extra, F.col("html"))).withColumn("m", H.metas(F.col("html")))
    m = F.col("m")
    return staged.select(
        "page_id", H.meta(m, "og:title").alias("og_title"), H.meta(m, "description", "og:description").alias("description"),
        H.first_attribute(F.col("html"), "meta", "charset", "charset").alias("charset"), H.item_meta(m, "price").alias("price"))


@query("page_text", rf"""
    SELECT page_id, md5({sql_text(f"regexp_replace({_BODY}, '{_HIDDEN}', ' ', 'g')")}) AS digest FROM pages""")
def page_text(spark, d):
    return spread(table(spark, d, "pages")).select("page_id", F.md5(H.visible_text(F.col("html"))).alias("digest"))


@query("page_body_text", rf"""
    SELECT page_id, md5({sql_text(f"regexp_replace({_BODY}, '(?s)<!--.*?-->', ' ', 'g')")}) AS digest FROM pages""")
def page_body_text(spark, d):
    return spread(table(spark, d, "pages")).select("page_id", F.md5(H.body_text(F.col("html"))).alias("digest"))


@query("entity_decode", """
    SELECT p_partkey, '€ ' || p_size || ' – ' || p_name || ' & 𝄞 &#xZZ; <b> "é"' AS txt FROM part""")
def entity_decode(spark, d):
    raw = F.concat(
        F.lit("&euro;&nbsp;"), F.col("p_size"), F.lit(" &#8211; "), F.col("p_name"),
        F.lit(" &amp; &#x1D11E; &#xZZ; &lt;b&gt; &quot;&eacute;&#34;"))
    return spread(table(spark, d, "part")).select("p_partkey", H.unescape(raw).alias("txt"))


_A_HREF = r"regexp_extract_all(html, '(?is)<a\b[^>]*\shref=\"([^\"]*)\"[^>]*>', 1)"


@query("entity_decode_all", """
    SELECT p_partkey, 'cafà Étê ' || p_name || ' &lt; € ♥ ∳ 𝔸 é &unknown; & b;' AS decoded FROM part""")
def entity_decode_all(spark, d):
    """References of every kind, decoded once: what '&amp;' shields stays."""
    raw = F.concat(F.lit("caf&agrave; &Eacute;t&ecirc; "), F.col("p_name"), F.lit(
        " &amp;lt; &#8364; &hearts; &CounterClockwiseContourIntegral; &Aopf; &#xe9; &unknown; & b;"))
    return spread(table(spark, d, "part")).select("p_partkey", H.unescape(raw).alias("decoded"))


@query("page_links", rf"""
    WITH a AS (SELECT url, unnest(list_zip(range(len({_A_HREF})), {_A_HREF}, regexp_extract_all(html, '(?is)<a\b[^>]*>(.*?)</a', 1))) AS z FROM pages)
    SELECT url AS from_url, regexp_extract(url, '^(https?://[^/?#]*)', 1) || {sql_unescape("z[2]")} AS to_url,
      {sql_text("z[3]")} AS label, z[1]::INT AS pos FROM a""")
def page_links(spark, d):
    return links.page_links(spread(table(spark, d, "pages")))


_QUALITY_HTML = "html || CASE WHEN page_id % 5 = 1 THEN repeat('<p>x</p>', 12000) || 'captcha' ELSE '' END"


@query("page_quality", f"""
    WITH p AS (SELECT page_id, {_QUALITY_HTML} AS html FROM pages),
    q AS (SELECT page_id, html, regexp_matches(lower(html), '{sql_words(lexicon.BLOCK_NEEDLES)}') AS notice,
      regexp_matches(lower(html), '{sql_words(lexicon.SHELL_MARKERS)}') AS marked,
      page_id % 50 = 3 OR regexp_matches(lower(html), '{sql_words(lexicon.BLOCK_BODY_NEEDLES)}')
        OR regexp_matches(lower(regexp_extract(html, '(?is)<title[^>]*>([^<]*)', 1)), '{sql_words(lexicon.BLOCK_TITLE_NEEDLES)}') AS refused FROM p)
    SELECT page_id, notice::INT AS bad_html, marked::INT AS shell, refused::INT AS blocked,
      (notice OR strlen(html) < 800)::INT AS bad_or_short, (marked OR length(html) < 4000)::INT AS shell_or_short,
      (refused OR strlen(html) < 5000)::INT AS blocked_or_short
    FROM q""")
def page_quality(spark, d):
    """Needles are found wherever they stand; every fifth page has one behind a long text."""
    h, n = F.col("html"), F.col("page_id")
    status = F.when(n % 50 == 3, 429).otherwise(200)
    long = F.when(n % 5 == 1, F.concat(h, F.repeat(F.lit("<p>x</p>"), F.lit(12000)), F.lit("captcha"))).otherwise(h)
    return spread(table(spark, d, "pages")).select("page_id", long.alias("html")).select(
        "page_id", classify.is_bad_html(h).cast("int").alias("bad_html"), classify.is_shell(h).cast("int").alias("shell"),
        classify.is_blocked(h, status).cast("int").alias("blocked"), classify.is_bad_html(h, 800).cast("int").alias("bad_or_short"),
        classify.is_shell(h, 4000).cast("int").alias("shell_or_short"),
        classify.is_blocked(h, status, 5000, 20000).cast("int").alias("blocked_or_short"))


@query("consent_filter", f"""
    SELECT doc_id, CASE WHEN NOT regexp_matches(lower(text), '{sql_words(lexicon.CONSENT_PHRASES + ["datalayer"])}') THEN md5(text) END AS kept,
      CASE WHEN doc_id % 3 = 0 THEN NULL ELSE md5(text) END AS no_dialog FROM documents""")
def consent_filter(spark, d):
    dialog = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("This is a MODAL window. "), "text")).otherwise(F.col("text"))
    return spread(table(spark, d, "documents")).select(
        "doc_id", F.md5(classify.without_consent(F.col("text"))).alias("kept"), F.md5(classify.without_dialog(dialog)).alias("no_dialog"))


def _typed_pages(spark, d):
    """Pages of known kind: one product, a list of six tiles, several products, shop home."""
    k = F.col("p_partkey") % 6
    one = rendered._script(F.concat(F.lit('{"@type":"Product","offers":[{"price":"'), rendered.plain_price(F.col("c")), F.lit('"}]}')))
    bare = F.lit('<script type="application/ld+json">{"@type":"Product"}</script>')
    tile = F.lit('<div class="t" data-product-id="1"><a href="/x">x</a></div>')
    og = F.lit('<meta property="og:type" content="og:product">')
    html = (
        F.when(k == 0, F.concat(one, F.lit('<span itemprop="price">1</span>')))
        .when(k == 1, F.repeat(tile, F.lit(6)))
        .when(k == 2, F.concat(bare, bare))
        .when(k == 3, F.concat(og, one, F.lit('<form action="/cart/add"></form>'), F.repeat(tile, F.lit(7))))
        .when(k == 4, F.concat(og, one, F.lit('<form action="/cart/add"></form><a rel="next" href="?page=2">v</a>')))
        .otherwise(F.lit("<p>home</p>")))
    return rendered.parts(spark, d).select(
        "p_partkey", F.concat(F.lit("https://s.example/"), F.col("p_partkey")).alias("url"), F.concat(F.lit("<html><body>"), html).alias("html"))


@query("page_type", """
    SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'product' WHEN 1 THEN 'listing' WHEN 2 THEN 'listing' WHEN 3 THEN 'product'
      WHEN 4 THEN 'listing' ELSE 'other' END AS page_kind, CASE p_partkey % 6 WHEN 0 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN 4 ELSE 0 END AS evidence,
      CASE p_partkey % 6 WHEN 1 THEN 6 WHEN 3 THEN 7 ELSE 0 END AS n_tiles
    FROM part""")
def page_type(spark, d):
    return classify.page_signals(_typed_pages(spark, d)).select("p_partkey", "page_kind", "evidence", "n_tiles")


@query("page_content_checks", """
    SELECT p_partkey, (p_partkey % 12 >= 6)::INT AS listing_ok, (p_partkey % 4 <> 0)::INT AS product_ok,
      (p_partkey % 3 = 0)::INT AS is_product_page FROM part""")
def page_content_checks(spark, d):
    n = F.col("p_partkey")
    listing = F.repeat(F.lit('<a data-test="product-title" href="/nl/nl/p/x">t</a>'), (n % 12).cast("int"))
    product = F.concat(F.lit("<h1>"), F.when(n % 4 == 0, " ").otherwise(F.col("p_name")), F.lit('</h1><div data-test="buy-block">x</div>'))
    page = F.when(n % 3 == 2, F.lit('<script type="application/ld+json">{"@type":"Offer"}</script>')).otherwise("Artikelnummer: 123456")
    u = F.when(n % 3 == 1, F.lit("https://www.thomann.nl/kontakt.htm")).otherwise("https://www.thomann.nl/a_1.htm")
    return table(spark, d, "part").select(
        "p_partkey", classify.listing_has_content(listing).cast("int").alias("listing_ok"),
        classify.product_has_content(product).cast("int").alias("product_ok"),
        classify.looks_like_product_page(page, u).cast("int").alias("is_product_page"))


@query("relevance_filter", """
    SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 1 ELSE 0 END AS relevant FROM part""")
def relevance_filter(spark, d):
    k = F.col("p_partkey") % 5
    title = (F.when(k == 0, "Microfoon Statief ").when(k == 1, "Studio Microphone ").when(k == 2, "SHURE ").otherwise("Set "))
    u = F.when(k == 3, F.lit("https://x/mic-1")).otherwise("https://x/p")
    return table(spark, d, "part").select(
        "p_partkey", classify.is_relevant(F.concat(title, F.lit("x "), F.col("p_size")), u).cast("int").alias("relevant"))


@query("page_specs", """
    SELECT p_partkey, p_brand AS brand, 'SKU-' || p_partkey AS sku, p_type AS model, 'MPN' || p_partkey AS mpn, 'zwart' AS color,
      CASE WHEN p_partkey % 3 <> 0 THEN 6 ELSE 5 END AS n_labels FROM part""")
def page_specs(spark, d):
    staged = S.staged(rendered.parts(spark, d).withColumn("h", rendered.spec_html()), S.spec_steps("h", "s"))
    s = F.col("s")
    return staged.select(
        "p_partkey", S.spec_value(s, "merk", "brand").alias("brand"), S.spec_value(s, "sku").alias("sku"),
        S.spec_value(s, "modelnummer", "typenummer").alias("model"), S.spec_value(s, "onderdeelnummer").alias("mpn"),
        F.try_element_at(s, F.lit("kleur")).alias("color"), F.size(s).alias("n_labels"))


@query("page_list_items", r"""
    SELECT page_id, len(regexp_extract_all(html, '(?is)<nav>.*?</nav>')) AS n_nav,
      array_to_string(regexp_extract_all(regexp_extract(html, '(?is)<nav>.*?</nav>'), 'href="([^"]*)"', 1), ' ') AS nav_links FROM pages""")
def page_list_items(spark, d):
    """Navigation blocks of the given pages, counted, and their links."""
    h = F.col("html")
    return spread(table(spark, d, "pages")).select(
        "page_id", F.size(H.nav_blocks(h)).cast("bigint").alias("n_nav"), F.array_join(H.nav_links(h), " ").alias("nav_links"))


@query("page_breadcrumbs", """
    SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'Home>' || p_brand WHEN 1 THEN p_brand || '>' || p_type ELSE '' END AS nav_names,
      CASE WHEN p_partkey % 3 = 1 THEN '/brand.html' WHEN p_partkey % 3 = 0 THEN '/' END AS first_link FROM part""")
def page_breadcrumbs(spark, d):
    k = F.col("p_partkey") % 3
    nav = F.concat(F.lit("<nav aria-label='breadcrumb'><ul><li><a href='/'>Home</a><li><a href='/b'><i>"), F.col("p_brand"), F.lit("</i></a></ul></nav>"))
    micro = F.concat(
        F.lit("<ol itemtype='https://schema.org/BreadcrumbList'><li itemtype='x/ListItem'><a itemprop='item' href='/brand.html'><span itemprop='name'>"),
        F.col("p_brand"), F.lit("</span></a><li itemtype='x/ListItem'><a itemprop='item' href='/t.html'><span itemprop='name'>"), F.col("p_type"),
        F.lit("</span></a></ol>"))
    html = F.when(k == 0, nav).when(k == 1, micro).otherwise("<nav><a href='/q'>no crumb</a></nav>")
    staged = rendered.parts(spark, d).withColumn("h", html)
    staged = S.staged(staged, S.item_crumb_steps("h", "i") + S.crumb_steps("h", "n")).withColumn("c", F.concat("i", "n"))
    return staged.select(
        "p_partkey", F.array_join(F.transform("c", lambda x: x["name"]), ">").alias("nav_names"), F.get("c", F.lit(0))["url"].alias("first_link"))


@query("page_pagination", """
    SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '?page=2' WHEN 1 THEN '/v' WHEN 2 THEN '/n' END AS next_bax,
      (p_partkey % 4 <> 3)::INT AS has_next FROM part""")
def page_pagination(spark, d):
    k = F.col("p_partkey") % 4
    html = (
        F.when(k == 0, '<a aria-label="Volgende" href="/v">v</a><a rel="next" href="?page=2">n</a>')
        .when(k == 1, '<a href="/v" aria-label="Volgende pagina">v</a>').when(k == 2, "<a aria-label='Next' href='/n'>n</a>")
        .otherwise('<a href="/p">Volgende</a>'))
    return table(spark, d, "part").select(
        "p_partkey", H.next_link(html, "bax").alias("next_bax"), H.has_next(html).cast("int").alias("has_next"))


@query("support_link", """
    SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'https://www.bax-shop.nl/klantenservice/x' END AS bax,
      CASE WHEN p_partkey % 2 = 0 THEN 'https://www.bol.com/nl/nl/klantenservice/retourneren/' ELSE 'https://www.bol.com/nl/nl/klantenservice/' END AS bol,
      CASE WHEN p_partkey % 2 = 0 THEN 'https://www.thomann.nl/helpdesk.html' ELSE 'https://www.thomann.nl/compinfo_contact.html' END AS thomann
    FROM part""")
def support_link(spark, d):
    even = F.col("p_partkey") % 2 == 0
    page = F.lit("<a href='https://other.example/klantenservice'>o</a><a href='/over-ons'>x</a>")
    def html(link):
        return F.concat(page, F.when(even, F.lit(f"<a href='{link}'>s</a><a href='/contact/last'>l</a>")).otherwise(""))

    return table(spark, d, "part").select(
        "p_partkey", H.support_link(F.lit("https://www.bax-shop.nl/a"), html("/klantenservice/x"), "bax").alias("bax"),
        H.support_link(F.lit("https://www.bol.com/nl/nl/p/1/"), html("/nl/nl/klantenservice/retourneren/"), "bol").alias("bol"),
        H.support_link(F.lit("https://www.thomann.nl/a.htm"), html("helpdesk.html"), "thomann").alias("thomann"))


@query("script_texts", r"""
    SELECT page_id, len(regexp_extract_all(html, '(?is)<script\b[^>]*>.*?</script')) AS n_scripts, 0 AS n_nodes FROM pages""")
def script_texts(spark, d):
    h = F.col("html")
    return spread(table(spark, d, "pages")).select(
        "page_id", F.size(L.script_texts(h)).cast("bigint").alias("n_scripts"), F.size(L.nodes(L.blocks(h))).alias("n_nodes"))
