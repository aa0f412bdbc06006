"""Service and support queries: phrases with known numbers, and the given texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise import lexicon
from shelfwise.catalog.registry import query
from shelfwise.catalog.text_queries import sql_words
from shelfwise.operators import resolve, support
from shelfwise.plans import compare
from shelfwise.session import table


def _flags(df, names):
    return df.withColumns({n: F.col(n).cast("int") for n in names})


_BOOLS = [
    "shipping_included", "pickup_point_available", "delivery_shipping_available", "delivery_courier_available", "free_returns",
]


def _pages(spark, d, phrases):
    """One page per supplier and part line: text from phrases that use the keys as numbers."""
    k = table(spark, d, "part").select("p_partkey", "p_size", "p_brand")
    html = F.concat(F.lit("<html><body><div>"), phrases, F.lit("</div></body></html>"))
    return k.select("p_partkey", F.lit("https://www.bol.com/nl/nl/p/1/").alias("url"), html.alias("html"))


def _by(n, *options):
    chain = F.when(F.col("p_partkey") % len(options) == 0, options[0])
    for i, o in enumerate(options[1:], 1):
        chain = chain.when(F.col("p_partkey") % len(options) == i, o)
    return chain


def _shop_phrases(seller: bool):
    size = F.col("p_size")
    ship = _by(0, F.concat(F.lit("<p>Gratis <b>verzending</b> al vanaf € "), size, F.lit(",95</p>")), F.lit("<p>Bezorgkosten: 5 euro</p>"), F.lit("<p>Winkel</p>"))
    days = _by(0, F.concat(size, F.lit(" dagen bedenktijd ")), F.lit("geen termijn "))
    warranty = _by(0, F.concat(size, F.lit(" jaar garantie ")), F.concat(size, F.lit(" maanden garantie ")), F.lit(" "))
    extra = _by(0, F.lit("Ophaalpunt PostNL, thuisbezorgd. Kosteloos retourneren. "), F.lit("Levertijd onbekend. "), F.lit("DHL "), F.lit(" "))
    sold = _by(0, F.lit("Verkoop door bol.com | "), F.concat(F.lit("Verkoop door "), F.col("p_brand"), F.lit(" BV | ")), F.lit(" ")) if seller else F.lit("Bax Music ")
    return F.concat(ship, days, warranty, extra, sold)


_SHOP_SQL = """
    SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS shipping_included,
      CASE WHEN p_partkey % 3 = 0 THEN (p_size * 100 + 95)::DOUBLE / 100 END AS free_shipping_threshold_amt,
      CASE WHEN p_partkey % 4 = 0 THEN 1 END AS pickup_point_available, CASE WHEN p_partkey % 4 IN (0, 1) THEN 1 END AS delivery_shipping_available,
      CASE WHEN p_partkey % 4 IN (0, 2) THEN 1 END AS delivery_courier_available,
      CASE WHEN p_partkey % 2 = 0 THEN p_size END AS cooling_off_days, CASE WHEN p_partkey % 4 = 0 THEN 1 END AS free_returns,
      {provider} AS warranty_provider, CASE p_partkey % 3 WHEN 0 THEN p_size * 12 WHEN 1 THEN p_size END AS warranty_duration_months,
      {url} AS customer_service_url
    FROM part"""


@query("service_flags_bol", _SHOP_SQL.format(
    provider="CASE p_partkey % 3 WHEN 0 THEN 'bol.com' WHEN 1 THEN p_brand || ' BV' END", url="'https://www.bol.com/nl/nl/klantenservice/'"))
def service_flags_bol(spark, d):
    return _flags(support.customer_service(_pages(spark, d, _shop_phrases(True)), "bol"), _BOOLS).drop("url")


@query("service_flags_bax", _SHOP_SQL.format(provider="CASE WHEN p_partkey % 3 < 2 THEN 'Bax Music' END", url="NULL::VARCHAR"))
def service_flags_bax(spark, d):
    return _flags(support.customer_service(_pages(spark, d, _shop_phrases(False)), "bax"), _BOOLS).drop("url")


@query("service_flags_thomann", """
    SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 1 WHEN p_partkey % 3 = 1 OR p_partkey % 2 = 0 THEN 0 END AS shipping_included,
      CASE WHEN p_partkey % 2 = 0 THEN (p_size * 100 + 50)::DOUBLE / 100 END AS free_shipping_threshold_amt,
      CASE WHEN p_partkey % 3 = 2 THEN 1 END AS delivery_shipping_available, CASE WHEN p_partkey % 2 = 0 THEN 30 END AS cooling_off_days,
      CASE WHEN p_partkey % 3 < 2 THEN 'Thomann' END AS warranty_provider,
      CASE p_partkey % 3 WHEN 0 THEN p_size * 12 WHEN 1 THEN 36 END AS warranty_duration_months, (p_partkey % 4 < 2)::INT AS courier
    FROM part""")
def service_flags_thomann(spark, d):
    ship = _by(0, F.lit("Standaard levering: gratis "), F.lit("Verzendkosten 9 euro "), F.lit("Levertijd 3 dagen "))
    terms = _by(0, F.concat(F.lit("Geen verzendkosten in Nederland vanaf een bedrag van € "), F.col("p_size"), F.lit(",50. 30 dagen money-back ")), F.lit("x "))
    warranty = _by(0, F.concat(F.col("p_size"), F.lit(" jaar Thomann garantie")), F.lit("Drie jaar THOMANN garantie"), F.lit("garantie"))
    carrier = _by(0, F.lit("<img alt='FedEx logo'>"), F.lit("<p>DPD</p>"), F.lit("<script>var dhl=1;</script>"), F.lit("<p>post</p>"))
    pages = _pages(spark, d, F.concat(ship, terms, warranty, carrier))
    facts = support.with_text(pages, "thomann").select(
        "p_partkey", *[c.alias(n) for n, c in support.service_columns(F.col("page_text"), "thomann").items()],
        support.courier(F.col("page_text"), F.col("html"), "thomann").cast("int").alias("courier"))
    return _flags(facts, ["shipping_included", "delivery_shipping_available"]).drop(
        "pickup_point_available", "delivery_courier_available", "free_returns")


_SUPPORT_BOOLS = ["expert_chat_available", "phone_support_available", "email_support_available", "in_store_support"]


@query("support_flags_bol", """
    SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 OR p_partkey % 3 = 0 THEN 1 END AS expert_chat_available,
      CASE WHEN p_partkey % 4 IN (1, 2) THEN 1 END AS phone_support_available, CASE WHEN p_partkey % 4 = 3 OR p_partkey % 3 = 0 THEN 1 END AS email_support_available,
      0 AS in_store_support,
      CASE p_partkey % 4 WHEN 0 THEN 'Livechat' WHEN 1 THEN 'Bel 030 123 4567' WHEN 2 THEN 'Wij zijn telefonisch bereikbaar' ELSE 'Contactformulier' END
        || CASE p_partkey % 3 WHEN 0 THEN ' Contact' ELSE '' END || ' Verkoop door ' || CASE p_partkey % 3 WHEN 0 THEN 'bol' ELSE p_brand END AS expert_support_text
    FROM part""")
def support_flags_bol(spark, d):
    way = _by(0, F.lit("Livechat"), F.lit("Bel 030 123 4567"), F.lit("Wij zijn telefonisch bereikbaar"), F.lit("Contactformulier"))
    contact = _by(0, F.lit(" Contact"), F.lit(""), F.lit(""))
    seller = _by(0, F.lit("bol"), F.col("p_brand"), F.col("p_brand"))
    pages = _pages(spark, d, F.concat(way, contact, F.lit(" Verkoop door "), seller))
    return _flags(support.expert_support(pages, "bol"), _SUPPORT_BOOLS).drop("url")


@query("support_flags_thomann", """
    SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 1 END AS expert_chat_available, CASE WHEN p_partkey % 5 = 1 THEN 1 END AS phone_support_available,
      CASE WHEN p_partkey % 5 IN (2, 3) THEN 1 END AS email_support_available, 0 AS in_store_support,
      CASE p_partkey % 5 WHEN 0 THEN 'Chat nu ' || p_brand WHEN 1 THEN '+49 9546 9223 0 ' || p_brand WHEN 2 THEN 'info@thomann.de ' || p_brand WHEN 3 THEN 'Mail ' || p_brand END AS expert_support_text
    FROM part""")
def support_flags_thomann(spark, d):
    way = _by(0, F.lit("<p>Chat nu"), F.lit("<p>+49 9546 9223 0"), F.lit("<p>info@thomann.de"), F.lit("<p><a href='mailto:x@y'>Mail</a>"), F.lit("<p>Onze cookies"))
    pages = _pages(spark, d, F.concat(way, F.lit(" "), F.col("p_brand"), F.lit("</p><script>chat()</script>")))
    return _flags(support.expert_support(pages, "thomann"), _SUPPORT_BOOLS).drop("url")


@query("text_service_words", f"""
    SELECT conv_id, turn, CASE WHEN regexp_matches(lower(text), '{sql_words(lexicon.FREE_SHIPPING_WORDS)}') THEN 1
      WHEN regexp_matches(lower(text), '{sql_words(lexicon.PAID_SHIPPING_WORDS)}') THEN 0 END AS shipping_included,
      CASE WHEN regexp_matches(lower(text), '{sql_words(lexicon.CHAT_WORDS["bol"])}') THEN 1 END AS chat,
      CASE WHEN regexp_matches(lower(text), '{sql_words(lexicon.EMAIL_WORDS)}') THEN 1 END AS email FROM conversations""")
def text_service_words(spark, d):
    """The same rules over the given conversations, where the prose decides what is found."""
    from shelfwise.functions.text import has_any

    t = F.col("text")
    return table(spark, d, "conversations").select(
        "conv_id", "turn", support.shipping_included(t, "bol").cast("int").alias("shipping_included"),
        F.when(has_any(t, lexicon.CHAT_WORDS["bol"]), 1).alias("chat"), F.when(has_any(t, lexicon.EMAIL_WORDS), 1).alias("email"))


@query("site_defaults", """
    WITH s AS (SELECT min(s_suppkey) FILTER (s_suppkey % 3 = 1) AS a, min(s_suppkey) FILTER (s_suppkey % 4 = 3) AS b FROM supplier)
    SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN (p_size * 100 + 95)::DOUBLE / 100 ELSE (a * 100 + 5)::DOUBLE / 100 END AS free_shipping_threshold_amt,
      CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE b::INT END AS cooling_off_days FROM part, s""")
def site_defaults(spark, d):
    """Values from the shop's own support pages (one per supplier), used where a product page states none."""
    k = F.col("s_suppkey")
    body = (F.when(k % 3 == 1, F.concat(F.lit("Gratis verzending vanaf € "), k, F.lit(",05. "))).otherwise("Welkom. "))
    days = F.when(k % 4 == 3, F.concat(k, F.lit(" dagen bedenktijd"))).otherwise("0 dagen bedenktijd")
    sites = table(spark, d, "supplier").select(
        k.alias("n"), F.lit("https://www.bol.com/nl/nl/klantenservice/").alias("url"), F.concat(F.lit("<body><p>"), body, days, F.lit("</p></body>")).alias("html"))
    defaults = support.site_defaults(sites, "bol", "n")
    rows = support.customer_service(_pages(spark, d, _shop_phrases(True)), "bol")
    return resolve.with_defaults(
        rows.select("p_partkey", "free_shipping_threshold_amt", "cooling_off_days"), defaults, ["free_shipping_threshold_amt", "cooling_off_days"])


@query("service_matrix", """
    SELECT (p_partkey % 4 + 1)::INT AS competitor_id, count(*) AS n_rows,
      max(CASE p_partkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END)::INT AS shipping_included, count(*) FILTER (p_partkey % 3 < 2) AS shipping_included_known,
      max(CASE WHEN p_partkey % 4 = 0 THEN 1 END)::INT AS free_returns, count(*) FILTER (p_partkey % 4 = 0) AS free_returns_known,
      min(CASE WHEN p_partkey % 2 = 0 THEN p_size END) AS cooling_off_days_min, max(CASE WHEN p_partkey % 2 = 0 THEN p_size END) AS cooling_off_days_max
    FROM part GROUP BY 1""")
def service_matrix(spark, d):
    rows = support.customer_service(_pages(spark, d, _shop_phrases(True)), "bol").withColumn(
        "competitor_id", (F.col("p_partkey") % 4 + 1).cast("int"))
    m = compare.service_matrix(rows, ["shipping_included", "free_returns"], ["cooling_off_days"])
    return _flags(m, ["shipping_included", "free_returns"])
