"""Text, key and name queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise import lexicon
from shelfwise.catalog.registry import query
from shelfwise.functions import keys, text
from shelfwise.plans.reskin import gtin
from shelfwise.session import spread, table

_SPACE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def sql_clean(x: str) -> str:
    return f"nullif(trim(regexp_replace({x}, '{_SPACE}', ' ', 'g')), '')"


def sql_words(words: list[str]) -> str:
    import re

    return "|".join(re.escape(w).replace("\\ ", " ") for w in words)


@query("clean_text", f"""
    SELECT 'd' AS src, doc_id AS id, md5(t) AS digest, length(t) AS n_chars
    FROM (SELECT doc_id, {sql_clean("text")} AS t FROM documents)
    UNION ALL
    SELECT 'c', conv_id * 1000 + turn, md5(t), length(t)
    FROM (SELECT conv_id, turn, {sql_clean("chr(160) || text || chr(9)")} AS t FROM conversations)
""")
def clean_text(spark, d):
    t = text.clean(F.col("text"))
    docs = spread(table(spark, d, "documents")).select(F.lit("d").alias("src"), F.col("doc_id").alias("id"), t.alias("t"))
    padded = text.clean(F.concat(F.lit(" "), F.col("text"), F.lit("\t")))
    talk = spread(table(spark, d, "conversations")).select(
        F.lit("c").alias("src"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), padded.alias("t"))
    both = docs.unionByName(talk)
    return both.select("src", "id", F.md5("t").alias("digest"), F.length("t").cast("bigint").alias("n_chars"))


@query("text_has_any", f"""
    SELECT doc_id,
      coalesce(regexp_matches(lower(text), '{sql_words(lexicon.COURIER_WORDS["bol"])}'), false)::INT AS courier,
      coalesce(regexp_matches(lower(text), '{sql_words(lexicon.RELEVANT_WORDS)}'), false)::INT AS relevant,
      coalesce(regexp_matches(lower(text), '{sql_words(lexicon.CONSENT_PHRASES)}'), false)::INT AS consent
    FROM documents""")
def text_has_any(spark, d):
    t = F.col("text")
    return spread(table(spark, d, "documents")).select(
        "doc_id",
        text.has_any(t, lexicon.COURIER_WORDS["bol"]).cast("int").alias("courier"),
        text.has_any(t, lexicon.RELEVANT_WORDS).cast("int").alias("relevant"),
        text.has_any(t, lexicon.CONSENT_PHRASES).cast("int").alias("consent"))


@query("category_label", """
    SELECT p_partkey,
      lower(p_name) || ' ' || lower(p_type) || ' set' AS label,
      replace(p_name, ' ', ' ') || ' ' || p_type AS slug_label
    FROM part""")
def category_label(spark, d):
    raw = F.concat(F.lit("  "), F.upper("p_name"), F.lit("-"), F.col("p_type"), F.lit(" / Set ("), F.col("p_size"), F.lit(" ) "))
    slug = F.concat_ws("_", F.replace(F.col("p_name"), F.lit(" "), F.lit("-")), "p_type")
    return table(spark, d, "part").select(
        "p_partkey", text.category_label(raw).alias("label"), text.slug_label(slug).alias("slug_label"))


@query("whole_number", """
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN user_id WHEN 1 THEN -user_id END AS n FROM events""")
def whole_number(spark, d):
    k, u = F.col("event_id") % 4, F.col("user_id").cast("string")
    raw = (F.when(k == 0, F.concat(F.lit(" "), u, F.lit(" "))).when(k == 1, F.concat(F.lit("-"), u))
           .when(k == 2, F.concat(u, F.lit(".5"))).otherwise(F.concat(u, F.lit("x"))))
    return table(spark, d, "events").select("event_id", text.whole_number(raw).alias("n"))


@query("stable_key_sha1", """
    SELECT page_id, ('0x' || substr(sha1(url), 1, 12))::BIGINT % 2000000000 AS url_key,
      ('0x' || substr(sha1(html), 1, 12))::BIGINT % 2000000000 AS html_key,
      ('0x' || substr(sha1(''), 1, 12))::BIGINT % 2000000000 AS null_key
    FROM pages""")
def stable_key_sha1(spark, d):
    return table(spark, d, "pages").select(
        "page_id", keys.sha1_key(F.col("url")).alias("url_key"), keys.sha1_key(F.col("html")).alias("html_key"),
        keys.sha1_key(F.lit(None).cast("string")).alias("null_key"))


@query("stable_key_md5", """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
      ('0x' || substr(md5('https://shop' || l_suppkey || '.example.com/p/' || l_partkey), 1, 12))::BIGINT AS listing_key,
      ('0x' || substr(md5(l_suppkey || '|' || l_partkey), 1, 12))::BIGINT AS pair_key
    FROM lineitem""")
def stable_key_md5(spark, d):
    u = F.concat(F.lit("https://shop"), F.col("l_suppkey"), F.lit(".example.com/p/"), F.col("l_partkey"))
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", keys.md5_key(u).alias("listing_key"),
        keys.composite_key(F.col("l_suppkey"), F.col("l_partkey")).alias("pair_key"))


@query("article_number", """
    SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN (100000 + p_partkey)::VARCHAR
      WHEN 1 THEN (200000 + p_partkey)::VARCHAR END AS listing_number FROM part""")
def article_number(spark, d):
    k, n = F.col("p_partkey") % 3, F.col("p_partkey")
    html = (
        F.when(k == 0, F.concat(F.lit("<p>ArtikelNummer: "), 100000 + n, F.lit("</p><img src='/prod/999999.jpg'>")))
        .when(k == 1, F.concat(F.lit("<img src='/img/prod/"), 200000 + n, F.lit(".JPEG'>")))
        .otherwise(F.concat(F.lit("<p>artikelnummer 12 "), F.col("p_name"))))
    return table(spark, d, "part").select("p_partkey", keys.article_number(html).alias("listing_number"))


@query("canonical_name_strict", """
    SELECT p_partkey,
      trim(regexp_replace(lower(p_brand || ' ' || p_name || ' ' || p_type), '[^a-z0-9]+', ' ', 'g')) AS name,
      CASE WHEN p_partkey % 2 = 0 THEN trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) END AS title_only
    FROM part""")
def canonical_name_strict(spark, d):
    none = F.lit(None).cast("string")
    title = F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise("!!")
    return table(spark, d, "part").select(
        "p_partkey",
        text.canonical_strict(F.col("p_brand"), F.concat(F.lit(" "), F.col("p_name")), F.col("p_type")).alias("name"),
        text.canonical_strict(none, title, none).alias("title_only"))


@query("canonical_name_loose", """
    SELECT p_partkey, p_brand || ' ' || p_name || CASE WHEN p_partkey % 2 = 0 THEN ' ' || p_type ELSE '' END AS name,
      CASE WHEN p_partkey % 2 = 0 THEN p_brand || ' ' || p_type ELSE p_name END AS pair_name
    FROM part""")
def canonical_name_loose(spark, d):
    model = F.when(F.col("p_partkey") % 2 == 0, F.col("p_type"))
    return table(spark, d, "part").select(
        "p_partkey", text.canonical_loose(F.col("p_brand"), F.col("p_name"), model).alias("name"),
        text.canonical_pair(F.col("p_brand"), model, F.col("p_name")).alias("pair_name"))


@query("model_normalise", """
    SELECT p_partkey,
      CASE p_partkey % 8 WHEN 0 THEN 'M-' || p_size WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN 'nvt'
        WHEN 5 THEN 'ning' WHEN 6 THEN 'ab' WHEN 7 THEN NULL END AS bax,
      CASE p_partkey % 8 WHEN 0 THEN 'M-' || p_size WHEN 1 THEN 'EditionType' WHEN 3 THEN p_type || repeat(' x', 20)
        WHEN 7 THEN p_type || repeat(' x', 40) END AS bol,
      CASE p_partkey % 8 WHEN 0 THEN 'M-' || p_size WHEN 1 THEN 'EditionType' WHEN 2 THEN 'q'
        WHEN 3 THEN p_type || repeat(' x', 20) WHEN 4 THEN 'nvt' WHEN 5 THEN 'ning' WHEN 6 THEN 'ab' END AS thomann,
      'M-' || p_size AS maxiaxi
    FROM part""")
def model_normalise(spark, d):
    k = F.col("p_partkey") % 8
    good = F.concat(F.lit("M-"), F.col("p_size"))
    raw = (F.when(k == 0, F.concat(F.lit(" "), good)).when(k == 1, F.lit("EditionType")).when(k == 2, F.lit("q"))
           .when(k == 3, F.concat(F.col("p_type"), F.repeat(F.lit(" x"), F.lit(20)))).when(k == 4, F.lit("nvt"))
           .when(k == 5, F.lit("ning")).when(k == 6, F.lit("ab"))
           .otherwise(F.concat(F.col("p_type"), F.repeat(F.lit(" x"), F.lit(40)))))
    return table(spark, d, "part").select(
        "p_partkey", *[text.model_name(raw, s).alias(s) for s in ("bax", "bol", "thomann")],
        text.model_name(good, "maxiaxi").alias("maxiaxi"))


@query("identifiers_in_text", """
    SELECT p_partkey,
      CASE WHEN p_partkey % 3 <> 0 THEN lpad((8710000000000 + p_partkey)::VARCHAR, 13, '0') END AS gtin,
      CASE WHEN p_partkey % 2 = 0 THEN p_size || '/x' END AS mpn,
      CASE WHEN p_partkey % 4 = 0 THEN CASE WHEN p_size < 10 THEN 'XM' ELSE 'M' END || p_size END AS model_digit,
      CASE WHEN p_partkey % 4 = 0 THEN CASE WHEN p_size < 10 THEN 'XM' ELSE 'M' END || p_size ELSE 'ind' END AS model_any
    FROM part""")
def identifiers_in_text(spark, d):
    # The gap after a label is greedy: it takes every non-digit that still leaves three characters.
    n = F.col("p_partkey")
    page = F.concat(
        F.lit("Specificaties "), F.coalesce(F.concat(F.lit("EAN code : "), gtin(n)), F.lit("geen code")),
        F.when(n % 2 == 0, F.concat(F.lit(" Artikelnummer: AB-"), F.col("p_size"), F.lit("/x "))).otherwise(" "),
        F.when(n % 4 == 0, F.concat(F.lit("Modelnummer - XM"), F.col("p_size"))).otherwise("Model: Deluxe "), F.lit(" eind"))
    return table(spark, d, "part").select(
        "p_partkey", text.gtin_in_text(page).alias("gtin"), text.part_number_in_text(page).alias("mpn"),
        text.model_in_text(page, True).alias("model_digit"), text.model_in_text(page, False).alias("model_any"))


@query("title_suffix", """SELECT p_partkey, p_name AS title FROM part""")
def title_suffix(spark, d):
    tail = F.when(F.col("p_partkey") % 2 == 0, " | Bax Shop ").otherwise("  |BAX shop")
    return table(spark, d, "part").select(
        "p_partkey", text.without_shop_suffix(F.concat("p_name", tail)).alias("title"))


@query("first_text", """
    SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'first ' || page_id ELSE 'second' END AS first_one,
      'a ' || page_id || ' b' AS joined FROM pages""")
def first_text(spark, d):
    n = F.col("page_id")
    a = F.when(n % 3 == 0, F.concat(F.lit(" first  "), n)).when(n % 3 == 1, F.lit("  "))
    parts = F.array(F.lit("a"), F.lit(" "), n.cast("string"), F.lit(""), F.lit("b"))
    return table(spark, d, "pages").select(
        "page_id", text.first_text(a, F.lit("second")).alias("first_one"), text.joined_text(parts).alias("joined"))


@query("falsy_fallback", """
    SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_type WHEN 1 THEN 'b' ELSE 'b' END AS txt,
      CASE WHEN event_id % 4 = 0 OR value = 0 THEN 7.0 ELSE value END::DOUBLE AS num,
      CASE WHEN event_id % 3 = 2 THEN 'b' WHEN event_id % 3 = 1 THEN '' ELSE event_type END AS null_only
    FROM events""")
def falsy_fallback(spark, d):
    k = F.col("event_id") % 3
    a = F.when(k == 0, F.col("event_type")).when(k == 1, F.lit(""))
    n = F.when(F.col("event_id") % 4 == 0, F.lit(0.0)).otherwise(F.col("value"))
    return table(spark, d, "events").select(
        "event_id", text.first_nonblank(a, F.lit("b")).alias("txt"),
        text.first_nonzero(n, F.lit(7.0)).alias("num"),
        F.coalesce(a, F.lit("b")).alias("null_only"))


@query("run_timestamp", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN epoch(o_orderdate)::BIGINT - 3600 * (o_orderkey % 2) END AS started_at
    FROM orders""")
def run_timestamp(spark, d):
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    raw = F.when(F.col("o_orderkey") % 5 == 0, F.lit("not a time")).otherwise(
        F.concat(iso, F.when(F.col("o_orderkey") % 2 == 0, F.lit("+00:00")).otherwise("+01:00")))
    return table(spark, d, "orders").select("o_orderkey", F.unix_seconds(text.utc_timestamp(raw)).alias("started_at"))
