"""Price, discount, stock and rating queries: numbers written as text, read back, compared with the numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.catalog.registry import query
from shelfwise.functions import price, stock
from shelfwise.plans.reskin import cents
from shelfwise.session import table

_KEYS = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"]
_KEYS_SQL = "l_orderkey, l_linenumber, l_suppkey, l_partkey"
_LI_SQL = f"""
    WITH li AS (SELECT {_KEYS_SQL}, l_returnflag, l_linestatus, CAST(round(l_extendedprice * 100) AS BIGINT) AS c,
      CAST(round(l_discount * 100) AS BIGINT) AS pct, l_linenumber % 5 AS k FROM lineitem)
"""


def _lines(spark, d):
    return table(spark, d, "lineitem").select(
        *_KEYS, "l_returnflag", "l_linestatus", cents(F.col("l_extendedprice")).alias("c"),
        cents(F.col("l_discount")).alias("pct"), (F.col("l_linenumber") % 5).alias("k"))


def _whole(c):
    return F.call_function("div", c, F.lit(100))


def _frac(c):
    return F.lpad((c % 100).cast("string"), 2, "0")


def _grouped(c, mark: str):
    return F.replace(F.format_number(_whole(c), 0), F.lit(","), F.lit(mark))


def euro(c):
    """1299.5 as '€ 1.299,50'."""
    return F.concat(F.lit("€ "), _grouped(c, "."), F.lit(","), _frac(c))


def _by_k(*forms):
    chain = F.when(F.col("k") == 0, forms[0])
    for i, f in enumerate(forms[1:-1], 1):
        chain = chain.when(F.col("k") == i, f)
    return chain.otherwise(forms[-1])


@query("price_parse_eu", f"""{_LI_SQL}
    SELECT {_KEYS_SQL}, CASE WHEN k = 3 AND c < 100000 THEN (c // 100)::DOUBLE
      WHEN k = 3 THEN (c // 100)::DOUBLE ELSE c::DOUBLE / 100 END AS price FROM li""")
def price_parse_eu(spark, d):
    c = F.col("c")
    raw = _by_k(
        euro(c), F.concat(_whole(c), F.lit(","), _frac(c)), F.concat(_grouped(c, "."), F.lit(","), _frac(c), F.lit(" EUR")),
        _grouped(c, "."), F.concat(_whole(c), F.lit("."), _frac(c)))
    return _lines(spark, d).select(*_KEYS, price.parse_eu(raw).alias("price"))


@query("price_parse_first", f"""{_LI_SQL}
    SELECT {_KEYS_SQL}, CASE k WHEN 1 THEN (c // 100)::DOUBLE WHEN 3 THEN (c // 100 * 100 + c // 10 % 10 * 10)::DOUBLE / 100
      ELSE c::DOUBLE / 100 END AS price FROM li""")
def price_parse_first(spark, d):
    c = F.col("c")
    raw = _by_k(
        F.concat(F.lit("Nu € "), _grouped(c, "."), F.lit(","), _frac(c), F.lit(" per stuk 12,00")),
        F.concat(F.lit("€"), _whole(c), F.lit(",-")),
        F.concat(_grouped(c, " "), F.lit(","), _frac(c)),
        F.concat(_whole(c), F.lit(","), F.substring(_frac(c), 1, 1)),
        F.concat(_whole(c), F.lit("."), _frac(c)))
    return _lines(spark, d).select(*_KEYS, price.parse_first(raw).alias("price"))


@query("price_parse_decimal", f"""{_LI_SQL}
    SELECT {_KEYS_SQL}, CASE WHEN k = 3 THEN NULL ELSE c::DOUBLE / 100 END AS price,
      CASE WHEN k <> 3 AND c BETWEEN 100 AND 5000000 THEN c::DOUBLE / 100 END AS sane_price,
      c::DOUBLE / 100 AS json_price
    FROM li""")
def price_parse_decimal(spark, d):
    c = F.col("c")
    raw = _by_k(
        euro(c), F.concat(_whole(c), F.lit(","), _frac(c)), F.concat(_whole(c), F.lit("."), _frac(c)),
        F.lit("op aanvraag"), F.concat(F.lit("EUR "), _whole(c), F.lit("."), _frac(c)))
    js = F.concat(_whole(c), F.when(F.col("k") % 2 == 0, ",").otherwise("."), _frac(c))
    return _lines(spark, d).select(
        *_KEYS, price.parse_plain(raw).alias("price"), price.sane(price.parse_plain(raw)).alias("sane_price"),
        price.parse_number(js).alias("json_price"))


@query("price_parse_support", f"""{_LI_SQL}
    SELECT {_KEYS_SQL}, CASE WHEN k = 3 THEN c::DOUBLE ELSE c::DOUBLE / 100 END AS price FROM li""")
def price_parse_support(spark, d):
    c = F.col("c")
    raw = _by_k(
        euro(c), F.concat(_whole(c), F.lit(","), _frac(c)), F.concat(F.lit(" "), _grouped(c, "."), F.lit(","), _frac(c), F.lit(" €")),
        F.concat(_whole(c), F.lit("."), _frac(c)), F.concat(F.lit("€"), _whole(c), F.lit(","), _frac(c)))
    return _lines(spark, d).select(*_KEYS, price.parse_support(raw).alias("price"))


@query("price_text_pick", f"""{_LI_SQL}
    SELECT {_KEYS_SQL}, CASE k WHEN 0 THEN (c // 100) || ',' || lpad((c % 100)::VARCHAR, 2, '0') WHEN 1 THEN '€ ' || (c // 100)
      WHEN 2 THEN NULL ELSE 'nu ' || (c // 100) || '.' || lpad((c % 100)::VARCHAR, 2, '0') END AS picked,
      (k IN (0, 1))::INT AS looks_like FROM li""")
def price_text_pick(spark, d):
    c = F.col("c")
    cand = _by_k(
        F.concat(_whole(c), F.lit(","), _frac(c)), F.concat(F.lit(" €  "), _whole(c)), F.lit("gratis"),
        F.concat(F.lit("nu "), _whole(c), F.lit("."), _frac(c)), F.concat(F.lit("nu "), _whole(c), F.lit("."), _frac(c)))
    picked = price.first_price_text(F.array(F.lit(" "), F.lit("12 stuks"), cand, F.lit(None).cast("string")))
    # Bare prices with a dot are picked as candidates, but do not pass as prices on their own.
    plain = F.when(F.col("k") == 0, F.concat(F.lit("x "), _grouped(c, "."), F.lit(","), _frac(c))).otherwise(cand)
    return _lines(spark, d).select(
        *_KEYS, picked.alias("picked"), price.looks_like_price(plain).cast("int").alias("looks_like"))


def _box(spark, d):
    """Texts of buy blocks: two euro prices, one, bare numbers, none."""
    c = F.col("c")
    cut = c - F.call_function("div", c * F.col("pct"), F.lit(100))
    lines = _lines(spark, d).withColumn("cut", cut)
    box = _by_k(
        F.concat(F.lit("Van "), euro(c), F.lit(" voor "), euro(F.col("cut")), F.lit(" nu bestellen")),
        F.concat(F.lit("Adviesprijs "), euro(c), F.lit(" in winkelwagen")),
        F.concat(F.lit("prijs "), _whole(F.col("cut")), F.lit(","), _frac(F.col("cut")), F.lit(" was "), _whole(c), F.lit(","), _frac(c)),
        F.concat(F.lit("30-Dagen-Beste-Prijs: "), euro(c), F.lit(" nu "), euro(F.col("cut")), F.lit(" ("), F.col("pct"), F.lit("% korting)")),
        F.lit("Niet meer te koop"))
    return lines.withColumn("box", box)


_BOX_SQL = _LI_SQL.replace("FROM lineitem)", "FROM lineitem), b AS (SELECT *, c - (c * pct) // 100 AS cut FROM li)")


@query("price_candidates", f"""{_BOX_SQL}
    SELECT {_KEYS_SQL}, CASE k WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 3 THEN 2 ELSE 0 END AS n_euro,
      CASE k WHEN 0 THEN c::DOUBLE / 100 WHEN 1 THEN c::DOUBLE / 100 WHEN 3 THEN c::DOUBLE / 100 END AS first_price
    FROM b""")
def price_candidates(spark, d):
    found = price.amounts_in_text(F.col("box"), any_number=False)
    return _box(spark, d).select(
        *_KEYS, F.size(found).alias("n_euro"), price.parse_eu(F.get(found, F.lit(0))).alias("first_price"))


@query("buy_block_prices", f"""{_BOX_SQL}
    SELECT {_KEYS_SQL}, CASE WHEN k IN (0, 2, 3) THEN cut::DOUBLE / 100 WHEN k = 1 THEN c::DOUBLE / 100 END AS cur,
      CASE WHEN k IN (0, 2, 3) THEN c::DOUBLE / 100 END AS base,
      CASE WHEN k IN (0, 3) AND cut BETWEEN 100 AND 5000000 THEN cut::DOUBLE / 100
           WHEN k IN (0, 1, 3) AND c BETWEEN 100 AND 5000000 THEN c::DOUBLE / 100 END AS lowest,
      CASE WHEN k = 3 AND c BETWEEN 100 AND 5000000 THEN c::DOUBLE / 100 END AS reference,
      CASE WHEN k = 3 THEN pct::DOUBLE END AS stated_percent
    FROM b""")
def buy_block_prices(spark, d):
    t = F.col("box")
    both = _box(spark, d).withColumn("p", price.buy_block_prices(t))
    return both.select(
        *_KEYS, F.col("p.current").alias("cur"), F.col("p.base").alias("base"),
        price.lowest_sane_price(t).alias("lowest"), price.reference_price(t).alias("reference"),
        price.discount_in_text(t).alias("stated_percent"))


@query("meta_price_first", f"""{_LI_SQL}
    SELECT {_KEYS_SQL}, CASE WHEN c BETWEEN 100 AND 5000000 THEN c::DOUBLE / 100 ELSE 1.5 END AS price,
      CASE WHEN c BETWEEN 100 AND 5000000 THEN (c // 100) || '.' || lpad((c % 100)::VARCHAR, 2, '0') ELSE '1,50' END AS price_text
    FROM li""")
def meta_price_first(spark, d):
    c = F.col("c")
    cands = F.array(F.lit("0.10"), F.lit("n.v.t."), F.concat(_whole(c), F.lit("."), _frac(c), F.lit(" ")), F.lit("1,50"))
    return _lines(spark, d).withColumn("hit", price.first_sane(cands)).select(
        *_KEYS, F.col("hit.price").alias("price"), F.col("hit.text").alias("price_text"))


@query("discount_calc", f"""{_LI_SQL}, b AS (SELECT *, (c * (100 - pct) + 50) // 100 AS cut FROM li)
    SELECT {_KEYS_SQL}, CASE WHEN c > cut THEN (c - cut)::DOUBLE / 100 END AS amount,
      CASE WHEN c > cut THEN (((c - cut) * 20000 + c) // (2 * c))::DOUBLE / 100 END AS percent,
      (c - cut)::DOUBLE / 100 AS amount_or_zero
    FROM b""")
def discount_calc(spark, d):
    c = F.col("c")
    cut = F.call_function("div", c * (100 - F.col("pct")) + 50, F.lit(100))
    euros = lambda x: (x / F.lit(100).cast("decimal(3,0)")).cast(price.MONEY)
    staged = _lines(spark, d).select(*_KEYS, euros(c).alias("base"), euros(cut).alias("cur"))
    amount = price.discount_amount(F.col("base"), F.col("cur"))
    return staged.select(
        *_KEYS, amount.cast("double").alias("amount"), price.percent_of(amount, F.col("base")).cast("double").alias("percent"),
        price.discount_amount(F.col("base"), F.col("cur"), strict=False).cast("double").alias("amount_or_zero"))


@query("price_label", f"""{_LI_SQL}
    SELECT {_KEYS_SQL}, '€ ' || (c // 100) || '.' || lpad((c % 100)::VARCHAR, 2, '0') AS label,
      c::DOUBLE / 100 AS embedded FROM li""")
def price_label(spark, d):
    c = F.col("c")
    p = (c / F.lit(100).cast("decimal(3,0)")).cast(price.MONEY)
    priced = F.concat(F.lit('{"sku": "x", "price" : "'), _whole(c), F.lit(","), _frac(c), F.lit('"}'))
    scripts = F.concat(F.array_repeat(F.lit("var a = 1;"), F.col("k").cast("int") * 20), F.array(priced))  # up to 80 before it
    return _lines(spark, d).select(
        *_KEYS, price.price_label(p).alias("label"), price.embedded_price(scripts).alias("embedded"))


@query("stock_infer", f"""{_LI_SQL}
    SELECT {_KEYS_SQL},
      CASE k WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN 1 END AS by_text_bol,
      CASE k WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 0 WHEN 3 THEN 1 END AS by_text_bax,
      CASE k WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 0 END AS by_text_thomann,
      CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 END AS ld_bol,
      CASE l_returnflag WHEN 'A' THEN 1 ELSE 0 END AS ld_other,
      CASE k WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' WHEN 2 THEN 'NO' WHEN 3 THEN 'YES' END AS label
    FROM li""")
def stock_infer(spark, d):
    raw = _by_k(F.lit("Op VOORRAAD"), F.lit("Niet op voorraad"), F.lit("Tijdelijk uitverkocht"),
                F.lit("Vandaag besteld, morgen in huis"), F.lit("Onbekend"))
    link = (F.when(F.col("l_returnflag") == "R", "https://schema.org/OutOfStock")
            .when(F.col("l_returnflag") == "A", "http://schema.org/InStock").otherwise("https://schema.org/PreOrder"))
    return _lines(spark, d).select(
        *_KEYS, *[stock.from_text(raw, s).cast("int").alias(f"by_text_{s}") for s in ("bol", "bax", "thomann")],
        stock.from_availability(link, "bol").cast("int").alias("ld_bol"),
        stock.from_availability(link, "bax").cast("int").alias("ld_other"),
        stock.yes_no(stock.from_text(raw, "bol")).alias("label"))


@query("stock_badge", f"""{_LI_SQL}
    SELECT {_KEYS_SQL}, CASE k WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN NULL
      ELSE CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 END END AS in_stock,
      CASE k WHEN 4 THEN NULL WHEN 0 THEN 'leverbaar over ' || repeat('x', 12000) ELSE 'Direct leverbaar ' || k END AS status
    FROM li""")
def stock_badge(spark, d):
    k = F.col("k")
    css = _by_k(F.lit("fx-availability fx-availability--in-stock"), F.lit("fx-availability out-of-stock"),
                F.lit("fx-availability"), F.lit("fx-availability"), F.lit(None).cast("string"))
    badge = _by_k(F.concat(F.lit(" leverbaar over "), F.repeat(F.lit("x"), F.lit(12000))), F.concat(F.lit("Direct leverbaar "), k),
                  F.concat(F.lit("Direct leverbaar "), k), F.lit("Op aanvraag"), F.lit(" "))
    link = F.when(F.col("l_returnflag") == "R", "https://schema.org/OutOfStock").when(
        F.col("l_returnflag") == "A", "https://schema.org/InStock")
    text = F.when(k == 3, F.lit("Direct leverbaar 3")).otherwise(badge)
    return _lines(spark, d).select(
        *_KEYS, stock.from_badge(css, badge, link).cast("int").alias("in_stock"), stock.status_text(text).alias("status"))


@query("rating_clean", f"""{_LI_SQL}
    SELECT {_KEYS_SQL}, CASE WHEN c % 70 <= 50 THEN (c % 70)::DOUBLE / 10 END AS rating,
      (c % 70 // 10)::DOUBLE + CASE WHEN k % 2 = 0 THEN (c % 10)::DOUBLE / 10 ELSE 0 END AS rating_text,
      c % 5000 AS n_reviews, c % 5000 AS n_reviews_text FROM li""")
def rating_clean(spark, d):
    c, k = F.col("c"), F.col("k")
    r = c % 70
    one, tenth = F.call_function("div", r, F.lit(10)), r % 10
    ld = F.concat(one, F.when(k % 2 == 0, ",").otherwise("."), tenth)
    shown = F.concat(F.lit("Score "), one, F.when(k % 2 == 0, F.concat(F.lit(","), tenth)).otherwise(""), F.lit(" van de klanten"))
    n = F.replace(F.format_number(c % 5000, 0), F.lit(","), F.lit("."))
    return _lines(spark, d).select(
        *_KEYS, price.rating_within_scale(price.parse_number(ld)).alias("rating"),
        F.round(price.rating_in_text(shown, r"\b(\d(?:[.,]\d)?)\b"), 1).alias("rating_text"),
        price.review_count(n).alias("n_reviews"),
        price.review_count_in_text(F.concat(F.lit("("), n, F.lit(" reviews)"))).alias("n_reviews_text"))
