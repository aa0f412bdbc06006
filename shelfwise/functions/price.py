"""Price, discount, rating columns. Money leaves here as DECIMAL(12,2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise import lexicon
from shelfwise.functions.text import bind, blank_to_null, clean, first_group

MONEY = "decimal(12,2)"


def money(c: Column) -> Column:
    return c.try_cast(MONEY)


def _digits_and_marks(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), r"[^0-9,.]", "")


def _comma_decimal(marks: Column) -> Column:
    return F.replace(F.replace(marks, F.lit("."), F.lit("")), F.lit(","), F.lit("."))


def parse_eu(c: Column) -> Column:
    """A comma is the decimal mark; a lone dot is one unless it groups thousands."""
    return bind(_digits_and_marks(c), lambda s: (
        F.when(s.contains(","), _comma_decimal(s))
        .when(s.rlike(r"^\d{1,3}(?:\.\d{3})+$"), F.replace(s, F.lit("."), F.lit("")))
        .otherwise(s))).try_cast("double")


def parse_plain(c: Column) -> Column:
    """A comma is the decimal mark; without one the dot is."""
    return bind(
        _digits_and_marks(c),
        lambda s: F.when(s.contains(","), _comma_decimal(s)).otherwise(s)).try_cast("double")


def parse_support(c: Column) -> Column:
    """Dots always group thousands, the comma is the decimal mark."""
    s = F.replace(F.trim(c.cast("string")), F.lit("."), F.lit(""))
    s = F.regexp_replace(F.replace(s, F.lit(","), F.lit(".")), r"[^0-9.]", "")
    return s.try_cast("double")


_FIRST_AMOUNT = r"(\d{1,3}(?:[. ]\d{3})+|\d+)(?:[.,](\d{1,2}))?"


def parse_first(c: Column) -> Column:
    """First amount in the text; handles grouped thousands, dash cents, one-digit cents."""
    s = clean(F.translate(c.cast("string"), "\u00a0\u202f€", "  "))
    s = F.regexp_replace(s, r"(\d)\s*[.,]\s*[-–—]", "$1")

    def amount(t: Column) -> Column:
        whole = F.regexp_replace(F.regexp_extract(t, _FIRST_AMOUNT, 1), "[. ]", "")
        return F.concat(whole, F.lit("."), F.rpad(F.regexp_extract(t, _FIRST_AMOUNT, 2), 2, "0"))

    # Without a match the text is '.00', which is no amount.
    return F.nullif(bind(s, amount), F.lit(".00")).try_cast("double")


def parse_number(c: Column) -> Column:
    """A JSON number or numeric text with an optional decimal comma."""
    return bind(
        F.trim(F.replace(c.cast("string"), F.lit(","), F.lit("."))),
        lambda s: F.when(s.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), s)).try_cast("double")


PARSERS = {"bax": parse_eu, "bol": parse_first, "thomann": parse_plain}


def sane(p: Column) -> Column:
    return bind(p, lambda x: F.when((x >= 1) & (x <= 50000), x))


def looks_like_price(c: Column) -> Column:
    s = clean(c)
    return F.coalesce(
        s.rlike(r"€|(?i:\b(?:eur|euro)\b)|\b\d{1,3}(?:[.\s]\d{3})*,\d{2}\b"), F.lit(False))


def first_price_text(texts: Column) -> Column:
    cleaned = F.transform(texts, clean)
    return F.get(F.filter(cleaned, lambda t: t.rlike(r"€|\b\d+[,.]\d{2}\b")), F.lit(0))


def amounts_in_text(c: Column, any_number: bool) -> Column:
    """All euro amounts; with `any_number`, bare numbers when there is none."""
    euro = F.regexp_extract_all(c, F.lit(lexicon.EURO_AMOUNT), F.lit(0))
    if not any_number:
        return euro
    bare = F.regexp_extract_all(c, F.lit(lexicon.PLAIN_AMOUNT), F.lit(0))
    return bind(euro, lambda e: F.when(F.size(e) > 0, e).otherwise(bare))


def buy_block_prices(text: Column) -> Column:
    """struct(current, base): one amount is current; of several, lowest and highest."""
    prices = F.filter(
        F.transform(amounts_in_text(text, any_number=True), parse_eu), lambda p: p.isNotNull())

    def low_and_high(found: Column) -> Column:
        above = F.filter(found, lambda p: p > 0)
        first, many = F.get(found, F.lit(0)), F.size(found) >= 2
        return F.struct(
            F.when(many, F.coalesce(F.array_min(above), first)).otherwise(first).alias("current"),
            F.when(many, F.coalesce(F.array_max(above), first)).alias("base"))

    return bind(prices, low_and_high)


def lowest_sane_price(text: Column) -> Column:
    vals = F.transform(amounts_in_text(text, any_number=False), lambda t: sane(parse_plain(t)))
    return F.array_min(vals)


def reference_price(text: Column) -> Column:
    amount = r"€\s*([\d.\s]+(?:,\d{1,2})?)"
    hit = F.coalesce(
        first_group(text, r"(?i)30\s*-\s*Dagen\s*-\s*Beste\s*-\s*Prijs\s*:\s*" + amount),
        first_group(text, r"(?i)30\s*Dagen\s*Beste\s*Prijs\s*:\s*" + amount),
    )
    return sane(parse_plain(hit))


def first_sane(texts: Column) -> Column:
    """struct(price, text) of the first candidate that is a plausible price."""
    pairs = F.transform(
        texts, lambda t: F.struct(sane(parse_plain(t)).alias("price"), clean(t).alias("text")))
    return F.get(F.filter(pairs, lambda p: p["price"].isNotNull()), F.lit(0))


def price_label(p: Column) -> Column:
    return F.when(p.isNotNull(), F.format_string("€ %.2f", p.cast("double")))


def embedded_price(scripts: Column) -> Column:
    """`"price": n` in any script, the first in page order."""
    blob = F.array_join(scripts, " ")
    return parse_first(first_group(blob, r'"price"\s*:\s*"?(\d+(?:[.,]\d{1,2})?)"?'))


def discount_in_text(c: Column) -> Column:
    return first_group(c, r"(?i)(\d{1,2})\s*%\s*(korting|discount)").try_cast("double")


def discount_amount(base: Column, current: Column, strict: bool = True) -> Column:
    applies = base > current if strict else base >= current
    return F.when(applies, money(base - current))


def percent_of(amount: Column, base: Column) -> Column:
    """Percent with two decimals, rounded half up in whole cents so no double is rounded."""
    a = (amount * 100).cast("bigint")
    b = (base * 100).cast("bigint")
    hundredths = F.call_function("div", a * 20000 + b, b * 2)
    return F.when(b > 0, (hundredths / F.lit(100).cast("decimal(3,0)")).cast("decimal(7,2)"))


def rating_in_text(c: Column, pattern: str) -> Column:
    return parse_number(first_group(c, pattern))


def rating_within_scale(value: Column, scale: int = 5) -> Column:
    return F.when(value <= scale, value)


def review_count(c: Column) -> Column:
    return blank_to_null(F.replace(c.cast("string"), F.lit("."), F.lit(""))).try_cast("bigint")


def review_count_in_text(c: Column) -> Column:
    return first_group(F.replace(c, F.lit("."), F.lit("")), r"(\d+)").try_cast("bigint")
