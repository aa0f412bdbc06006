"""Service and support facts from page text, three-valued: True, False, unknown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise import lexicon
from shelfwise.functions import html as H
from shelfwise.functions.price import parse_eu, parse_support
from shelfwise.functions.text import clean, first_group, has_any
from shelfwise.operators.classify import without_consent


def _true_or_unknown(hit: Column) -> Column:
    return F.when(hit, True)


def shipping_included(t: Column, shop: str) -> Column:
    if shop == "thomann":
        free = has_any(t, ["standaard levering"]) & has_any(t, ["gratis"])
    else:
        free = has_any(t, lexicon.FREE_SHIPPING_WORDS)
    return F.when(free, True).when(has_any(t, lexicon.PAID_SHIPPING_WORDS), False)


def free_shipping_threshold(t: Column, shop: str) -> Column:
    amount = r"€\s*([0-9]+(?:[.,][0-9]{1,2})?)"
    if shop == "thomann":
        found = first_group(
            t, r"(?i)(?:geen\s+verzendkosten|gratis\s+verzending).{0,160}?\bvanaf\b.{0,40}?" + amount)
    else:
        found = first_group(t, r"(?i)gratis\s+verzending.{0,80}?vanaf\s*" + amount)
    return parse_eu(found) if shop == "bax" else parse_support(found)


def cooling_off_days(t: Column, shop: str) -> Column:
    end = r"(?:money-?back|moneyback|bedenktijd)" if shop == "thomann" else "bedenktijd"
    return first_group(t, r"(?i)(\d+)\s*dagen\s*" + end).try_cast("int")


def warranty_months(t: Column, shop: str) -> Column:
    if shop == "thomann":
        years = first_group(t, r"(?i)(\d+)\s*(?:jaar|jaren)\s+thomann\s+garantie").try_cast("int")
        three = F.when(t.rlike(r"(?i)\bdrie\s+jaar\s+thomann\s+garantie\b"), 36)
        return F.coalesce(years * 12, three)
    years = first_group(t, r"(?i)(\d+)\s*(?:jaren|jaar)\s*garantie").try_cast("int")
    months = first_group(t, r"(?i)(\d+)\s*(?:maanden|maand)\s*garantie").try_cast("int")
    return F.coalesce(years * 12, months)


def seller(t: Column) -> Column:
    return clean(first_group(t, r"(?i)verkoop\s+door\s+([^|\n\r]+)"))


def is_sold_by_shop(t: Column) -> Column:
    s = F.lower(seller(t))
    return F.coalesce(s.contains("bol.com") | F.trim(s).isin("bol", "bolcom"), F.lit(False))


def warranty_provider(t: Column, shop: str) -> Column:
    name = lexicon.WARRANTY_SHOP_NAME[shop]
    if shop == "bol":
        return F.when(is_sold_by_shop(t), name).otherwise(seller(t))
    known = warranty_months(t, shop).isNotNull()
    if shop == "bax":
        known = known & has_any(t, lexicon.WARRANTY_SHOP_WORDS)
    return F.when(known, name)


def courier(t: Column, html: Column | None, shop: str) -> Column:
    hit = has_any(t, lexicon.COURIER_WORDS[shop])
    if shop != "thomann":
        return _true_or_unknown(hit)
    shown = F.array_join(F.regexp_extract_all(
        html, F.lit(r"""(?is)\s(?:alt|title|aria-label)\s*=\s*("[^"]*"|'[^']*')"""), F.lit(1)), " ")
    return hit | has_any(shown, lexicon.COURIER_WORDS[shop])


def service_columns(t: Column, shop: str) -> dict[str, Column]:
    """The service facts one page's text gives; fields a shop never states are NULL."""
    unknown = F.lit(None).cast("boolean")
    own = shop != "thomann"
    return {
        "shipping_included": shipping_included(t, shop),
        "free_shipping_threshold_amt": free_shipping_threshold(t, shop),
        "pickup_point_available": _true_or_unknown(has_any(t, lexicon.PICKUP_WORDS)) if own else unknown,
        "delivery_shipping_available": _true_or_unknown(has_any(t, lexicon.DELIVERY_WORDS[shop])),
        "delivery_courier_available": courier(t, None, shop) if own else unknown,
        "cooling_off_days": cooling_off_days(t, shop),
        "free_returns": _true_or_unknown(has_any(t, lexicon.FREE_RETURN_WORDS)) if own else unknown,
        "warranty_provider": warranty_provider(t, shop),
        "warranty_duration_months": warranty_months(t, shop),
    }


def support_columns(t: Column, html: Column, shop: str) -> dict[str, Column]:
    phone_number = t.rlike(lexicon.PHONE_PATTERN[shop])
    chat = has_any(t, lexicon.CHAT_WORDS[shop])
    if shop == "bol":
        sold = is_sold_by_shop(t)
        chat_ok = chat | (sold & has_any(t, lexicon.SHOP_SUPPORT_WORDS))
        phone_ok = phone_number | has_any(t, lexicon.PHONE_WORDS)
        mail_ok = has_any(t, lexicon.EMAIL_WORDS) | (sold & has_any(t, lexicon.SHOP_CONTACT_WORDS))
        snippet = clean(t)
    else:
        chat_ok = chat
        phone_ok = phone_number
        mail_ok = html.rlike(r"""(?is)<a\b[^>]*href\s*=\s*["']mailto:""") | t.rlike(lexicon.SHOP_MAIL_PATTERN)
        snippet = without_consent(clean(t))
    return {
        "expert_chat_available": _true_or_unknown(chat_ok),
        "phone_support_available": _true_or_unknown(phone_ok),
        "email_support_available": _true_or_unknown(mail_ok),
        "in_store_support": F.lit(False),
        "expert_support_text": snippet,
    }


def with_text(pages: DataFrame, shop: str) -> DataFrame:
    """pages(url, html) with the text the shop's rules read."""
    read = H.visible_text if shop == "thomann" else H.body_text
    return pages.withColumn("page_text", read(F.col("html")))


def customer_service(pages: DataFrame, shop: str) -> DataFrame:
    staged = with_text(pages, shop)
    facts = service_columns(F.col("page_text"), shop)
    return staged.select(
        *[c for c in pages.columns if c != "html"],
        *[c.alias(n) for n, c in facts.items()],
        H.support_link(F.col("url"), F.col("html"), shop).alias("customer_service_url"),
    )


def expert_support(pages: DataFrame, shop: str) -> DataFrame:
    staged = with_text(pages, shop)
    facts = support_columns(F.col("page_text"), F.col("html"), shop)
    return staged.select(
        *[c for c in pages.columns if c != "html"], *[c.alias(n) for n, c in facts.items()])


def site_defaults(support_pages: DataFrame, shop: str, order: str) -> DataFrame:
    """Threshold, courier and cooling-off stated on the shop's own support pages: one row.

    The first page (by `order`) that states a value gives it.
    """
    staged = with_text(support_pages, shop)
    t, at = F.col("page_text"), F.col(order)
    threshold = free_shipping_threshold(t, shop)
    days = F.nullif(cooling_off_days(t, shop), F.lit(0))
    fallback = F.lit(lexicon.DEFAULT_COOLING_OFF_DAYS.get(shop)).cast("int")
    facts = staged.select(
        at.alias("_at"), threshold.alias("_threshold"), days.alias("_days"),
        courier(t, F.col("html"), shop).alias("_courier"))

    def first(c: str) -> Column:
        return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_at")))

    return facts.agg(
        first("_threshold").alias("free_shipping_threshold_amt"),
        F.coalesce(first("_days"), fallback).alias("cooling_off_days"),
        F.bool_or("_courier").alias("delivery_courier_available"),
    )
