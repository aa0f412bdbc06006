"""Text, label, name and model columns."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise import lexicon

# Java's \s is ASCII only; pages carry no-break and typographic spaces as well (category Z).
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
# Only runs that change are matched, so plain text passes without a replacement per blank: a run starts with
# another space than a blank, or has two characters. A character that is no space is looked at once.
_UNEVEN_SPACE = rf"{SPACE}(?:(?<! ){SPACE}*|(?<= ){SPACE}+)"

_JAVA_SPECIAL = re.compile(r"([\\.^$|?*+()\[\]{}\-])")


def quoted(words: list[str]) -> str:
    """Alternation of literal words, for a single regular expression scan."""
    return "|".join(_JAVA_SPECIAL.sub(r"\\\1", w.lower()) for w in words)


def bind(c: Column, f: Callable[[Column], Column]) -> Column:
    """`f(c)` with `c` computed once, however often `f` uses it: a one-element transform.

    Keeps plans small where a column function reads its argument several times.
    """
    # The lambda keeps optional parameters of `f` from being taken as the index.
    return F.get(F.transform(F.array(c), lambda v: f(v)), F.lit(0))


def blank_to_null(c: Column) -> Column:
    """`c` computed once: inside lambdas and branches Spark writes the argument of `nullif` out twice, so nested ones double."""
    return F.get(F.array_remove(F.array(c.cast("string")), F.lit("")), F.lit(0))


def squeezed(c: Column) -> Column:
    """Collapse all white space to one blank and trim."""
    return F.trim(F.regexp_replace(c.cast("string"), _UNEVEN_SPACE, " "))


def clean(c: Column) -> Column:
    """Collapse all white space to one blank, trim, empty becomes NULL."""
    return blank_to_null(squeezed(c))


def has_text(c: Column) -> Column:
    """Whether `clean` leaves something: the first character that is no space decides."""
    return c.cast("string").rlike(r"[^\s\x1c-\x1f\x85\p{Z}]")


def has_any(c: Column, words: list[str]) -> Column:
    """True when any word occurs, case-insensitive; NULL text counts as False.

    Byte searches beat one alternation by several times on long texts. The one-element
    array binds the lower-cased text, so it is built once for all words.
    """
    return F.coalesce(F.exists(F.array(F.lower(c)), lambda t: _holds_any(t, words)), F.lit(False))


def lower_has_any(low: Column, words: list[str]) -> Column:
    """`has_any` of a text that is lower case already, for one that is asked more than once."""
    return F.coalesce(_holds_any(low, words), F.lit(False))


def _holds_any(t: Column, words: list[str]) -> Column:
    return reduce(or_, [t.contains(w.lower()) for w in dict.fromkeys(words)])


def first_group(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group, NULL when the pattern does not occur."""
    return blank_to_null(F.regexp_extract(c, pattern, group))


def first_nonblank(*cols: Column) -> Column:
    """`a or b or c` on texts: NULL and the empty text fall through."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def first_nonzero(*cols: Column) -> Column:
    """`a or b or c` on numbers: NULL and zero fall through."""
    return F.coalesce(*[F.nullif(c, F.lit(0).cast("double")) for c in cols])


def first_text(*cols: Column) -> Column:
    """First candidate that still has text after cleaning."""
    return F.coalesce(*[clean(c) for c in cols])


def joined_text(parts: Column) -> Column:
    """Non-blank parts joined by a blank, cleaned."""
    kept = F.filter(parts, lambda p: clean(p).isNotNull())
    return clean(F.array_join(kept, " "))


def slug_label(c: Column) -> Column:
    return clean(F.translate(c, "-_", "  "))


def category_label(c: Column) -> Column:
    """Label form used for matching: lower case, no trailing count, plain blanks."""
    low = F.lower(F.coalesce(clean(c), F.lit("")))
    no_count = F.regexp_replace(low, r"\s*\(\s*\d+\s*\)\s*$", "")
    return F.trim(F.regexp_replace(F.translate(no_count, "-/", "  "), r"\s+", " "))


def whole_number(c: Column) -> Column:
    return c.cast("string").try_cast("bigint")


def without_shop_suffix(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?i)\s*\|\s*bax\s*shop\s*$", ""))


def utc_timestamp(c: Column) -> Column:
    """ISO-8601 text with zone offset to an instant; bad text becomes NULL."""
    return F.try_to_timestamp(c)


# ---- names ---------------------------------------------------------------

def canonical_strict(brand: Column, title: Column, model: Column) -> Column:
    """Lower case letters and digits of brand, title and model; title alone as fallback."""

    def squash(c: Column) -> Column:
        return blank_to_null(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " ")))

    whole = F.concat_ws(" ", clean(brand), clean(title), clean(model))
    return F.coalesce(squash(whole), squash(clean(title)))


def canonical_loose(brand: Column, title: Column, model: Column) -> Column:
    """Same parts, case and punctuation kept."""
    return clean(F.concat_ws(" ", clean(brand), clean(title), clean(model)))


def canonical_pair(brand: Column, model: Column, name: Column) -> Column:
    """Brand and model when both are known, otherwise the product name."""
    b, m = clean(brand), clean(model)
    return F.when(b.isNotNull() & m.isNotNull(), F.concat_ws(" ", b, m)).otherwise(clean(name))


def model_name(c: Column, shop: str) -> Column:
    """Model text per shop; texts known to be no model become NULL."""
    return bind(clean(c), lambda m: _model(m, shop))


def _model(m: Column, shop: str) -> Column:
    n = F.length(m)
    if shop == "bax":
        bad = F.lower(m).isin(lexicon.BAD_MODELS["bax"]) | ((n > 30) & m.contains(" ")) | (n < 2)
    elif shop == "bol":
        bad = F.lower(m).isin(lexicon.BAD_MODELS["bol"]) | (n <= 2)
    elif shop == "thomann":
        bad = n > 80
    else:
        return m
    return F.when(~bad, m)


def gtin_preference(values: dict[str, Column], shop: str) -> Column:
    order = ["gtin13", "gtin14", "gtin"] if shop == "bol" else [
        "gtin13", "gtin14", "gtin12", "gtin8", "gtin"]
    return clean(first_nonblank(*[values[k] for k in order]))


def gtin_in_text(c: Column) -> Column:
    return first_group(c, r"(?i)\b(EAN|GTIN)\b\D{0,30}(\d{8,14})\b", 2)


def part_number_in_text(c: Column) -> Column:
    return first_group(
        c,
        r"(?i)\b(MPN|Artikelnummer|Part number|Onderdeelnummer)\b\D{0,30}([A-Z0-9][A-Z0-9\-_/.]{2,})",
        2,
    )


def model_in_text(c: Column, needs_digit: bool) -> Column:
    m = first_group(
        c, r"(?i)\b(Model|Modelnummer|Typenummer)\b\D{0,30}([A-Z0-9][A-Z0-9\-_/.]{2,})", 2)
    return F.when(m.rlike(r"\d"), m) if needs_digit else m
