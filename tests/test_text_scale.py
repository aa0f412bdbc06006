"""Text functions on long texts and full tables: what they read more than once, and what they search."""

from html import unescape
import random
import re

from pyspark.sql import functions as F

from shelfwise.functions import html as H
from shelfwise.functions import stock, text

SPACES = " \t\n\x0b\r\x1c\x1f\x85    　"


def test_every_named_reference_is_found_in_a_small_group(spark):
    names = sorted(H.NAMED_ENTITIES)
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n: r.t for r in df.select("n", H.unescape(F.concat(F.lit("a&"), "n", F.lit(";b &x;"))).alias("t")).collect()}
    assert got == {n: f"a{H.NAMED_ENTITIES[n]}b &x;" for n in names}
    assert got["eacute"] == unescape("a&eacute;b") + " &x;"
    assert max(len(group) for of_letter in H._ENTITY_GROUPS.values() for group in of_letter.values()) <= 64


def test_white_space_is_squeezed_as_before(spark):
    draw = random.Random(7)
    rows = [("".join(draw.choice("ab​" + SPACES * 2) for _ in range(draw.randrange(9))),) for _ in range(3000)] + [(None,), ("",)]
    got = spark.createDataFrame(rows, "t string").select("t", text.clean(F.col("t")).alias("c"), text.has_text(F.col("t")).alias("h")).collect()
    for r in got:
        want = None if r.t is None else re.sub(f"[{SPACES}]+", " ", r.t).strip(" ") or None
        assert (r.c, bool(r.h)) == (want, want is not None), r


def test_badge_text_is_read_for_words_once_and_not_squeezed(spark):
    df = spark.createDataFrame(
        [("x", "Direct leverbaar", None, True), ("x", "Niet leverbaar", None, False), ("x", "  ", "InStock", True), ("x", None, "OutOfStock", False),
         ("out-of-stock", "leverbaar", "InStock", False), (None, "anders", "InStock", None)], "css string, t string, link string, want boolean")
    out = df.select("want", stock.from_badge(F.col("css"), F.col("t"), F.col("link")).alias("got"))
    assert all(r.got == r.want for r in out.collect())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and plan.count("lower(") == 1


def test_subcategory_links_are_cleaned_once_by_the_filter(spark):
    from shelfwise.operators import links

    here = "https://www.thomann.nl/1/hub.html"
    rows = [(here, "https://www.thomann.nl/1/usb_podcast.html?ref=1", "USB", 1), (here, here, "Zelf", 2), (here, None, "x", 3), (None, None, None, 4)]
    out = links.subcategories(spark.createDataFrame(rows, "from_url string, to_url string, label string, pos int"), 1)
    assert [tuple(r) for r in out.collect()] == [(here, "https://www.thomann.nl/1/usb_podcast.html", 1)]
    # The prefix of tracking keys: once in the filter for each end, once for the links that are left. It stood there 12 times.
    assert out._jdf.queryExecution().optimizedPlan().toString().count("utm_") == 3
