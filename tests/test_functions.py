"""Column functions on literal cases."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import blocks as B
from shelfwise.functions import html as H
from shelfwise.functions import jsonld as L
from shelfwise.functions import keys, price, stock, text, url
from shelfwise.functions import structure as S
from shelfwise.operators import classify, support


def values(spark, column, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, x string")
    return [r["r"] for r in df.orderBy("i").select(column(F.col("x")).alias("r")).collect()]


@pytest.mark.parametrize("parse, cases", [
    (price.parse_eu, {"€ 49,99": 49.99, "1.234,56": 1234.56, "1.299": 1299.0, "49.99": 49.99, "€ 1.299,00": 1299.0,
                      "": None, None: None, "geen": None, "1,2,3": None}),
    (price.parse_first, {"€ 49,99": 49.99, "49,99": 49.99, "49.-": 49.0, "49,-": 49.0, "1.234,56": 1234.56, "1 234,56": 1234.56,
                         "€ 49,99": 49.99, "1299": 1299.0, "12,5": 12.5, "x": None, None: None}),
    (price.parse_plain, {"€ 1.299,00": 1299.0, "49.99": 49.99, "1.299": 1.299, None: None}),
    (price.parse_support, {"€ 1.299,00": 1299.0, "49.99": 4999.0, "19,95": 19.95, None: None}),
    (price.parse_number, {"12,5": 12.5, "1e3": 1000.0, "12f": None, " 7 ": 7.0, None: None}),
    (lambda c: price.reference_price(c), {"30-Dagen-Beste-Prijs: € 449": 449.0, "30 Dagen Beste Prijs: € 1.449,50": 1449.5, "€ 449": None}),
    (text.clean, {" a   b\n": "a b", "\x1c": None, "": None, None: None, "a b c": "a b c", "a  b": "a b"}),
    (text.category_label, {"Name (123)": "name", "USB/Podcast-Mics": "usb podcast mics", None: ""}),
    (text.slug_label, {"a-b_c": "a b c", "-": None}),
    (lambda c: stock.from_text(c, "bol"), {"Niet op voorraad": False, "Op voorraad": True, "": None, None: None}),
    (lambda c: text.model_name(c, "bax"), {"EditionType": None, "x": None, "M 1": "M 1", "a " + "b" * 40: None}),
])
def test_literals(spark, parse, cases):
    assert values(spark, parse, list(cases)) == list(cases.values())


def test_has_any_counts_null_as_false(spark):
    assert values(spark, lambda c: text.has_any(c, ["ups", "a.b"]), ["Pushups", "axb", "A.B", None, ""]) == [True, False, True, False, False]


def test_keys_match_hashlib(spark):
    words = ["https://x/é", "", "a"]
    assert values(spark, keys.sha1_key, words) == [int(hashlib.sha1(w.encode()).hexdigest()[:12], 16) % 2_000_000_000 for w in words]
    assert values(spark, keys.md5_key, words) == [int(hashlib.md5(w.encode()).hexdigest()[:12], 16) for w in words]
    assert values(spark, keys.md5_key, [None]) == [None]


@pytest.mark.parametrize("shop, given, expected", [
    ("bax", "https://x.nl/a?UTM_Source=1&ref=2&b=1&b=2&c=#f", "https://x.nl/a?b=1&b=2#f"),
    ("bax", "https://x.nl/a b?q=a%20b&z=%zz", "https://x.nl/a b?q=a+b&z=%25zz"),
    ("bol", "https://x.nl/a?promo=1&Promo=2#f", "https://x.nl/a?Promo=2"),
    ("maxiaxi", "https://x.nl/?_GL=1&cid=3", "https://x.nl/"),
    ("thomann", "https://x.nl/a/;p?utm_any=1&e=&SPM=2", "https://x.nl/a?e="),
    ("thomann", "https://x.nl/a.html/?x=~*", "https://x.nl/a.html?x=~%2A"),
])
def test_strip_tracking(spark, shop, given, expected):
    assert values(spark, lambda c: url.strip_tracking(c, shop), [given]) == [expected]


def test_resolve_agrees_with_the_standard_library(spark):
    from urllib.parse import urljoin

    base = "https://h.nl/a/b/c.html?x=1#old"
    hrefs = ["/z", "d", "../d", "./d/./e", "../../../d", "//o.nl/x", "http://q.nl", "?y=2", "d/..", "mailto:a@b"]
    got = values(spark, lambda c: url.resolve(F.lit(base), c), hrefs)
    assert got == [urljoin(base, h) for h in hrefs]


def test_next_page(spark):
    assert values(spark, lambda c: url.next_page(c, "bax"), ["http://x/a?page=9&q=1", "http://x/a"]) == ["http://x/a?page=10&q=1", None]
    pages = ["http://x/a", "http://x/a?page=120"]
    assert values(spark, lambda c: url.next_page(c, "bol"), pages) == ["http://x/a?page=2", "http://x/a?page=121"]
    assert values(spark, lambda c: url.next_page(c, "bol", 120), pages) == ["http://x/a?page=2", None]


def test_nodes_of_any_depth(spark):
    from shelfwise.functions import jsonld

    def block(n):
        return '<script type="application/ld+json">' + '{"@graph": [[' * n + '{"@type": "Product", "name": "x"}' + "]]}" * n + "</script>"

    pages = [block(0), block(1), block(6) + block(2), block(12), '<script type="application/ld+json">[[[{"@type": "Product"}, 1], []]]</script>', ""]
    found = values(spark, lambda c: F.size(jsonld.of_type(jsonld.nodes(jsonld.blocks(c)), "Product")), pages)
    assert found == [1, 1, 2, 1, 1, 0]


def test_long_texts_are_read_whole(spark):
    from shelfwise.functions import price, stock
    from shelfwise.operators import classify

    long = "x " * 20_000
    assert values(spark, lambda c: stock.from_text(c, "bol"), [long + "niet leverbaar", "Niet op voorraad"]) == [False, False]
    assert values(spark, lambda c: stock.from_text(c, "bax"), ["Niet op voorraad", long + "op voorraad"]) == [False, True]
    assert values(spark, lambda c: price.embedded_price(F.concat(F.array_repeat(F.lit("a"), 50), F.array(c))), ['{"price": 12.5}']) == [12.5]
    assert values(spark, lambda c: classify.is_bad_html(c), [long + "captcha", "short"]) == [True, False]
    assert values(spark, lambda c: classify.is_bad_html(c, 800), ["short", long]) == [True, False]
    assert values(spark, lambda c: classify.is_blocked(c, None, None, 20000), ["<p>no title</p>", "<title>t</title>"]) == [True, False]


def test_buy_block_edges(spark):
    got = values(spark, price.buy_block_prices, ["€ 10,00", "€ 12,00 € 10,00", "12,50 of 10,00", "niets", None])
    assert [(r["current"], r["base"]) if r else None for r in got] == [
        (10.0, None), (10.0, 12.0), (10.0, 12.5), (None, None), (None, None)]


def test_graph_nodes_keep_document_order(spark):
    page = ('<script type="application/ld+json">[{"@type":"A","@graph":[{"@type":"B"},[{"@type":"C","@graph":[{"@type":"D"}]}]]},'
            '{"@type":["E","Product"]}]</script><script type="application/ld+json">{bad</script>')
    got = values(spark, lambda c: F.transform(L.nodes(L.blocks(c)), lambda v: F.array_join(L.types(v), "+")), [page])
    assert got == [["A", "B", "C", "D", "E+Product"]]


def test_blocks_survive_malformed_pages(spark):
    page = ("<table><tr><th>Merk<td>A &amp; B<tr><th>Merk<td>late</table><ul><li>K: v<li>no</ul><div class='buy'>€ 5<b>x"
            "<script>if (a<b) '</div>'</script></div><p data-x='>'>t < u</p><a href=x")
    df = spark.createDataFrame([(page,), (None,), ("",), ("<",)], "x string").withColumn("m", B.marks(F.col("x")))
    got = S.staged(df, S.spec_steps("x", "s")).select("s", B.all_text(F.col("m"), "buy").alias("b")).collect()
    assert [r["s"] for r in got] == [{"merk": "A & B", "k": "v"}, {}, {}, {}]
    assert got[0]["b"] == "€ 5 x"


def test_visible_text_leaves_scripts_out(spark):
    page = "<html><head><title>t</title></head><body>a<script>x()</script><style>p{}</style><!-- c --><p>b &euro;&#33;</p></body>"
    assert values(spark, H.visible_text, [page]) == ["a b €!"]


def test_blocked_pages(spark):
    long_page = "<title>ok</title>" + "x" * 90_000
    pages = [long_page, "short", None, "<title>Captcha</title>" + "x" * 90_000]
    assert values(spark, classify.is_blocked, pages) == [False, False, True, True]
    assert values(spark, lambda c: classify.is_blocked(c, least_bytes=5000), pages) == [False, True, True, True]
    assert values(spark, classify.is_bad_html, [long_page, None, "captcha" + "x" * 900, "x" * 6000 + "captcha"]) == [False, True, True, True]
    assert values(spark, classify.is_shell, [long_page, None]) == [False, True]


def test_support_flags_are_three_valued(spark):
    got = values(spark, lambda c: support.shipping_included(c, "bol"), ["gratis verzending", "verzendkosten", "x"])
    assert got == [True, False, None]


def test_nested_navigation_keeps_all_links(spark):
    from shelfwise.functions import html as H

    pages = [
        ("<ol><li><a href='/a'>a</a><ol><li><a href='/b'>b</a></ol><li><a href='/c'>c</a></ol><a href='/out'>o</a>", ["/a", "/b", "/c"], 1),
        ("<nav><ol><a href='/a'></a></ol><nav><a href='/b'></a></nav><a href='/c'></a></nav><ol><a href='/d'></a></ol>", ["/a", "/b", "/c", "/d"], 2),
        ("</ol><a href='/x'></a><NAV class='n'><a href='/a'></a>", ["/a"], 1),
        ("<navy><a href='/x'></a></navy><p>no list", [], 0), ("", [], 0)]
    rows = spark.createDataFrame([(i, p[0]) for i, p in enumerate(pages)], "i int, h string")
    got = rows.select("i", H.nav_links(F.col("h")).alias("links"), F.size(H.nav_blocks(F.col("h"))).alias("n")).orderBy("i").collect()
    assert [(r.links, r.n) for r in got] == [(p[1], p[2]) for p in pages]


def test_price_in_a_buy_block_is_known_by_place(spark):
    from shelfwise.functions import blocks as B

    html = ("<div class='price'><b>9,99</b></div><div data-test='buy-block'>9,99 <span class='price'><i>19,99</i></span></div>"
            "<div class='price'><b>29,99</b></div>")
    staged = spark.createDataFrame([(html,)], "h string").withColumn("m", B.marks(F.col("h")))
    assert staged.select(B.texts_within(F.col("m"), "price", "buy_block").alias("t")).first().t == ["19,99"]


def test_brackets_in_texts_cost_no_steps(spark):
    """Nested lists and graphs open whatever their texts hold; depth bounds the steps where lists stand side by side."""
    deep = json.dumps([
        [{"@type": "A", "n": '[[ ,[ " ]'}], [[{"@type": "B"}]],
        {"@graph": [{"@type": "C"}, [{"@graph": {"@type": "D", "x": '"@graph":', "y\\": "[["}}]]}])
    wide = "[" + ",".join('[{"@type":"E","g":[[1,2],[3,4]]}]' for _ in range(300)) + "]"
    rows = spark.createDataFrame([(0, deep), (1, wide)], "i int, t string").select("i", L.nodes(F.array(F.parse_json("t"))).alias("n"))
    kinds = rows.select("i", F.transform("n", lambda v: F.try_variant_get(v, '$["@type"]', "string")).alias("k")).orderBy("i").collect()
    assert [k for k in kinds[0].k if k] == ["A", "B", "C", "D"] and [k for k in kinds[1].k if k] == ["E"] * 300
