import math
import re

import duckdb
from helpers import awkward, empty, words

from shelfwise.llm import mixing, urls
from shelfwise.llm.catalog import MIX_SQL


def check_mix(table):
    rows = table.collect()
    con = duckdb.connect()
    con.register("documents", table.select("doc_id", "text", "source").toPandas())
    con.execute("CREATE TABLE d AS SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(text AS VARCHAR) AS text, CAST(source AS VARCHAR) AS source FROM documents")
    want = con.execute(MIX_SQL.replace("FROM documents", "FROM d")).fetchall()
    names = [c[0] for c in con.description]
    got = [tuple(r[n] for n in names) for r in mixing.mix(table).collect()]
    norm = lambda rs: sorted(([x if not isinstance(x, float) else round(x, 6) for x in r] for r in rs), key=str)
    assert norm(got) == norm(want)
    assert len(got) == len(rows)
    return got


def test_mix_against_sql(docs, llm):
    got = check_mix(docs)
    by = {}
    for doc_id, source, size, source_size, target, copies, taken in got:
        assert taken <= 2 * size and taken == copies * size
        by.setdefault(source, [0, target, 0])
        by[source][0] += taken
        by[source][2] = max(by[source][2], size)
    assert all(abs(taken - target) <= 2 * largest for taken, target, largest in by.values())
    assert math.isclose(sum(t for _, t, _ in by.values()), 1.5 * sum(r[2] for r in got))
    check_mix(awkward(llm))
    assert mixing.mix(empty(llm)).collect() == []


def level(sizes, share=1.5):
    """Targets by resharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while open_:
        each = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if each * weight[s] >= 2 * sizes[s]}
        if not above:
            return target | {s: each * weight[s] for s in open_}
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def test_targets_reshare_the_excess(llm):
    for sizes in ({"a": 10, "b": 1000, "c": 5, "d": 70, None: 300}, {"x": 5}, {"a": 0, "b": 0}, {"é": 9, "z": 9, "Z": 1}):
        table = llm.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(table).collect()}
        want = level(sizes)
        assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in want)


def test_emitted_rows(llm):
    table = awkward(llm)
    copies = {}
    for r in mixing.mix(table.where("doc_id is not null and doc_id <> 5")).collect():
        copies[r.doc_id] = r.copies
    got = mixing.emit(table.where("doc_id is not null and doc_id <> 5"))
    assert got.columns == table.columns
    counts = {}
    for r in got.collect():
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
        assert len(words(r.text)) == len(words(r.text)) and r.row == "x"
    total = sum(copies.values())
    assert abs(sum(counts.values()) - total) <= len(copies) and max(counts.values()) <= 2
    assert mixing.emit(empty(llm)).collect() == []


PAGES = "page_id long, url string, html string, host string, verdict string"
URLS = [
    (1, "http://WWW.Example.COM/en/x?q=/es/"), (2, "https://example.com/en/"), (3, "http://a.example.com/en"), (4, "http://shop.net/es/1"),
    (5, "http://net/fr/"), (6, "http://internet/fr/"), (7, "http://other.org/de/page"), (8, None), (9, "no scheme"), (10, "://com/"),
    (11, "http://com"), (12, "ftp://x.com#frag/y"), (13, "http://a.net/es?x"), (4, "http://shop.net/es/1"), (None, "http://a.b://c.com/z"),
    (14, "http://www.example.com.evil.org/en/"), (15, "http://häuser.com/ü/ß"), (16, "http://" + "long" * 5000 + ".org/" + "x" * 5000),
]


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), re.match(r"[^?#]*", rest[len(host):]).group()


def plain_rule(host, path):
    fit = [(h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, key=lambda x: len(x[0]), default=(None, None))


def test_url_rules_and_method(llm):
    page = "<html><head><style>the{}</style><script>the the</script></head><body>the house and the garden of the house</body></html>"
    table = llm.createDataFrame([(i, u, page, "x", "y") for i, u in URLS] + [(99, "http://housegarden.org/", None, "x", "y")], PAGES)
    got = urls.judge(table).collect()
    assert len(got) == len(URLS) + 1
    by = {(r.page_id, r.host, r.path): r for r in got}
    fit = []
    for page_id, url in URLS:
        host, path = plain_parts(url)
        rule, verdict = plain_rule(host, path)
        r = by[page_id, host, path]
        assert r.rule == rule and r.verdict in ("allow", "block")
        if rule:
            assert r.verdict == verdict
            fit.append((verdict, r.segments.split()))
    assert by[99, "housegarden.org", "/"].segments == "h:house h:garden h:org"
    known = {t for _, ts in fit for t in ts}
    for r in got:  # naive Bayes from its definition
        odds = 0.0
        for sign, verdict in ((1, "block"), (-1, "allow")):
            own = [t for v, ts in fit if v == verdict for t in ts]
            odds += sign * math.log(sum(v == verdict for v, _ in fit) / len(fit))
            odds += sign * sum(math.log((own.count(t) + 1) / (len(own) + len(known) + 1)) for t in r.segments.split() if t in known)
        assert math.isclose(odds, r.log_odds, abs_tol=1e-9)
        if not r.rule:
            assert r.verdict == ("block" if r.log_odds > 0 else "allow")


def test_no_pages(llm):
    assert urls.judge(llm.createDataFrame([], PAGES)).collect() == []
    alone = urls.judge(llm.createDataFrame([(1, "http://x.org/a", "<p>x</p>", "", "")], PAGES)).collect()
    assert [(r.rule, r.verdict) for r in alone] == [(None, "allow")]


def test_segment_is_the_best_split():
    words_ = {w: math.log10(n / 100) for w, n in {"the": 40, "he": 9, "at": 20, "heat": 3, "t": 1, "a": 10}.items()}

    def splits(name):
        if not name:
            yield []
        for i in range(1, len(name) + 1):
            for rest in splits(name[i:]):
                yield [name[:i], *rest]

    cost = lambda parts: sum(words_.get(p, -2 - len(p)) for p in parts)
    for name in ("theheat", "attheat", "xyz", "thexat", ""):
        assert math.isclose(cost(urls.segment(name, words_, 2.0)), max(map(cost, splits(name))))
