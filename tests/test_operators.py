"""Operators against brute force, with hot keys and missing keys."""

import random
from collections import defaultdict
from statistics import median

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators import integrity, links, loading, matching, resolve
from shelfwise.plans import compare
from shelfwise.sources import feeds, schema
from shelfwise.streaming import incremental


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def skewed(n=600, keys=40, seed=1):
    """A third of all rows share key 0, some have none."""
    r = random.Random(seed)
    return [(None if i % 11 == 0 else 0 if i % 3 == 0 else r.randrange(keys), i, r.choice([None, f"v{i}"])) for i in range(n)]


def test_insert_ignore_keeps_first_and_is_idempotent(spark):
    data = skewed()
    new = spark.createDataFrame(data, "k int, pos int, v string")
    target = spark.createDataFrame([(5, -1, "old"), (0, -1, "old")], "k int, pos int, v string")
    loaded = loading.loaded_ignore(target, new, "k", ["pos"], required=["v"])
    want = {5: "old", 0: "old"}
    for k, _, v in data:
        if k is not None and v is not None:
            want.setdefault(k, v)
    assert {r["k"]: r["v"] for r in loaded.filter("k is not null").collect()} == want
    assert loading.insert_ignore(loaded, new.filter("k is not null"), "k", ["pos"], ["v"]).count() == 0
    no_key = sum(1 for k, _, v in data if k is None and v is not None)
    assert loaded.filter("k is null").count() == no_key


def test_replace_keeps_last(spark):
    data = [d for d in skewed() if d[0] is not None]
    got = loading.replace_rows(
        spark.createDataFrame([(99, 0, "old")], "k int, pos int, v string"), spark.createDataFrame(data, "k int, pos int, v string"), "k", ["pos"])
    want = {99: "old", **{k: v for k, _, v in data}}
    assert {r["k"]: r["v"] for r in got.collect()} == want


def test_upsert_keeps_known_values(spark):
    data = [d for d in skewed() if d[0] is not None]
    old = spark.createDataFrame([(0, "a", "b"), (77, "c", None)], "k int, v string, w string")
    folded = loading.last_known_per_key(spark.createDataFrame(data, "k int, pos int, v string"), ["k"], ["pos"])
    got = loading.upsert_coalesce(old, folded.select("k", "v", F.lit(None).cast("string").alias("w")), ["k"])
    want = {0: ("a", "b"), 77: ("c", None)}
    for k, _, v in data:
        was = want.get(k, (None, None))
        want[k] = (v if v is not None else was[0], was[1])
    assert {r["k"]: (r["v"], r["w"]) for r in got.collect()} == want


def test_resolve_left_keeps_rows_without_key(spark):
    data = skewed()
    facts = spark.createDataFrame([(k, i) for k, i, _ in data], "k int, i int")
    dim = spark.createDataFrame([(k, k * 10) for k in range(0, 40, 2)], "k int, id int")
    got = {r["i"]: r["id"] for r in resolve.resolve_left(facts, dim, ["k"], "id").collect()}
    assert got == {i: (k * 10 if k is not None and k % 2 == 0 else None) for k, i, _ in data}


def test_cross_shop_matches_are_linear_and_complete(spark):
    r = random.Random(3)
    listings = [
        (i, r.randrange(4), "0" if i % 3 == 0 else (None if i % 5 == 0 else f"g{r.randrange(200)}"), f"n{r.randrange(60)}") for i in range(900)]
    df = spark.createDataFrame(listings, "listing_key int, competitor_id int, gtin string, canonical_name string")
    got = {row["listing_key"]: row["match_method"] for row in matching.cross_shop(df).collect()}
    shops = defaultdict(set)
    for _, c, g, _ in listings:
        if g:
            shops[g].add(c)
    want = {i: "gtin" for i, _, g, _ in listings if g and len(shops[g]) > 1}
    names = defaultdict(set)
    for i, c, _, n in listings:
        if i not in want:
            names[n].add(c)
    want |= {i: "canonical_name" for i, _, _, n in listings if i not in want and len(names[n]) > 1}
    assert got == want
    assert matching.cross_shop(df).count() == len(want)


def test_medians_are_exact(spark):
    r = random.Random(5)
    prices = [("hot" if i % 3 else r.choice("abc"), r.choice([r.randrange(100), r.randrange(9_999_999)])) for i in range(3000)]
    prices += [("single", 5), ("pair", 10_000), ("pair", 30_001)]
    counts = spark.createDataFrame(prices, "grp string, cents bigint").groupBy("grp", "cents").agg(F.count("*").alias("n"))
    by_group = defaultdict(list)
    for g, c in prices:
        by_group[g].append(c)
    assert {r["grp"]: r["median_cents"] for r in compare.medians(counts).collect()} == {g: float(median(v)) for g, v in by_group.items()}


def test_reach_is_breadth_first(spark):
    r = random.Random(7)
    edges = {(f"u{r.randrange(300)}", f"u{r.randrange(300)}") for _ in range(500)} | {("hub", f"u{i}") for i in range(0, 300, 2)}
    got = dict(links.reach(
        spark.createDataFrame(list(edges), "from_url string, to_url string"), spark.createDataFrame([("u1",), ("hub",)], "url string"), 4).collect())
    want, frontier = {"u1": 0, "hub": 0}, {"u1", "hub"}
    for depth in range(1, 5):
        frontier = {t for f, t in edges if f in frontier} - set(want)
        want |= dict.fromkeys(frontier, depth)
    assert got == want


def test_integrity_checks(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(2,), (2,), (None,), (None,)], "p int")
    assert rows(integrity.orphans(child, "k", parent, "p")) == [(1, 2)]
    assert rows(integrity.duplicate_keys(parent, "p")) == [(2, 2)]
    timed = integrity.with_default_time(child, "scraped_at", "2024-01-01 00:00:00")
    assert timed.filter("scraped_at is null").count() == 0


def test_coerce_turns_misfits_into_null(spark):
    df = spark.createDataFrame([("12.345", "abc", "99999999999")], "current_price string, base_price string, discount_amount string")
    r = schema.coerce(df, "pricesnapshot").first()
    assert (str(r["current_price"]), r["base_price"], r["discount_amount"], r["currency"]) == ("12.35", None, None, None)


def test_create_missing_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shelf_test")
    made = schema.create_missing(spark, "shelf_test")
    assert len(made) == len(schema.TABLES) and schema.create_missing(spark, "shelf_test") == []
    spark.sql("DROP DATABASE shelf_test CASCADE")


FEED = T.StructType().add("type", "string").add("n", "long")


def test_feed_policies(spark, tmp_path):
    path = tmp_path / "f.jsonl"
    path.write_text('{"type":"a","n":1}\n\n{"type":"a",\n{"type":"b","n":2}\n')
    feed = feeds.read_feed(spark, str(path), FEED)
    assert rows(feeds.good(feed)) == [("a", 1), ("b", 2)]
    assert [r["_bad_line"] for r in feeds.quarantined(feed).collect()] == ['{"type":"a",']
    assert feeds.quarantined(feed).count() == 1
    assert feeds.read_feed(spark, str(path), FEED, bad_lines="drop").count() == 2
    with pytest.raises(Exception):
        feeds.read_feed(spark, str(path), FEED, bad_lines="fail").collect()
    assert feeds.read_feed(spark, str(tmp_path / "none"), FEED, missing="empty").count() == 0
    with pytest.raises(Exception):
        feeds.read_feed(spark, str(tmp_path / "none"), FEED)


def test_pretty_array_feed(spark, tmp_path):
    path = tmp_path / "f.json"
    path.write_text('[\n {"type": "a",\n  "n": 1}, {"type": "b", "n": 2}]')
    assert rows(feeds.read_array(spark, str(path), FEED)) == [("a", 1), ("b", 2)]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    def batch(*keys):
        return spark.createDataFrame([(k, 1) for k in keys], "k int, pos int")

    path = str(tmp_path / "dim")
    for batch_id, df in [(0, batch(1, 2)), (1, batch(2, 3, 3)), (1, batch(2, 3, 3)), (0, batch(1, 2))]:
        incremental.load_new_keys(df, batch_id, path, "k", ["pos"])
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]
