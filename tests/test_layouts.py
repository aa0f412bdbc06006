"""JSON feeds in every layout, cut into ranges of a few bytes."""

import json

import pytest

from shelfwise.sources import feeds, layouts

FEED = feeds.T.StructType().add("type", "string").add("n", "long").add("props", feeds.T.MapType(feeds.T.StringType(), feeds.T.StringType()))
RECORDS = [
    {"type": t, "n": i, "props": {"a": "x } { y", "b": 'quote " and \\" and \\', "c": "line\nend ]["} if i % 2 else {}}
    for i, t in enumerate(["view", "b{uy", "}", "{", "ä\"", "", "back\\", "[", "]", ","] * 3)]


def rows(df):
    return sorted((r.type, r.n, r.props) for r in df.collect())


def written(layout, records):
    if layout == "lines":
        return "\n".join(map(json.dumps, records)) + "\n"
    if layout == "lines without an end":
        return "\n".join(map(json.dumps, records))
    if layout == "array of lines":
        return "[\n" + ",\n".join(map(json.dumps, records)) + "\n]\n"
    if layout == "one line":
        return json.dumps(records)
    return json.dumps(records, indent=2 if layout == "pretty" else 0)


LAYOUTS = ["lines", "lines without an end", "array of lines", "one line", "pretty", "flat"]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts(spark, tmp_path, layout):
    (tmp_path / "a.json").write_text(written(layout, RECORDS))
    (tmp_path / "b.json").write_text(written(layout, RECORDS[:3]))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
        feed = feeds.read_feed(spark, str(tmp_path), FEED, layout="any")
        good, bad = rows(feeds.good(feed)), feeds.quarantined(feed).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert good == sorted((r["type"], r["n"], r["props"]) for r in RECORDS + RECORDS[:3])
    assert bad == []


@pytest.mark.parametrize(("layout", "broken"), [
    ("lines", '{"type": "cut'), ("array of lines", '{"type": "x", "n": '), ("pretty", '{"type": "x", "props": {"a": {'), ("lines", '{"type" "x"}')])
def test_broken_records_stay_alone(spark, tmp_path, layout, broken):
    marker = {"type": "BROKEN", "n": 0, "props": {}}
    text = written(layout, RECORDS[:4] + [marker] + RECORDS[4:])
    indent = 2 if layout == "pretty" else None
    old = json.dumps([marker], indent=2)[4:-2] if layout == "pretty" else json.dumps(marker)
    assert old in text and (indent is None or text.count(old) == 1)
    (tmp_path / "a.json").write_text(text.replace(old, broken))
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
        feed = feeds.read_feed(spark, str(tmp_path), FEED, layout="any")
        good, bad = rows(feeds.good(feed)), [r[feeds.BAD_LINE] for r in feeds.quarantined(feed).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert good == sorted((r["type"], r["n"], r["props"]) for r in RECORDS)
    assert bad == [broken.strip()]


def test_empty_and_odd_files(spark, tmp_path):
    for name, text in {"a": "", "b": "[]", "c": "[\n]\n", "d": "  \n\n", "e": "}", "f": '{"type": "only", "n": 1'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    got = [r.text for r in layouts.objects(spark, str(tmp_path)).collect()]
    assert sorted(got) == ['{"type": "only", "n": 1', "}"]


def test_records_keep_which_keys_were_there(spark, tmp_path):
    lines = ['[', '{"type":"item","current_price":null,"brand":"x"},', '{"type":"item","current_price":"no number"}', '{"type":"item"}', '', '{"type":', '7', ']']
    (tmp_path / "f.json").write_text("\n".join(lines))
    rows = feeds.read_records(spark, str(tmp_path / "f.json")).select(
        "brand", "current_price", feeds.stated("current_price", "currency").alias("s"), "_bad_line")
    assert sorted(map(str, (tuple(r) for r in rows.collect()))) == sorted(map(str, [
        ("x", None, True, None), (None, None, True, None), (None, None, False, None), (None, None, False, '{"type":'), (None, None, False, "7")]))


def test_a_feed_of_several_files(spark, tmp_path, monkeypatch):
    """Files hold a bounded number of records, each an array of its own, so no task writes a whole feed."""
    from shelfwise.catalog import feed_queries

    rows_ = [(i, i % 7, ["view", "buy"][i % 2], '{"k": %d}' % i) for i in range(200)]
    spark.createDataFrame(rows_, "event_id LONG, user_id LONG, event_type STRING, props STRING").write.parquet(str(tmp_path / "events.parquet"))
    written_ = iter(range(4))
    monkeypatch.setattr(feed_queries, "RECORDS_A_FILE", 60)
    monkeypatch.setattr(feed_queries, "scratch_path", lambda spark, name: str(tmp_path / f"{name}-{next(written_)}"))
    got = {(r.layout, r.type): (r.n, r.ids, r.props_length) for r in feed_queries.feed_array_layouts(spark, str(tmp_path)).collect()}
    good = [r for r in rows_ if r[0] % 50 != 7]
    for layout in ("one line", "array of lines", "pretty", "lines"):
        for type_ in ("view", "buy"):
            mine = [r for r in good if r[2] == type_]
            assert got.pop((layout, type_)) == (len(mine), sum(r[0] for r in mine), sum(len(r[3]) for r in mine))
    assert got == {(layout, "bad"): (4, None, None) for layout in ("array of lines", "pretty", "lines")}
    files = [[p.read_text() for p in (tmp_path / f"layout-{i}").rglob("part-*.txt")] for i in range(4)]
    assert list(map(len, files)) == [4, 4, 4, 4]
    assert [r["event_id"] for t in sorted(files[0], key=lambda t: json.loads(t)[0]["event_id"]) for r in json.loads(t)] == [r[0] for r in good]


def test_only_the_edges_of_ranges_are_joined(tmp_path):
    """Whole records leave the task that reads their range; what is cut by ranges has a place to be joined by."""
    def batch(texts, block, **more):
        n = len(texts)
        return layouts.pa.RecordBatch.from_pydict({"value": texts, "file": ["f"] * n, "block": [block] * n} | {k: [v] * n for k, v in more.items()})

    known = {"least": None, "odd": 0, "open": 0, "unfinished": False}
    got = [r for b in layouts._records([batch(['[{"a":"}', '\\\\"}', ',{"a":{}'], 0, **known), batch(["}", ',{"b":{}'], 0, **known)]) for r in b.to_pylist()]
    assert [(r["block"], r["part"], r["text"]) for r in got] == [(0, 0, '\n[{"a":"}\\\\"}'), (None, None, ',{"a":{}}'), (0, 1, ',{"b":{}')]
    report = [r for b in layouts._reports([batch(['[{"a":"}', '\\\\"}', ',{"b":{}'], 0, length=9, size=9, least=None)]) for r in b.to_pylist()]
    assert [(r["odd0"], r["moves0"], r["anew"], r["bytes"]) for r in report] == [(0, 1, False, 20)]
