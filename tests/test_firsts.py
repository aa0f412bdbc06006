"""First record per key of a growing feed against a plain loop, with broken runs in between."""

import random

import pytest
from pyspark.sql import types as T

from shelfwise.streaming.firsts import FirstRecords

FEED = T.StructType().add("k", "long").add("pos", "long").add("v", "string")


def file_rows(number, n=400, keys=30):
    """A third under one key, some without; places shuffled, one of them null."""
    r = random.Random(number)
    rows = [(None if i % 11 == 0 else -1 if i % 3 == 0 else number * 10 + r.randrange(keys), i or None, f"{number}:{i}") for i in range(n)]
    r.shuffle(rows)
    return rows


def arrive(spark, path, number):
    spark.createDataFrame(file_rows(number), FEED).coalesce(1).write.mode("append").json(path)


def wanted(files):
    found = {}
    for number in files:
        for k, pos, v in sorted(file_rows(number), key=lambda r: (r[1] is not None, r[1] or 0)):
            if k is not None:
                found.setdefault(k, (pos, v))
    return found


def stored(firsts):
    rows = firsts.read().collect()
    assert len(rows) == len({r["k"] for r in rows})
    return {r["k"]: (r["pos"], r["v"]) for r in rows}


def made(spark, tmp_path, **options):
    return FirstRecords(spark, str(tmp_path / "feed"), FEED, "k", ["pos"], str(tmp_path / "kept"), buckets=2, hold_ms=1, **options)


def test_first_in_feed_order_and_state_for_new_keys_only(spark, tmp_path):
    sizes = []
    for number in range(4):
        arrive(spark, str(tmp_path / "feed"), number)
        firsts = made(spark, tmp_path).advance()
        assert stored(firsts) == wanted(range(number + 1))
        sizes.append(firsts.state_rows[-1])
    assert sizes[0] > 0 and max(sizes) <= sizes[0]
    versions = len(firsts.table.versions())
    assert stored(made(spark, tmp_path).advance()) == wanted(range(4))  # nothing new
    assert len(firsts.table.versions()) == versions


@pytest.mark.parametrize("when", ["before", "after"])
def test_run_that_breaks_off(spark, tmp_path, when):
    """The second batch fails before or after it has written its records; the next run makes up for it."""
    for number in range(3):
        arrive(spark, str(tmp_path / "feed"), number)

    class Broken(FirstRecords):
        def emit(self, batch, run, number):
            if number == 1 and when == "before":
                raise RuntimeError("lost")
            super().emit(batch, run, number)
            if number == 1:
                raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        Broken(spark, str(tmp_path / "feed"), FEED, "k", ["pos"], str(tmp_path / "kept"), buckets=2, files_per_batch=1).advance()
    assert stored(made(spark, tmp_path, files_per_batch=1).advance()) == wanted(range(3))
