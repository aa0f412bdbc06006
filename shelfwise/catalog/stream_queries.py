"""Streaming queries: run files loaded batch by batch end in the state of one batch load."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.catalog.registry import query
from shelfwise.session import scratch_path, table
from shelfwise.streaming import incremental
from shelfwise.streaming.firsts import FirstRecords

FEED = (
    T.StructType().add("user_id", "long").add("shop", "long").add("event_id", "long").add("cents", "long"))


def _events(spark, d):
    """The events as a feed; every user comes back in many runs."""
    return table(spark, d, "events").select(
        F.when(F.col("event_id") % 20 != 0, F.col("user_id")).alias("user_id"), (F.col("user_id") % 10).alias("shop"), "event_id",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"))


_SQL = """
    WITH e AS (SELECT user_id, user_id % 10 AS shop, event_id, CAST(round(value * 100) AS BIGINT) AS cents FROM events WHERE event_id % 20 <> 0)
"""


@query("incremental_load", f"""{_SQL}
    SELECT 'user' AS target, user_id AS k, min(shop) AS v FROM e GROUP BY user_id
    UNION ALL SELECT 'fact', event_id, cents FROM e""")
def incremental_load(spark, d):
    """Two calls on a growing feed: the second finds the state of the first and adds only new rows."""
    feed, target, checkpoint = (scratch_path(spark, n) for n in ("runs", "loaded", "progress"))
    for half in (0, 1):
        _events(spark, d).filter(F.col("event_id") % 2 == half).write.mode("append").json(feed)
        users, facts = incremental.load_feed(
            spark, feed, FEED, "user_id", ["shop"], ["event_id", "cents"], target, checkpoint)
    return users.select(F.lit("user").alias("target"), F.col("user_id").alias("k"), F.col("shop").alias("v")).unionByName(
        facts.select(F.lit("fact").alias("target"), F.col("event_id").alias("k"), F.col("cents").alias("v")))


@query("stream_first_seen", f"""{_SQL} SELECT DISTINCT user_id FROM e UNION ALL SELECT NULL""")
def stream_first_seen(spark, d):
    feed = scratch_path(spark, "runs")
    _events(spark, d).write.json(feed)
    return incremental.first_seen(spark, feed, FEED, "user_id")


@query("stream_first_records", f"""{_SQL}
    SELECT user_id, shop, event_id, cents FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id % 2, event_id) AS rn FROM e) WHERE rn = 1""")
def stream_first_records(spark, d):
    """The first record of each user in feed order: files of the first run, then those of the second."""
    feed, root = scratch_path(spark, "runs"), scratch_path(spark, "firsts")
    for half in (0, 1):
        _events(spark, d).filter(F.col("event_id") % 2 == half).write.mode("append").json(feed)
        firsts = FirstRecords(spark, feed, FEED, "user_id", ["event_id"], root).advance()
    return firsts.read()
