"""Documents dealt into consecutive ranges of their ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bounds(docs: DataFrame, key: str, parts: int) -> list[int]:
    """At most parts - 1 ascending values that cut the ids into ranges of about equal numbers."""
    shares = [i / parts for i in range(1, parts)]
    if not shares:
        return []
    found = docs.agg(F.percentile_approx(key, shares, max(10_000, 10 * parts))).first()[0]
    return sorted(set(found or []))


def range_of(key: str, cuts: list[int]) -> Column:
    """0 for null and ids up to the first cut, and so on."""
    if not cuts:
        return F.lit(0)
    tree = _tree(F.col(key), cuts, 0, len(cuts))
    return F.when(F.col(key).isNull(), F.lit(0)).otherwise(tree)


def _tree(key: Column, cuts: list[int], low: int, high: int) -> Column:
    """Binary search as nested conditions: `low` cuts are below the key, those from `high` are not."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(key > F.lit(cuts[middle]), _tree(key, cuts, middle + 1, high)).otherwise(_tree(key, cuts, low, middle))


def parts_for(docs: DataFrame) -> int:
    """As many ranges as the session shuffles into, or the scan has parts, if those are more."""
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
