"""Key to id resolution and defaults.

No join carries a broadcast hint except onto relations whose size is fixed (one row of
defaults, the constant competitors). For the others Spark picks broadcast from measured
sizes below its threshold and otherwise a sort-merge join with adaptive skew splitting.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve_inner(facts: DataFrame, dim: DataFrame, key: Sequence[str], id_column: str) -> DataFrame:
    """Add the id; rows whose key the dimension lacks are dropped."""
    return facts.join(dim.select(*key, id_column), list(key), "inner")


# Parts that rows without a key are spread over in an outer join.
NULL_SPREAD = 1024


def resolve_left(facts: DataFrame, dim: DataFrame, key: Sequence[str], id_column: str) -> DataFrame:
    """Add the id, NULL when unknown; an id the row already has is kept.

    Rows without a key match nothing but must stay. A second join column spreads them, as
    otherwise all of them would go to the one partition of the NULL key.
    """
    no_key = reduce(or_, [F.col(k).isNull() for k in key])
    spread = F.when(no_key, F.pmod(F.xxhash64(*facts.columns), F.lit(NULL_SPREAD))).otherwise(F.lit(0))
    looked_up = dim.select(*key, F.col(id_column).alias("_found"), F.lit(0).cast("bigint").alias("_spread"))
    joined = facts.withColumn("_spread", spread.cast("bigint")).join(looked_up, [*key, "_spread"], "left")
    if id_column in facts.columns:
        joined = joined.withColumn(id_column, F.coalesce(F.col(id_column), F.col("_found")))
    else:
        joined = joined.withColumn(id_column, F.col("_found"))
    return joined.drop("_found", "_spread")


def resolve_parent(categories: DataFrame) -> DataFrame:
    """category_key, parent_key -> parent_category_id, NULL for roots and unknown parents."""
    parents = categories.select(F.col("category_key").alias("parent_key"), F.col("category_id").alias("parent_category_id"))
    return resolve_left(categories, parents, ["parent_key"], "parent_category_id")


def with_defaults(rows: DataFrame, defaults: DataFrame, columns: list[str]) -> DataFrame:
    """Values found once for the whole site, used where a row has none of its own.

    `defaults` must be an aggregate without grouping, so it has exactly one row.
    """
    one = defaults.select(*[F.col(c).alias(f"_default_{c}") for c in columns])
    joined = rows.join(F.broadcast(one))
    out = [
        F.coalesce(F.col(c), F.col(f"_default_{c}")).alias(c) if c in columns else F.col(c)
        for c in rows.columns
    ]
    return joined.select(*out, *[F.col(f"_default_{c}").alias(c) for c in columns if c not in rows.columns])
