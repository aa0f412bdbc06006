"""Keyed loading: first or last row per key, insert-ignore, replace, null-preserving upsert.

The per-key choice is an aggregate over (order, row) structs, so a key that holds a large
part of all rows is reduced before the shuffle and never gathered in one window or task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool) -> DataFrame:
    """Least or greatest (order, row) struct per key; the order columns decide first."""
    place = [o for o in order if o not in keys]
    rest = [c for c in df.columns if c not in keys and c not in place]
    pick = F.max if last else F.min
    chosen = df.groupBy(*keys).agg(pick(F.struct(*place, *rest)).alias("_row"))
    return chosen.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in feed order. `order` must be unique within a key."""
    return _one_per_key(df, keys, order, last=False)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _one_per_key(df, keys, order, last=True)


def insert_ignore(
    target: DataFrame,
    new: DataFrame,
    key: str,
    order: Sequence[str],
    required: Sequence[str] = (),
) -> DataFrame:
    """Rows to append: first per key, keys the target lacks, required columns present.

    Rows without a key are all kept, since a unique index allows any number of them.
    """
    valid = new
    for c in required:
        valid = valid.filter(F.col(c).isNotNull())
    keyed = first_per_key(valid.filter(F.col(key).isNotNull()), [key], order)
    fresh = keyed.join(target.select(key), key, "left_anti")
    return fresh.select(*new.columns).unionByName(valid.filter(F.col(key).isNull()))


def loaded_ignore(target: DataFrame, new: DataFrame, key: str, order, required=()) -> DataFrame:
    added = insert_ignore(target, new, key, order, required)
    return target.unionByName(added.select(*[c for c in target.columns if c in added.columns]),
                              allowMissingColumns=True)


def replace_rows(target: DataFrame, new: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Insert or replace by key; the last new row of a key wins."""
    latest = last_per_key(new, [key], order)
    kept = target.join(latest.select(key), key, "left_anti").select(*target.columns)
    return kept.unionByName(latest.select(*target.columns))


def upsert_coalesce(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert new keys; on known keys a NULL in the new row keeps the old value.

    `new` holds one row per key.
    """
    rest = [c for c in target.columns if c not in keys]
    t = target.select(*keys, F.struct(*rest).alias("_old"))
    n = new.select(*keys, F.struct(*rest).alias("_new"))
    return t.join(n, list(keys), "full_outer").select(
        *keys, *[F.coalesce(F.col(f"_new.{c}"), F.col(f"_old.{c}")).alias(c) for c in rest])


def last_known_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Fold of many upserts of one feed: per column the last value that is not NULL."""
    rest = [c for c in df.columns if c not in keys]
    place = F.struct(*order)
    return df.groupBy(*keys).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), place)).alias(c) for c in rest])
