"""Checks that stand in for constraints: unique, foreign, not-null, fitting types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.sources.schema import FOREIGN_KEYS, UNIQUE_KEYS, table_schema


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once; NULL may repeat."""
    return (
        df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).filter("n > 1"))


def orphans(child: DataFrame, child_column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose reference points nowhere; an empty reference is allowed.

    Only distinct references are joined, so a reference shared by many rows is one row.
    """
    refs = child.filter(F.col(child_column).isNotNull()).groupBy(child_column).agg(
        F.count("*").alias("n_rows"))
    known = parent.select(F.col(parent_column).alias(child_column))
    return refs.join(known, child_column, "left_anti")


def missing_required(df: DataFrame, table: str) -> DataFrame:
    """One row per NOT NULL column of the table with the number of rows that break it."""
    required = [f.name for f in table_schema(table) if not f.nullable and f.name in df.columns]
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], required, "column_name", "n_missing")


def with_default_time(df: DataFrame, column: str, run_time: str) -> DataFrame:
    """The time of the run where the record names none."""
    t = F.lit(run_time).cast("timestamp")
    if column not in df.columns:
        return df.withColumn(column, t)
    return df.withColumn(column, F.coalesce(F.col(column).cast("timestamp"), t))


def observed(df: DataFrame, table: str, defaulted: str | None = None) -> tuple[DataFrame, Observation]:
    """`df`, and what is counted while it is written: `rows`, and for each NOT NULL column how many rows lack it.

    `defaulted`: a column of the record from before `with_default_time`; `defaulted_rows` counts where it was null.
    No pass of its own: the counts are those of the action that writes the rows. Ask the observation after it.
    """
    required = [f.name for f in table_schema(table) if not f.nullable and f.name in df.columns]
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in required]]
    if defaulted:
        counts.append(F.count_if(F.col(defaulted).isNull()).alias("defaulted_rows"))
    seen = Observation()
    return df.observe(seen, *counts), seen


def report(tables: dict[str, DataFrame]) -> DataFrame:
    """Every unique and foreign key of the model with its number of violations, in one keyed pass.

    Each table gives, from one scan, a row for each key it owns or refers to: which key column, the value, and
    whether as owner or by which reference. Summed per value, in the map tasks first, a value says
    for itself whether it is owned twice, or referred to and not owned. An empty key violates nothing.
    Values are compared as whole numbers where all key columns are, else as texts.
    """
    unique = [(name, key) for name, key in UNIQUE_KEYS.items() if name in tables]
    foreign = [f for f in FOREIGN_KEYS if f[0] in tables and f[2] in tables]
    owned = list(dict.fromkeys(unique + [(parent, column) for _, _, parent, column in foreign]))
    used = {}
    for name in tables:
        uses = [(owned.index((name, c)), -1, c) for n, c in owned if n == name]
        uses += [(owned.index((parent, column)), i, c) for i, (child, c, parent, column) in enumerate(foreign) if child == name]
        if uses:
            used[name] = uses
    whole = all(isinstance(tables[name].schema[c].dataType, T.IntegralType) for name, uses in used.items() for _, _, c in uses)
    parts = []
    for name, uses in used.items():
        rows = [[F.lit(at).alias("owned"), F.lit(kind).alias("kind"), F.col(c).cast("long" if whole else "string").alias("value")] for at, kind, c in uses]
        if len(rows) == 1:
            parts.append(tables[name].select(*rows[0]))
        else:
            parts.append(tables[name].select(F.explode(F.array(*[F.struct(*r) for r in rows])).alias("u")).select("u.*"))
    values = reduce(DataFrame.unionByName, parts).where("value is not null").groupBy("owned", "value").agg(
        F.count_if(F.col("kind") == -1).alias("owners"), *[F.count_if(F.col("kind") == i).alias(f"n{i}") for i in range(len(foreign))])
    found = [F.count_if((F.col("owned") == owned.index((name, key))) & (F.col("owners") > 1)).alias(f"unique {name}.{key}") for name, key in unique]
    found += [
        F.coalesce(F.sum(F.when(F.col("owners") == 0, F.col(f"n{i}"))), F.lit(0)).alias(f"foreign {child}.{column}")
        for i, (child, column, _, _) in enumerate(foreign)]
    sums = values.agg(*found)
    return sums.unpivot([], [F.col(f"`{c}`") for c in sums.columns], "constraint_name", "n_violations")
