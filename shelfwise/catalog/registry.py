"""Named queries, each with the SQL that states its result independently."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.session import tune

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def add(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def load_all() -> None:
    from shelfwise.catalog import (  # noqa: F401
        compare_queries, extract_queries, feed_queries, jsonld_queries, link_queries, load_queries,
        page_queries, price_queries, site_queries, stream_queries, support_queries, text_queries, url_queries)
