"""Loading queries: keyed loads, resolution, integrity, normalisation of wide records."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise import lexicon
from shelfwise.catalog.registry import query
from shelfwise.functions import keys
from shelfwise.operators import integrity, loading, numbering, resolve
from shelfwise.plans import normalise, reskin, typed_feed
from shelfwise.session import materialise, scratch_path, table
from shelfwise.sources import feeds, schema, stored

_KEY = "('0x' || substr(md5({x}), 1, 12))::BIGINT"
_URL = "'https://shop' || l_suppkey || '.example.com/p/' || l_partkey"


def _copies(spark, d):
    """New part rows: every part, and for every third one two altered copies later in the feed."""
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    n = F.col("p_partkey")
    times = F.when(n % 3 == 0, F.array(*[F.lit(i) for i in (0, 1, 2)])).otherwise(F.array(F.lit(0)))
    rows = p.withColumn("pos", F.explode(times))
    late = F.col("pos") > 0
    return rows.select(
        F.when((n % 10 != 9), n).alias("p_partkey"),
        F.when(late & (n % 2 == 0), F.lit(None)).when(late, F.concat("p_name", F.lit(" v"), "pos")).otherwise(F.col("p_name")).alias("p_name"),
        F.when((F.col("pos") == 2) & (n % 4 == 1), F.lit(None)).otherwise(F.col("p_brand")).alias("p_brand"),
        (F.col("p_size") + F.col("pos") * 100).alias("p_size"), "pos")


_COPIES_SQL = """
    WITH rows AS (SELECT p_partkey AS n, p_name, p_brand, p_size, unnest(CASE WHEN p_partkey % 3 = 0 THEN [0, 1, 2] ELSE [0] END) AS pos FROM part),
      new AS (SELECT CASE WHEN n % 10 <> 9 THEN n END AS p_partkey,
        CASE WHEN pos > 0 AND n % 2 = 0 THEN NULL WHEN pos > 0 THEN p_name || ' v' || pos ELSE p_name END AS p_name,
        CASE WHEN pos = 2 AND n % 4 = 1 THEN NULL ELSE p_brand END AS p_brand, p_size + pos * 100 AS p_size, pos FROM rows),
      target AS (SELECT p_partkey, 'old ' || p_name AS p_name, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_brand END AS p_brand, p_size
        FROM part WHERE p_partkey % 2 = 1)
"""


def _target(spark, d):
    n = F.col("p_partkey")
    return table(spark, d, "part").filter(n % 2 == 1).select(
        n, F.concat(F.lit("old "), "p_name").alias("p_name"),
        F.when(n % 5 != 0, F.col("p_brand")).alias("p_brand"), "p_size")


@query("load_insert_ignore", f"""{_COPIES_SQL},
      ok AS (SELECT * FROM new WHERE p_name IS NOT NULL),
      firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY pos) AS rn FROM ok WHERE p_partkey IS NOT NULL) WHERE rn = 1)
    SELECT p_partkey, p_name, p_brand, p_size FROM target
    UNION ALL SELECT p_partkey, p_name, p_brand, p_size FROM firsts WHERE p_partkey NOT IN (SELECT p_partkey FROM target)
    UNION ALL SELECT p_partkey, p_name, p_brand, p_size FROM ok WHERE p_partkey IS NULL""")
def load_insert_ignore(spark, d):
    return loading.loaded_ignore(
        _target(spark, d), _copies(spark, d), "p_partkey", ["pos"], required=["p_name"])


@query("load_insert_ignore_again", f"""{_COPIES_SQL},
      ok AS (SELECT * FROM new WHERE p_name IS NOT NULL AND p_partkey IS NOT NULL)
    SELECT count(*) AS n_first, 0::BIGINT AS n_again
    FROM (SELECT DISTINCT p_partkey FROM ok WHERE p_partkey NOT IN (SELECT p_partkey FROM target))""")
def load_insert_ignore_again(spark, d):
    """Loading the same feed a second time adds nothing."""
    target = _target(spark, d)
    new = _copies(spark, d).filter("p_partkey is not null")
    once = loading.insert_ignore(target, new, "p_partkey", ["pos"], ["p_name"])
    after = target.select("p_partkey").unionByName(once.select("p_partkey"))
    again = loading.insert_ignore(after, new, "p_partkey", ["pos"], ["p_name"])
    tagged = once.select(F.lit(1).alias("first")).unionByName(again.select(F.lit(0).alias("first")))
    return tagged.agg(F.count_if(F.col("first") == 1).alias("n_first"), F.count_if(F.col("first") == 0).alias("n_again"))


@query("load_replace", f"""{_COPIES_SQL},
      lasts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY pos DESC) AS rn FROM new WHERE p_partkey IS NOT NULL) WHERE rn = 1)
    SELECT p_partkey, p_name, p_brand, p_size FROM target WHERE p_partkey NOT IN (SELECT p_partkey FROM lasts)
    UNION ALL SELECT p_partkey, p_name, p_brand, p_size FROM lasts""")
def load_replace(spark, d):
    new = _copies(spark, d).filter("p_partkey is not null")
    return loading.replace_rows(_target(spark, d), new, "p_partkey", ["pos"])


@query("load_upsert_coalesce", f"""{_COPIES_SQL},
      folded AS (SELECT p_partkey, arg_max(p_name, pos) FILTER (p_name IS NOT NULL) AS p_name,
        arg_max(p_brand, pos) FILTER (p_brand IS NOT NULL) AS p_brand, arg_max(p_size, pos) AS p_size
        FROM new WHERE p_partkey IS NOT NULL GROUP BY 1)
    SELECT coalesce(f.p_partkey, t.p_partkey) AS p_partkey, coalesce(f.p_name, t.p_name) AS p_name,
      coalesce(f.p_brand, t.p_brand) AS p_brand, coalesce(f.p_size, t.p_size) AS p_size
    FROM target t FULL OUTER JOIN folded f ON t.p_partkey = f.p_partkey""")
def load_upsert_coalesce(spark, d):
    new = _copies(spark, d).filter("p_partkey is not null")
    folded = loading.last_known_per_key(new, ["p_partkey"], ["pos"]).select("p_partkey", "p_name", "p_brand", "p_size")
    return loading.upsert_coalesce(_target(spark, d), folded, ["p_partkey"])


@query("load_competitors", """
    SELECT CASE s_suppkey % 4 WHEN 0 THEN 4 ELSE s_suppkey % 4 END::INT AS competitor_id,
      CASE s_suppkey % 4 WHEN 0 THEN 'Thomann' WHEN 1 THEN 'Bax-shop' WHEN 2 THEN 'bol.com' ELSE 'MaxiAxi' END AS name,
      CASE s_suppkey % 4 WHEN 0 THEN 'DE' ELSE 'NL' END AS country, s_suppkey AS supplier
    FROM supplier""")
def load_competitors(spark, d):
    """The constant dimension loaded twice (seed, then ignore), joined to every supplier."""
    seed = schema.competitors(spark)
    loaded = loading.loaded_ignore(seed, seed.withColumn("pos", F.lit(1)), "competitor_id", ["pos"])
    s = table(spark, d, "supplier")
    k = F.col("s_suppkey") % len(lexicon.COMPETITORS)
    which = s.select(F.when(k == 0, 4).otherwise(k).cast("int").alias("competitor_id"), F.col("s_suppkey").alias("supplier"))
    return which.join(F.broadcast(loaded), "competitor_id").select("competitor_id", "name", "country", "supplier")


@query("resolve_inner", f"""
    SELECT l_orderkey AS run_no, l_linenumber AS line_no, l_suppkey::INT AS competitor_id, l_partkey AS product_no,
      {_KEY.format(x=_URL)} AS listing_id
    FROM lineitem WHERE l_partkey % 7 <> 0""")
def resolve_inner(spark, d):
    """Price rows whose listing is not in the dimension are dropped."""
    dim = reskin.listings(spark, d).filter(F.col("product_no") % 7 != 0).withColumnRenamed("listing_key", "listing_id")
    facts = reskin.snapshots(spark, d).select("run_no", "line_no", *reskin.LISTING)
    return resolve.resolve_inner(facts, dim, reskin.LISTING, "listing_id")


@query("resolve_left", f"""
    SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey,
      CASE WHEN l_orderkey % 9 = 0 THEN -1 WHEN l_partkey % 4 <> 0 THEN {_KEY.format(x="p_brand || '|' || p_type")} END AS category_id
    FROM lineitem JOIN part ON p_partkey = l_partkey""")
def resolve_left(spark, d):
    """Category ids: a given id is kept, else looked up, else NULL."""
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
        F.when(F.col("l_orderkey") % 9 == 0, F.lit(-1)).cast("bigint").alias("category_id"))
    dim = table(spark, d, "part").filter(F.col("p_partkey") % 4 != 0).select(
        F.col("p_partkey").alias("l_partkey"),
        keys.md5_key(F.concat_ws("|", "p_brand", "p_type")).alias("category_id"))
    return resolve.resolve_left(rows, dim, ["l_partkey"], "category_id")


@query("category_parent", f"""
    SELECT p_brand AS name, {_KEY.format(x="p_brand")} AS category_key, NULL::BIGINT AS parent_category_id FROM part GROUP BY p_brand
    UNION ALL
    SELECT p_type, {_KEY.format(x="p_brand || '|' || p_type")}, {_KEY.format(x="p_brand")} FROM part GROUP BY p_brand, p_type""")
def category_parent(spark, d):
    return resolve.resolve_parent(reskin.categories(spark, d)).select("name", "category_key", "parent_category_id")


@query("defaults_broadcast", """
    WITH g AS (SELECT min(s_acctbal) AS lo, max(s_nationkey) AS hi FROM supplier)
    SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, CASE WHEN l_tax > 0.04 THEN l_tax ELSE lo END AS threshold, hi AS days
    FROM lineitem, g""")
def defaults_broadcast(spark, d):
    defaults = table(spark, d, "supplier").agg(F.min("s_acctbal").alias("threshold"), F.max("s_nationkey").alias("days"))
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
        F.when(F.col("l_tax") > 0.04, F.col("l_tax")).alias("threshold"))
    return resolve.with_defaults(rows, defaults, ["threshold", "days"])


@query("unique_violations", """
    SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1 HAVING count(*) > 1""")
def unique_violations(spark, d):
    o = table(spark, d, "orders").select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"))
    return integrity.duplicate_keys(o, "k")


@query("fk_violations", """
    SELECT l_partkey, count(*) AS n_rows FROM lineitem
    WHERE l_linenumber <> 1 AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 25) GROUP BY 1""")
def fk_violations(spark, d):
    li = table(spark, d, "lineitem").select(F.when(F.col("l_linenumber") != 1, F.col("l_partkey")).alias("l_partkey"))
    return integrity.orphans(li, "l_partkey", table(spark, d, "part").filter("p_size > 25"), "p_partkey")


@query("not_null_violations", """
    SELECT 'product_id' AS column_name, 0::BIGINT AS n_missing
    UNION ALL SELECT 'canonical_name', count(*) FROM part WHERE p_partkey % 6 = 0""")
def not_null_violations(spark, d):
    p = table(spark, d, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 6 != 0, F.col("p_name")).alias("canonical_name"), F.col("p_brand").alias("brand"))
    return integrity.missing_required(p, "product")


@query("model_constraints", """
    SELECT c AS constraint_name, 0::BIGINT AS n_violations FROM (VALUES ('unique product.product_key'),
      ('unique productlisting.listing_key'), ('foreign pricesnapshot.listing_id'), ('foreign productmatch.product_id'),
      ('foreign productmatch.listing_id'), ('foreign review.listing_id')) t(c)""")
def model_constraints(spark, d):
    """Every constraint holds on the tables normalised from the wide records."""
    found = normalise.split(reskin.wide_records(spark, d))
    parts = {n: materialise(t, n) for n, t in found.items() if n != "productmatch"}
    # From the stored listings: they are not looked for again.
    parts["productmatch"] = materialise(normalise.matches(parts["productlisting"]), "productmatch")
    tables = {
        "product": parts["product"].withColumn("product_id", F.col("product_key")),
        "productlisting": parts["productlisting"].withColumn("listing_id", F.col("listing_key")).drop("competitor_id"),
        "pricesnapshot": parts["pricesnapshot"], "productmatch": parts["productmatch"], "review": parts["review"],
    }
    return integrity.report(tables)


@query("schema_align", """
    SELECT l_orderkey AS price_snapshot_id, l_partkey AS listing_id,
      CASE WHEN l_linenumber % 2 = 0 THEN CAST(round(l_extendedprice * 100) AS BIGINT)::DOUBLE / 100 END AS current_price,
      CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE CAST(round(l_discount * 100) AS BIGINT)::DOUBLE END AS discount_percent, NULL::VARCHAR AS currency, 'note' AS added
    FROM lineitem""")
def schema_align(spark, d):
    """Project to the table's columns and types; texts that are no number become NULL."""
    li = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("price_snapshot_id"), F.col("l_partkey").alias("listing_id"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("l_extendedprice").cast("string")).otherwise("n/a").alias("current_price"),
        F.when(F.col("l_linenumber") % 3 == 0, F.lit(123456.0)).otherwise(F.round(F.col("l_discount") * 100)).alias("discount_percent"),
        F.col("l_tax").alias("not_in_table"))
    wanted = ["price_snapshot_id", "listing_id", "current_price", "discount_percent", "currency"]
    coerced = schema.align(schema.coerce(li, "pricesnapshot"), wanted)
    extended = schema.add_column(schema.add_column(coerced, "added", "string"), "currency", "string")
    return extended.select(
        "price_snapshot_id", "listing_id", F.col("current_price").cast("double").alias("current_price"),
        F.col("discount_percent").cast("double").alias("discount_percent"), "currency",
        F.coalesce("added", F.lit("note")).alias("added"))


_WIDE_SQL = f"""
    WITH li AS (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS c, CAST(round(l_discount * 100) AS BIGINT) AS pct,
        {_URL} AS u, {_KEY.format(x=_URL)} AS k FROM lineitem)
"""


@query("wide_split_product", f"""{_WIDE_SQL}
    SELECT DISTINCT k AS product_key, trim(regexp_replace(lower(p_brand || ' ' || p_name || ' ' || p_type), '[^a-z0-9]+', ' ', 'g')) AS canonical_name,
      p_brand AS brand, p_type AS model FROM li JOIN part ON p_partkey = l_partkey""")
def wide_split_product(spark, d):
    return normalise.split(reskin.wide_records(spark, d))["product"]


@query("wide_split_listing", f"""{_WIDE_SQL}
    SELECT DISTINCT k AS listing_key, u AS product_url, p_name AS title_on_page, l_suppkey::INT AS competitor_id,
      CASE WHEN p_partkey % 3 <> 0 THEN lpad((8710000000000 + p_partkey)::VARCHAR, 13, '0') END AS gtin_ean_upc_on_page
    FROM li JOIN part ON p_partkey = l_partkey""")
def wide_split_listing(spark, d):
    return normalise.split(reskin.wide_records(spark, d))["productlisting"]


@query("wide_split_price", f"""{_WIDE_SQL}
    SELECT k AS listing_id, l_orderkey AS scrape_run_id, strftime(l_shipdate, '%Y-%m-%d') AS scraped_on, 'EUR' AS currency,
      ((c * (100 - pct) + 50) // 100)::DOUBLE / 100 AS current_price, c::DOUBLE / 100 AS base_price, pct::DOUBLE AS discount_percent,
      CASE WHEN l_returnflag = 'R' THEN 0 WHEN l_linestatus = 'F' THEN 1 END AS in_stock,
      {_KEY.format(x="k || '|' || l_orderkey || '|' || l_linenumber")} AS price_snapshot_id
    FROM li""")
def wide_split_price(spark, d):
    t = normalise.split(reskin.wide_records(spark, d, product_facts=False))["pricesnapshot"]
    return t.select(
        "listing_id", "scrape_run_id", F.date_format("scraped_at", "yyyy-MM-dd").alias("scraped_on"), "currency",
        *[F.col(c).cast("double").alias(c) for c in ("current_price", "base_price", "discount_percent")],
        F.col("in_stock").cast("int").alias("in_stock"), "price_snapshot_id")


@query("wide_split_review", f"""{_WIDE_SQL}
    SELECT k AS listing_id, (c % 41 + 10)::DOUBLE / 10 AS rating_value, 5 AS rating_scale, (l_orderkey % 50 + 1)::INT AS review_count,
      {_KEY.format(x="k || '|' || l_orderkey || '|' || l_linenumber")} AS review_id
    FROM li WHERE l_linenumber % 3 = 0""")
def wide_split_review(spark, d):
    return normalise.split(reskin.wide_records(spark, d, product_facts=False))["review"].select(
        "listing_id", F.col("rating_value").cast("double").alias("rating_value"), "rating_scale", "review_count", "review_id")


@query("wide_split_match", f"""{_WIDE_SQL}
    SELECT DISTINCT k AS product_id, k AS listing_id, 'auto' AS match_method, 1.0::DOUBLE AS match_score FROM li""")
def wide_split_match(spark, d):
    return normalise.split(reskin.wide_records(spark, d))["productmatch"].withColumn(
        "match_score", F.col("match_score").cast("double"))


def _typed_tables(spark, d):
    """The typed feed of one shop, split by type in one pass and loaded."""
    path = scratch_path(spark, "typed")
    feeds.route(reskin.typed_feed(spark, d), path)
    feed = spark.read.schema(reskin.typed_feed_schema()).parquet(path)
    return typed_feed.load(feed, 2, reskin.RUN_TIME)


@query("typed_load_products", """
    SELECT p_partkey AS product_key, p_name AS canonical_name, p_brand AS brand, p_type AS model FROM part WHERE p_partkey % 10 <> 0""")
def typed_load_products(spark, d):
    """Repeated products keep their first record; products without a name are not loaded."""
    return _typed_tables(spark, d)["product"].select("product_key", "canonical_name", "brand", "model")


@query("typed_load_listings", f"""
    SELECT DISTINCT {_KEY.format(x=_URL)} AS listing_id, 2 AS competitor_id, {_URL} AS product_url,
      CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE {_KEY.format(x="p_type")} END AS category_id
    FROM lineitem JOIN part ON p_partkey = l_partkey WHERE l_partkey % 7 <> 0""")
def typed_load_listings(spark, d):
    return _typed_tables(spark, d)["productlisting"].select("listing_id", "competitor_id", "product_url", "category_id")


@query("typed_load_prices", f"""
    SELECT {_KEY.format(x=_URL)} AS listing_id, l_orderkey AS scrape_run_id, epoch(l_shipdate)::BIGINT AS scraped_at,
      CAST(round(l_extendedprice * 100) AS BIGINT)::DOUBLE / 100 AS base_price
    FROM lineitem WHERE l_partkey % 7 <> 0 AND l_orderkey % 5 <> 0""")
def typed_load_prices(spark, d):
    """Price rows whose listing or run is not in the feed are dropped."""
    return _typed_tables(spark, d)["pricesnapshot"].select(
        "listing_id", "scrape_run_id", F.unix_seconds("scraped_at").alias("scraped_at"), F.col("base_price").cast("double").alias("base_price"))


@query("typed_load_counts", f"""
    WITH l AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_partkey % 7 <> 0)
    SELECT 'scraperun' AS table_name, count(*) AS n_rows FROM orders WHERE o_orderkey % 5 <> 0
    UNION ALL SELECT 'category', count(DISTINCT p_type) + count(DISTINCT CASE WHEN p_brand NOT LIKE '%3' THEN p_brand END) FROM part UNION ALL SELECT 'product', count(*) FROM part WHERE p_partkey % 10 <> 0
    UNION ALL SELECT 'productlisting', count(*) FROM l UNION ALL SELECT 'pricesnapshot', count(*) FROM lineitem WHERE l_partkey % 7 <> 0 AND l_orderkey % 5 <> 0
    UNION ALL SELECT 'review', count(*) FROM lineitem WHERE l_partkey % 7 <> 0 AND l_linenumber % 3 = 0
    UNION ALL SELECT 'pagelink', count(*) FROM lineitem WHERE l_orderkey % 5 <> 0 AND (l_linenumber <> 4 OR l_orderkey % 2 = 0)
    UNION ALL SELECT 'productmatch', count(*) FROM l WHERE l_partkey % 10 <> 0
    UNION ALL SELECT 'customer_service', count(*) FROM supplier UNION ALL SELECT 'expert_support', count(*) FROM supplier""")
def typed_load_counts(spark, d):
    from shelfwise.plans import compare

    return compare.table_counts(_typed_tables(spark, d))


@query("typed_load_categories", f"""
    WITH t AS (SELECT p_type AS name, arg_min(p_brand, p_partkey) AS parent FROM part GROUP BY 1)
    SELECT name, {_KEY.format(x="name")} AS category_id, 2 AS competitor_id, CASE WHEN parent NOT LIKE '%3' THEN {_KEY.format(x="parent")} END AS parent_category_id FROM t
    UNION ALL SELECT DISTINCT p_brand, {_KEY.format(x="p_brand")}, 2, NULL FROM part WHERE p_brand NOT LIKE '%3'""")
def typed_load_categories(spark, d):
    """Categories find their parent by key, wherever it stands in the feed; an unknown parent is NULL."""
    return _typed_tables(spark, d)["category"].select("name", "category_id", "competitor_id", "parent_category_id")


@query("typed_load_links", f"""
    SELECT {_URL} AS from_url, 'https://page/' || l_partkey AS to_url, l_orderkey AS scrape_run_id, epoch(l_shipdate)::BIGINT AS scraped_at
    FROM lineitem WHERE l_orderkey % 5 <> 0 AND (l_linenumber <> 4 OR l_orderkey % 2 = 0)""")
def typed_load_links(spark, d):
    """Page links with both ends, under either name, of runs that the feed has."""
    return _typed_tables(spark, d)["pagelink"].select(
        "from_url", "to_url", "scrape_run_id", F.unix_seconds("scraped_at").alias("scraped_at"))


@query("typed_load_service", f"""
    SELECT s_suppkey::INT AS cooling_off_days, CASE WHEN s_suppkey % 2 = 0 THEN 1 END AS free_returns,
      CASE WHEN s_suppkey % 3 <> 2 AND EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_partkey = s_suppkey AND l_partkey % 7 <> 0)
        THEN {_KEY.format(x="'https://shop' || s_suppkey || '.example.com/p/' || s_suppkey")} END AS listing_id
    FROM supplier""")
def typed_load_service(spark, d):
    """Service rows find their listing by key; rows without one, or with an unknown one, stay."""
    t = _typed_tables(spark, d)["customer_service"]
    return t.select("cooling_off_days", F.col("free_returns").cast("int").alias("free_returns"), "listing_id")


_STORED = T.StructType().add("order_id", "long").add("line", "long").add("status", "string").add("cents", "long")


@query("load_stored_twice", """
    WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders)
    SELECT k AS order_id, k % 4 = 1 AS replaced, CASE WHEN k % 4 = 1 THEN 'new ' || s ELSE s END AS status,
      CASE WHEN k % 5 = 0 THEN 1 WHEN k % 4 = 1 THEN c + 1 ELSE c END AS cents
    FROM o WHERE k % 3 <> 0 OR k % 4 = 1""")
def load_stored_twice(spark, d):
    """Insert-ignore, replace and upsert into a stored table, each feed loaded twice."""
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("long").alias("order_id"), F.lit(1).cast("long").alias("line"), F.col("o_orderstatus").alias("status"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    k = F.col("order_id")
    fed = o.where(k % 3 != 0)
    later = o.where(k % 4 == 1).withColumn("status", F.concat(F.lit("new "), "status")).withColumn("cents", F.col("cents") + 1)
    known = o.where((k % 5 == 0) & ((k % 3 != 0) | (k % 4 == 1))).select(
        "order_id", F.lit(None).cast("long").alias("line"), F.lit(None).cast("string").alias("status"), F.lit(1).cast("long").alias("cents"))
    kept = stored.KeyedTable(spark, scratch_path(spark, "stored"), _STORED, "order_id", int(spark.conf.get("spark.sql.shuffle.partitions")))
    for _ in range(2):
        kept.insert_ignore(fed.unionByName(fed.withColumn("line", F.lit(2).cast("long")).withColumn("status", F.lit("again"))), ["line"])
    for _ in range(2):
        kept.replace(later, ["line"])
    for _ in range(2):
        kept.upsert(known)
    return kept.read().select("order_id", (k % 4 == 1).alias("replaced"), "status", "cents")


@query("constraints_while_written", """
    SELECT count(*) AS n_rows, count(*) FILTER (l_orderkey % 7 = 0) AS missing_id, count(*) FILTER (l_partkey % 11 = 0) AS missing_listing,
      count(*) FILTER (l_linenumber % 2 = 0) AS defaulted_rows, count(*) FILTER (l_linenumber % 2 = 0) AS at_run_time FROM lineitem""")
def constraints_while_written(spark, d):
    """NOT NULL violations and default times, counted in the pass that writes the price rows."""
    n = F.col("l_orderkey")
    rows = table(spark, d, "lineitem").select(
        F.when(n % 7 != 0, n).alias("price_snapshot_id"), F.when(F.col("l_partkey") % 11 != 0, F.col("l_partkey")).alias("listing_id"),
        F.when(F.col("l_linenumber") % 2 != 0, F.col("l_shipdate").cast("timestamp")).alias("fed_at"))
    run_time = "2030-01-01 00:00:00"
    timed = integrity.with_default_time(rows.withColumn("scraped_at", F.col("fed_at")), "scraped_at", run_time)
    checked, seen = integrity.observed(timed, "pricesnapshot", "fed_at")
    written = materialise(checked, "pricesnapshot")
    counts = {"n_rows": "rows", "missing_id": "missing_price_snapshot_id", "missing_listing": "missing_listing_id", "defaulted_rows": "defaulted_rows"}
    said = {name: F.lit(seen.get[metric]).cast("long").alias(name) for name, metric in counts.items()}
    return written.agg(F.count_if(F.col("scraped_at") == F.lit(run_time).cast("timestamp")).alias("at_run_time")).select(*said.values(), "at_run_time")


@query("key_violations", """
    WITH l AS (SELECT CASE WHEN p_partkey % 10 = 0 THEN p_partkey - 1 ELSE p_partkey END AS k FROM part WHERE p_partkey % 13 <> 0),
    f AS (SELECT CASE WHEN l_orderkey % 9 <> 0 THEN l_partkey END AS k FROM lineitem)
    SELECT 'unique productlisting.listing_key' AS constraint_name, count(*) AS n_violations FROM (SELECT k FROM l GROUP BY k HAVING count(*) > 1)
    UNION ALL SELECT 'foreign pricesnapshot.listing_id', count(*) FROM f WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM l)""")
def key_violations(spark, d):
    """Repeated listing keys and prices of unknown listings, as the one pass over all keys reports them."""
    k = F.col("p_partkey").cast("long")
    listing = table(spark, d, "part").where(k % 13 != 0).select(F.when(k % 10 == 0, k - 1).otherwise(k).alias("listing_key"))
    prices = table(spark, d, "lineitem").select(F.when(F.col("l_orderkey") % 9 != 0, F.col("l_partkey").cast("long")).alias("listing_id"))
    return integrity.report({"productlisting": listing.withColumn("listing_id", F.col("listing_key")), "pricesnapshot": prices})


@query("dense_ids", """
    SELECT p_partkey, p_brand, row_number() OVER (ORDER BY p_brand, p_partkey) AS report_id FROM part""")
def dense_ids(spark, d):
    """Gapless numbers for a report, in order of brand and part."""
    return numbering.dense_ids(table(spark, d, "part").select("p_partkey", "p_brand"), ["p_brand", "p_partkey"], "report_id")
