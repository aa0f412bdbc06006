from pyspark.sql import functions as F

from shelfwise.operators import integrity, numbering
from shelfwise.plans import normalise


def test_dense_ids(spark):
    rows = spark.range(1000).select((F.col("id") % 7).alias("g"), F.when(F.col("id") > 0, F.col("id")).alias("id")).repartition(5)
    got = numbering.dense_ids(rows, ["g", "id"], "n").orderBy("n").collect()
    want = sorted(((i % 7, i or None) for i in range(1000)), key=lambda r: (r[0], r[1] is not None, r[1]))
    assert [(r.g, r.id, r.n) for r in got] == [(*w, n) for n, w in enumerate(want, 1)]
    assert numbering.dense_ids(rows.where("g > 9"), ["g", "id"], "n").collect() == []


def test_report_counts_all_violations(spark):
    listing = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (2, None)], "listing_key long, listing_id long")
    prices = spark.createDataFrame([(1,), (1,), (9,), (9,), (None,), (8,)], "listing_id long")
    got = dict(map(tuple, integrity.report({"productlisting": listing, "pricesnapshot": prices, "review": prices.limit(0)}).collect()))
    assert got == {"unique productlisting.listing_key": 1, "foreign pricesnapshot.listing_id": 3, "foreign review.listing_id": 0}


def test_observed_counts_come_with_the_write(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (None, None), (3, "2024-01-01")], "price_snapshot_id long, fed string")
    df, seen = integrity.observed(integrity.with_default_time(rows.withColumn("scraped_at", F.col("fed")), "scraped_at", "2030-01-01"), "pricesnapshot", "fed")
    df.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"rows": 3, "missing_price_snapshot_id": 1, "missing_scraped_at": 0, "defaulted_rows": 2}


def test_whole_keys_are_compared_as_numbers_and_others_as_texts(spark):
    listing = spark.createDataFrame([(1,), (2,), (2,), (None,)], "listing_key LONG").withColumn("listing_id", F.col("listing_key"))
    prices = spark.createDataFrame([(1,), (3,), (3,), (None,)], "listing_id INT")
    want = {"unique productlisting.listing_key": 1, "foreign pricesnapshot.listing_id": 2}
    for kind in ("int", "string"):
        found = integrity.report({"productlisting": listing, "pricesnapshot": prices.select(F.col("listing_id").cast(kind))})
        assert dict(map(tuple, found.collect())) == want
        assert ("as string" in found._jdf.queryExecution().toString()) == (kind == "string")


def test_matches_of_stored_listings(spark):
    stored = spark.createDataFrame([(5, "u"), (6, "v")], "listing_key LONG, product_url STRING")
    got = sorted((r.product_id, r.listing_id, r.match_method, float(r.match_score)) for r in normalise.matches(stored).collect())
    assert got == [(5, 5, "auto", 1.0), (6, 6, "auto", 1.0)]
