"""Records are read by methods that the JVM compiles."""

from shelfwise.sources import feeds

NAME = "spark.sql.codegen.hugeMethodLimit"


def test_reading_records_keeps_generated_methods_small(spark, tmp_path):
    (tmp_path / "feed").write_text('{"type":"item","current_price":null},\n{"type":"item","brok\n')
    spark.conf.unset(NAME)
    read = feeds.read_records(spark, str(tmp_path / "feed"))
    assert int(spark.conf.get(NAME)) <= 8000
    rows = read.select("type", feeds.stated("current_price").alias("stated"), feeds.BAD_LINE).collect()
    assert sorted(map(str, map(tuple, rows))) == ["('item', True, None)", "(None, False, '{\"type\":\"item\",\"brok')"]
    spark.conf.unset(NAME)
