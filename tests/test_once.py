"""What a page extraction reads several times is computed once."""

from pyspark.sql import functions as F

from shelfwise.functions import structure, text


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_blank_texts_become_null_without_computing_the_text_twice(spark):
    rows = spark.createDataFrame([(["a  b", " ", "", None],)], "texts array<string>")
    twice = rows.select(F.transform("texts", lambda t: text.clean(text.clean(t))).alias("t"))
    assert _plan(twice).count("regexp_replace(") == 2
    assert twice.first().t == ["a b", None, None, None]


def test_pages_are_cut_once_for_their_breadcrumbs(spark):
    pages = spark.createDataFrame([
        ("<script>var breadcrumb</script><ol class='breadcrumb'><li><a href='/a'>A</a></ol><nav><a href='/b'>B</a></nav>",),
        ("<ol class='path'><li><a href='/a'>A</a></ol>",), (None,)], "html string")
    read = structure.staged(pages, structure.crumb_steps("html", "found")).select("found")
    assert _plan(read).count(" AS found_cuts#") == 1
    assert [[tuple(c) for c in r.found] for r in read.collect()] == [[("A", "/a")], [], []]
