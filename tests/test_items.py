"""Items of pages on hand-worked pages, and lookups with blank keys."""

from pyspark.sql import functions as F

from tidemill.functions.items import attribute, element, extract_page_items
from tidemill.operators.joins import lookup_text

FIELDS = {"title": element("span", "title"), "rank": element("em"), "url": attribute("a", "href"), "quote": element("span", "inq")}

LISTED = """<html><script>var x = '<div class="item"><em>9</em></div>';</script><!-- <div class="item"><em>8</em></div> -->
<div class="list"><div class="item"><div><em>1</em></div><a href="/one">x</a><span class="big title">The
  <b>first</b></span><span class='inq'>good</span></div>
<DIV id=i2 class='item last'><em>2</em><a data-x="a>b" href='/two'>y</a><span class=title>Second</span></DIV>
<div class="items"><em>7</em></div><div class="item"><span class="subtitle">no</span></div></div></html>"""


def pages(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "item_no_of long, html string").withColumnRenamed("item_no_of", "page")


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_items_of_a_page(spark):
    rows = found(extract_page_items(pages(spark, LISTED), "div", FIELDS, "item"))
    assert rows == [
        (0, 1, "The first", "1", "/one", "good"),
        (0, 2, "Second", "2", "/two", None),
        (0, 3, None, None, None, None),
    ]


def test_nested_items_belong_to_the_outer_one(spark):
    html = "<ul><li><em>1</em><ul><li><em>2</em></li></ul></li><li><em>3</em></li></ul>"
    assert found(extract_page_items(pages(spark, html), "li", {"rank": element("em")})) == [(0, 1, "1"), (0, 2, "3")]


def test_paragraphs_end_at_the_next(spark):
    html = "<p><em>1</em><p><em>2</em></p><p>"
    assert found(extract_page_items(pages(spark, html), "p", {"rank": element("em")})) == [(0, 1, "1"), (0, 2, "2"), (0, 3, None)]


def test_open_ends_empty_and_repeated_pages(spark):
    df = pages(spark, None, "", "no items", "<li><em>1</em>", "<li class='a", "<!-- <li>")
    assert found(extract_page_items(df.union(df), "li", {"rank": element("em")})) == [(3, 1, "1"), (3, 1, "1")]
    assert extract_page_items(df.where("false"), "li", FIELDS).count() == 0


def test_clashing_names(spark):
    df = pages(spark, "<li><em>1</em></li>").withColumn("_item", F.lit("x")).withColumn("a.b", F.lit(1))
    assert found(extract_page_items(df, "li", {"rank": element("em")})) == [(0, "x", 1, 1, "1")]


def test_scan_time_grows_with_the_page(spark):
    html = "<li a='\"'" * 20_000 + "<li class=\"x\"><em>1</em></li>" * 20_000
    assert extract_page_items(pages(spark, html), "li", {"rank": element("em")}, "x").where("rank = '1'").count() == 20_000


def test_blank_keys_spread_and_match_nothing(spark):
    keys = F.when(F.col("id") % 10 == 0, (F.col("id") % 50).cast("string")).when(F.col("id") % 10 == 1, F.lit(" "))
    facts = spark.range(20_000).select(F.col("id").cast("string").alias("line"), keys.alias("k"))
    lanes = [(f"\u0001{n}", "wrong") for n in range(4096)]
    dim = spark.createDataFrame([("0", "a"), ("10", "b"), ("20", "c"), *lanes], "id string, name string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(before, ("false", "-1", "8")):
            spark.conf.set(k, v)
        joined = lookup_text(facts, dim, "k", "id", ["id", "name"], "d_")
        rows = joined.withColumn("part", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(rows) == 20_000
    names = {"0": "a", "10": "b", "20": "c"}
    assert all(r.d_name == names.get(r.k) and r.d_id == (r.k if r.k in names else None) for r in rows)
    blank = [r.part for r in rows if not (r.k or "").strip()]
    assert len(blank) == 18_000 and max(blank.count(p) for p in range(8)) < 18_000 / 4
