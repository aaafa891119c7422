"""Results of several facts in one aggregation, against full joins."""

from pyspark.sql import functions as F

from tidemill.plans import transport


def _pair(spark, *rows):
    """(last day, N-day) tables of (days, id, name, count); one day has days 1."""
    df = spark.createDataFrame(list(rows), "recent_days int, city_id long, city_name string, order_count long").withColumns(
        {"sort_count": F.col("order_count"), "order_amount": (F.col("order_count") * 2).cast("decimal(16,2)")})
    daily = df.where("recent_days = 1").drop("recent_days").withColumn("dt", F.lit("2024-01-09").cast("date"))
    return daily, df.where("recent_days > 1")


def test_sides_meet_on_whole_keys_only(spark, as_rows):
    deliver = _pair(spark, (1, 1, "a", 3), (1, 1, "a", 4), (1, None, None, 5), (7, 2, "b", 6))
    sort = _pair(spark, (1, 1, "a", 10), (1, None, None, 20), (7, 3, "c", 30))
    receive = _pair(spark, (1, 1, "a", 100), (30, 2, "b", 200), (1, 4, None, 1))
    found = transport.express_city_stats(deliver, sort, receive, "2024-01-09").drop("dt")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert as_rows(found.withColumn("receive_order_amount", F.col("receive_order_amount").cast("int"))) == sorted([
        (1, 1, "a", 100, 200, 7, 10), (1, None, None, None, None, 5, None), (1, None, None, None, None, None, 20),
        (7, 2, "b", None, None, 6, None), (7, 3, "c", None, None, None, 30), (30, 2, "b", 200, 400, None, None),
        (1, 4, None, 1, 2, None, None)], key=repr)


def test_longer_windows_of_organisations_need_both_sides(spark, as_rows):
    columns = "recent_days int, org_id long, org_name string"
    cargo = spark.createDataFrame([(1, 1, "a", 2), (7, 1, "a", 3), (7, 2, "b", 4), (7, None, None, 9)], f"{columns}, order_count long") \
        .withColumn("order_amount", F.lit(1).cast("decimal(16,2)"))
    trips = spark.createDataFrame([(1, 3, "c", 5), (7, 1, "a", 6), (30, 2, "b", 7), (7, None, None, 8)], f"{columns}, trans_finish_count long").withColumns(
        {"trans_finish_distance": F.lit(10).cast("decimal(16,2)"), "trans_finish_dur_sec": F.lit(10).cast("bigint")})

    def split(df):
        return df.where("recent_days = 1").drop("recent_days").withColumn("dt", F.lit("2024-01-09").cast("date")), df.where("recent_days > 1")

    found = transport.org_stats(*split(cargo), *split(trips), "2024-01-09")
    assert as_rows(found, "recent_days", "org_id", "order_count", "trans_finish_count") == [(1, 1, 2, None), (1, 3, None, 5), (7, 1, 3, 6)]


def test_empty_facts(spark):
    none = _pair(spark)
    assert transport.express_city_stats(none, none, none, "2024-01-09").count() == 0
    assert transport.express_stats(none, none, "2024-01-09").count() == 0
