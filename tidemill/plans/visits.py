"""Visit, purchase and cohort questions over plain logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.columns import count_where, percent_text
from tidemill.operators.ordered import row_numbers
from tidemill.session import pinned


def first_purchase_in_month(purchases: DataFrame, month: int, year: int | None = None) -> DataFrame:
    """The first purchases of users whose first purchase falls in the month; purchases at the same time all count."""
    first = purchases.groupBy("user_id").agg(F.min("pay_time").alias("pay_time")).where(F.month("pay_time") == month)
    if year is not None:
        first = first.where(F.year("pay_time") == year)
    return purchases.join(first, ["user_id", "pay_time"])


def top_addresses(access_log: DataFrame, endpoint: str, start, end, n: int = 10) -> DataFrame:
    """Addresses with most hits on an endpoint from ``start`` up to, not including, ``end``."""
    hits = access_log.where(
        (F.col("endpoint") == endpoint) & (F.col("log_time") >= F.lit(start).cast("timestamp"))
        & (F.col("log_time") < F.lit(end).cast("timestamp"))
    )
    return hits.groupBy("address", "endpoint").agg(F.count(F.lit(1)).alias("hits")).orderBy(
        F.col("hits").desc(), "address"
    ).limit(n)


def monthly_visits(visits: DataFrame) -> DataFrame:
    """Visits per user and month with a running total. The window sees one row per user and month."""
    monthly = visits.groupBy("user_id", F.date_format("visit_date", "yyyy-MM").alias("month")).agg(
        F.sum("visit_count").alias("visits")
    )
    w = Window.partitionBy("user_id").orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly.withColumn("visits_to_date", F.sum("visits").over(w))


def shop_visitors(visits: DataFrame) -> DataFrame:
    return visits.where(F.col("user_id").isNotNull()).select("shop", "user_id").distinct().groupBy("shop").agg(
        F.count("user_id").alias("uv")
    )


def shop_top_visitors(visits: DataFrame, k: int = 3) -> DataFrame:
    """Most frequent visitors per shop; equal counts share a rank."""
    counted = visits.groupBy("shop", "user_id").agg(F.count(F.lit(1)).alias("visits"))
    w = Window.partitionBy("shop").orderBy(F.col("visits").desc())
    return counted.withColumn("rank", F.rank().over(w)).where(F.col("rank") <= k)


def monthly_orders(orders: DataFrame, year: int) -> DataFrame:
    per_user = orders.where(F.year("order_date") == year).groupBy(
        F.date_format("order_date", "yyyy-MM").alias("month"), "user_id"
    ).agg(F.count("order_id").alias("n"), F.sum("amount").alias("a"))
    return per_user.groupBy("month").agg(
        F.sum("n").alias("orders"), F.count("user_id").alias("users"), F.sum("a").alias("amount")
    )


def new_customers_by_month(orders: DataFrame) -> DataFrame:
    first = orders.groupBy("user_id").agg(F.min("order_date").alias("first"))
    return first.groupBy(F.date_format("first", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("new_customers"))


def new_customers_in(orders: DataFrame, month: str) -> DataFrame:
    """Number of customers whose first order falls in ``month`` (yyyy-MM): one row."""
    first = orders.groupBy("user_id").agg(F.min("order_date").alias("first"))
    return first.where(F.date_format("first", "yyyy-MM") == month).agg(F.count(F.lit(1)).alias("new_customers"))


def two_day_active(visits: DataFrame) -> DataFrame:
    """All users and users with visits on two days in a row: counts and means of their distinct ages."""
    days = visits.select("user_id", "age", "visit_date").distinct()
    tomorrow = days.select("user_id", F.date_sub("visit_date", 1).alias("visit_date")).distinct()
    active = days.join(tomorrow, ["user_id", "visit_date"], "left_semi").select("user_id", "age").distinct()
    people = days.select("user_id", "age").distinct()
    marked = people.withColumn("active", F.lit(0)).unionByName(active.withColumn("active", F.lit(1)))

    # one row per user, then one per age: no distinct over the whole input in one task
    users = marked.groupBy("user_id").agg(F.max("active").alias("active"))
    ages = marked.groupBy("age").agg(F.max("active").alias("active"))
    user_counts = users.agg(F.count("user_id").alias("users"), F.sum("active").alias("active_users"))
    age_means = ages.agg(
        F.round(F.avg("age"), 2).alias("mean_age"), F.round(F.avg(F.when(F.col("active") == 1, F.col("age"))), 2).alias("active_mean_age")
    )
    means = age_means.select(F.struct("mean_age", "active_mean_age")).scalar()
    return user_counts.select(
        "users", "active_users", means["mean_age"].alias("mean_age"), means["active_mean_age"].alias("active_mean_age")
    )


def totals_with_share(amounts: DataFrame) -> DataFrame:
    """Total per name, its overall rank and its share of everything as text."""
    totals = pinned(amounts.groupBy("name").agg(F.sum("amount").alias("total")))
    everything = totals.agg(F.sum("total")).scalar()
    ranked = row_numbers(totals, [], [F.col("total").desc(), "name"], "rank")
    share = F.round(F.col("total").cast("double") / everything.cast("double"), 4)
    return ranked.select("name", "total", "rank", percent_text(share).alias("ratio"))


def daily_new_returning(logins: DataFrame) -> DataFrame:
    """Users per login day who log in for the first time, and who came back; each user counts once a day."""
    days = logins.select("user_id", "login_date").distinct()
    first = days.groupBy("user_id").agg(F.min("login_date").alias("first"))
    return days.join(first, "user_id").groupBy("login_date").agg(
        count_where(F.col("login_date") == F.col("first")).alias("new_user_cnt"),
        count_where(F.col("login_date") > F.col("first")).alias("old_user_cnt"),
    )
