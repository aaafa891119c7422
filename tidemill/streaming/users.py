"""User statistics, preferences and tags over behaviour and order rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.columns import count_where, flag

KINDS = {"pv": "view", "click": "click", "cart": "cart", "pay": "pay"}


def session_totals(behaviour: DataFrame) -> DataFrame:
    """Per user and session: counts by kind, records, first and last time in ms."""
    known = behaviour.where(F.col("user_id").isNotNull() & F.col("session_id").isNotNull())
    return known.groupBy("user_id", "session_id").agg(
        *[count_where(F.col("behavior_type") == k).alias(n) for n, k in KINDS.items()],
        F.count(F.lit(1)).alias("records"), F.min("behavior_time").alias("first_ms"), F.max("behavior_time").alias("last_ms"),
    )


def merge_session_totals(parts: DataFrame) -> DataFrame:
    return parts.groupBy("user_id", "session_id").agg(
        *[F.sum(n).alias(n) for n in KINDS], F.sum("records").alias("records"),
        F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"),
    )


def stats_of_sessions(sessions: DataFrame) -> DataFrame:
    """Counts, sessions, one-record sessions and the mean session length; each session weighs the same."""
    return sessions.groupBy("user_id").agg(
        *[F.sum(n).alias(n) for n in KINDS], F.count("session_id").alias("session_ct"),
        count_where(F.col("records") == 1).alias("bounce_ct"),
        F.round(F.avg(F.col("last_ms") - F.col("first_ms")), 2).alias("avg_stay_duration"),
    )


def user_behaviour_stats(behaviour: DataFrame) -> DataFrame:
    return stats_of_sessions(session_totals(behaviour))


def user_funnel(behaviour: DataFrame) -> DataFrame:
    """View, cart and pay counts with their three rates, for users with all steps."""
    kinds = ("view", "cart", "pay")
    counts = behaviour.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        *[count_where(F.col("behavior_type") == k).alias(f"{k}_cnt") for k in kinds]
    )

    def rate(part: str, whole: str) -> Column:
        return F.when(F.col(f"{whole}_cnt") == 0, F.lit(0.0)).otherwise(F.col(f"{part}_cnt") / F.col(f"{whole}_cnt"))

    return counts.withColumns({
        "view_to_cart_rate": rate("cart", "view"), "cart_to_pay_rate": rate("pay", "cart"), "view_to_pay_rate": rate("pay", "view"),
    }).where((F.col("view_cnt") > 0) & (F.col("cart_cnt") > 0) & (F.col("pay_cnt") > 0))


def province_user_totals(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("province").isNotNull()).groupBy("province", "user_id").agg(
        F.sum("order_amount").alias("order_amount"), F.max(flag(F.col("pay_time").isNotNull())).alias("paid"),
        F.sum("refund_amount").alias("refund_amount"),
    )


def merge_province_user_totals(parts: DataFrame) -> DataFrame:
    return parts.groupBy("province", "user_id").agg(
        F.sum("order_amount").alias("order_amount"), F.max("paid").alias("paid"), F.sum("refund_amount").alias("refund_amount")
    )


def stats_of_province_users(totals: DataFrame) -> DataFrame:
    return totals.groupBy("province").agg(
        F.count("user_id").alias("user_cnt"), F.sum("order_amount").alias("order_amount"),
        F.sum(F.when(F.col("user_id").isNotNull(), F.col("paid")).otherwise(0)).alias("pay_user_cnt"),
        F.sum("refund_amount").alias("refund_amount"),
    )


def province_stats(orders: DataFrame) -> DataFrame:
    """Users, amount, paying users and refunds per province."""
    return stats_of_province_users(province_user_totals(orders))


BRAND_KINDS = ("view", "cart", "pay")


def preference_items(behaviour: DataFrame) -> DataFrame:
    """A row for each brand that a user has viewed, carted or paid, and for each place (category with platform): user_id, what, name, platform."""
    known = behaviour.where(F.col("user_id").isNotNull())
    brand = F.when(F.col("brand_id").isNotNull() & F.col("behavior_type").isin(*BRAND_KINDS),
                   F.struct(F.col("behavior_type").alias("what"), F.col("brand_id").alias("name"), F.lit(None).cast("string").alias("platform")))
    place = F.when(F.col("category3_id").isNotNull() & F.col("platform").isNotNull(),
                   F.struct(F.lit("place").alias("what"), F.col("category3_id").alias("name"), "platform"))
    return known.select("user_id", F.explode(F.array(brand, place)).alias("i")).where(F.col("i").isNotNull()).select("user_id", "i.*")


def preference_counts(behaviour: DataFrame) -> DataFrame:
    """How often each of ``preference_items`` occurs, as ``n``; on a stream a running aggregate."""
    return preference_items(behaviour).groupBy("user_id", "what", "name", "platform").agg(F.count(F.lit(1)).alias("n"))


def top_preferences(counts: DataFrame) -> DataFrame:
    """Of ``preference_counts``, each user's most frequent brands and place; ties go to the smaller name."""
    def top(column: str, what: str) -> Column:
        rank = F.when(F.col("what") == what, F.struct(-F.col("n"), F.col("name"), F.col("platform")))
        return F.min_by(column, rank)

    return counts.groupBy("user_id").agg(
        *[top("name", k).alias(f"top_{k}_brand") for k in BRAND_KINDS],
        top("name", "place").alias("prefer_category3"), top("platform", "place").alias("prefer_platform"),
    )


def user_preference(behaviour: DataFrame, form: str = "left", complete_only: bool = False) -> DataFrame:
    """Each user's most viewed, carted and paid brand and most frequent category with platform; ties go to the
    smaller name.

    ``form="left"`` keeps users with a viewed brand, ``"full"`` all users with any preference.
    """
    result = top_preferences(preference_counts(behaviour))
    if form == "left":
        result = result.where(F.col("top_view_brand").isNotNull())
    return result.dropna() if complete_only else result


# Tag -> (field of the enriched behaviour row, text where it is missing).
TAGS = {
    "gender": ("user_id_gender", "未知"),
    "age": ("user_id_age", "未知"),
    "level": ("user_id_level", "未知"),
    "province": ("user_id_province", "未知"),
    "channel": ("user_id_channel", "未知"),
    "is_blacklist": ("user_id_is_blacklist", "0"),
    "top_click_category3": ("category3_id_category3_id", "无"),
    "top_click_category2": ("category3_id_category2_id", "无"),
    "top_click_category1": ("category3_id_category1_id", "无"),
    "top_brand": ("sku_id_brand_id", "无"),
}


def user_tags(behaviour: DataFrame, orders: DataFrame, order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Tags from each user's newest behaviour row; users known only from orders get the defaults."""
    fields = [f for f, _ in TAGS.values()]
    seen = behaviour.select("user_id", F.struct(*order).alias("at"), F.struct(*fields).alias("row"))
    bought = orders.select("user_id").withColumn("at", F.lit(None).cast(seen.schema["at"].dataType)).withColumn(
        "row", F.lit(None).cast(seen.schema["row"].dataType))
    newest = seen.unionByName(bought).where(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.max_by("row", "at").alias("row"))
    return newest.select(
        "user_id", *[F.coalesce(F.col(f"row.{f}").cast("string"), F.lit(default)).alias(tag) for tag, (f, default) in TAGS.items()]
    )
