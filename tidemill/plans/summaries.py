"""E-commerce summaries: last day, last 7/30 days, to date.

Facts are aggregated first and the small result is joined to its dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.columns import Day, day, zero_if_null
from tidemill.operators.joins import lookup
from tidemill.operators.recent import roll_forward, sum_last_days

SKU_ATTRS = [
    "sku_name", "category1_id", "category1_name", "category2_id", "category2_name",
    "category3_id", "category3_name", "tm_id", "tm_name",
]
PROVINCE_ATTRS = ["province_name", "area_code", "iso_code", "iso_3166_2"]
COUPON_ATTRS = ["coupon_name", "coupon_type_code", "coupon_type_name", "benefit_rule"]

_ORDER_AMOUNTS = {
    "order_original_amount": "split_original_amount",
    "activity_reduce_amount": "split_activity_amount",
    "coupon_reduce_amount": "split_coupon_amount",
    "order_total_amount": "split_total_amount",
}
USER_ORDER_TOTALS = {
    "order_count_td": "order_count_1d",
    "order_num_td": "order_num_1d",
    "original_amount_td": "order_original_amount_1d",
    "activity_reduce_amount_td": "activity_reduce_amount_1d",
    "coupon_reduce_amount_td": "coupon_reduce_amount_1d",
    "total_amount_td": "order_total_amount_1d",
}


def _amount_sums():
    return [F.sum(zero_if_null(source)).alias(f"{name}_1d") for name, source in _ORDER_AMOUNTS.items()]


def _orders_once(order_detail: DataFrame, keys: list[str]) -> DataFrame:
    """Lines reduced to one row per (keys, order), so that orders are counted without a distinct."""
    return order_detail.groupBy(*keys, "order_id").agg(F.sum("sku_num").alias("order_num_1d"), *_amount_sums())


def _order_totals(per_order: DataFrame, keys: list[str], with_num: bool) -> DataFrame:
    sums = (["order_num_1d"] if with_num else []) + [f"{name}_1d" for name in _ORDER_AMOUNTS]
    return per_order.groupBy(*keys).agg(
        F.count("order_id").alias("order_count_1d"), *[F.sum(c).alias(c) for c in sums]
    )


def user_sku_order_1d(order_detail: DataFrame, sku: DataFrame) -> DataFrame:
    daily = order_detail.groupBy("dt", "user_id", "sku_id").agg(
        F.count(F.lit(1)).alias("order_count_1d"), F.sum("sku_num").alias("order_num_1d"), *_amount_sums()
    )
    measures = [c for c in daily.columns if c.endswith("_1d")]
    return lookup(daily, sku, "sku_id", "id", SKU_ATTRS).select("dt", "user_id", "sku_id", *SKU_ATTRS, *measures)


def user_order_1d(order_detail: DataFrame) -> DataFrame:
    keys = ["dt", "user_id"]
    return _order_totals(_orders_once(order_detail, keys), keys, with_num=True)


def user_cart_add_1d(cart_add: DataFrame) -> DataFrame:
    return cart_add.groupBy("dt", "user_id").agg(
        F.count(F.lit(1)).alias("cart_add_count_1d"), F.sum("sku_num").alias("cart_add_num_1d")
    )


def user_payment_1d(payment: DataFrame) -> DataFrame:
    per_order = payment.groupBy("dt", "user_id", "order_id").agg(
        F.sum("sku_num").alias("payment_num_1d"), F.sum("split_payment_amount").alias("payment_amount_1d")
    )
    return per_order.groupBy("dt", "user_id").agg(
        F.count("order_id").alias("payment_count_1d"),
        F.sum("payment_num_1d").alias("payment_num_1d"),
        F.sum("payment_amount_1d").alias("payment_amount_1d"),
    )


def province_order_1d(order_detail: DataFrame, province: DataFrame) -> DataFrame:
    keys = ["dt", "province_id"]
    daily = _order_totals(_orders_once(order_detail, keys), keys, with_num=False)
    measures = [c for c in daily.columns if c.endswith("_1d")]
    return lookup(daily, province, "province_id", "id", PROVINCE_ATTRS).select(*keys, *PROVINCE_ATTRS, *measures)


def user_coupon_used_1d(coupon_used: DataFrame, coupon: DataFrame) -> DataFrame:
    daily = coupon_used.groupBy("dt", "user_id", "coupon_id").agg(F.count(F.lit(1)).alias("used_count_1d"))
    return lookup(daily, coupon, "coupon_id", "id", COUPON_ATTRS).select(
        "dt", "user_id", "coupon_id", *COUPON_ATTRS, "used_count_1d"
    )


def sku_favor_add_1d(favor_add: DataFrame, sku: DataFrame) -> DataFrame:
    daily = favor_add.groupBy("dt", "sku_id").agg(F.count(F.lit(1)).alias("favor_add_count_1d"))
    return lookup(daily, sku, "sku_id", "id", SKU_ATTRS).select("dt", "sku_id", *SKU_ATTRS, "favor_add_count_1d")


def session_page_view_1d(page_view: DataFrame, as_of: Day | None = None) -> DataFrame:
    rows = page_view if as_of is None else page_view.where(F.col("dt") == day(as_of))
    return rows.groupBy(
        "dt", "session_id", "mid_id", "brand", "model", "operate_system", "version_code", "channel"
    ).agg(F.sum("during_time").alias("during_time_1d"), F.count(F.lit(1)).alias("page_count_1d"))


def visitor_page_view_1d(page_view: DataFrame, as_of: Day | None = None) -> DataFrame:
    rows = page_view if as_of is None else page_view.where(F.col("dt") == day(as_of))
    return rows.groupBy("dt", "mid_id", "brand", "model", "operate_system", "page_id").agg(
        F.sum("during_time").alias("during_time_1d"), F.count(F.lit(1)).alias("view_count_1d")
    )


def user_sku_order_nd(user_sku_1d: DataFrame, as_of: Day) -> DataFrame:
    stems = ["order_count", "order_num", *_ORDER_AMOUNTS]
    return sum_last_days(user_sku_1d, ["user_id", "sku_id", *SKU_ATTRS], {s: f"{s}_1d" for s in stems}, as_of)


def province_order_nd(province_1d: DataFrame, as_of: Day) -> DataFrame:
    stems = ["order_count", *_ORDER_AMOUNTS]
    return sum_last_days(province_1d, ["province_id", *PROVINCE_ATTRS], {s: f"{s}_1d" for s in stems}, as_of)


def user_order_td(user_1d: DataFrame, as_of: Day) -> DataFrame:
    """Totals from the first day on, from all daily summaries."""
    return user_1d.where(F.col("dt") <= day(as_of)).groupBy("user_id").agg(
        F.min("dt").alias("order_date_first"),
        F.max("dt").alias("order_date_last"),
        *[F.sum(source).alias(total) for total, source in USER_ORDER_TOTALS.items()],
    )


def user_order_td_forward(yesterday: DataFrame, user_1d: DataFrame, as_of: Day) -> DataFrame:
    """The same totals from yesterday's and one day's rows."""
    today = user_1d.where(F.col("dt") == day(as_of))
    return roll_forward(yesterday, today, ["user_id"], USER_ORDER_TOTALS, as_of, "order_date_first", "order_date_last")


def _logins(login: DataFrame) -> DataFrame:
    return login.groupBy("dt", "user_id").agg(F.count(F.lit(1)).alias("login_count_1d"))


def user_login_td(login: DataFrame, as_of: Day) -> DataFrame:
    return login.where(F.col("dt") <= day(as_of)).groupBy("user_id").agg(
        F.max("dt").alias("login_date_last"),
        F.min("dt").alias("login_date_first"),
        F.count(F.lit(1)).alias("login_count_td"),
    )


def user_login_td_forward(yesterday: DataFrame, login: DataFrame, as_of: Day) -> DataFrame:
    today = _logins(login.where(F.col("dt") == day(as_of)))
    rolled = roll_forward(yesterday, today, ["user_id"], {"login_count_td": "login_count_1d"}, as_of,
                          "login_date_first", "login_date_last")
    return rolled.select("user_id", "login_date_last", "login_date_first", "login_count_td")
