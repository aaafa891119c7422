"""E-commerce fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.columns import Day, date_id, money, zero_if_null
from tidemill.operators.joins import lookup, lookup_within, name_of_code
from tidemill.plans.dims import PAYMENT_TYPES

# Status codes of the order systems.
STATUS_FINISHED = "1004"
STATUS_PAID = "1602"

AMOUNTS = ["split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"]


def fact_cart_add(cart: DataFrame) -> DataFrame:
    day_text = date_id("create_time")
    return cart.select("id", "user_id", "sku_id", day_text.alias("date_id"), "create_time", "sku_num",
                       F.to_date("create_time").alias("dt"))


def _priced(order_detail: DataFrame) -> DataFrame:
    return order_detail.withColumn("split_original_amount", money(F.col("sku_num") * F.col("order_price")))


def _with_benefits(detail: DataFrame, activity: DataFrame, coupon: DataFrame) -> DataFrame:
    """Promotion and coupon by line; where these name the line's order too, the lines stay with their order."""
    for benefit, columns in ((activity, ["activity_id", "activity_rule_id"]), (coupon, ["coupon_id"])):
        if "order_id" in benefit.columns:
            detail = lookup_within(detail, benefit, "order_id", "id", "order_detail_id", columns)
        else:
            detail = lookup(detail, benefit, "id", "order_detail_id", columns)
    return detail


def _amounts():
    return [
        F.col("split_original_amount"),
        money(zero_if_null("split_activity_amount")).alias("split_activity_amount"),
        money(zero_if_null("split_coupon_amount")).alias("split_coupon_amount"),
        F.col("split_total_amount"),
    ]


def fact_order_detail(order_detail: DataFrame, orders: DataFrame, activity: DataFrame, coupon: DataFrame) -> DataFrame:
    """Order lines with their order's user and province, promotion and coupon; missing cuts count as 0."""
    wide = lookup(_priced(order_detail), orders, "order_id", "id", ["user_id", "province_id"])
    return _with_benefits(wide, activity, coupon).select(
        "id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
        date_id("create_time").alias("date_id"), "create_time", "sku_num", *_amounts(),
        F.to_date("create_time").alias("dt"),
    )


def fact_payment_success(
    order_detail: DataFrame,
    payment: DataFrame,
    orders: DataFrame,
    activity: DataFrame,
    coupon: DataFrame,
    dictionary: DataFrame,
    as_of: Day | None = None,
    paid_only: bool = False,
) -> DataFrame:
    """Paid order lines + payment type and time.

    With ``as_of`` this is the daily increment: payments of that day against order rows of that day and the
    day before (an order may be paid after midnight). The inputs then need a ``ds`` column. ``paid_only``
    keeps payments whose status is the paid code, as the first version of this fact did.
    """
    if as_of is not None:
        today = F.lit(str(as_of)).cast("date")
        recent = F.col("ds").isin(today) | (F.col("ds") == F.date_sub(today, 1))
        payment = payment.where(F.col("ds") == today)
        order_detail, orders = order_detail.where(recent), orders.where(recent)
        activity, coupon = activity.where(recent), coupon.where(recent)
    if paid_only:
        payment = payment.where(F.col("payment_status") == STATUS_PAID)
    paid = payment.select("order_id", "user_id", F.col("payment_type").alias("payment_type_code"), "callback_time")
    wide = _priced(order_detail).drop("create_time").join(paid, "order_id")
    wide = lookup(wide, orders, "order_id", "id", ["province_id"])
    wide = _with_benefits(wide, activity, coupon)
    wide = name_of_code(wide, dictionary, PAYMENT_TYPES, F.col("payment_type_code"), "payment_type_name")
    return wide.select(
        "id", "order_id", "user_id", "sku_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
        "payment_type_code", "payment_type_name", date_id("callback_time").alias("date_id"), "callback_time", "sku_num",
        "split_original_amount", *_amounts()[1:3], F.col("split_total_amount").alias("split_payment_amount"),
        F.to_date("callback_time").alias("dt"),
    )


def fact_cart_snapshot(cart: DataFrame) -> DataFrame:
    """Cart rows not ordered yet."""
    return cart.where(F.col("is_ordered") == "0").select("id", "user_id", "sku_id", "sku_name", "sku_num")


def fact_trade_flow_acc(orders: DataFrame, payment: DataFrame, status_log: DataFrame) -> DataFrame:
    """One row per order with the times of ordering, paying and finishing."""
    paid = payment.select("order_id", "callback_time", F.col("total_amount").alias("payment_amount"))
    finished = status_log.where(F.col("order_status") == STATUS_FINISHED).select(
        "order_id", F.col("operate_time").alias("finish_time")
    )
    wide = lookup(orders.withColumnRenamed("id", "order_id"), paid, "order_id", "order_id")
    wide = lookup(wide, finished, "order_id", "order_id")
    return wide.select(
        "order_id", "user_id", "province_id",
        date_id("create_time").alias("order_date_id"), F.col("create_time").alias("order_time"),
        date_id("callback_time").alias("payment_date_id"), F.col("callback_time").alias("payment_time"),
        date_id("finish_time").alias("finish_date_id"), "finish_time",
        F.col("original_total_amount").alias("order_original_amount"),
        F.col("activity_reduce_amount").alias("order_activity_amount"),
        F.col("coupon_reduce_amount").alias("order_coupon_amount"),
        F.col("total_amount").alias("order_total_amount"),
        money(zero_if_null("payment_amount")).alias("payment_amount"),
    )


def fact_coupon_used(coupon_use: DataFrame) -> DataFrame:
    return coupon_use.select("id", "coupon_id", "user_id", "order_id", date_id("get_time").alias("date_id"),
                             F.col("used_time").alias("payment_time"), F.to_date("get_time").alias("dt"))


def fact_favor_add(favor: DataFrame) -> DataFrame:
    return favor.select("id", "user_id", "sku_id", date_id("create_time").alias("date_id"), "create_time",
                        F.to_date("create_time").alias("dt"))


def fact_page_view(log: DataFrame) -> DataFrame:
    """Page views out of parsed app-log rows (``common``, ``page`` structs and ``ts`` in ms)."""
    at = F.timestamp_millis("ts")
    return log.where(F.col("page").isNotNull()).select(
        F.col("common.ar").alias("province_id"), F.col("common.ba").alias("brand"), F.col("common.ch").alias("channel"),
        F.col("common.is_new").alias("is_new"), F.col("common.md").alias("model"), F.col("common.mid").alias("mid_id"),
        F.col("common.os").alias("operate_system"), F.col("common.uid").alias("user_id"),
        F.col("common.vc").alias("version_code"), F.col("page.item").alias("page_item"),
        F.col("page.item_type").alias("page_item_type"), F.col("page.last_page_id").alias("last_page_id"),
        F.col("page.page_id").alias("page_id"), F.col("page.from_pos_id").alias("from_pos_id"),
        F.col("page.from_pos_seq").alias("from_pos_seq"), F.col("page.refer_id").alias("refer_id"),
        date_id(at).alias("date_id"), at.alias("view_time"), F.col("common.sid").alias("session_id"),
        F.col("page.during_time").alias("during_time"), F.to_date(at).alias("dt"),
    )


def fact_register(users: DataFrame, log: DataFrame) -> DataFrame:
    """New users + the device attributes of their first logged visit that day."""
    at = F.timestamp_millis("ts")
    visits = log.where(F.col("common.uid").isNotNull()).select(
        F.col("common.uid").alias("_uid"), F.to_date(at).alias("_dt"),
        F.struct("ts", F.col("common.ch").alias("channel"), F.col("common.ar").alias("province_id"),
                 F.col("common.vc").alias("version_code"), F.col("common.mid").alias("mid_id"),
                 F.col("common.ba").alias("brand"), F.col("common.md").alias("model"),
                 F.col("common.os").alias("operate_system")).alias("_visit"),
    ).groupBy("_uid", "_dt").agg(F.min("_visit").alias("_visit"))
    day_of = F.to_date("create_time")
    new = users.select("user_id", "create_time", day_of.alias("dt"))
    return new.join(visits, (F.col("user_id") == F.col("_uid")) & (F.col("dt") == F.col("_dt")), "left").select(
        "user_id", date_id("create_time").alias("date_id"), "create_time", "_visit.channel", "_visit.province_id",
        "_visit.version_code", "_visit.mid_id", "_visit.brand", "_visit.model", "_visit.operate_system", "dt",
    )


def fact_login(page_view: DataFrame) -> DataFrame:
    """The first page view of each user session is its login."""
    rest = ["channel", "province_id", "version_code", "mid_id", "brand", "model", "operate_system"]
    first = page_view.where(F.col("user_id").isNotNull()).groupBy("dt", "user_id", "session_id").agg(
        F.min(F.struct("view_time", *rest)).alias("_first")
    )
    return first.select(
        "user_id", date_id("_first.view_time").alias("date_id"), F.col("_first.view_time").alias("login_time"),
        *[f"_first.{c}" for c in rest], "dt",
    )
