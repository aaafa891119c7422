"""Tumbling event-time windows, for streams (append mode) and batches alike.

Distinct users are counted by grouping twice - by user, then without - instead of holding a set per window, so
state rows stay small and one busy window is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.columns import count_where, flag

DELAY = "5 seconds"


def event_timed(df: DataFrame, epoch_ms: str = "ts", delay: str = DELAY) -> DataFrame:
    """Add ``event_time`` from epoch milliseconds, with a bound on how late rows may come."""
    return df.withColumn("event_time", F.timestamp_millis(epoch_ms)).withWatermark("event_time", delay)


def _bounds(df: DataFrame, *columns) -> DataFrame:
    text = "yyyy-MM-dd HH:mm:ss"
    return df.select(
        F.date_format("window.start", text).alias("stt"), F.date_format("window.end", text).alias("edt"), *columns
    )


def _windowed(df: DataFrame, size: str) -> Column:
    return F.window("event_time", size)


def _with_users(
    df: DataFrame, size: str, dims: Sequence[Column | str], user: str | Column, sums: dict[str, Column],
    users: dict[str, Column],
) -> DataFrame:
    """Sums per (window, dims), and for each of ``users`` the number of users for whom the flag was ever 1."""
    user_col = F.col(user) if isinstance(user, str) else user
    per_user = df.groupBy(_windowed(df, size).alias("window"), *dims, user_col.alias("_user")).agg(
        *[agg.alias(n) for n, agg in sums.items()], *[F.max(f).alias(n) for n, f in users.items()]
    )
    known = F.col("_user").isNotNull()
    keys = [c for c in per_user.columns if c not in ("_user", *sums, *users)]
    return per_user.groupBy(*keys).agg(
        *[F.sum(n).alias(n) for n in sums], *[F.sum(F.when(known, F.col(n)).otherwise(0)).alias(n) for n in users]
    )


# user behaviour

_WHO = ["vc", "ch", "ar", "is_new"]


def _who(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(f"common.{c}") for c in _WHO})


def pv_uv_window(actions: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Records and users per window, version, channel, area and new flag."""
    counted = _with_users(_who(actions), size, _WHO, "common.uid", {"pv_ct": F.count(F.lit(1))}, {"uv_ct": F.lit(1)})
    return _bounds(counted, *_WHO, "pv_ct", "uv_ct")


def session_window_stats(actions: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Starts, starts without a previous page, and time on page."""
    starts = _who(actions.where(F.col("event_type") == "start"))
    counted = starts.groupBy(_windowed(starts, size).alias("window"), *_WHO).agg(
        F.count(F.lit(1)).alias("sv_ct"), count_where(F.col("page.last_page_id").isNull()).alias("uj_ct"),
        F.sum("page.during_time").alias("dur_sum"),
    )
    return _bounds(counted, *_WHO, "sv_ct", "uj_ct", "dur_sum")


def display_click_window(actions: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Displays and clicks per item, page and channel; the item counts are 0 or 1 since the item is a key."""
    seen = actions.where(F.col("event_type").isin("display", "click") & F.col("display.item").isNotNull()).withColumns(
        {"sku_id": F.col("display.item"), "page_id": F.col("page.page_id"), "ch": F.col("common.ch")}
    )
    keys = ["sku_id", "page_id", "ch"]
    counted = seen.groupBy(_windowed(seen, size).alias("window"), *keys).agg(
        count_where(F.col("event_type") == "display").alias("disp_ct"), count_where(F.col("event_type") == "click").alias("click_ct")
    )
    return _bounds(
        counted, *keys, "disp_ct", flag(F.col("disp_ct") > 0).alias("disp_sku_num"),
        "click_ct", flag(F.col("click_ct") > 0).alias("click_sku_num"),
    )


# trade

def order_stats(details: DataFrame, size: str = "10 seconds") -> DataFrame:
    rows = details.where(F.col("event_type") == "order")
    counted = _with_users(rows, size, ["sku_id"], "user_id",
                          {"order_ct": F.count(F.lit(1)), "order_amount": F.sum("order_amount")}, {"order_user_ct": F.lit(1)})
    return _bounds(counted, "sku_id", "order_ct", "order_user_ct", F.col("order_ct").alias("sku_num"), "order_amount")


def payment_stats(details: DataFrame, size: str = "10 seconds") -> DataFrame:
    rows = details.where(F.col("event_type") == "payment")
    counted = _with_users(rows, size, ["sku_id"], "user_id",
                          {"payment_ct": F.count(F.lit(1)), "payment_amount": F.sum("payment_amount")}, {"payment_user_ct": F.lit(1)})
    return _bounds(counted, "sku_id", "payment_ct", "payment_user_ct", F.round("payment_amount", 2).alias("payment_amount"))


def refund_stats(details: DataFrame, size: str = "10 seconds") -> DataFrame:
    rows = details.where(F.col("event_type") == "refund")
    counted = _with_users(rows, size, ["sku_id"], "user_id",
                          {"refund_ct": F.count(F.lit(1)), "refund_amount": F.sum("refund_amount")}, {"refund_user_ct": F.lit(1)})
    return _bounds(counted, "sku_id", "refund_ct", "refund_user_ct", "refund_amount")


def trade_window_stats(details: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Orders with the payments and refunds of the same window and item (NULL where there are none).

    One pass with conditional sums stands in for a join of three windowed streams.
    """
    kind = F.col("event_type")
    sums, users = {}, {}
    for name in ("order", "payment", "refund"):
        sums[f"{name}_ct"] = count_where(kind == name)
        sums[f"{name}_amount"] = F.sum(F.when(kind == name, F.col(f"{name}_amount")))
        users[f"{name}_user_ct"] = flag(kind == name)
    counted = _with_users(details.where(kind.isin("order", "payment", "refund")), size, ["sku_id"], "user_id", sums, users)

    def shown(name: str, column: str) -> Column:
        return F.when(F.col(f"{name}_ct") > 0, F.col(column)).alias(column)

    return _bounds(
        counted.where(F.col("order_ct") > 0), "sku_id", "order_ct", "order_user_ct", F.col("order_ct").alias("sku_num"),
        F.round("order_amount", 2).alias("order_amount"),
        shown("payment", "payment_ct"), shown("payment", "payment_user_ct"), F.round("payment_amount", 2).alias("payment_amount"),
        shown("refund", "refund_ct"), shown("refund", "refund_user_ct"), F.round("refund_amount", 2).alias("refund_amount"),
    )


def payment_5min(payments: DataFrame, size: str = "5 minutes") -> DataFrame:
    """Paid amount, payments and paying users per window."""
    valid = payments.where(F.col("payment_id").isNotNull())
    counted = _with_users(valid, size, [], "user_id",
                          {"window_gmv": F.sum("amount"), "window_payments": F.count(F.lit(1))}, {"window_users": F.lit(1)})
    return _bounds(counted, "window_gmv", "window_payments", "window_users")


def user_order_rows(orders: DataFrame, size: str = "1 minute") -> DataFrame:
    """Refunds and sums per window, user and order; on a stream all rows of a window come with the batch that closes it."""
    rows = orders.where(F.col("user_id").isNotNull())
    return rows.groupBy(_windowed(rows, size).alias("window"), "user_id", "order_id").agg(
        count_where(F.col("refund_amount") > 0).alias("refund_ct"),
        *[F.sum(c).alias(f"{c}_sum") for c in ("order_amount", "refund_amount", "coupon_amount")],
    )


def user_order_totals(per_order: DataFrame) -> DataFrame:
    """``user_order_rows`` per user and window; an order's rows count as one order."""
    sums = ["refund_ct", "order_amount_sum", "refund_amount_sum", "coupon_amount_sum"]
    counted = per_order.groupBy("window", "user_id").agg(F.count("order_id").alias("order_ct"), *[F.sum(c).alias(c) for c in sums])
    return _bounds(counted, "user_id", "order_ct", *sums)


def user_order_window(orders: DataFrame, size: str = "1 minute") -> DataFrame:
    """Orders, refunds and sums per user and window; an order's rows count as one order."""
    return user_order_totals(user_order_rows(orders, size))


def platform_stats(orders: DataFrame, size: str = "1 minute") -> DataFrame:
    """Users, orders, amount and mean order per channel and window."""
    rows = orders.where(F.col("channel").isNotNull() & F.col("user_id").isNotNull())
    per_order = rows.groupBy(_windowed(rows, size).alias("window"), "channel", "user_id", "order_id").agg(
        F.sum("order_amount").alias("pay_amount")
    )
    per_user = per_order.groupBy("window", "channel", "user_id").agg(
        F.count("order_id").alias("order_cnt"), F.sum("pay_amount").alias("pay_amount")
    )
    counted = per_user.groupBy("window", "channel").agg(
        F.count("user_id").alias("user_cnt"), F.sum("order_cnt").alias("order_cnt"), F.sum("pay_amount").alias("pay_amount")
    )
    mean = F.when(F.col("order_cnt") > 0, F.col("pay_amount").cast("double") / F.col("order_cnt")).otherwise(F.lit(0.0))
    return _bounds(counted, "channel", "user_cnt", "order_cnt", "pay_amount", mean.alias("avg_order_amount"))


# alerts

RULE_FIELDS = ["order_amount", "refund_amount", "sku_num", "order_ct", "order_user_ct", "refund_user_ct"]


def metric_alerts(stats: DataFrame, rules: DataFrame) -> DataFrame:
    """Every enabled rule ``field operator threshold`` a statistic meets.

    Statistics are turned to (field, value) rows and joined to the rules of that field, so each rule on a field
    applies. The refund rate exists only where something was ordered. A missing amount is written as 0.00.
    """
    rate = F.when(F.col("order_amount") > 0, F.col("refund_amount").cast("double") / F.col("order_amount").cast("double"))
    values = {**{c: F.col(c).cast("double") for c in RULE_FIELDS}, "refund_rate": rate}
    long = stats.select(
        "stt", "edt", "sku_id", "order_amount", "refund_amount",
        F.explode(F.array(*[F.struct(F.lit(n).alias("field"), v.alias("value")) for n, v in values.items()])).alias("m"),
    ).select("*", "m.*").where(F.col("value").isNotNull()).drop("m")
    active = rules.where(F.col("status") == 1).select(
        F.col("id").alias("rule_id"), F.col("field_name").alias("field"), "operator", "threshold", "description"
    )
    v, t, op = F.col("value"), F.col("threshold"), F.col("operator")
    hit = (
        ((op == ">") & (v > t)) | ((op == ">=") & (v >= t)) | ((op == "<") & (v < t)) | ((op == "<=") & (v <= t))
        | ((op == "==") & (v == t))
    )
    text = F.format_string(
        "ALERT SKU: %s | order_amount: %.2f | refund_amount: %.2f", F.col("sku_id").cast("string"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in ("order_amount", "refund_amount")],
    )
    return long.join(active, "field").where(hit).select(
        "rule_id", F.col("description").alias("alert_type"), text.alias("message"), F.col("edt").alias("alert_time")
    )


def refund_rate_alert(stats: DataFrame, threshold: float) -> DataFrame:
    """The single refund-rate rule; a rate over no orders counts as 0."""
    rate = F.when(F.col("order_amount") != 0, F.col("refund_amount").cast("double") / F.col("order_amount").cast("double")).otherwise(0.0)
    text = F.format_string("退款率报警 SKU: %s 退款率: %.2f  阈值: %.2f", F.col("sku_id").cast("string"), F.col("rate"), F.lit(threshold))
    return stats.withColumn("rate", rate).where(F.col("rate") > threshold).select("stt", "edt", "sku_id", text.alias("message"))
