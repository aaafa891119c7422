"""Product efficiency and product rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.columns import Day, amount_per, band, count_where, day, days_back, flag, ratio, zero_if_null
from tidemill.operators.joins import lookup
from tidemill.operators.ordered import row_numbers

KEYS = ["product_id", "store_id", "dt"]

# Visit bands and segment labels, from the highest bound down.
VISIT_BANDS = [(10000, "10000+"), (5000, "5000-9999"), (1000, "1000-4999"), (100, "100-999")]
CONVERSION_SEGMENTS = [(0.3, "高转化"), (0.1, "中转化")]
VALUE_SEGMENTS = [(200, "高价值"), (100, "中价值")]
BOUNCE_SEGMENTS = [(0.5, "高跳出"), (0.2, "中跳出")]


def fact_with_product_store(
    log: DataFrame, product: DataFrame, store: DataFrame, time: str, as_of: Day, days: int = 30
) -> DataFrame:
    """A log of the last ``days`` days with product and store names and a compact day ``dt``."""
    recent = log.where((F.col(time) >= days_back(as_of, days)) & (F.col(time) < F.date_add(day(as_of), 1)))
    named = lookup(recent, product, "product_id", "product_id", ["product_name"])
    named = lookup(named, store, "store_id", "store_id", ["store_name"])
    return named.withColumn("dt", F.date_format(time, "yyyyMMdd"))


def fact_product_action(view: DataFrame, fav: DataFrame, cart: DataFrame) -> DataFrame:
    """View, favourite and cart logs stacked with their type."""
    logs = (("view", view, "visit_time"), ("fav", fav, "fav_time"), ("cart", cart, "cart_time"))
    parts = [
        df.select("user_id", "product_id", F.col(time).alias("action_time"), F.lit(kind).alias("action_type"), "dt")
        for kind, df, time in logs
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def product_visit_summary(behaviour: DataFrame) -> DataFrame:
    """Visits, visitors, mean stay, bounce rate and micro-detail views.

    The bounce rate is one minus non-bounced visits per visitor, so it can fall below zero for repeat visitors.
    """
    per_log = behaviour.groupBy(*KEYS, "user_id", "log_id").agg(
        F.sum("stay_duration").alias("stay"), F.count("stay_duration").alias("stays"),
        count_where(F.col("is_micro_detail")).alias("micro"), count_where(~F.col("is_bounce")).alias("kept"),
    )
    sums = ("stay", "stays", "micro", "kept")
    per_user = per_log.groupBy(*KEYS, "user_id").agg(F.count("log_id").alias("pv"), *[F.sum(c).alias(c) for c in sums])
    totals = per_user.groupBy(*KEYS).agg(
        F.count("user_id").alias("uv"), F.sum("pv").alias("pv"), *[F.sum(c).alias(c) for c in sums]
    )
    return totals.select(
        *KEYS, "pv", "uv", (F.col("stay").cast("double") / F.col("stays")).alias("avg_stay_time"),
        (1 - F.col("kept") / F.col("uv")).alias("bounce_rate"), F.col("micro").alias("micro_detail_uv"),
    )


def product_fav_summary(fav: DataFrame) -> DataFrame:
    users = fav.where(~F.col("is_cancelled")).select(*KEYS, "user_id").where(F.col("user_id").isNotNull()).distinct()
    return users.groupBy(*KEYS).agg(F.count("user_id").alias("fav_user_cnt"))


def product_cart_summary(cart: DataFrame) -> DataFrame:
    per_user = cart.where(~F.col("is_deleted")).groupBy(*KEYS, "user_id").agg(F.sum("quantity").alias("q"))
    return per_user.groupBy(*KEYS).agg(F.count("user_id").alias("cart_user_cnt"), F.sum("q").alias("cart_total_qty"))


def order_payment_summary(order_item: DataFrame, payment: DataFrame, refund: DataFrame) -> DataFrame:
    """Orders, payments and refunds per product, store and day; sides that lack a key count as 0."""
    per_order = order_item.groupBy(*KEYS, "order_id").agg(F.sum("quantity").alias("q"), F.sum("amount").alias("a"))
    ordered = per_order.groupBy(*KEYS).agg(
        F.count("order_id").alias("order_user_cnt"), F.sum("q").alias("order_total_qty"), F.sum("a").alias("order_total_amt")
    )
    per_payer = payment.groupBy(*KEYS, "user_id").agg(F.sum("pay_amount").alias("a"), F.count(F.lit(1)).alias("n"))
    paid = per_payer.groupBy(*KEYS).agg(
        F.count("user_id").alias("pay_user_cnt"), F.sum("n").alias("pay_total_qty"), F.sum("a").alias("pay_total_amt")
    )
    refunded = refund.groupBy(*KEYS).agg(F.sum("refund_amount").alias("refund_amt"))
    return ordered.join(paid, KEYS, "full").join(refunded, KEYS, "full").na.fill(0)


MEASURES = [
    "fav_user_cnt", "cart_user_cnt", "cart_total_qty", "order_user_cnt", "order_total_qty", "order_total_amt",
    "pay_user_cnt", "pay_total_qty", "pay_total_amt", "refund_amt",
]


def _joined(visit: DataFrame, fav: DataFrame, cart: DataFrame, orders: DataFrame) -> DataFrame:
    return visit.join(fav, KEYS, "left").join(cart, KEYS, "left").join(orders, KEYS, "left")


def product_efficiency_monitor(visit: DataFrame, fav: DataFrame, cart: DataFrame, orders: DataFrame) -> DataFrame:
    wide = _joined(visit, fav, cart, orders).select(
        *KEYS, "pv", "uv", "avg_stay_time", "bounce_rate", "micro_detail_uv",
        *[zero_if_null(m).alias(m) for m in MEASURES],
    )
    rate = F.when(F.col("uv") == 0, F.lit(0.0)).otherwise(F.col("pay_user_cnt") / F.col("uv"))
    return wide.withColumns({"conversion_rate": rate, "visit_interval": band("uv", VISIT_BANDS, "0-99")})


def _rounded_mean(mean: Column, digits: int) -> Column:
    """Through ten decimals, so that halves round up."""
    return F.round(mean.cast("decimal(20,10)"), digits).cast("double")


def _with_rates(df: DataFrame) -> DataFrame:
    """Users of each step per visitor; payments per payer and per visitor."""
    steps = {"pay_rate": "pay_user_cnt", "order_rate": "order_user_cnt", "fav_rate": "fav_user_cnt", "cart_rate": "cart_user_cnt"}
    amounts = {"item_per_pay_user": "pay_user_cnt", "visitor_value": "uv"}
    return df.withColumns({name: ratio(users, "uv") for name, users in steps.items()}
                          | {name: amount_per("pay_total_amt", per) for name, per in amounts.items()})


def product_efficiency_overview(visit: DataFrame, fav: DataFrame, cart: DataFrame, orders: DataFrame) -> DataFrame:
    """All measures per product, store and day. The four summaries hold one row a key, so nothing is left to add up.

    Measures that a key lacks are NULL, and so are a mean stay without visitors and a bounce rate without visits.
    """
    return _with_rates(_joined(visit, fav, cart, orders).select(
        *KEYS, "pv", "uv", F.when(F.col("uv") > 0, _rounded_mean(F.col("avg_stay_time"), 2)).alias("avg_stay_time"),
        F.when(F.col("pv") > 0, _rounded_mean(F.col("bounce_rate"), 4)).alias("bounce_rate"), "micro_detail_uv", *MEASURES))


def efficiency_over_days(overview: DataFrame, by: Sequence[str]) -> DataFrame:
    """The overview of several days, products or stores added up per ``by``.

    Stay is the mean weighted by visitors, bounce by visits, over the rows that have one; rates are taken of the sums, so a day of
    many visitors counts for more than a quiet one. Sums of no values are 0. Visitors of several days count once a day.
    """
    def mean(value: str, weight: str, digits: int) -> Column:
        known = F.when(F.col(value).isNotNull(), F.col(weight))
        total = F.sum(F.col(value).cast("decimal(20,6)") * known.cast("decimal(18,0)")).cast("double")
        return F.when(F.sum(known) > 0, _rounded_mean(total / F.sum(known), digits)).alias(value)

    sums = ["pv", "uv", "micro_detail_uv", *MEASURES]
    added = overview.groupBy(*by).agg(F.countDistinct("dt").alias("days"), mean("avg_stay_time", "uv", 2), mean("bounce_rate", "pv", 4),
                                      *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums])
    return _with_rates(added)


def store_efficiency_summary(overview: DataFrame) -> DataFrame:
    names = ["pv", "uv", "order_user_cnt", "pay_user_cnt", "order_total_amt", "pay_total_amt"]
    return overview.groupBy("store_id").agg(*[F.sum(c).alias(c) for c in names])


def product_conversion_rate(visit: DataFrame, orders: DataFrame) -> DataFrame:
    """Rates from each step to the next: visit, micro-detail, order, payment."""
    wide = visit.join(orders, KEYS, "left").select(
        *KEYS, "uv", F.col("micro_detail_uv").alias("click_uv"), F.col("order_user_cnt").alias("order_uv"),
        F.col("pay_user_cnt").alias("pay_uv"),
    )
    return wide.withColumns({
        "click_rate": ratio("click_uv", "uv"),
        "order_rate": ratio("order_uv", "click_uv"),
        "pay_rate": ratio("pay_uv", "order_uv"),
    })


def product_segments(overview: DataFrame) -> DataFrame:
    return overview.select(
        *KEYS, "uv", "pay_user_cnt", "order_user_cnt", "bounce_rate", "pay_rate", "visitor_value",
        band("order_rate", CONVERSION_SEGMENTS, "低转化").alias("conversion_segment"),
        band("visitor_value", VALUE_SEGMENTS, "低价值").alias("pay_segment"),
        band("bounce_rate", BOUNCE_SEGMENTS, "低跳出").alias("bounce_segment"),
    )


def product_summary(order_detail: DataFrame, product_action: DataFrame) -> DataFrame:
    """Payers, quantity and amount per product and day, next to its viewing, favouring and carting users.

    Both sides are aggregated before they are joined, so actions do not multiply quantities.
    """
    keys = ["product_id", "dt"]
    per_payer = order_detail.groupBy(*keys, "user_id").agg(
        F.sum("quantity").alias("q"), F.sum("payment_amount").alias("a")
    )
    paid = per_payer.groupBy(*keys).agg(
        F.count("user_id").alias("pay_user_cnt"), F.sum("q").alias("pay_qty"), F.sum("a").alias("pay_amt")
    )
    kinds = ("view", "fav", "cart")
    per_user = product_action.where(F.col("user_id").isNotNull()).groupBy(*keys, "user_id").agg(
        *[F.max(flag(F.col("action_type") == k)).alias(k) for k in kinds]
    )
    acted = per_user.groupBy(*keys).agg(*[F.sum(k).alias(f"{k}_user_cnt") for k in kinds])
    return paid.join(acted, keys, "left").na.fill(0, [f"{k}_user_cnt" for k in kinds])


def _daily_rank(df: DataFrame, measure: str, name: str) -> DataFrame:
    return row_numbers(df, ["dt"], [F.col(measure).desc_nulls_last(), "product_id"], name)


def product_sales_rank(summary: DataFrame) -> DataFrame:
    return _daily_rank(summary.select("dt", "product_id", "pay_amt"), "pay_amt", "rank_by_amt")


def product_quantity_rank(summary: DataFrame) -> DataFrame:
    return _daily_rank(summary.select("dt", "product_id", "pay_qty"), "pay_qty", "rank_by_qty")


def product_conversion_rank(summary: DataFrame) -> DataFrame:
    rated = summary.select("dt", "product_id", "pay_user_cnt", "view_user_cnt",
                           ratio("pay_user_cnt", "view_user_cnt").alias("conversion_rate"))
    return _daily_rank(rated, "conversion_rate", "rank_by_conversion")
