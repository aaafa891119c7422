"""Item linkage: what else the visitors of a main item look at, put in the cart and buy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.columns import Day, day, days_back, flag, sum_where, within_days
from tidemill.operators.joins import lookup
from tidemill.operators.near import near_pair_counts


def fact_user_sku_action(action: DataFrame, sku: DataFrame) -> DataFrame:
    return lookup(action, sku, "sku_id", "sku_id")


def related_actions(action: DataFrame, main_skus: Sequence, as_of: Day, minutes: int = 30, days: int = 7) -> DataFrame:
    """Actions on other items within ``minutes`` of an action on a main item by the same user in the last ``days`` days.

    Only actions from the first possible main action, less the range, to the end of ``as_of``, plus the range, can pair, so
    others are not read.
    """
    first, end = days_back(as_of, days).cast("timestamp"), F.date_add(day(as_of), 1).cast("timestamp")
    at, range_ = F.col("action_time"), F.expr(f"interval {minutes} minutes")
    main = action.where(F.col("sku_id").isin(list(main_skus)) & (at >= first) & (at < end))
    action = action.where((at >= first - range_) & (at <= end + range_))
    pairs = near_pair_counts(
        main.select("user_id", "action_time", F.col("sku_id").alias("main_sku")),
        action.select("user_id", "action_time", F.col("sku_id").alias("related_sku"), "action_type"),
        "user_id", "action_time", "main_sku", ["related_sku", "action_type"], minutes * 60,
    )
    return pairs.withColumnRenamed("pairs", "action_cnt")


def related_behaviour_pivot(related: DataFrame) -> DataFrame:
    kinds = ("click", "cart", "pay")
    return related.groupBy("main_sku", "related_sku").agg(
        *[sum_where(F.col("action_type") == k, "action_cnt").alias(f"related_{k}_cnt") for k in kinds]
    )


def sku_linkage(action: DataFrame, main_skus: Sequence) -> DataFrame:
    """For users who viewed a main item: how many viewed, carted and ordered each other item.

    Actions of other users are dropped first, then both sides are reduced to one row per user and item. A user then gives at most
    (main items viewed) x (items touched) rows, and users need no second distinct.
    """
    main = list(main_skus)
    viewers = action.where(F.col("sku_id").isin(main) & (F.col("action_type") == "view")).select(
        "user_id", F.col("sku_id").alias("main_sku_id")
    ).distinct()
    kinds = {"visit": "view", "cart": "cart", "order": "order"}
    others = action.where(~F.col("sku_id").isin(main)).join(viewers, "user_id", "left_semi")
    touched = others.groupBy("user_id", F.col("sku_id").alias("related_sku_id")).agg(
        *[F.max(flag(F.col("action_type") == kind)).alias(name) for name, kind in kinds.items()]
    )
    return viewers.join(touched, "user_id").groupBy("main_sku_id", "related_sku_id").agg(
        *[F.sum(name).alias(f"{name}_user_count") for name in kinds]
    )


def detail_guide(action: DataFrame) -> DataFrame:
    """Users per item who opened the detail page, clicked, carted and paid."""
    kinds = ("detail", "click", "cart", "pay")
    per_user = action.where(F.col("user_id").isNotNull()).groupBy("sku_id", "user_id").agg(
        *[F.max(flag(F.col("action_type") == k)).alias(k) for k in kinds]
    )
    return per_user.groupBy("sku_id").agg(*[F.sum(k).alias(f"{k}_uv") for k in kinds])


def top_traffic_items(visit_1d: DataFrame, as_of: Day, n: int = 10, days: int = 7) -> DataFrame:
    """Items with the most visitors over the last days."""
    recent = visit_1d.where(within_days("dt", as_of, days))
    return recent.groupBy("item_id").agg(F.sum("pv_uv").alias("total_uv")).orderBy(F.col("total_uv").desc(), "item_id").limit(n)
