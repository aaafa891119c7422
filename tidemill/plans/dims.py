"""Dimension builds. Each takes raw tables of one day and returns the dimension of that day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.columns import (
    Day, activity_benefit, coupon_benefit, day, masked_email, masked_name, masked_phone,
)
from tidemill.operators.joins import lookup, name_of_code

# Parent codes in the code dictionary.
ACTIVITY_TYPES, COUPON_TYPES, COUPON_RANGES, PAYMENT_TYPES = "31", "32", "33", "11"


def _attribute_sets(attributes: DataFrame, fields: Sequence[str], name: str) -> DataFrame:
    text = [F.col(f).cast("string").alias(f) for f in fields]
    return attributes.groupBy("sku_id").agg(F.sort_array(F.collect_set(F.struct(*text))).alias(name))


def dim_sku(
    sku: DataFrame,
    spu: DataFrame,
    category3: DataFrame,
    category2: DataFrame,
    category1: DataFrame,
    trademark: DataFrame,
    attr_values: DataFrame,
    sale_attr_values: DataFrame,
) -> DataFrame:
    """Item + product + three category levels + brand + attribute arrays (sorted, without repeats)."""
    c1 = category1.select(F.col("id").alias("category1_id"), F.col("name").alias("category1_name"))
    c2 = category2.select(F.col("id").alias("category2_id"), F.col("name").alias("category2_name"),
                          F.col("category1_id"))
    c3 = category3.select(F.col("id").alias("category3_id"), F.col("name").alias("category3_name"),
                          F.col("category2_id"))
    categories = c3.join(c2, "category2_id", "left").join(c1, "category1_id", "left")
    attrs = _attribute_sets(attr_values, ["attr_id", "value_id", "attr_name", "value_name"], "sku_attr_values")
    sale_attrs = _attribute_sets(
        sale_attr_values,
        ["sale_attr_id", "sale_attr_value_id", "sale_attr_name", "sale_attr_value_name"],
        "sku_sale_attr_values",
    )
    wide = lookup(sku, spu, "spu_id", "id", ["spu_name"])
    wide = wide.join(categories, "category3_id", "left")
    wide = lookup(wide, trademark, "tm_id", "id", ["tm_name"])
    wide = lookup(wide, attrs, "id", "sku_id")
    wide = lookup(wide, sale_attrs, "id", "sku_id")
    return wide.select(
        "id", "price", "sku_name", "sku_desc", "weight", "is_sale", "spu_id", "spu_name",
        "category3_id", "category3_name", "category2_id", "category2_name", "category1_id", "category1_name",
        "tm_id", "tm_name", "sku_attr_values", "sku_sale_attr_values", "create_time",
    )


def dim_coupon(coupon: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Coupon + names of its type and range + readable rule."""
    kind = F.col("coupon_type").cast("string")
    reach = F.col("range_type").cast("string")
    named = name_of_code(coupon, dictionary, COUPON_TYPES, kind, "coupon_type_name")
    named = name_of_code(named, dictionary, COUPON_RANGES, reach, "range_type_name")
    return named.select(
        "id", "coupon_name", kind.alias("coupon_type_code"), "coupon_type_name",
        "condition_amount", "condition_num", "activity_id", "benefit_amount", "benefit_discount",
        coupon_benefit(kind, F.col("condition_amount"), F.col("condition_num"), F.col("benefit_amount"),
                       F.col("benefit_discount")).alias("benefit_rule"),
        "create_time", reach.alias("range_type_code"), "range_type_name",
        "limit_num", "taken_count", "start_time", "end_time", "operate_time", "expire_time",
    )


def dim_activity(rules: DataFrame, activity: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Promotion rule + its promotion + type name + readable rule."""
    kind = F.col("activity_type").cast("string")
    info = activity.select(
        F.col("id").alias("activity_id"), "activity_name", "activity_desc", "start_time", "end_time", "create_time"
    )
    wide = lookup(rules.withColumnRenamed("id", "activity_rule_id"), info, "activity_id", "activity_id")
    wide = name_of_code(wide, dictionary, ACTIVITY_TYPES, kind, "activity_type_name")
    return wide.select(
        "activity_rule_id", "activity_id", "activity_name", kind.alias("activity_type_code"), "activity_type_name",
        "activity_desc", "start_time", "end_time", "create_time",
        "condition_amount", "condition_num", "benefit_amount", "benefit_discount",
        activity_benefit(kind, F.col("condition_amount"), F.col("condition_num"), F.col("benefit_amount"),
                         F.col("benefit_discount")).alias("benefit_rule"),
        "benefit_level",
    )


def dim_province(province: DataFrame, region: DataFrame) -> DataFrame:
    wide = lookup(province, region, "region_id", "id", ["region_name"])
    return wide.select(
        "id", F.col("name").alias("province_name"), "area_code", "iso_code", "iso_3166_2", "region_id", "region_name"
    )


def dim_promotion_pos(promotion_pos: DataFrame) -> DataFrame:
    return promotion_pos.select("id", "pos_location", "pos_type", "promotion_type", "create_time", "operate_time")


def dim_promotion_refer(promotion_refer: DataFrame) -> DataFrame:
    return promotion_refer.select("id", "refer_name", "create_time", "operate_time")


def dim_date(spark: SparkSession, start: Day, end: Day, holidays: Sequence[Day] = ()) -> DataFrame:
    """Calendar from ``start`` to ``end``. Weekend is Saturday and Sunday."""
    days = spark.range(1).select(F.explode(F.sequence(day(start), day(end))).alias("date"))
    return calendar(days, holidays)


def calendar(days: DataFrame, holidays: Sequence[Day] = ()) -> DataFrame:
    """Calendar attributes of a column ``date`` of distinct days."""
    d = F.col("date")
    is_holiday = d.isin([day(h) for h in holidays]) if holidays else F.lit(False)
    return days.select(
        "date",
        F.weekofyear(d).alias("week"),
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        F.dayofmonth(d).alias("day"),
        F.dayofweek(d).alias("week_day"),
        F.when(F.dayofweek(d).isin(1, 7), F.lit("Y")).otherwise(F.lit("N")).alias("is_weekend"),
        F.when(is_holiday, F.lit("Y")).otherwise(F.lit("N")).alias("is_holiday"),
    )


def mask_pii(
    df: DataFrame, name: str | None = "name", phone: str | None = "phone_num", email: str | None = "email",
    daily: bool = False,
) -> DataFrame:
    """Mask name, phone and mail columns in place; invalid phones and mails become NULL.

    ``daily`` uses the longer masks of the daily merge instead of those of the first load.
    """
    masked = {}
    if name:
        masked[name] = masked_name(name)
    if phone:
        masked[phone] = masked_phone(phone, daily)
    if email:
        masked[email] = masked_email(email, daily)
    return df.withColumns(masked)


def user_history_first_load(users: DataFrame, as_of: Day) -> DataFrame:
    """All users of the first day as open history rows, masked."""
    return mask_pii(users).withColumns(
        {"start_date": day(as_of), "end_date": F.lit("9999-12-31").cast("date")}
    )


def dim_product(products: DataFrame) -> DataFrame:
    return products.select("product_id", "product_name", "brand_id", "cat_id", "price")


def dim_store(stores: DataFrame) -> DataFrame:
    return stores.select("store_id", "store_name", "region")


def dim_brand(products: DataFrame) -> DataFrame:
    return products.select("brand_id", F.col("brand_id").alias("brand_name")).distinct()


def dim_category(products: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Category columns from the top level down -> one row per category: cat_id, cat_name, level, parent_id."""
    rows = [
        F.struct(
            F.col(c).cast("string").alias("cat_id"),
            F.col(c).cast("string").alias("cat_name"),
            F.lit(i + 1).alias("level"),
            (F.col(levels[i - 1]).cast("string") if i else F.lit(None).cast("string")).alias("parent_id"),
        )
        for i, c in enumerate(levels)
    ]
    return products.select(F.explode(F.array(*rows)).alias("c")).select("c.*").distinct()


def category_paths(categories: DataFrame) -> DataFrame:
    """Lowest-level categories with both ancestors, by joining the parent tree to itself."""
    leaf = categories.where(F.col("level") == 3).select(
        F.col("cat_id").alias("category3_id"), F.col("cat_name").alias("category3_name"), "parent_id"
    )
    mid = categories.where(F.col("level") == 2).select(
        F.col("cat_id").alias("category2_id"), F.col("cat_name").alias("category2_name"),
        F.col("parent_id").alias("_top"),
    )
    top = categories.where(F.col("level") == 1).select(
        F.col("cat_id").alias("category1_id"), F.col("cat_name").alias("category1_name")
    )
    return (
        leaf.join(mid, F.col("parent_id") == F.col("category2_id"), "left")
        .join(top, F.col("_top") == F.col("category1_id"), "left")
        .drop("parent_id", "_top")
    )


def dim_device(log: DataFrame) -> DataFrame:
    return log.select("device_id", "device_type", "os_type", "app_version").distinct()


def dim_user(users: DataFrame) -> DataFrame:
    return users.select("user_id", "gender", "age", "province", "city")


def dim_page(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "page_name", "page_type", "module_name")
