"""Page flow and page modules: stays, entries, transitions, paths; exposure, click and jump per module."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.columns import Day, count_where, day, flag, ratio_or_null, ratio_over_one
from tidemill.operators.joins import lookup
from tidemill.operators.ordered import next_values, row_numbers

# Page and order codes of the page-flow theme.
ENTRY_PAGES = ["home", "detail", "campaign"]
VALID_ORDER = ["created", "paid", "shipped", "completed"]
PAID_ORDER = ["paid", "shipped", "completed"]
BOUNCE_SECONDS = 5

CHAIN_CHUNK = 1000


# facts

def fact_page_stay(visit_log: DataFrame, page: DataFrame) -> DataFrame:
    stays = visit_log.where(F.col("event_type") == "stay").drop("page_name", "page_type")
    return lookup(stays, page, "page_id", "page_id", ["page_name", "page_type", "module_name"]).select(
        "user_id", "session_id", "device_id", "page_id", "page_name", "page_type", "module_name",
        F.col("ref_page_id").alias("refer_page_id"), "duration", "event_time", "os_type", "app_version",
        "channel", "province", "city", "ip",
    )


def fact_entry(visit_log: DataFrame, entry_pages: Sequence[str] = ENTRY_PAGES) -> DataFrame:
    return visit_log.where(F.col("page_id").isin(list(entry_pages))).select(
        "user_id", "session_id", "device_id", F.col("page_id").alias("entry_page"), "event_time", "province", "city"
    )


def fact_valid_order(orders: DataFrame, product: DataFrame, statuses: Sequence[str] = VALID_ORDER) -> DataFrame:
    valid = orders.where(F.col("order_status").isin(list(statuses)))
    return lookup(valid, product, "sku_id", "sku_id", ["product_name", "category", "brand"]).select(
        "order_id", "user_id", "sku_id", "product_name", "category", "brand", "order_amount", "order_status", "order_time"
    )


def page_transitions(
    visit_log: DataFrame,
    keys: Sequence[str] = ("user_id", "session_id"),
    order: Sequence[str] = ("event_time", "log_id"),
    number: str | None = None,
) -> DataFrame:
    """from_page -> to_page for each pair of consecutive visits of a session; ``number`` adds the step number.

    Visits at the same time follow in the order of the log id.
    """
    columns = list(dict.fromkeys([*keys, "page_id", *order]))
    steps = next_values(visit_log.select(*columns), keys, order, {"to_page": "page_id"}, number)
    kept = [c for c in columns if c != "page_id"] + ([number] if number else [])
    return steps.where(F.col("to_page").isNotNull()).select(F.col("page_id").alias("from_page"), "to_page", *kept)


# summaries

def user_visit_1d(page_stay: DataFrame) -> DataFrame:
    per_page = page_stay.groupBy("user_id", "page_id").agg(
        F.count(F.lit(1)).alias("visits"), F.sum("duration").alias("duration")
    )
    totals = per_page.groupBy("user_id").agg(
        F.sum("visits").alias("visit_cnt"), F.sum("duration").alias("total_duration"), F.count("page_id").alias("page_count")
    )
    bounced = (F.col("page_count") == 1) & (F.col("total_duration") < BOUNCE_SECONDS)
    return totals.withColumn("bounce_flag", flag(bounced))


def page_visit_1d(page_stay: DataFrame) -> DataFrame:
    per_user = page_stay.groupBy("page_id", "user_id").agg(
        F.count(F.lit(1)).alias("pv"), F.sum("duration").alias("s"), F.count("duration").alias("n")
    )
    return per_user.groupBy("page_id").agg(
        F.sum("pv").alias("pv"), F.count("user_id").alias("uv"),
        (F.sum("s").cast("double") / F.sum("n")).alias("avg_duration"),
    )


def page_path_1d(transitions: DataFrame) -> DataFrame:
    per_user = transitions.groupBy("from_page", "to_page", "user_id").agg(F.count(F.lit(1)).alias("cnt"))
    return per_user.groupBy("from_page", "to_page").agg(F.sum("cnt").alias("cnt"), F.count("user_id").alias("uv"))


def user_order_pay_1d(valid_orders: DataFrame) -> DataFrame:
    return valid_orders.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("order_cnt"), F.sum("order_amount").alias("order_amt"),
        count_where(F.col("order_status").isin(PAID_ORDER)).alias("pay_cnt"),
    )


# results

def page_visit_topn(page_1d: DataFrame) -> DataFrame:
    return page_1d.orderBy(F.col("uv").desc(), "page_id")


def page_stay_analysis(page_stay: DataFrame, page_1d: DataFrame) -> DataFrame:
    """Mean and longest stay, and the share of users with a single visit shorter than five seconds."""
    per_time = page_stay.groupBy("page_id", "user_id", "event_time").agg(
        F.sum("duration").alias("duration"), F.max("duration").alias("longest")
    )
    per_user = per_time.groupBy("page_id", "user_id").agg(
        F.count("event_time").alias("times"), F.sum("duration").alias("duration"), F.max("longest").alias("longest")
    )
    bounced = (F.col("times") == 1) & (F.col("duration") < BOUNCE_SECONDS)
    per_page = per_user.groupBy("page_id").agg(
        F.max("longest").alias("max_stay"), count_where(bounced).alias("bounced"), F.count("user_id").alias("users")
    )
    rate = F.when(F.col("users") > 0, F.col("bounced") / F.col("users")).otherwise(F.lit(0.0))
    return page_1d.join(per_page, "page_id", "left").select(
        "page_id", F.col("avg_duration").alias("avg_stay"), "max_stay", rate.alias("bounce_rate")
    )


def page_jump_rate(path_1d: DataFrame) -> DataFrame:
    """Transitions over the largest user count among the source page's transitions."""
    top = path_1d.groupBy("from_page").agg(F.max("uv").alias("from_page_uv"))
    return path_1d.join(top, "from_page").select(
        "from_page", "to_page", "cnt", (F.col("cnt") / F.col("from_page_uv")).alias("jump_rate")
    )


def entry_conversion(entry: DataFrame, valid_orders: DataFrame) -> DataFrame:
    """Orders and paid orders of the users who entered on a page, each order counted once per page.

    Entries are reduced to (user, page) and orders to (user, order) before they meet, so a user who entered
    often does not multiply orders.
    """
    pages = entry.select("user_id", F.col("entry_page").alias("page_id")).distinct()
    orders = valid_orders.groupBy("user_id", "order_id").agg(
        F.max(flag(F.col("order_status").isin(PAID_ORDER))).alias("paid")
    )
    per_order = pages.join(orders, "user_id").groupBy("page_id", "order_id").agg(F.max("paid").alias("paid"))
    return per_order.groupBy("page_id").agg(
        F.count("order_id").alias("order_cnt"), F.sum("paid").alias("pay_cnt")
    ).withColumn("conversion_rate", F.when(F.col("order_cnt") > 0, F.col("pay_cnt") / F.col("order_cnt")).otherwise(0.0))


def user_flow_path(
    transitions: DataFrame, page_stay: DataFrame, as_of: Day, order: Sequence[str] = ("event_time", "log_id")
) -> DataFrame:
    """The ordered path of each session as text, with the user's total stay.

    A path is one value, so its length sets the row size; it is put together from chunks of ``CHAIN_CHUNK``
    steps, so no task sorts more steps than that plus one entry per chunk. Transitions that already carry their
    step number as ``rn`` are not numbered again.
    """
    keys = ["user_id", "session_id"]
    numbered = transitions if "rn" in transitions.columns else row_numbers(transitions, keys, order, "rn")
    step = F.concat(F.col("from_page"), F.lit("->"), F.col("to_page"))

    def joined(entries):
        return F.concat_ws("->", F.transform(F.array_sort(F.collect_list(entries)), lambda e: e["text"]))

    chunks = numbered.withColumn("chunk", F.expr(f"(rn - 1) div {CHAIN_CHUNK}")).groupBy(*keys, "chunk").agg(
        joined(F.struct(F.col("rn").alias("at"), step.alias("text"))).alias("text")
    )
    chains = chunks.groupBy(*keys).agg(joined(F.struct(F.col("chunk").alias("at"), "text")).alias("path_chain"))
    stay = page_stay.groupBy("user_id").agg(F.sum("duration").alias("total_duration"))
    return chains.join(stay, "user_id", "left").select("user_id", "session_id", day(as_of).alias("visit_date"), "path_chain", "total_duration")


# page modules

def dim_page_module(module: DataFrame, styles: Sequence[str] = ("Card", "Banner", "Slider", "List")) -> DataFrame:
    """Modules with a display style. The style is a hash of the id, so a rerun gives the same one."""
    names = F.array(*[F.lit(s) for s in styles])
    at = F.pmod(F.xxhash64("module_id"), F.lit(len(styles))).cast("int")
    return module.withColumn("display_style", F.get(names, at))


def fact_click(visit_log: DataFrame, module: DataFrame) -> DataFrame:
    return lookup(visit_log, module, "module_id", "module_id", ["module_name", "module_type", "display_style"]).select(
        "visit_id", "user_id", "visit_time", "page_id", "module_id", "module_name", "module_type", "display_style",
        "click_position", "ip", "device",
    )


def fact_exposure(visit_log: DataFrame, module: DataFrame) -> DataFrame:
    return lookup(visit_log, module, "module_id", "module_id", ["module_name", "module_type", "display_style"]).select(
        "visit_id", "user_id", F.col("visit_time").alias("expose_time"), "page_id", "module_id",
        "module_name", "module_type", "display_style", F.lit("auto_click_before").alias("expose_reason"),
    )


def fact_jump(jump_log: DataFrame, product: DataFrame, module: DataFrame) -> DataFrame:
    attrs = ["category", "brand_name", "level1_category", "level2_category", "price"]
    known = product.select(F.col("product_id").alias("_pid"), F.col("product_id").alias("known_product_id"), *attrs)
    wide = lookup(jump_log, known, "product_id", "_pid", ["known_product_id", *attrs])
    wide = lookup(wide, module, "module_id", "module_id", ["module_name", "module_type"])
    return wide.select(
        "jump_id", "user_id", "page_id", "module_id", "module_name", "module_type",
        F.col("known_product_id").alias("product_id"), *attrs, "jump_time",
    )


MODULE = ["dt", "page_id", "module_id"]


def _hits(rows: DataFrame, time: str, count: str, users: str) -> DataFrame:
    per_user = rows.withColumn("dt", F.to_date(time)).groupBy(*MODULE, "user_id").agg(F.count(F.lit(1)).alias("n"))
    return per_user.groupBy(*MODULE).agg(F.sum("n").alias(count), F.count("user_id").alias(users))


def module_click_1d(exposure: DataFrame, click: DataFrame) -> DataFrame:
    """Exposures, clicks and click rate per day, page and module; a zero count of exposures is read as 1."""
    shown = _hits(exposure, "expose_time", "expo_count", "expo_user_count")
    clicked = _hits(click, "visit_time", "click_count", "click_user_count")
    both = shown.join(clicked, MODULE, "left").na.fill(0)
    return both.withColumn("click_rate", ratio_over_one("click_count", "expo_count"))


def page_guide_conversion_1d(jump: DataFrame, module_1d: DataFrame) -> DataFrame:
    per_product = jump.withColumn("dt", F.to_date("jump_time")).groupBy(*MODULE, "product_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    jumps = per_product.groupBy(*MODULE).agg(
        F.sum("n").alias("guide_jump_count"), F.count("product_id").alias("guide_sku_count")
    )
    both = jumps.join(module_1d.select(*MODULE, "click_count", "expo_count"), MODULE, "left").na.fill(0)
    return both.withColumns({
        "jump_click_rate": ratio_over_one("guide_jump_count", "click_count"),
        "jump_expo_rate": ratio_over_one("guide_jump_count", "expo_count"),
    })


def product_from_page_1d(jump: DataFrame) -> DataFrame:
    per_user = jump.withColumn("dt", F.to_date("jump_time")).groupBy(*MODULE, "product_id", "user_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_user.groupBy(*MODULE, "product_id").agg(F.sum("n").alias("jump_count"), F.count("user_id").alias("user_count"))


def module_click_rank(module_1d: DataFrame, k: int = 20) -> DataFrame:
    """The most clicked modules of each day; equal counts are ordered by page and module id."""
    w = Window.partitionBy("dt").orderBy(F.col("click_count").desc(), "page_id", "module_id")
    return module_1d.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        *MODULE, "click_count", "expo_count", "click_rate", "rank"
    )


def page_conversion_trend(guide_1d: DataFrame) -> DataFrame:
    totals = guide_1d.groupBy("dt").agg(
        F.sum("guide_jump_count").alias("total_jump"), F.sum("click_count").alias("total_click"),
        F.sum("expo_count").alias("total_expo"),
    )
    return totals.withColumns({
        "click_conversion_rate": ratio_or_null("total_jump", "total_click"),
        "expo_conversion_rate": ratio_or_null("total_jump", "total_expo"),
    })


def module_guidance_effect(guide_1d: DataFrame) -> DataFrame:
    totals = guide_1d.groupBy("module_id").agg(
        F.sum("expo_count").alias("expo_count"), F.sum("click_count").alias("click_count"),
        F.sum("guide_jump_count").alias("jump_count"),
    )
    return totals.withColumns({
        "click_rate": ratio_or_null("click_count", "expo_count"),
        "jump_click_rate": ratio_or_null("jump_count", "click_count"),
    })


def abnormal_modules(effect: DataFrame, max_rate: float = 0.2, min_expo: int = 50) -> DataFrame:
    low = (F.col("click_rate") < max_rate) | (F.col("jump_click_rate") < max_rate)
    return effect.where(low & (F.col("expo_count") > min_expo))
