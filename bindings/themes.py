"""Page flow, page modules, products, item linkage and visit questions over events, orders and parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.ctes import cte
from bindings.inputs import EVENT_DAY, Inputs
from bindings.register import big, dbl, query, tms, txt
from tidemill.functions.columns import money
from tidemill.plans import linkage, pages, products, visits

E = f"date '{EVENT_DAY}'"


# page flow

def visit_log(i: Inputs):
    u, k = F.col("user_id"), F.col("k")
    page = (
        F.when(F.col("event_type") == "click", "home").when(F.col("event_type") == "view", "detail")
        .when(F.col("event_type") == "purchase", "campaign").when(F.col("event_type") == "signup", "list").otherwise("search")
    )
    return i.events().select(
        F.col("event_id").alias("log_id"), "user_id", F.concat_ws("_", u, "dt").alias("session_id"), F.concat(F.lit("d"), u).alias("device_id"),
        page.alias("page_id"), F.when(k % 4 != 0, "home").alias("ref_page_id"), F.when(k % 2 == 0, "stay").otherwise("leave").alias("event_type"),
        F.col("ts").alias("event_time"), F.floor("value").cast("int").alias("duration"), F.concat(F.lit("os"), u % 2).alias("os_type"),
        F.concat(F.lit("v"), k % 5).alias("app_version"), F.concat(F.lit("ch"), u % 4).alias("channel"),
        F.concat(F.lit("p"), u % 25).alias("province"), F.concat(F.lit("c"), u % 50).alias("city"), F.concat(F.lit("10.0.0."), u % 250).alias("ip"))


def page_dim(i: Inputs):
    return visit_log(i).select("page_id").distinct().select(
        "page_id", F.upper("page_id").alias("page_name"), F.concat(F.lit("t-"), "page_id").alias("page_type"), F.concat(F.lit("m-"), "page_id").alias("module_name"))


def page_orders(i: Inputs):
    status = F.when(F.col("o_orderstatus") == "F", "paid").when(F.col("o_orderstatus") == "O", "created").otherwise("cancelled")
    return i.table("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), (F.col("o_orderkey") % 300).alias("sku_id"),
        money("o_totalprice").alias("order_amount"), status.alias("order_status"), F.col("o_orderdate").alias("order_time"))


def valid_orders(i: Inputs):
    product = i.table("part").select(F.col("p_partkey").alias("sku_id"), F.col("p_name").alias("product_name"),
                                     F.col("p_type").alias("category"), F.col("p_brand").alias("brand"))
    return pages.fact_valid_order(page_orders(i), product)


def page_stay(i: Inputs):
    return pages.fact_page_stay(visit_log(i), page_dim(i))


cte("z_log", """
SELECT event_id AS log_id, user_id, user_id || '_' || dt AS session_id, 'd' || user_id AS device_id,
       CASE event_type WHEN 'click' THEN 'home' WHEN 'view' THEN 'detail' WHEN 'purchase' THEN 'campaign' WHEN 'signup' THEN 'list' ELSE 'search' END AS page_id,
       CASE WHEN k % 4 <> 0 THEN 'home' END AS ref_page_id, k % 2 = 0 AS stays, ts AS event_time, cast(floor(value) as bigint) AS duration, k
FROM x_ev
""")
cte("z_stay", "SELECT * FROM z_log WHERE stays")
cte("z_order", """
SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderkey % 300 AS sku_id, cast(o_totalprice as decimal(16,2)) AS order_amount,
       CASE o_orderstatus WHEN 'F' THEN 'paid' ELSE 'created' END AS order_status, o_orderdate AS order_time, p_name, p_type, p_brand
FROM orders LEFT JOIN part ON p_partkey = o_orderkey % 300 WHERE o_orderstatus IN ('F', 'O')
""")
cte("z_step", """
SELECT * FROM (SELECT user_id, session_id, page_id AS from_page, lead(page_id) OVER (PARTITION BY user_id, session_id ORDER BY event_time, log_id) AS to_page, event_time, log_id FROM z_log)
WHERE to_page IS NOT NULL
""")


@query(f"""
SELECT user_id, session_id, device_id, page_id, upper(page_id) AS page_name, 't-' || page_id AS page_type, 'm-' || page_id AS module_name,
       ref_page_id AS refer_page_id, duration, {tms('event_time', 'event_time')}, 'os' || (user_id % 2) AS os_type, 'v' || (k % 5) AS app_version,
       'ch' || (user_id % 4) AS channel, 'p' || (user_id % 25) AS province, 'c' || (user_id % 50) AS city, '10.0.0.' || (user_id % 250) AS ip FROM z_stay
""")
def fact_page_stay(i: Inputs):
    return page_stay(i)


@query(f"""
SELECT user_id, session_id, device_id, page_id AS entry_page, {tms('event_time', 'event_time')}, 'p' || (user_id % 25) AS province, 'c' || (user_id % 50) AS city
FROM z_log WHERE page_id IN ('home', 'detail', 'campaign')
""")
def fact_entry(i: Inputs):
    return pages.fact_entry(visit_log(i))


@query(f"""
SELECT order_id, user_id, sku_id, p_name AS product_name, p_type AS category, p_brand AS brand, {dbl('order_amount', 'order_amount')}, order_status,
       {tms('order_time', 'order_time')} FROM z_order
""")
def fact_valid_order(i: Inputs):
    return valid_orders(i)


@query(f"SELECT user_id, session_id, from_page, to_page, {tms('event_time', 'event_time')}, log_id FROM z_step")
def page_transitions(i: Inputs):
    return pages.page_transitions(visit_log(i))


@query("""
SELECT conv_id, from_page, to_page, turn FROM (SELECT conv_id, role AS from_page, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS to_page, turn FROM conversations)
WHERE to_page IS NOT NULL
""")
def page_transitions_conversations(i: Inputs):
    return pages.page_transitions(i.table("conversations").withColumnRenamed("role", "page_id"), ["conv_id"], ["turn"])


@query(f"""
SELECT user_id, count(*) AS visit_cnt, {big('sum(duration)', 'total_duration')}, count(DISTINCT page_id) AS page_count,
       cast(CASE WHEN count(DISTINCT page_id) = 1 AND sum(duration) < 5 THEN 1 ELSE 0 END as bigint) AS bounce_flag FROM z_stay GROUP BY user_id
""")
def user_visit_1d(i: Inputs):
    return pages.user_visit_1d(page_stay(i))


cte("z_page1d", "SELECT page_id, count(*) AS pv, count(DISTINCT user_id) AS uv, cast(sum(duration) as double) / count(duration) AS avg_duration FROM z_stay GROUP BY page_id")


@query("SELECT * FROM z_page1d")
def page_visit_1d(i: Inputs):
    return pages.page_visit_1d(page_stay(i))


cte("z_path1d", "SELECT from_page, to_page, count(*) AS cnt, count(DISTINCT user_id) AS uv FROM z_step GROUP BY from_page, to_page")


@query("SELECT * FROM z_path1d")
def page_path_1d(i: Inputs):
    return pages.page_path_1d(pages.page_transitions(visit_log(i)))


@query(f"""
SELECT user_id, count(*) AS order_cnt, {dbl('sum(order_amount)', 'order_amt')}, {big("sum(CASE WHEN order_status = 'paid' THEN 1 ELSE 0 END)", 'pay_cnt')}
FROM z_order GROUP BY user_id
""")
def user_order_pay_1d(i: Inputs):
    return pages.user_order_pay_1d(valid_orders(i))


@query("SELECT * FROM z_page1d ORDER BY uv DESC, page_id")
def page_visit_topn(i: Inputs):
    return pages.page_visit_topn(pages.page_visit_1d(page_stay(i)))


@query("""
WITH u AS (SELECT page_id, user_id, count(DISTINCT event_time) AS n, sum(duration) AS d FROM z_stay GROUP BY 1, 2),
b AS (SELECT page_id, cast(sum(CASE WHEN n = 1 AND d < 5 THEN 1 ELSE 0 END) as double) / count(*) AS bounce_rate FROM u GROUP BY 1)
SELECT page_id, avg_duration AS avg_stay, max_stay, bounce_rate FROM z_page1d JOIN (SELECT page_id, max(duration) AS max_stay FROM z_stay GROUP BY 1) USING (page_id) JOIN b USING (page_id)
""")
def page_stay_analysis(i: Inputs):
    stay = page_stay(i)
    return pages.page_stay_analysis(stay, pages.page_visit_1d(stay))


@query("SELECT from_page, to_page, cnt, cast(cnt as double) / max(uv) OVER (PARTITION BY from_page) AS jump_rate FROM z_path1d")
def page_jump_rate(i: Inputs):
    return pages.page_jump_rate(pages.page_path_1d(pages.page_transitions(visit_log(i))))


@query(f"""
WITH e AS (SELECT DISTINCT user_id, page_id FROM z_log WHERE page_id IN ('home', 'detail', 'campaign'))
SELECT page_id, count(DISTINCT order_id) AS order_cnt, count(DISTINCT CASE WHEN order_status = 'paid' THEN order_id END) AS pay_cnt,
       cast(count(DISTINCT CASE WHEN order_status = 'paid' THEN order_id END) as double) / count(DISTINCT order_id) AS conversion_rate
FROM e JOIN z_order USING (user_id) GROUP BY page_id
""")
def entry_conversion(i: Inputs):
    return pages.entry_conversion(pages.fact_entry(visit_log(i)), valid_orders(i))


@query(f"""
SELECT p.user_id, session_id, '{EVENT_DAY}' AS visit_date, path_chain, d AS total_duration
FROM (SELECT user_id, session_id, string_agg(from_page || '->' || to_page, '->' ORDER BY event_time, log_id) AS path_chain FROM z_step GROUP BY ALL) p
LEFT JOIN (SELECT user_id, cast(sum(duration) as bigint) AS d FROM z_stay GROUP BY 1) s ON p.user_id = s.user_id
""")
def user_flow_path(i: Inputs):
    return pages.user_flow_path(pages.page_transitions(visit_log(i), number="rn"), page_stay(i), EVENT_DAY)


# page modules

def module_dim(i: Inputs):
    return i.events().select("k").distinct().select(
        F.col("k").alias("module_id"), F.concat(F.lit("module "), "k").alias("module_name"), F.concat(F.lit("t"), F.col("k") % 4).alias("module_type"),
        F.when(F.col("k") % 2 == 0, "Card").otherwise("List").alias("display_style"))


def module_visits(i: Inputs, kinds: list[str]):
    return i.events().where(F.col("event_type").isin(kinds)).select(
        F.col("event_id").alias("visit_id"), "user_id", F.col("ts").alias("visit_time"), (F.col("k") % 10).alias("page_id"),
        F.col("k").alias("module_id"), (F.col("k") % 6).alias("click_position"), F.concat(F.lit("10.0.0."), F.col("user_id") % 250).alias("ip"),
        F.concat(F.lit("d"), "user_id").alias("device"))


def exposures(i: Inputs):
    return pages.fact_exposure(module_visits(i, ["view", "error"]), module_dim(i))


def clicks(i: Inputs):
    return pages.fact_click(module_visits(i, ["click"]), module_dim(i))


def jumps(i: Inputs):
    log = i.events().where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("jump_id"), "user_id", (F.col("k") % 10).alias("page_id"), F.col("k").alias("module_id"),
        (F.col("k") * 3).alias("product_id"), F.col("ts").alias("jump_time"))
    product = i.table("part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"), F.col("p_brand").alias("brand_name"),
        F.col("p_type").alias("level1_category"), F.concat_ws("-", "p_type", F.col("p_size") % 5).alias("level2_category"),
        money("p_retailprice").alias("price"))
    return pages.fact_jump(log, product, module_dim(i))


def module_1d(i: Inputs):
    return pages.module_click_1d(exposures(i), clicks(i))


def guide_1d(i: Inputs):
    return pages.page_guide_conversion_1d(jumps(i), module_1d(i))


_MODULE_COLS = "'module ' || k AS module_name, 't' || (k % 4) AS module_type"
_STYLE = "CASE WHEN k % 2 = 0 THEN 'Card' ELSE 'List' END AS display_style"


@query(f"""
SELECT event_id AS visit_id, user_id, {tms('ts', 'visit_time')}, k % 10 AS page_id, k AS module_id, {_MODULE_COLS}, {_STYLE}, k % 6 AS click_position,
       '10.0.0.' || (user_id % 250) AS ip, 'd' || user_id AS device FROM x_ev WHERE event_type = 'click'
""")
def fact_click(i: Inputs):
    return clicks(i)


@query(f"""
SELECT event_id AS visit_id, user_id, {tms('ts', 'expose_time')}, k % 10 AS page_id, k AS module_id, {_MODULE_COLS}, {_STYLE},
       'auto_click_before' AS expose_reason FROM x_ev WHERE event_type IN ('view', 'error')
""")
def fact_exposure(i: Inputs):
    return exposures(i)


@query(f"""
SELECT event_id AS jump_id, user_id, k % 10 AS page_id, k AS module_id, {_MODULE_COLS}, p_partkey AS product_id, p_type AS category, p_brand AS brand_name,
       p_type AS level1_category, p_type || '-' || (p_size % 5) AS level2_category, {dbl('p_retailprice', 'price')}, {tms('ts', 'jump_time')}
FROM x_ev LEFT JOIN part ON p_partkey = k * 3 WHERE event_type = 'purchase'
""")
def fact_jump(i: Inputs):
    return jumps(i)


cte("z_mod1d", """
SELECT e.dt, e.page_id, e.module_id, expo_count, expo_user_count, coalesce(click_count, 0) AS click_count, coalesce(click_user_count, 0) AS click_user_count,
       round(cast(coalesce(click_count, 0) as double) / expo_count, 4) AS click_rate
FROM (SELECT dt, k % 10 AS page_id, k AS module_id, count(*) AS expo_count, count(DISTINCT user_id) AS expo_user_count FROM x_ev WHERE event_type IN ('view', 'error') GROUP BY ALL) e
LEFT JOIN (SELECT dt, k AS module_id, count(*) AS click_count, count(DISTINCT user_id) AS click_user_count FROM x_ev WHERE event_type = 'click' GROUP BY ALL) c
ON e.dt = c.dt AND e.module_id = c.module_id
""")
cte("z_jump", "SELECT dt, k % 10 AS page_id, k AS module_id, p_partkey AS product_id, user_id FROM x_ev LEFT JOIN part ON p_partkey = k * 3 WHERE event_type = 'purchase'")
cte("z_guide", """
SELECT j.dt, j.page_id, j.module_id, guide_jump_count, guide_sku_count, coalesce(click_count, 0) AS click_count, coalesce(expo_count, 0) AS expo_count,
       round(cast(guide_jump_count as double) / CASE WHEN coalesce(click_count, 0) = 0 THEN 1 ELSE click_count END, 4) AS jump_click_rate,
       round(cast(guide_jump_count as double) / CASE WHEN coalesce(expo_count, 0) = 0 THEN 1 ELSE expo_count END, 4) AS jump_expo_rate
FROM (SELECT dt, page_id, module_id, count(*) AS guide_jump_count, count(DISTINCT product_id) AS guide_sku_count FROM z_jump GROUP BY ALL) j
LEFT JOIN z_mod1d m ON j.dt = m.dt AND j.page_id = m.page_id AND j.module_id = m.module_id
""")
DT = "strftime(dt, '%Y-%m-%d') AS dt"


@query(f"SELECT * REPLACE ({DT}) FROM z_mod1d")
def module_click_1d(i: Inputs):
    return module_1d(i)


@query(f"SELECT * REPLACE ({DT}) FROM z_guide")
def page_guide_conversion_1d(i: Inputs):
    return guide_1d(i)


@query(f"SELECT {txt('dt', 'dt')}, page_id, module_id, product_id, jump_count, user_count FROM (SELECT dt, page_id, module_id, product_id, count(*) AS jump_count, count(DISTINCT user_id) AS user_count FROM z_jump GROUP BY ALL)")
def product_from_page_1d(i: Inputs):
    return pages.product_from_page_1d(jumps(i))


@query(f"""
SELECT {txt('dt', 'dt')}, page_id, module_id, click_count, expo_count, click_rate, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY dt ORDER BY click_count DESC, page_id, module_id) AS rank FROM z_mod1d) WHERE rank <= 20
""")
def module_click_rank(i: Inputs):
    return pages.module_click_rank(module_1d(i))


@query(f"""
SELECT {txt('dt', 'dt')}, j AS total_jump, c AS total_click, e AS total_expo, CASE WHEN c <> 0 THEN round(cast(j as double) / c, 4) END AS click_conversion_rate,
       CASE WHEN e <> 0 THEN round(cast(j as double) / e, 4) END AS expo_conversion_rate
FROM (SELECT dt, cast(sum(guide_jump_count) as bigint) AS j, cast(sum(click_count) as bigint) AS c, cast(sum(expo_count) as bigint) AS e FROM z_guide GROUP BY dt)
""")
def page_conversion_trend(i: Inputs):
    return pages.page_conversion_trend(guide_1d(i))


cte("z_effect", """
SELECT module_id, e AS expo_count, c AS click_count, j AS jump_count, CASE WHEN e <> 0 THEN round(cast(c as double) / e, 4) END AS click_rate,
       CASE WHEN c <> 0 THEN round(cast(j as double) / c, 4) END AS jump_click_rate
FROM (SELECT module_id, cast(sum(guide_jump_count) as bigint) AS j, cast(sum(click_count) as bigint) AS c, cast(sum(expo_count) as bigint) AS e FROM z_guide GROUP BY module_id)
""")


@query("SELECT * FROM z_effect")
def module_guidance_effect(i: Inputs):
    return pages.module_guidance_effect(guide_1d(i))


@query("SELECT * FROM z_effect WHERE (click_rate < 0.5 OR jump_click_rate < 0.5) AND expo_count > 5")
def abnormal_modules(i: Inputs):
    return pages.abnormal_modules(pages.module_guidance_effect(guide_1d(i)), 0.5, 5)


# products

def behaviour_log(i: Inputs):
    k = F.col("k")
    return i.events().select(
        F.col("event_id").alias("log_id"), "user_id", F.concat_ws("_", "user_id", "dt").alias("session_id"), F.col("ts").alias("visit_time"),
        F.col("event_type").alias("page_type"), k.alias("product_id"), (k % 10).alias("store_id"),
        F.floor("value").cast("bigint").alias("stay_duration"), (k % 3 == 0).alias("is_bounce"), (k % 5 == 0).alias("is_micro_detail"))


def product_names(i: Inputs):
    return i.table("part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"))


def store_names(i: Inputs):
    return i.table("supplier").select(F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"))


def with_names(i: Inputs, log, time: str):
    return products.fact_with_product_store(log, product_names(i), store_names(i), time, EVENT_DAY)


def typed_log(i: Inputs, kind: str, time: str):
    k = F.col("k")
    return i.events().where(F.col("event_type") == kind).select(
        F.col("event_id").alias("log_id"), "user_id", k.alias("product_id"), (k % 10).alias("store_id"), F.col("ts").alias(time),
        (k % 7).alias("quantity"), money("value").alias("amount"), (k % 4 == 0).alias("gone"), (F.col("event_id") % 500).alias("order_id"))


def visit_summary(i: Inputs):
    return products.product_visit_summary(with_names(i, behaviour_log(i), "visit_time"))


def fav_summary(i: Inputs):
    return products.product_fav_summary(with_names(i, typed_log(i, "error", "fav_time").withColumnRenamed("gone", "is_cancelled"), "fav_time"))


def cart_summary(i: Inputs):
    return products.product_cart_summary(with_names(i, typed_log(i, "signup", "add_time").withColumnRenamed("gone", "is_deleted"), "add_time"))


def order_summary(i: Inputs):
    order = with_names(i, typed_log(i, "click", "order_time"), "order_time")
    pay = with_names(i, typed_log(i, "purchase", "pay_time").withColumnRenamed("amount", "pay_amount"), "pay_time")
    refund = with_names(i, typed_log(i, "error", "refund_time").withColumnRenamed("amount", "refund_amount"), "refund_time")
    return products.order_payment_summary(order, pay, refund)


cte("p_log", f"""
SELECT event_id AS log_id, user_id, event_type, ts, k AS product_id, k % 10 AS store_id, strftime(ts, '%Y%m%d') AS dt, cast(floor(value) as bigint) AS stay,
       k % 3 = 0 AS is_bounce, k % 5 = 0 AS is_micro, k % 7 AS quantity, cast(value as decimal(16,2)) AS amount, k % 4 = 0 AS gone, event_id % 500 AS order_id, k
FROM x_ev WHERE ts >= {E} - 29 AND ts < {E} + 1
""")
cte("p_visit", """
SELECT product_id, store_id, dt, count(DISTINCT log_id) AS pv, count(DISTINCT user_id) AS uv, cast(sum(stay) as double) / count(stay) AS avg_stay_time,
       1 - cast(sum(CASE WHEN NOT is_bounce THEN 1 ELSE 0 END) as double) / count(DISTINCT user_id) AS bounce_rate,
       cast(sum(CASE WHEN is_micro THEN 1 ELSE 0 END) as bigint) AS micro_detail_uv FROM p_log GROUP BY product_id, store_id, dt
""")
cte("p_fav", "SELECT product_id, store_id, dt, count(DISTINCT user_id) AS fav_user_cnt FROM p_log WHERE event_type = 'error' AND NOT gone GROUP BY ALL")
cte("p_cart", "SELECT product_id, store_id, dt, count(DISTINCT user_id) AS cart_user_cnt, cast(sum(quantity) as bigint) AS cart_total_qty FROM p_log WHERE event_type = 'signup' AND NOT gone GROUP BY ALL")
cte("p_order", """
SELECT product_id, store_id, dt, coalesce(order_user_cnt, 0) AS order_user_cnt, cast(coalesce(order_total_qty, 0) as bigint) AS order_total_qty,
       cast(coalesce(order_total_amt, 0) as double) AS order_total_amt, coalesce(pay_user_cnt, 0) AS pay_user_cnt, coalesce(pay_total_qty, 0) AS pay_total_qty,
       cast(coalesce(pay_total_amt, 0) as double) AS pay_total_amt, cast(coalesce(refund_amt, 0) as double) AS refund_amt
FROM (SELECT product_id, store_id, dt, count(DISTINCT order_id) AS order_user_cnt, sum(quantity) AS order_total_qty, sum(amount) AS order_total_amt FROM p_log WHERE event_type = 'click' GROUP BY ALL) o
FULL JOIN (SELECT product_id, store_id, dt, count(DISTINCT user_id) AS pay_user_cnt, count(*) AS pay_total_qty, sum(amount) AS pay_total_amt FROM p_log WHERE event_type = 'purchase' GROUP BY ALL) p USING (product_id, store_id, dt)
FULL JOIN (SELECT product_id, store_id, dt, sum(amount) AS refund_amt FROM p_log WHERE event_type = 'error' GROUP BY ALL) r USING (product_id, store_id, dt)
""")


@query(f"""
SELECT log_id, user_id, user_id || '_' || cast(ts as date) AS session_id, {tms('ts', 'visit_time')}, event_type AS page_type, product_id, store_id, stay AS stay_duration,
       is_bounce, is_micro AS is_micro_detail, p_name AS product_name, s_name AS store_name, dt
FROM p_log LEFT JOIN part ON product_id = p_partkey LEFT JOIN supplier ON store_id = s_suppkey
""")
def fact_with_product_store(i: Inputs):
    return with_names(i, behaviour_log(i), "visit_time")


@query(f"""
SELECT user_id, product_id, {tms('ts', 'action_time')}, CASE event_type WHEN 'view' THEN 'view' WHEN 'error' THEN 'fav' ELSE 'cart' END AS action_type, {txt('ts', 'dt')}
FROM p_log WHERE event_type IN ('view', 'error', 'signup')
""")
def fact_product_action(i: Inputs):
    return product_actions(i)


def product_actions(i: Inputs):
    def log(kind: str, time: str):
        return i.events().where(F.col("event_type") == kind).select("user_id", F.col("k").alias("product_id"), F.col("ts").alias(time), "dt")

    return products.fact_product_action(log("view", "visit_time"), log("error", "fav_time"), log("signup", "cart_time"))


@query("SELECT * FROM p_visit")
def product_visit_summary(i: Inputs):
    return visit_summary(i)


@query("SELECT * FROM p_fav")
def product_fav_summary(i: Inputs):
    return fav_summary(i)


@query("SELECT * FROM p_cart")
def product_cart_summary(i: Inputs):
    return cart_summary(i)


@query("SELECT * FROM p_order")
def order_payment_summary(i: Inputs):
    return order_summary(i)


@query("""
SELECT * EXCLUDE (f, c, q, o), coalesce(f, 0) AS fav_user_cnt, coalesce(c, 0) AS cart_user_cnt, coalesce(q, 0) AS cart_total_qty,
       coalesce(o.order_user_cnt, 0) AS order_user_cnt, coalesce(o.order_total_qty, 0) AS order_total_qty, coalesce(o.order_total_amt, 0) AS order_total_amt,
       coalesce(o.pay_user_cnt, 0) AS pay_user_cnt, coalesce(o.pay_total_qty, 0) AS pay_total_qty, coalesce(o.pay_total_amt, 0) AS pay_total_amt,
       coalesce(o.refund_amt, 0) AS refund_amt, cast(coalesce(o.pay_user_cnt, 0) as double) / uv AS conversion_rate,
       CASE WHEN uv >= 10000 THEN '10000+' WHEN uv >= 5000 THEN '5000-9999' WHEN uv >= 1000 THEN '1000-4999' WHEN uv >= 100 THEN '100-999' ELSE '0-99' END AS visit_interval
FROM (SELECT v.*, fav_user_cnt AS f, cart_user_cnt AS c, cart_total_qty AS q, o FROM p_visit v LEFT JOIN p_fav USING (product_id, store_id, dt)
      LEFT JOIN p_cart USING (product_id, store_id, dt) LEFT JOIN p_order o USING (product_id, store_id, dt))
""")
def product_efficiency_monitor(i: Inputs):
    return products.product_efficiency_monitor(visit_summary(i), fav_summary(i), cart_summary(i), order_summary(i))


def overview(i: Inputs):
    return products.product_efficiency_overview(visit_summary(i), fav_summary(i), cart_summary(i), order_summary(i))


def _rate(part: str, whole: str, digits: int = 4) -> str:
    return f"CASE WHEN {whole} > 0 THEN round(cast({part} as double) / {whole}, {digits}) ELSE 0.0 END"


def _money_rate(part: str, whole: str) -> str:
    """Amount per unit in whole cents, halves up."""
    return f"CASE WHEN {whole} > 0 THEN cast((2 * cast(round({part} * 100) as bigint) + {whole}) // (2 * {whole}) as double) / 100 ELSE 0.0 END"


cte("p_over", f"""
SELECT product_id, store_id, dt, pv, uv, cast(round(cast(avg_stay_time * uv / uv as decimal(20,10)), 2) as double) AS avg_stay_time, cast(round(cast(bounce_rate * pv / pv as decimal(20,10)), 4) as double) AS bounce_rate, micro_detail_uv,
       fav_user_cnt, cart_user_cnt, cart_total_qty, order_user_cnt, order_total_qty, order_total_amt, pay_user_cnt, pay_total_qty, pay_total_amt, refund_amt,
       {_rate('pay_user_cnt', 'uv')} AS pay_rate, {_rate('order_user_cnt', 'uv')} AS order_rate, {_rate('fav_user_cnt', 'uv')} AS fav_rate,
       {_rate('cart_user_cnt', 'uv')} AS cart_rate, {_money_rate('pay_total_amt', 'pay_user_cnt')} AS item_per_pay_user, {_money_rate('pay_total_amt', 'uv')} AS visitor_value
FROM p_visit LEFT JOIN p_fav USING (product_id, store_id, dt) LEFT JOIN p_cart USING (product_id, store_id, dt) LEFT JOIN p_order USING (product_id, store_id, dt)
""")


@query("SELECT * FROM p_over")
def product_efficiency_overview(i: Inputs):
    return overview(i)


@query(f"""
SELECT store_id, {big('sum(pv)', 'pv')}, {big('sum(uv)', 'uv')}, {big('sum(order_user_cnt)', 'order_user_cnt')}, {big('sum(pay_user_cnt)', 'pay_user_cnt')},
       {dbl('sum(cast(order_total_amt as decimal(20,2)))', 'order_total_amt')}, {dbl('sum(cast(pay_total_amt as decimal(20,2)))', 'pay_total_amt')} FROM p_over GROUP BY store_id
""")
def store_efficiency_summary(i: Inputs):
    return products.store_efficiency_summary(overview(i))


def _over_days(by: str) -> str:
    def mean(value: str, weight: str, digits: int) -> str:
        known = f"sum(CASE WHEN {value} IS NOT NULL THEN {weight} END)"
        return f"CASE WHEN {known} > 0 THEN cast(round(cast(cast(sum(cast({value} as decimal(20,6)) * cast({weight} as decimal(10,0))) as double) / {known} as decimal(20,10)), {digits}) as double) END AS {value}"

    counts = ("pv", "uv", "micro_detail_uv", "fav_user_cnt", "cart_user_cnt", "cart_total_qty", "order_user_cnt", "order_total_qty", "pay_user_cnt", "pay_total_qty")
    amounts = ("order_total_amt", "pay_total_amt", "refund_amt")
    sums = [big(f"coalesce(sum({c}), 0)", c) for c in counts] + [dbl(f"coalesce(sum(cast({c} as decimal(20,2))), 0)", c) for c in amounts]
    return f"""
SELECT *, {_rate('pay_user_cnt', 'uv')} AS pay_rate, {_rate('order_user_cnt', 'uv')} AS order_rate, {_rate('fav_user_cnt', 'uv')} AS fav_rate,
       {_rate('cart_user_cnt', 'uv')} AS cart_rate, {_money_rate('pay_total_amt', 'pay_user_cnt')} AS item_per_pay_user, {_money_rate('pay_total_amt', 'uv')} AS visitor_value
FROM (SELECT {by}, count(DISTINCT dt) AS days, {mean('avg_stay_time', 'uv', 2)}, {mean('bounce_rate', 'pv', 4)}, {', '.join(sums)} FROM p_over GROUP BY {by})
"""


@query(_over_days("product_id, store_id"))
def product_efficiency_over_days(i: Inputs):
    return products.efficiency_over_days(overview(i), ["product_id", "store_id"])


@query(_over_days("store_id"))
def store_efficiency_over_days(i: Inputs):
    return products.efficiency_over_days(overview(i), ["store_id"])


@query(f"""
SELECT product_id, store_id, dt, uv, micro_detail_uv AS click_uv, order_user_cnt AS order_uv, pay_user_cnt AS pay_uv, {_rate('micro_detail_uv', 'uv')} AS click_rate,
       {_rate('order_user_cnt', 'micro_detail_uv')} AS order_rate, {_rate('pay_user_cnt', 'order_user_cnt')} AS pay_rate
FROM p_visit LEFT JOIN p_order USING (product_id, store_id, dt)
""")
def product_conversion_rate(i: Inputs):
    return products.product_conversion_rate(visit_summary(i), order_summary(i))


@query("""
SELECT product_id, store_id, dt, uv, pay_user_cnt, order_user_cnt, bounce_rate, pay_rate, visitor_value,
       CASE WHEN order_rate >= 0.3 THEN '高转化' WHEN order_rate >= 0.1 THEN '中转化' ELSE '低转化' END AS conversion_segment,
       CASE WHEN visitor_value >= 200 THEN '高价值' WHEN visitor_value >= 100 THEN '中价值' ELSE '低价值' END AS pay_segment,
       CASE WHEN bounce_rate >= 0.5 THEN '高跳出' WHEN bounce_rate >= 0.2 THEN '中跳出' ELSE '低跳出' END AS bounce_segment FROM p_over
""")
def product_segments(i: Inputs):
    return products.product_segments(overview(i))


def summary(i: Inputs):
    orders = i.events().where(F.col("event_type") == "purchase").select(
        "user_id", F.col("k").alias("product_id"), (F.col("k") % 7).alias("quantity"), money("value").alias("payment_amount"), "dt")
    return products.product_summary(orders, product_actions(i))


cte("p_sum", """
SELECT o.product_id, o.dt, pay_user_cnt, pay_qty, pay_amt, coalesce(v, 0) AS view_user_cnt, coalesce(f, 0) AS fav_user_cnt, coalesce(c, 0) AS cart_user_cnt
FROM (SELECT k AS product_id, dt, count(DISTINCT user_id) AS pay_user_cnt, cast(sum(k % 7) as bigint) AS pay_qty, cast(sum(cast(value as decimal(16,2))) as double) AS pay_amt
      FROM x_ev WHERE event_type = 'purchase' GROUP BY ALL) o
LEFT JOIN (SELECT k AS product_id, dt, count(DISTINCT CASE WHEN event_type = 'view' THEN user_id END) AS v, count(DISTINCT CASE WHEN event_type = 'error' THEN user_id END) AS f,
      count(DISTINCT CASE WHEN event_type = 'signup' THEN user_id END) AS c FROM x_ev GROUP BY ALL) a USING (product_id, dt)
""")


@query(f"SELECT * REPLACE ({DT}) FROM p_sum")
def product_summary(i: Inputs):
    return summary(i)


@query("SELECT strftime(dt, '%Y-%m-%d') AS dt, product_id, pay_amt, row_number() OVER (PARTITION BY p_sum.dt ORDER BY pay_amt DESC, product_id) AS rank_by_amt FROM p_sum")
def product_sales_rank(i: Inputs):
    return products.product_sales_rank(summary(i))


@query("SELECT strftime(dt, '%Y-%m-%d') AS dt, product_id, pay_qty, row_number() OVER (PARTITION BY p_sum.dt ORDER BY pay_qty DESC, product_id) AS rank_by_qty FROM p_sum")
def product_quantity_rank(i: Inputs):
    return products.product_quantity_rank(summary(i))


@query(f"""
SELECT strftime(dt, '%Y-%m-%d') AS dt, product_id, pay_user_cnt, view_user_cnt, r AS conversion_rate, row_number() OVER (PARTITION BY s.dt ORDER BY r DESC, product_id) AS rank_by_conversion
FROM (SELECT *, {_rate('pay_user_cnt', 'view_user_cnt')} AS r FROM p_sum) s
""")
def product_conversion_rank(i: Inputs):
    return products.product_conversion_rank(summary(i))


# linkage

MAIN = list(range(50))
MAIN_SQL = ", ".join(str(n) for n in MAIN)


def actions(i: Inputs):
    kind = (
        F.when(F.col("event_type") == "signup", "cart").when(F.col("event_type") == "purchase", "pay")
        .when(F.col("event_type") == "error", "detail").otherwise(F.col("event_type"))
    )
    return i.events().select("user_id", F.col("k").alias("sku_id"), kind.alias("action_type"), F.col("ts").alias("action_time"),
                             F.concat(F.lit("ch"), F.col("user_id") % 4).alias("channel"), "dt")


cte("l_act", """
SELECT user_id, k AS sku_id, CASE event_type WHEN 'signup' THEN 'cart' WHEN 'purchase' THEN 'pay' WHEN 'error' THEN 'detail' ELSE event_type END AS action_type,
       ts AS action_time, 'ch' || (user_id % 4) AS channel, dt FROM x_ev
""")


@query(f"""
SELECT user_id, sku_id, action_type, {tms('action_time', 'action_time')}, channel, {txt('dt', 'dt')}, s.sku_name, s.tm_id AS brand_id, s.category3_id AS category_id, {dbl('price', 'price')}
FROM l_act a LEFT JOIN x_sku s ON a.sku_id = s.id
""")
def fact_user_sku_action(i: Inputs):
    sku = i.sku().select(F.col("id").alias("sku_id"), "sku_name", F.col("tm_id").alias("brand_id"), F.col("category3_id").alias("category_id"), "price")
    return linkage.fact_user_sku_action(actions(i), sku)


cte("l_rel", f"""
SELECT a.sku_id AS main_sku, b.sku_id AS related_sku, b.action_type, count(*) AS action_cnt FROM l_act a JOIN l_act b
  ON a.user_id = b.user_id AND b.action_time BETWEEN a.action_time - interval 30 minutes AND a.action_time + interval 30 minutes AND a.sku_id <> b.sku_id
WHERE a.sku_id IN ({MAIN_SQL}) AND a.action_time >= {E} - 29 AND a.action_time < {E} + 1 GROUP BY ALL
""")


def related(i: Inputs):
    return linkage.related_actions(actions(i), MAIN, EVENT_DAY, days=30)


@query("SELECT * FROM l_rel")
def related_actions(i: Inputs):
    return related(i)


@query(f"""
SELECT main_sku, related_sku, {', '.join(big(f"sum(CASE WHEN action_type = '{k}' THEN action_cnt ELSE 0 END)", f'related_{k}_cnt') for k in ('click', 'cart', 'pay'))}
FROM l_rel GROUP BY main_sku, related_sku
""")
def related_behaviour_pivot(i: Inputs):
    return linkage.related_behaviour_pivot(related(i))


@query(f"""
WITH v AS (SELECT DISTINCT user_id, sku_id AS main_sku_id FROM l_act WHERE sku_id IN ({MAIN_SQL}) AND action_type = 'view')
SELECT main_sku_id, sku_id AS related_sku_id, count(DISTINCT CASE WHEN action_type = 'view' THEN l_act.user_id END) AS visit_user_count,
       count(DISTINCT CASE WHEN action_type = 'cart' THEN l_act.user_id END) AS cart_user_count, count(DISTINCT CASE WHEN action_type = 'order' THEN l_act.user_id END) AS order_user_count
FROM v JOIN (SELECT * REPLACE (CASE action_type WHEN 'pay' THEN 'order' ELSE action_type END AS action_type) FROM l_act) l_act ON v.user_id = l_act.user_id
WHERE sku_id NOT IN ({MAIN_SQL}) GROUP BY ALL
""")
def sku_linkage(i: Inputs):
    day_actions = actions(i).withColumn("action_type", F.when(F.col("action_type") == "pay", "order").otherwise(F.col("action_type")))
    return linkage.sku_linkage(day_actions, MAIN)


@query(f"SELECT sku_id, {', '.join(f'''count(DISTINCT CASE WHEN action_type = '{k}' THEN user_id END) AS {k}_uv''' for k in ('detail', 'click', 'cart', 'pay'))} FROM l_act GROUP BY sku_id")
def detail_guide(i: Inputs):
    return linkage.detail_guide(actions(i))


@query(f"""
SELECT item_id, cast(sum(n) as bigint) AS total_uv FROM (SELECT k AS item_id, dt, count(DISTINCT user_id) AS n FROM x_ev WHERE dt BETWEEN {E} - 6 AND {E} GROUP BY ALL)
GROUP BY item_id ORDER BY total_uv DESC, item_id LIMIT 10
""")
def top_traffic_items(i: Inputs):
    daily = i.events().groupBy(F.col("k").alias("item_id"), "dt").agg(F.count_distinct("user_id").alias("pv_uv"))
    return linkage.top_traffic_items(daily, EVENT_DAY)


# visits

@query("""
WITH f AS (SELECT user_id, min(ts) AS t FROM x_ev WHERE event_type = 'purchase' GROUP BY 1)
SELECT e.user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS pay_time, cast(value as double) AS money, event_id AS order_id
FROM x_ev e JOIN f ON e.user_id = f.user_id AND ts = t WHERE event_type = 'purchase' AND month(t) = 1
""")
def first_purchase_in_month(i: Inputs):
    e = i.events().where(F.col("event_type") == "purchase").select("user_id", F.col("ts").alias("pay_time"), F.col("value").alias("money"), F.col("event_id").alias("order_id"))
    return visits.first_purchase_in_month(e, 1)


@query("""
SELECT user_id AS address, event_type AS endpoint, count(*) AS hits FROM x_ev WHERE event_type = 'click' AND ts >= timestamp '2024-01-09 08:00:00' AND ts < timestamp '2024-01-09 20:00:00'
GROUP BY ALL ORDER BY hits DESC, address LIMIT 10
""")
def top_addresses(i: Inputs):
    log = i.events().select(F.col("user_id").alias("address"), F.col("event_type").alias("endpoint"), F.col("ts").alias("log_time"))
    return visits.top_addresses(log, "click", "2024-01-09 08:00:00", "2024-01-09 20:00:00")


@query("""
SELECT user_id, month, visits, cast(sum(visits) OVER (PARTITION BY user_id ORDER BY month) as bigint) AS visits_to_date
FROM (SELECT o_custkey AS user_id, strftime(o_orderdate, '%Y-%m') AS month, cast(sum(o_orderkey % 5) as bigint) AS visits FROM orders GROUP BY ALL)
""")
def monthly_visits(i: Inputs):
    return visits.monthly_visits(i.table("orders").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("visit_date"), (F.col("o_orderkey") % 5).alias("visit_count")))


def shop_log(i: Inputs):
    return i.events().select((F.col("k") % 10).alias("shop"), "user_id")


@query("SELECT k % 10 AS shop, count(DISTINCT user_id) AS uv FROM x_ev GROUP BY 1")
def shop_visitors(i: Inputs):
    return visits.shop_visitors(shop_log(i))


@query("""
SELECT shop, user_id, visits, rank FROM (SELECT *, rank() OVER (PARTITION BY shop ORDER BY visits DESC) AS rank FROM
  (SELECT k % 10 AS shop, user_id, count(*) AS visits FROM x_ev GROUP BY ALL)) WHERE rank <= 3
""")
def shop_top_visitors(i: Inputs):
    return visits.shop_top_visitors(shop_log(i))


def plain_orders(i: Inputs):
    return i.table("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
                                    F.to_date("o_orderdate").alias("order_date"), money("o_totalprice").alias("amount"))


@query(f"""
SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS orders, count(DISTINCT o_custkey) AS users, {dbl('sum(cast(o_totalprice as decimal(16,2)))', 'amount')}
FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1
""")
def monthly_orders(i: Inputs):
    return visits.monthly_orders(plain_orders(i), 1997)


@query("SELECT month, count(*) AS new_customers FROM (SELECT strftime(min(o_orderdate), '%Y-%m') AS month FROM orders GROUP BY o_custkey) GROUP BY month")
def new_customers_by_month(i: Inputs):
    return visits.new_customers_by_month(plain_orders(i))


@query("SELECT count(*) AS new_customers FROM (SELECT strftime(min(o_orderdate), '%Y-%m') AS month FROM orders GROUP BY o_custkey) WHERE month = '1995-11'")
def new_customers_in_month(i: Inputs):
    return visits.new_customers_in(plain_orders(i), "1995-11")


@query("""
WITH v AS (SELECT DISTINCT user_id, 18 + user_id % 50 AS age, dt FROM x_ev WHERE event_type = 'purchase'),
a AS (SELECT DISTINCT v.user_id, v.age FROM v JOIN v w ON v.user_id = w.user_id AND w.dt = v.dt + 1)
SELECT (SELECT count(DISTINCT user_id) FROM v) AS users, (SELECT count(DISTINCT user_id) FROM a) AS active_users,
       (SELECT round(avg(DISTINCT age), 2) FROM v) AS mean_age, (SELECT round(avg(DISTINCT age), 2) FROM a) AS active_mean_age
""")
def two_day_active(i: Inputs):
    return visits.two_day_active(i.events().where(F.col("event_type") == "purchase").select(
        "user_id", (18 + F.col("user_id") % 50).alias("age"), F.col("dt").alias("visit_date")))


@query("""
WITH t AS (SELECT c_name AS name, sum(cast(o_totalprice as decimal(16,2))) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
SELECT name, cast(total as double) AS total, row_number() OVER (ORDER BY total DESC, name) AS rank,
       printf('%.2f', round(round(cast(total as double) / (SELECT cast(sum(total) as double) FROM t), 4) * 100, 2)) || '%' AS ratio FROM t
""")
def totals_with_share(i: Inputs):
    o = i.table("orders").join(i.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return visits.totals_with_share(o.select(F.col("c_name").alias("name"), money("o_totalprice").alias("amount")))


@query(f"""
WITH d AS (SELECT DISTINCT user_id, dt FROM x_login), f AS (SELECT user_id, min(dt) AS first FROM d GROUP BY 1)
SELECT {txt('dt', 'login_date')}, {big('sum(CASE WHEN dt = first THEN 1 ELSE 0 END)', 'new_user_cnt')}, {big('sum(CASE WHEN dt > first THEN 1 ELSE 0 END)', 'old_user_cnt')}
FROM d JOIN f USING (user_id) GROUP BY dt
""")
def daily_new_returning(i: Inputs):
    return visits.daily_new_returning(i.logins().select("user_id", F.col("dt").alias("login_date")))
