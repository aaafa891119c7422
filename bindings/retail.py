"""E-commerce operators: dimensions, facts, summaries, results."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.ctes import cte
from bindings.inputs import EVENT_DAY, TRADE_DAY, Inputs
from bindings.register import big, dbl, query, tms, txt
from tidemill.operators.latest import dim_upsert_latest, scd2_merge
from tidemill.plans import dims, facts, reports, summaries

T = f"date '{TRADE_DAY}'"
E = f"date '{EVENT_DAY}'"
AMOUNTS = ", ".join(dbl(e, n) for e, n in (
    ("original", "split_original_amount"), ("coalesce(act_cut, 0)", "split_activity_amount"),
    ("coalesce(cou_cut, 0)", "split_coupon_amount")))
SKU = ("sku_name, category1_id, category1_name, category2_id, category2_name, category3_id, category3_name, tm_id, tm_name")
PROV = "province_name, area_code, iso_code, iso_3166_2"


# dimensions

@query(f"""
SELECT s.id, {dbl('price', 'price')}, sku_name, lower(sku_name) AS sku_desc, cast(weight as bigint) AS weight,
       cast(is_sale as bigint) AS is_sale, sku_name AS spu_id, upper(sku_name) AS spu_name, category3_id, category3_name,
       category2_id, category2_name, category1_id, category1_name, tm_id, tm_name, a.flags, b.statuses
FROM x_sku s
LEFT JOIN (SELECT l_partkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY 1) a ON s.id = a.l_partkey
LEFT JOIN (SELECT l_partkey, string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS statuses FROM lineitem GROUP BY 1) b ON s.id = b.l_partkey
""")
def dim_sku(i: Inputs):
    wide = dims.dim_sku(**i.raw_sku())
    return wide.withColumns({
        "flags": F.concat_ws(",", F.col("sku_attr_values.value_id")),
        "statuses": F.concat_ws(",", F.col("sku_sale_attr_values.sale_attr_value_id")),
    }).drop("sku_attr_values", "sku_sale_attr_values", "create_time")


@query(f"""
SELECT id, coupon_name, coupon_type_code, coupon_type_name, {dbl('condition_amount', 'condition_amount')}, condition_num,
       activity_id, {dbl('benefit_amount', 'benefit_amount')}, benefit_discount, benefit_rule, range_type_code, range_type_name,
       limit_num, taken_count FROM x_coupon
""")
def dim_coupon(i: Inputs):
    return dims.dim_coupon(i.raw_coupon(), i.dictionary()).drop(
        "create_time", "start_time", "end_time", "operate_time", "expire_time")


@query("""
SELECT a * 10 + n AS activity_rule_id, a AS activity_id, 'activity ' || a AS activity_name, '310' || (n % 4) AS activity_type_code,
       d.dic_name AS activity_type_name, 'cut ' || a AS activity_desc, cast(a * 50 as double) AS condition_amount, n AS condition_num,
       cast(a * 3 as double) AS benefit_amount, 10 - n AS benefit_discount,
       CASE n % 4 WHEN 1 THEN '满' || cast(a * 50 as decimal(16,2)) || '元减' || cast(a * 3 as decimal(16,2)) || '元'
                  WHEN 2 THEN '满' || n || '件打' || (10 - n) || ' 折' WHEN 3 THEN '打' || (10 - n) || '折' END AS benefit_rule,
       n AS benefit_level
FROM (SELECT DISTINCT cast(round(l_discount * 100) as bigint) AS a, cast(l_linenumber as bigint) AS n FROM lineitem WHERE l_discount > 0) r
LEFT JOIN x_dic d ON d.parent_code = '31' AND d.dic_code = '310' || (n % 4)
""")
def dim_activity(i: Inputs):
    return dims.dim_activity(i.raw_activity_rule(), i.raw_activity(), i.dictionary()).drop("start_time", "end_time", "create_time")


@query("SELECT id, province_name, area_code, iso_code, iso_3166_2, cast(region_id as bigint) AS region_id, region_name FROM x_province")
def dim_province(i: Inputs):
    return dims.dim_province(i.raw_province(), i.raw_region())


@query("""
SELECT s_suppkey AS id, s_name AS pos_location, 'p' || (s_suppkey % 3) AS pos_type, 't' || (s_suppkey % 2) AS promotion_type FROM supplier
""")
def dim_promotion_pos(i: Inputs):
    raw = i.table("supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("pos_location"),
        F.concat(F.lit("p"), F.col("s_suppkey") % 3).alias("pos_type"),
        F.concat(F.lit("t"), F.col("s_suppkey") % 2).alias("promotion_type"),
        F.lit(None).cast("timestamp").alias("create_time"), F.lit(None).cast("timestamp").alias("operate_time"), "s_acctbal")
    return dims.dim_promotion_pos(raw).drop("create_time", "operate_time")


@query("SELECT s_suppkey AS id, 'refer ' || s_name AS refer_name FROM supplier")
def dim_promotion_refer(i: Inputs):
    raw = i.table("supplier").select(
        F.col("s_suppkey").alias("id"), F.concat(F.lit("refer "), "s_name").alias("refer_name"),
        F.lit(None).cast("timestamp").alias("create_time"), F.lit(None).cast("timestamp").alias("operate_time"))
    return dims.dim_promotion_refer(raw).drop("create_time", "operate_time")


@query(f"""
SELECT {txt('d', 'date')}, {big('weekofyear(d)', 'week')}, {big('month(d)', 'month')}, {big('quarter(d)', 'quarter')},
       {big('year(d)', 'year')}, {big('day(d)', 'day')}, {big('dayofweek(d) + 1', 'week_day')},
       CASE WHEN dayofweek(d) IN (0, 6) THEN 'Y' ELSE 'N' END AS is_weekend,
       CASE WHEN d IN (date '1996-01-01', date '1997-10-01') THEN 'Y' ELSE 'N' END AS is_holiday
FROM (SELECT cast(unnest(generate_series(min(cast(o_orderdate as date)), max(cast(o_orderdate as date)), interval 1 day)) as date) AS d FROM orders)
""")
def dim_date(i: Inputs):
    """Every day from the first to the last order."""
    day = F.to_date("o_orderdate")
    days = i.table("orders").agg(F.min(day).alias("first"), F.max(day).alias("last")).select(F.explode(F.sequence("first", "last")).alias("date"))
    return dims.calendar(days, ["1996-01-01", "1997-10-01"])


def people(i: Inputs):
    """A customer's name, a made-up phone number and each mail address of the document of the same number."""
    doc = F.col("doc_id")
    phone = F.when(doc % 3 == 0, F.concat(F.lit("1"), 30 + doc % 60, F.lpad((doc * 7919 % 100000000).cast("string"), 8, "0"))).otherwise(doc.cast("string"))
    mails = F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9._+-]+@[A-Za-z0-9._-]+"), F.lit(0))
    found = i.table("documents").select("doc_id", phone.alias("phone_num"), F.explode_outer(mails).alias("email"))
    return found.join(i.table("customer"), F.col("c_custkey") == doc, "left").select("doc_id", F.col("c_name").alias("name"), "phone_num", "email")


@query("""
WITH raw AS (
  SELECT doc_id, c_name AS name, unnest(CASE WHEN len(mails) = 0 THEN [NULL] ELSE mails END) AS email,
         CASE WHEN doc_id % 3 = 0 THEN '1' || (30 + doc_id % 60) || lpad((doc_id * 7919 % 100000000) || '', 8, '0') ELSE doc_id || '' END AS phone
  FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9._+-]+@[A-Za-z0-9._-]+') AS mails FROM documents) LEFT JOIN customer ON c_custkey = doc_id)
SELECT doc_id, substring(name, 1, 1) || '*' AS name,
  CASE WHEN regexp_matches(phone, '^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])[0-9]{8}$') THEN substring(phone, 1, 3) || '*' END AS phone_num,
  CASE WHEN regexp_matches(email, '^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\\.[a-zA-Z0-9_-]+)+$') THEN '*@' || split_part(email, '@', 2) END AS email
FROM raw
""")
def mask_pii(i: Inputs):
    return dims.mask_pii(people(i))


@query("""
WITH raw AS (
  SELECT doc_id, c_name AS name, unnest(CASE WHEN len(mails) = 0 THEN [NULL] ELSE mails END) AS email,
         CASE WHEN doc_id % 3 = 0 THEN '1' || (30 + doc_id % 60) || lpad((doc_id * 7919 % 100000000) || '', 8, '0') ELSE doc_id || '' END AS phone
  FROM (SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9._+-]+@[A-Za-z0-9._-]+') AS mails FROM documents) LEFT JOIN customer ON c_custkey = doc_id)
SELECT doc_id, substring(name, 1, 1) || '*' AS name,
  CASE WHEN regexp_matches(phone, '^1[3-9][0-9]{9}$') THEN substring(phone, 1, 3) || '****' || substring(phone, 8) END AS phone_num,
  CASE WHEN regexp_matches(email, '^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\\.[a-zA-Z0-9-.]+$') THEN '***@' || split_part(email, '@', 2) END AS email
FROM raw
""")
def mask_pii_daily(i: Inputs):
    return dims.mask_pii(people(i), daily=True)


# History: every customer starts open on the first day; those with an order on the last day change level.
@query(f"""
WITH changed AS (SELECT o_custkey, max(o_orderpriority) AS level FROM orders WHERE cast(o_orderdate as date) = {T} GROUP BY 1),
hist AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS user_level, date '1995-01-01' AS start_date,
         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN date '1999-12-31' ELSE date '9999-12-31' END AS end_date FROM customer
         UNION ALL SELECT c_custkey, c_name, lower(c_mktsegment), date '2000-01-01', date '9999-12-31' FROM customer WHERE c_mktsegment = 'HOUSEHOLD')
SELECT h.id, name, user_level, {txt('start_date', 'start_date')},
       strftime(CASE WHEN end_date = date '9999-12-31' AND o_custkey IS NOT NULL THEN {T} - 1 ELSE end_date END, '%Y-%m-%d') AS end_date
FROM hist h LEFT JOIN changed ON h.id = o_custkey
UNION ALL
SELECT c_custkey, c_name, level, '{TRADE_DAY}', '9999-12-31' FROM changed JOIN customer ON c_custkey = o_custkey
""")
def scd2_user_history(i: Inputs):
    c, o = i.table("customer"), i.table("orders")
    old = F.col("c_mktsegment") == "HOUSEHOLD"
    open_end = F.lit("9999-12-31").cast("date")
    base = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("user_level"),
                    F.lit("1995-01-01").cast("date").alias("start_date"),
                    F.when(old, F.lit("1999-12-31").cast("date")).otherwise(open_end).alias("end_date"))
    later = c.where(old).select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lower("c_mktsegment").alias("user_level"),
                                F.lit("2000-01-01").cast("date").alias("start_date"), open_end.alias("end_date"))
    changes = o.where(F.to_date("o_orderdate") == F.lit(TRADE_DAY).cast("date")).join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("o_orderpriority").alias("user_level"))
    return scd2_merge(base.unionByName(later), changes, "id", TRADE_DAY, ["user_level"])


@query("""
SELECT user_id, o_orderkey AS order_id, cast(o_totalprice as double) AS amount, strftime(o_orderdate, '%Y-%m-%d') AS dt FROM (
  SELECT o_custkey AS user_id, *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderstatus <> 'P') WHERE rn = 1
""")
def dim_upsert_latest_order(i: Inputs):
    changes = i.table("orders").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("amount"),
        F.to_date("o_orderdate").alias("dt"), F.when(F.col("o_orderstatus") == "P", "d").otherwise("u").alias("op"))
    return dim_upsert_latest(changes, ["user_id"], ["dt", "order_id"])


@query("""
SELECT DISTINCT category3_id, category3_id AS category3_name, category2_id, category2_id AS category2_name, category1_id, category1_id AS category1_name FROM x_sku
""")
def dim_category_paths(i: Inputs):
    return dims.category_paths(dims.dim_category(i.categories(), ["c1", "c2", "c3"]))


@query("""
SELECT DISTINCT category1_id AS cat_id, category1_id AS cat_name, cast(1 as bigint) AS level, cast(NULL as varchar) AS parent_id FROM x_sku
UNION ALL SELECT DISTINCT category2_id, category2_id, 2, category1_id FROM x_sku
UNION ALL SELECT DISTINCT category3_id, category3_id, 3, category2_id FROM x_sku
""")
def dim_category(i: Inputs):
    return dims.dim_category(i.categories(), ["c1", "c2", "c3"])


@query("SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand_id, p_type AS cat_id, cast(p_retailprice as double) AS price FROM part")
def dim_product(i: Inputs):
    return dims.dim_product(i.table("part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"), F.col("p_brand").alias("brand_id"),
        F.col("p_type").alias("cat_id"), F.col("p_retailprice").alias("price")))


@query("SELECT s_suppkey AS store_id, s_name AS store_name, n_name AS region FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def dim_store(i: Inputs):
    return dims.dim_store(i.table("supplier").join(i.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"), F.col("n_name").alias("region")))


@query("SELECT DISTINCT p_brand AS brand_id, p_brand AS brand_name FROM part")
def dim_brand(i: Inputs):
    return dims.dim_brand(i.table("part").select(F.col("p_brand").alias("brand_id")))


@query("SELECT DISTINCT 'd' || user_id AS device_id, 'dt' || (user_id % 3) AS device_type, 'os' || (user_id % 2) AS os_type, 'v' || (k % 5) AS app_version FROM x_ev")
def dim_device(i: Inputs):
    u = F.col("user_id")
    return dims.dim_device(i.events().select(
        F.concat(F.lit("d"), u).alias("device_id"), F.concat(F.lit("dt"), u % 3).alias("device_type"),
        F.concat(F.lit("os"), u % 2).alias("os_type"), F.concat(F.lit("v"), F.col("k") % 5).alias("app_version")))


@query("""
SELECT c_custkey AS user_id, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, 18 + c_custkey % 50 AS age, n_name AS province, r_name AS city
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def dim_user(i: Inputs):
    c = i.table("customer").join(i.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
        i.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return dims.dim_user(c.select(
        F.col("c_custkey").alias("user_id"), F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"),
        (18 + F.col("c_custkey") % 50).alias("age"), F.col("n_name").alias("province"), F.col("r_name").alias("city")))


# facts

@query(f"SELECT id, user_id, sku_id, {txt('create_time', 'date_id')}, {tms('create_time', 'create_time')}, sku_num, {txt('dt', 'dt')} FROM x_cart")
def fact_cart_add(i: Inputs):
    return facts.fact_cart_add(i.raw_cart())


@query(f"""
SELECT id, order_id, user_id, sku_id, province_id, activity_id, activity_rule_id, coupon_id, {txt('dt', 'date_id')},
       {tms('create_time', 'create_time')}, sku_num, {AMOUNTS}, {dbl('total', 'split_total_amount')}, {txt('dt', 'dt')} FROM x_od
""")
def fact_order_detail(i: Inputs):
    return facts.fact_order_detail(i.raw_order_detail(), i.raw_orders(), i.raw_detail_activity(), i.raw_detail_coupon())


_PAY = f"""
SELECT id, order_id, user_id, sku_id, province_id, activity_id, activity_rule_id, coupon_id, payment_type AS payment_type_code,
       dic_name AS payment_type_name, {txt('pay_dt', 'date_id')}, {tms('callback_time', 'callback_time')}, sku_num, {AMOUNTS},
       {dbl('total', 'split_payment_amount')}, {txt('pay_dt', 'dt')}
FROM x_payd LEFT JOIN x_dic ON parent_code = '11' AND dic_code = payment_type
"""


@query(_PAY)
def fact_payment_success(i: Inputs):
    return facts.fact_payment_success(i.raw_order_detail(), i.raw_payment(), i.raw_orders(), i.raw_detail_activity(),
                                      i.raw_detail_coupon(), i.dictionary())


@query(_PAY + "WHERE payment_status = '1602'")
def fact_payment_success_by_status(i: Inputs):
    return facts.fact_payment_success(i.raw_order_detail(), i.raw_payment(), i.raw_orders(), i.raw_detail_activity(),
                                      i.raw_detail_coupon(), i.dictionary(), paid_only=True)


# A day in mid-range, so that both the day and the day before hold paid orders.
@query(_PAY + "WHERE pay_dt = date '2000-06-11' AND dt IN (date '2000-06-11', date '2000-06-10')")
def fact_payment_success_daily(i: Inputs):
    d = i.of_days("2000-06-10", "2000-06-11")
    return facts.fact_payment_success(d.raw_order_detail(), d.raw_payment(), d.raw_orders(), d.raw_detail_activity(day=True),
                                      d.raw_detail_coupon(day=True), i.dictionary(), as_of="2000-06-11")


@query("SELECT id, user_id, sku_id, sku_name, sku_num FROM x_cart WHERE is_ordered = '0'")
def fact_cart_snapshot(i: Inputs):
    return facts.fact_cart_snapshot(i.raw_cart())


cte("x_flow", """
SELECT o_orderkey AS order_id, o_custkey AS user_id, cast(c_nationkey as bigint) AS province_id, o_orderdate AS order_time,
       callback_time AS payment_time, CASE WHEN o_orderstatus = 'F' THEN o_orderdate + interval 20 days END AS finish_time,
       cast(o_totalprice as decimal(16,2)) AS price, p.total_amount AS payment_amount
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN x_pay p ON o_orderkey = p.order_id
""")


@query(f"""
SELECT order_id, user_id, province_id, {txt('order_time', 'order_date_id')}, {tms('order_time', 'order_time')},
       {txt('payment_time', 'payment_date_id')}, {tms('payment_time', 'payment_time')}, {txt('finish_time', 'finish_date_id')},
       {tms('finish_time', 'finish_time')}, {dbl('price', 'order_original_amount')},
       {dbl('cast(price * 0.05 as decimal(16,2))', 'order_activity_amount')}, {dbl('cast(price * 0.01 as decimal(16,2))', 'order_coupon_amount')},
       {dbl('cast(price * 0.94 as decimal(16,2))', 'order_total_amount')}, {dbl('coalesce(payment_amount, 0)', 'payment_amount')}
FROM x_flow
""")
def fact_trade_flow_acc(i: Inputs):
    return facts.fact_trade_flow_acc(i.raw_orders(), i.raw_payment(), i.status_log())


@query(f"SELECT id, coupon_id, user_id, order_id, {txt('get_time', 'date_id')}, {tms('used_time', 'payment_time')}, {txt('dt', 'dt')} FROM x_cuse")
def fact_coupon_used(i: Inputs):
    return facts.fact_coupon_used(i.raw_coupon_use())


@query(f"SELECT id, user_id, sku_id, {txt('create_time', 'date_id')}, {tms('create_time', 'create_time')}, {txt('dt', 'dt')} FROM x_favor")
def fact_favor_add(i: Inputs):
    return facts.fact_favor_add(i.raw_favor())


@query(f"""
SELECT province_id, brand, channel, is_new, model, mid_id, operate_system, user_id, version_code, page_item, page_item_type,
       last_page_id, page_id, from_pos_id, from_pos_seq, refer_id, {txt('dt', 'date_id')}, {tms('view_time', 'view_time')},
       session_id, during_time, {txt('dt', 'dt')} FROM x_pv
""")
def fact_page_view(i: Inputs):
    return i.page_view()


@query(f"""
WITH new AS (SELECT user_id || '' AS user_id, min(ts) AS create_time FROM x_ev WHERE event_type = 'signup' GROUP BY 1),
first_visit AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, dt ORDER BY ts_ms, channel, province_id, version_code) AS rn FROM x_pv) WHERE rn = 1)
SELECT n.user_id, {txt('create_time', 'date_id')}, {tms('create_time', 'create_time')}, channel, province_id, version_code, mid_id, brand,
       model, operate_system, {txt('create_time', 'dt')}
FROM new n LEFT JOIN first_visit f ON n.user_id = f.user_id AND cast(create_time as date) = f.dt
""")
def fact_register(i: Inputs):
    users = i.events().where(F.col("event_type") == "signup").groupBy(F.col("user_id").cast("string").alias("user_id")).agg(
        F.min("ts").alias("create_time"))
    return facts.fact_register(users, i.app_log())


@query(f"""
SELECT user_id, {txt('dt', 'date_id')}, {tms('view_time', 'login_time')}, channel, province_id, version_code, mid_id, brand, model, operate_system, {txt('dt', 'dt')}
FROM (SELECT *, row_number() OVER (PARTITION BY dt, user_id, session_id ORDER BY view_time, channel, province_id, version_code) AS rn FROM x_pv) WHERE rn = 1
""")
def fact_login(i: Inputs):
    return facts.fact_login(i.page_view())


# summaries

cte("x_usku1d", f"""
SELECT dt, user_id, sku_id, count(*) AS order_count_1d, sum(sku_num) AS order_num_1d, sum(original) AS order_original_amount_1d,
       sum(act_cut) AS activity_reduce_amount_1d, sum(cou_cut) AS coupon_reduce_amount_1d, sum(total) AS order_total_amount_1d
FROM x_od GROUP BY dt, user_id, sku_id
""")
cte("x_usku1d_n", f"SELECT u.*, {SKU} FROM x_usku1d u LEFT JOIN x_sku s ON u.sku_id = s.id")
cte("x_user1d", """
SELECT dt, user_id, count(DISTINCT order_id) AS order_count_1d, sum(sku_num) AS order_num_1d, sum(original) AS order_original_amount_1d,
       sum(act_cut) AS activity_reduce_amount_1d, sum(cou_cut) AS coupon_reduce_amount_1d, sum(total) AS order_total_amount_1d
FROM x_od GROUP BY dt, user_id
""")
cte("x_prov1d", f"""
SELECT o.*, {PROV} FROM (
SELECT dt, province_id, count(DISTINCT order_id) AS order_count_1d, sum(original) AS order_original_amount_1d,
       sum(act_cut) AS activity_reduce_amount_1d, sum(cou_cut) AS coupon_reduce_amount_1d, sum(total) AS order_total_amount_1d
FROM x_od GROUP BY dt, province_id) o LEFT JOIN x_province p ON o.province_id = p.id
""")
_AMT1D = ", ".join(dbl(f"{n}_1d", f"{n}_1d") for n in (
    "order_original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_total_amount"))


@query(f"SELECT {txt('dt', 'dt')}, user_id, sku_id, {SKU}, order_count_1d, {big('order_num_1d', 'order_num_1d')}, {_AMT1D} FROM x_usku1d_n")
def user_sku_order_1d(i: Inputs):
    return summaries.user_sku_order_1d(i.order_fact(), i.sku())


@query(f"SELECT {txt('dt', 'dt')}, user_id, order_count_1d, {big('order_num_1d', 'order_num_1d')}, {_AMT1D} FROM x_user1d")
def user_order_1d(i: Inputs):
    return summaries.user_order_1d(i.order_fact())


@query(f"SELECT {txt('dt', 'dt')}, user_id, count(*) AS cart_add_count_1d, {big('sum(sku_num)', 'cart_add_num_1d')} FROM x_cart GROUP BY x_cart.dt, user_id")
def user_cart_add_1d(i: Inputs):
    return summaries.user_cart_add_1d(facts.fact_cart_add(i.raw_cart()))


@query(f"""
SELECT {txt('pay_dt', 'dt')}, user_id, count(DISTINCT order_id) AS payment_count_1d, {big('sum(sku_num)', 'payment_num_1d')},
       {dbl('sum(total)', 'payment_amount_1d')} FROM x_payd GROUP BY pay_dt, user_id
""")
def user_payment_1d(i: Inputs):
    return summaries.user_payment_1d(i.payment_fact())


@query(f"SELECT {txt('dt', 'dt')}, province_id, {PROV}, order_count_1d, {_AMT1D} FROM x_prov1d")
def province_order_1d(i: Inputs):
    return summaries.province_order_1d(i.order_fact(province=True), i.province())


@query(f"""
SELECT {txt('dt', 'dt')}, user_id, coupon_id, coupon_name, coupon_type_code, coupon_type_name, benefit_rule, used_count_1d
FROM (SELECT dt, user_id, coupon_id, count(*) AS used_count_1d FROM x_cuse GROUP BY ALL) u LEFT JOIN x_coupon c ON u.coupon_id = c.id
""")
def user_coupon_used_1d(i: Inputs):
    return summaries.user_coupon_used_1d(facts.fact_coupon_used(i.raw_coupon_use()), i.coupon())


cte("x_fav1d", f"""
SELECT f.dt, f.sku_id, {SKU}, n AS favor_add_count_1d FROM (SELECT dt, sku_id, count(*) AS n FROM x_favor GROUP BY ALL) f
LEFT JOIN x_sku s ON f.sku_id = s.id
""")


@query(f"SELECT * REPLACE (strftime(dt, '%Y-%m-%d') AS dt) FROM x_fav1d")
def sku_favor_add_1d(i: Inputs):
    return summaries.sku_favor_add_1d(facts.fact_favor_add(i.raw_favor()), i.sku())


cte("x_sess1d", """
SELECT dt, session_id, mid_id, brand, model, operate_system, version_code, channel, cast(sum(during_time) as bigint) AS during_time_1d,
       count(*) AS page_count_1d FROM x_pv GROUP BY ALL
""")


@query("SELECT * REPLACE (strftime(dt, '%Y-%m-%d') AS dt) FROM x_sess1d")
def session_page_view_1d(i: Inputs):
    return summaries.session_page_view_1d(i.page_view())


@query("""
SELECT strftime(dt, '%Y-%m-%d') AS dt, mid_id, brand, model, operate_system, page_id, cast(sum(during_time) as bigint) AS during_time_1d,
       count(*) AS view_count_1d FROM x_pv GROUP BY x_pv.dt, mid_id, brand, model, operate_system, page_id
""")
def visitor_page_view_1d(i: Inputs):
    return summaries.visitor_page_view_1d(i.page_view())


def _nd(stems: list[str], cast) -> str:
    return ", ".join(
        cast(s)(f"sum(CASE WHEN dt >= {T} - {n - 1} THEN {s}_1d ELSE 0 END)", f"{s}_{n}d") for n in (7, 30) for s in stems)


_STEMS = ["order_count", "order_num", "order_original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_total_amount"]


def _kind(stem: str):
    return dbl if "amount" in stem else big


cte("x_uskund", f"""
SELECT user_id, sku_id, {SKU}, {_nd(_STEMS, _kind)} FROM x_usku1d_n WHERE dt BETWEEN {T} - 29 AND {T} GROUP BY ALL
""")
cte("x_provnd", f"""
SELECT province_id, {PROV}, {_nd([s for s in _STEMS if s != 'order_num'], _kind)} FROM x_prov1d WHERE dt BETWEEN {T} - 29 AND {T} GROUP BY ALL
""")


def _usku1d(i: Inputs):
    return summaries.user_sku_order_1d(i.order_fact(), i.sku())


def _prov1d(i: Inputs):
    return summaries.province_order_1d(i.order_fact(province=True), i.province())


@query("SELECT * FROM x_uskund")
def user_sku_order_nd(i: Inputs):
    return summaries.user_sku_order_nd(_usku1d(i), TRADE_DAY)


@query("SELECT * FROM x_provnd")
def province_order_nd(i: Inputs):
    return summaries.province_order_nd(_prov1d(i), TRADE_DAY)


_TD = f"""
SELECT user_id, {txt('min(dt)', 'order_date_first')}, {txt('max(dt)', 'order_date_last')}, {big('sum(order_count_1d)', 'order_count_td')},
       {big('sum(order_num_1d)', 'order_num_td')}, {dbl('sum(order_original_amount_1d)', 'original_amount_td')},
       {dbl('sum(activity_reduce_amount_1d)', 'activity_reduce_amount_td')}, {dbl('sum(coupon_reduce_amount_1d)', 'coupon_reduce_amount_td')},
       {dbl('sum(order_total_amount_1d)', 'total_amount_td')} FROM x_user1d WHERE dt <= {T} GROUP BY user_id
"""


@query(_TD)
def user_order_td(i: Inputs):
    return summaries.user_order_td(summaries.user_order_1d(i.order_fact()), TRADE_DAY)


@query(_TD)
def user_order_td_forward(i: Inputs):
    daily = summaries.user_order_1d(i.order_fact())
    return summaries.user_order_td_forward(summaries.user_order_td(daily, "2001-07-31"), daily, TRADE_DAY)


_LTD = f"""
SELECT user_id, {txt('max(dt)', 'login_date_last')}, {txt('min(dt)', 'login_date_first')}, count(*) AS login_count_td
FROM x_login WHERE dt <= {E} GROUP BY user_id
"""


@query(_LTD)
def user_login_td(i: Inputs):
    return summaries.user_login_td(i.logins(), EVENT_DAY)


@query(_LTD)
def user_login_td_forward(i: Inputs):
    return summaries.user_login_td_forward(summaries.user_login_td(i.logins(), "2024-01-29"), i.logins(), EVENT_DAY)


# results

@query(f"""
SELECT '{EVENT_DAY}' AS dt, cast(n as bigint) AS recent_days, channel, count(DISTINCT mid_id) AS uv_count,
       cast(sum(during_time_1d) // (count(*) * 1000) as bigint) AS avg_duration_sec, cast(sum(page_count_1d) // count(*) as bigint) AS avg_page_count,
       count(*) AS sv_count,
       cast((sum(CASE WHEN page_count_1d = 1 THEN 1 ELSE 0 END) * 200 + count(*)) // (2 * count(*)) as double) / 100 AS bounce_rate
FROM x_sess1d, (VALUES (1), (7), (30)) d(n) WHERE dt BETWEEN {E} - n + 1 AND {E} GROUP BY n, channel
""")
def traffic_by_channel(i: Inputs):
    return reports.traffic_by_channel(summaries.session_page_view_1d(i.page_view()), EVENT_DAY)


def _path(where: str) -> str:
    return f"""
SELECT 'step-' || rn || ':' || page_id AS source, coalesce('step-' || (rn + 1) || ':' || nxt, 'null') AS target, count(*) AS path_count
FROM (SELECT page_id, lead(page_id) OVER w AS nxt, row_number() OVER w AS rn FROM x_pv {where}
      WINDOW w AS (PARTITION BY session_id ORDER BY view_time, page_id)) GROUP BY ALL
"""


@query(_path(""))
def page_path(i: Inputs):
    return reports.page_path(i.page_view())


@query(_path(f"WHERE dt = {E}"))
def page_path_one_day(i: Inputs):
    return reports.page_path(i.page_view(), EVENT_DAY)


@query(f"""
WITH td AS (SELECT user_id, max(dt) AS last FROM x_login WHERE dt <= {E} GROUP BY 1),
before AS (SELECT user_id, max(dt) AS prev FROM x_login WHERE dt <= {E} - 1 GROUP BY 1)
SELECT '{EVENT_DAY}' AS dt, (SELECT count(*) FROM td WHERE last = {E} - 7) AS user_churn_count,
       (SELECT count(*) FROM td JOIN before USING (user_id) WHERE last = {E} AND last - prev >= 8) AS user_back_count
""")
def user_change(i: Inputs):
    return reports.user_change(summaries.user_login_td(i.logins(), EVENT_DAY), summaries.user_login_td(i.logins(), "2024-01-29"), EVENT_DAY)


@query(f"""
WITH td AS (SELECT user_id, max(dt) AS last, min(dt) AS first FROM x_login WHERE dt <= {E} GROUP BY 1)
SELECT '{EVENT_DAY}' AS dt, cast(n as bigint) AS recent_days, {big(f'sum(CASE WHEN first >= {E} - n + 1 THEN 1 ELSE 0 END)', 'new_user_count')},
       count(*) AS active_user_count FROM td, (VALUES (1), (7), (30)) d(n) WHERE last >= {E} - n + 1 GROUP BY n
""")
def user_stats(i: Inputs):
    return reports.user_stats(summaries.user_login_td(i.logins(), EVENT_DAY), EVENT_DAY)


@query(f"""
SELECT '{EVENT_DAY}' AS dt,
  (SELECT count(DISTINCT mid_id) FROM x_pv WHERE dt = {E} AND page_id = 'home') AS home_count,
  (SELECT count(DISTINCT mid_id) FROM x_pv WHERE dt = {E} AND page_id = 'good_detail') AS good_detail_count,
  (SELECT count(DISTINCT user_id) FROM x_ev WHERE dt = {E} AND event_type = 'signup') AS cart_count,
  (SELECT count(DISTINCT user_id) FROM x_ev WHERE dt = {E} AND event_type = 'click') AS order_count,
  (SELECT count(DISTINCT user_id) FROM x_ev WHERE dt = {E} AND event_type = 'purchase') AS payment_count
""")
def user_action_funnel(i: Inputs):
    e = i.events()

    def per_user(kind: str):
        return e.where(F.col("event_type") == kind).groupBy("dt", "user_id").agg(F.count(F.lit(1)).alias("n"))

    return reports.user_action_funnel(summaries.visitor_page_view_1d(i.page_view()), per_user("signup"), per_user("click"),
                                      per_user("purchase"), EVENT_DAY)


@query(f"""
WITH d AS (SELECT DISTINCT user_id, dt FROM x_ev WHERE event_type = 'purchase' AND dt BETWEEN {E} - 6 AND {E})
SELECT '{EVENT_DAY}' AS dt, cast(7 as bigint) AS recent_days, count(DISTINCT a.user_id) AS order_continuously_user_count
FROM d a JOIN d b ON a.user_id = b.user_id AND b.dt = a.dt + 1 JOIN d c ON a.user_id = c.user_id AND c.dt = a.dt + 2
""")
def consecutive_order_users(i: Inputs):
    days = i.events().where(F.col("event_type") == "purchase").groupBy("dt", "user_id").agg(F.count(F.lit(1)).alias("n"))
    return reports.consecutive_order_users(days, EVENT_DAY)


@query(f"""
WITH u AS (SELECT user_id, tm_id, tm_name, sum(order_count_30d) AS n FROM x_uskund GROUP BY ALL)
SELECT '{TRADE_DAY}' AS dt, cast(30 as bigint) AS recent_days, tm_id, tm_name,
       cast((sum(CASE WHEN n >= 2 THEN 1 ELSE 0 END) * 200 + sum(CASE WHEN n >= 1 THEN 1 ELSE 0 END)) // (2 * sum(CASE WHEN n >= 1 THEN 1 ELSE 0 END)) as double) / 100 AS order_repeat_rate
FROM u GROUP BY tm_id, tm_name
""")
def repeat_purchase_by_brand(i: Inputs):
    return reports.repeat_purchase_by_brand(summaries.user_sku_order_nd(_usku1d(i), TRADE_DAY), TRADE_DAY)


def _stats(group: str) -> str:
    return f"""
SELECT '{TRADE_DAY}' AS dt, cast(1 as bigint) AS recent_days, {group}, {big('sum(order_count_1d)', 'order_count')},
       count(DISTINCT user_id) AS order_user_count FROM x_usku1d_n WHERE dt = {T} GROUP BY {group}
UNION ALL
SELECT '{TRADE_DAY}', n, {group}, cast(sum(CASE n WHEN 7 THEN order_count_7d ELSE order_count_30d END) as bigint),
       count(DISTINCT CASE WHEN (CASE n WHEN 7 THEN order_count_7d ELSE order_count_30d END) > 0 THEN user_id END)
FROM x_uskund, (VALUES (7), (30)) d(n) GROUP BY n, {group}
"""


@query(_stats("tm_id, tm_name"))
def order_stats_by_brand(i: Inputs):
    daily = _usku1d(i)
    return reports.order_stats_by_brand(daily, summaries.user_sku_order_nd(daily, TRADE_DAY), TRADE_DAY)


@query(_stats("category1_id, category1_name, category2_id, category2_name, category3_id, category3_name"))
def order_stats_by_category(i: Inputs):
    daily = _usku1d(i)
    return reports.order_stats_by_category(daily, summaries.user_sku_order_nd(daily, TRADE_DAY), TRADE_DAY)


@query(f"""
SELECT '{TRADE_DAY}' AS dt, * FROM (
  SELECT category1_id, category1_name, category2_id, category2_name, category3_id, category3_name, sku_id, s.sku_name, cart_num,
         rank() OVER (PARTITION BY category1_id, category2_id, category3_id ORDER BY cart_num DESC) AS rk
  FROM (SELECT sku_id, cast(sum(sku_num) as bigint) AS cart_num FROM x_cart WHERE is_ordered = '0' GROUP BY 1) c LEFT JOIN x_sku s ON c.sku_id = s.id)
WHERE rk <= 3
""")
def cart_top3_by_category(i: Inputs):
    return reports.cart_top_by_category(facts.fact_cart_snapshot(i.raw_cart()), i.sku(), TRADE_DAY)


@query("""
SELECT '2000-06-11' AS dt, * FROM (SELECT tm_id, tm_name, sku_id, sku_name, favor_add_count_1d,
  rank() OVER (PARTITION BY tm_id ORDER BY favor_add_count_1d DESC) AS rk FROM x_fav1d WHERE dt = date '2000-06-11') WHERE rk <= 3
""")
def favor_top3_by_brand(i: Inputs):
    daily = summaries.sku_favor_add_1d(facts.fact_favor_add(i.raw_favor()), i.sku())
    return reports.favor_top_by_brand(daily, "2000-06-11")


@query("""
SELECT '2000-06-11' AS dt, cast(sum(epoch(payment_time) - epoch(order_time)) // count(*) as bigint) AS order_to_pay_interval_avg
FROM x_flow WHERE cast(payment_time as date) = date '2000-06-11'
""")
def order_to_pay_avg_seconds(i: Inputs):
    flow = facts.fact_trade_flow_acc(i.raw_orders(), i.raw_payment(), i.status_log())
    return reports.order_to_pay_avg_seconds(flow, "2000-06-11")


@query(f"""
SELECT '{TRADE_DAY}' AS dt, cast(1 as bigint) AS recent_days, province_id, {PROV}, order_count_1d AS order_count,
       {dbl('order_total_amount_1d', 'order_total_amount')} FROM x_prov1d WHERE dt = {T}
UNION ALL
SELECT '{TRADE_DAY}', n, province_id, {PROV}, CASE n WHEN 7 THEN order_count_7d ELSE order_count_30d END,
       CASE n WHEN 7 THEN order_total_amount_7d ELSE order_total_amount_30d END FROM x_provnd, (VALUES (7), (30)) d(n)
""")
def order_by_province(i: Inputs):
    daily = _prov1d(i)
    return reports.order_by_province(daily, summaries.province_order_nd(daily, TRADE_DAY), TRADE_DAY)
