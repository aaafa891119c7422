"""Operator inputs as DuckDB SQL. Each entry is one CTE; ``with_ctes`` prepends the ones a query names."""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


def _named(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_][a-z_0-9]*", sql))
    return [name for name in CTES if name in words]


def with_ctes(sql: str) -> str:
    needed: dict[str, None] = {}

    def add(name: str) -> None:
        if name in needed:
            return
        for inner in _named(CTES[name]):
            if inner != name:
                add(inner)
        needed[name] = None

    for name in _named(sql):
        add(name)
    if not needed:
        return sql.strip()
    body = ",\n".join(f"{name} AS (\n{CTES[name]}\n)" for name in needed)
    own = sql.strip()
    if own.upper().startswith("WITH "):
        return f"WITH {body},\n{own[5:]}"
    return f"WITH {body}\n{own}"


LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice * 100) as bigint))"
PRICE = "cast(l_extendedprice as decimal(16,2))"
CUT = "cast(l_discount as decimal(4,2))"
UNIT = "cast((cast(round(l_extendedprice * 100) as bigint) // cast(l_quantity as bigint)) * 0.01 as decimal(16,2))"

cte("x_od", f"""
SELECT {LINE_ID} AS id, l_orderkey AS order_id, o_custkey AS user_id, l_partkey AS sku_id,
       cast(c_nationkey as bigint) AS province_id,
       CASE WHEN l_discount > 0 THEN cast(round(l_discount * 100) as bigint) END AS activity_id,
       CASE WHEN l_discount > 0 THEN cast(round(l_discount * 100) as bigint) * 10 + l_linenumber END AS activity_rule_id,
       CASE WHEN l_tax > 0 THEN cast(round(l_tax * 100) as bigint) END AS coupon_id,
       o_orderdate AS create_time, cast(o_orderdate as date) AS dt, cast(l_quantity as bigint) AS sku_num,
       cast(cast(l_quantity as bigint) * {UNIT} as decimal(16,2)) AS original,
       cast({PRICE} * {CUT} as decimal(16,2)) AS act_cut,
       cast({PRICE} * cast(l_tax as decimal(4,2)) as decimal(16,2)) AS cou_cut,
       cast({PRICE} * (1 - {CUT}) as decimal(16,2)) AS total
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
""")
cte("x_pay", f"""
SELECT l_orderkey AS order_id, any_value(o_custkey) AS user_id, '110' || (l_orderkey % 4) AS payment_type,
       CASE WHEN count(*) % 2 = 0 THEN '1602' ELSE '1601' END AS payment_status,
       greatest(min(l_shipdate), any_value(o_orderdate)) AS callback_time,
       cast(sum(cast({PRICE} * (1 - {CUT}) as decimal(16,2))) as decimal(16,2)) AS total_amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'F' GROUP BY l_orderkey
""")
cte("x_dic", """
SELECT '11' AS parent_code, '110' || n AS dic_code, 'pay-' || n AS dic_name FROM (SELECT DISTINCT o_orderkey % 4 AS n FROM orders)
UNION ALL SELECT '31', '310' || n, 'activity-' || n FROM (SELECT DISTINCT o_orderkey % 4 AS n FROM orders) WHERE n <> 0
UNION ALL SELECT '32', '320' || n, 'coupon-' || n FROM (SELECT DISTINCT o_orderkey % 4 AS n FROM orders) WHERE n <> 0
UNION ALL SELECT '33', '330' || n, 'range-' || n FROM (SELECT DISTINCT o_orderkey % 4 AS n FROM orders) WHERE n <> 0
""")
cte("x_payd", """
SELECT x_od.*, p.payment_type, p.payment_status, p.callback_time, cast(p.callback_time as date) AS pay_dt
FROM x_od JOIN x_pay p ON x_od.order_id = p.order_id
""")
cte("x_cart", f"""
SELECT {LINE_ID} AS id, o_custkey AS user_id, l_partkey AS sku_id, p_name AS sku_name, cast(l_quantity as bigint) AS sku_num,
       CASE WHEN l_linestatus = 'O' THEN '0' ELSE '1' END AS is_ordered, o_orderdate AS create_time,
       cast(o_orderdate as date) AS dt
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'N'
""")
cte("x_favor", f"""
SELECT {LINE_ID} AS id, o_custkey AS user_id, l_partkey AS sku_id, l_shipdate AS create_time, cast(l_shipdate as date) AS dt
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'A'
""")
cte("x_cuse", f"""
SELECT {LINE_ID} AS id, cast(round(l_tax * 100) as bigint) AS coupon_id, o_custkey AS user_id, l_orderkey AS order_id,
       o_orderdate AS get_time, l_shipdate AS used_time, cast(o_orderdate as date) AS dt
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_tax > 0
""")
cte("x_sku", """
SELECT p_partkey AS id, p_name AS sku_name, p_type AS category1_id, 'n1 ' || p_type AS category1_name,
       p_type || '-' || (p_size % 5) AS category2_id, 'n2 ' || p_type || '-' || (p_size % 5) AS category2_name,
       p_type || '-' || (p_size % 5) || '-' || p_size AS category3_id,
       'n3 ' || p_type || '-' || (p_size % 5) || '-' || p_size AS category3_name,
       p_brand AS tm_id, lower(p_brand) AS tm_name, cast(p_retailprice as decimal(16,2)) AS price,
       p_size AS weight, p_size % 2 AS is_sale
FROM part
""")
cte("x_province", """
SELECT cast(n_nationkey as bigint) AS id, n_name AS province_name, '0' || (n_nationkey + 10) AS area_code,
       'CN-' || n_nationkey AS iso_code, 'ISO-' || n_nationkey AS iso_3166_2, n_regionkey AS region_id, r_name AS region_name
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
""")
cte("x_coupon", """
SELECT id, 'coupon ' || id AS coupon_name, '320' || (id % 4) AS coupon_type_code, d.dic_name AS coupon_type_name,
       cast(id * 100 as decimal(16,2)) AS condition_amount, id + 1 AS condition_num, id * 10 AS activity_id,
       cast(id * 5 as decimal(16,2)) AS benefit_amount, 10 - id AS benefit_discount,
       CASE id % 4 WHEN 1 THEN '满' || cast(id * 100 as decimal(16,2)) || '元减' || cast(id * 5 as decimal(16,2)) || '元'
                   WHEN 2 THEN '满' || (id + 1) || '件打' || (10 - id) || ' 折'
                   WHEN 3 THEN '减' || cast(id * 5 as decimal(16,2)) || '元' END AS benefit_rule,
       '330' || (id % 3) AS range_type_code, r.dic_name AS range_type_name, id + 5 AS limit_num, id + 3 AS taken_count
FROM (SELECT DISTINCT cast(round(l_tax * 100) as bigint) AS id FROM lineitem WHERE l_tax > 0) c
LEFT JOIN x_dic d ON d.parent_code = '32' AND d.dic_code = '320' || (id % 4)
LEFT JOIN x_dic r ON r.parent_code = '33' AND r.dic_code = '330' || (id % 3)
""")
cte("x_ev", """
SELECT event_id, ts, user_id, event_type, value, cast(regexp_extract(props, '"k": ([0-9]+)', 1) as bigint) AS k,
       cast(ts as date) AS dt
FROM events
""")
cte("x_pv", """
SELECT user_id % 25 || '' AS province_id, 'ba' || (user_id % 6) AS brand, 'ch' || (user_id % 4) AS channel,
       CASE WHEN k % 3 = 0 THEN '1' ELSE '0' END AS is_new, 'md' || (user_id % 9) AS model, 'mid_' || user_id AS mid_id,
       'os' || (user_id % 2) AS operate_system, user_id || '' AS user_id, 'v' || (k % 5) AS version_code,
       k || '' AS page_item, 'sku_id' AS page_item_type, CASE WHEN k % 4 <> 0 THEN 'home' END AS last_page_id,
       CASE event_type WHEN 'view' THEN 'good_detail' WHEN 'click' THEN 'home' WHEN 'signup' THEN 'cart'
                       WHEN 'purchase' THEN 'trade' ELSE 'mine' END AS page_id,
       (k % 7) || '' AS from_pos_id, (k % 3) || '' AS from_pos_seq, (k % 5) || '' AS refer_id, dt,
       epoch_us(ts) // 1000 AS ts_ms, user_id || '_' || dt AS session_id, cast(round(value * 1000) as bigint) AS during_time,
       event_type, event_id, k, make_timestamp((epoch_us(ts) // 1000) * 1000) AS view_time
FROM x_ev
""")
cte("x_login", "SELECT user_id, dt, ts AS login_time FROM x_ev WHERE event_type = 'signup'")
