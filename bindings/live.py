"""Real-time operators: app log and change records built as JSON text from the driver's tables, run as batches and as streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindings.ctes import cte
from bindings.inputs import Inputs
from bindings.register import big, dbl, query
from bindings.replay import batch_of, dealt, faulty_lines, faulty_sql, files_of
from tidemill.functions import items, text
from tidemill.functions.columns import money
from tidemill.session import scratch
from tidemill.sources import schemas, streams
from tidemill.streaming import dedup, jobs, logs, state, users, windows


def stream_of(i: Inputs, name: str, by: str | None = None):
    """A driver table as a stream of five batches, in the order of time (or of ``by``); written once for all streams of a query."""
    table = i.spark.read.parquet(f"{i.sf_dir}/{name}.parquet")
    by, schema = by or {"events": "ts", "orders": "o_orderdate"}.get(name, table.columns[0]), table.schema
    if (name, by) not in i.folders:
        at = F.col(by) if schema[by].dataType.typeName() in ("long", "integer") else F.unix_micros(F.col(by).cast("timestamp"))
        cuts = table.agg(F.percentile_approx(at, [0.2, 0.4, 0.6, 0.8])).first()[0] or []
        batch = F.lit(0)
        for cut in cuts:
            batch = batch + F.coalesce((at > cut).cast("int"), F.lit(0))
        i.folders[name, by] = dealt(i, table.withColumn("_batch", batch), f"stream-of-{name}", files=files_of(table), kept=False), files_of(table)
    out, files = i.folders[name, by]
    df = i.spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(out)
    return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in schema if f.dataType.typeName() == "timestamp_ntz"})


def events_of(i: Inputs, live: bool = False):
    e = stream_of(i, "events") if live else i.table("events")
    return e.withColumns({"k": F.get_json_object("props", "$.k").cast("bigint"), "ms": F.unix_millis("ts")})


# app log

def raw_log(e):
    """JSON text per event: sign-ups are starts, half of them on a page, views show items, clicks act, errors carry an error; some lines are cut off."""
    uid, k, kind = F.col("user_id"), F.col("k"), F.col("event_type")
    common = F.struct(
        (uid % 25).cast("string").alias("ar"), uid.cast("string").alias("uid"), F.concat(F.lit("ch"), uid % 4).alias("ch"),
        F.when(k % 3 == 0, "0").otherwise("1").alias("is_new"), F.concat(F.lit("v"), k % 2).alias("vc"),
        F.concat(F.lit("ba"), uid % 6).alias("ba"), F.concat(F.lit("os"), uid % 2).alias("os"),
        F.concat(F.lit("md"), uid % 9).alias("md"), F.concat(F.lit("mid_"), uid).alias("mid"), F.concat(F.lit("s"), uid).alias("sid"))
    page = F.when((kind != "signup") | (k % 2 == 0), F.struct(
        F.concat(F.lit("p"), k % 10).alias("page_id"), F.when(k % 4 != 0, F.concat(F.lit("p"), k % 3)).alias("last_page_id"),
        F.round(F.col("value") * 1000).cast("bigint").alias("during_time")))
    start = F.when(kind == "signup", F.struct(F.lit("icon").alias("entry"), k.alias("loading_time")))
    displays = F.when(kind == "view", F.transform(
        F.sequence(F.lit(0), (k % 3).cast("int")),
        lambda j: F.struct((k + j).cast("string").alias("item"), F.lit("sku_id").alias("item_type"), j.alias("pos_id"))))
    actions = F.when(kind == "click", F.array(F.struct(
        F.concat(F.lit("a"), k % 4).alias("action_id"), k.cast("string").alias("item"), F.lit("sku_id").alias("item_type"), (F.col("ms") + 1).alias("ts"))))
    err = F.when(kind == "error", F.struct(k.alias("error_code"), F.concat(F.lit("m"), k).alias("msg")))
    whole = F.to_json(F.struct(common.alias("common"), page.alias("page"), start.alias("start"), displays.alias("displays"),
                               actions.alias("actions"), err.alias("err"), F.col("ms").alias("ts")))
    return e.select(F.when(F.col("event_id") % 97 == 0, F.substring(whole, 1, 30)).otherwise(whole).alias("value"))


def app_log(i: Inputs, live: bool = False):
    return streams.parsed(raw_log(events_of(i, live)), schemas.APP_LOG)


def flat_log(df, *columns):
    return df.select(F.col("common.uid").alias("uid"), F.col("common.is_new").alias("is_new"), *columns)


cte("r_ev", """
SELECT *, epoch_us(ts) // 1000 AS ms, event_id % 97 = 0 AS dirty, CASE WHEN k % 3 = 0 THEN '0' ELSE '1' END AS is_new, user_id || '' AS uid,
       'p' || (k % 10) AS page_id, CASE WHEN k % 4 <> 0 THEN 'p' || (k % 3) END AS last_page_id, cast(round(value * 1000) as bigint) AS during_time,
       'v' || (k % 2) AS vc, 'ch' || (user_id % 4) AS ch, (user_id % 25) || '' AS ar, 'mid_' || user_id AS mid
FROM x_ev
""")
cte("r_ok", "SELECT *, event_type <> 'signup' OR k % 2 = 0 AS has_page FROM r_ev WHERE NOT dirty")
cte("r_disp", "SELECT r.*, j, (k + j) || '' AS item FROM r_ok r, (VALUES (0), (1), (2)) t(j) WHERE event_type = 'view' AND j <= k % 3")


@query("""
SELECT 'page' AS part, uid, page_id AS item, ms AS ts, cast(NULL as varchar) AS text FROM r_ok WHERE event_type <> 'signup'
UNION ALL SELECT 'start', uid, CASE WHEN has_page THEN page_id END, ms, 'icon' FROM r_ok WHERE event_type = 'signup'
UNION ALL SELECT 'display', uid, item, ms, j || '' FROM r_disp
UNION ALL SELECT 'action', uid, k || '', ms + 1, 'a' || (k % 4) FROM r_ok WHERE event_type = 'click'
UNION ALL SELECT 'err', NULL, k || '', NULL, 'm' || k FROM r_ok WHERE event_type = 'error'
UNION ALL SELECT 'dirty', NULL, NULL, NULL, substring('{"common":{"ar":"' || ar || '","uid":"' || uid || '","ch":"' || ch || '"', 1, 30) FROM r_ev WHERE dirty
""")
def split_app_log(i: Inputs):
    """Every row of the six outputs; one scan and one parse."""
    parts = logs.log_parts(raw_log(events_of(i)))
    item = F.coalesce("display.item", "action.item", F.col("err.error_code").cast("string"), "page.page_id")
    text = F.coalesce("value", "err.msg", "action.action_id", F.col("display.pos_id").cast("string"), "start.entry")
    return parts.select("part", F.col("common.uid").alias("uid"), item.alias("item"), F.coalesce("action.ts", "ts").alias("ts"), text.alias("text"))


@query("SELECT uid, is_new, page_id, item, cast(j as bigint) AS pos_id, ms AS ts FROM r_disp")
def split_log_displays(i: Inputs):
    return flat_log(logs.split_app_log(raw_log(events_of(i)))["display"], F.col("page.page_id").alias("page_id"), "display.item", "display.pos_id", "ts")


@query("SELECT uid, is_new, page_id, item, cast(j as bigint) AS pos_id, ms AS ts FROM r_disp")
def stream_split_log_displays(i: Inputs):
    parts = logs.split_app_log(raw_log(events_of(i, live=True)))
    return streams.run_to_parquet(flat_log(parts["display"], F.col("page.page_id").alias("page_id"), "display.item", "display.pos_id", "ts"), "displays")


_ROUTED = """
SELECT 'page' AS topic, uid, ms AS ts FROM r_ok WHERE has_page
UNION ALL SELECT 'start', uid, ms FROM r_ok WHERE event_type = 'signup' UNION ALL SELECT 'display', uid, ms FROM r_ok WHERE event_type = 'view'
UNION ALL SELECT 'action', uid, ms FROM r_ok WHERE event_type = 'click' UNION ALL SELECT 'error', uid, ms FROM r_ok WHERE event_type = 'error'
"""


def _sent(df):
    record = F.from_json("value", "common struct<uid: string>, ts bigint")
    return df.select("topic", streams.once(record).alias("r")).select("topic", F.col("r.common.uid").alias("uid"), F.col("r.ts").alias("ts"))


@query(_ROUTED)
def route_log_by_type(i: Inputs):
    return _sent(logs.routed_records(raw_log(events_of(i))))


@query(_ROUTED)
def stream_topic_routing(i: Inputs):
    """Records of all five kinds written to one folder per topic by a stream, then read back."""
    out = scratch(i.spark, "topics")
    sent = logs.routed_records(raw_log(events_of(i, live=True)))
    streams.start_topic_sink(sent, "parquet", out, scratch(i.spark, "topics-checkpoint")).awaitTermination()
    return _sent(i.spark.read.schema("value string, topic string").parquet(out))


@query("SELECT uid, is_new, page_id, 'a' || (k % 4) AS action_id, k || '' AS item, ms + 1 AS action_ts, ms AS ts FROM r_ok WHERE event_type = 'click'")
def flatten_actions(i: Inputs):
    return flat_log(logs.flatten_actions(app_log(i)), F.col("page.page_id").alias("page_id"), "action.action_id", "action.item", F.col("action.ts").alias("action_ts"), "ts")


@query("SELECT uid, is_new, page_id, item, cast(j as bigint) AS pos_id, ms AS ts FROM r_disp")
def flatten_displays(i: Inputs):
    return flat_log(logs.flatten_displays(app_log(i)), F.col("page.page_id").alias("page_id"), "display.item", "display.pos_id", "ts")


@query("SELECT uid, is_new, page_id, last_page_id, during_time, ms AS ts FROM r_ok WHERE has_page")
def page_log_facts(i: Inputs):
    return flat_log(logs.page_facts(app_log(i)), "page.page_id", "page.last_page_id", "page.during_time", "ts")


@query("SELECT uid, is_new, 'icon' AS entry, k AS loading_time, ms AS ts FROM r_ok WHERE event_type = 'signup'")
def start_log_facts(i: Inputs):
    return flat_log(logs.start_facts(app_log(i)), "start.entry", "start.loading_time", "ts")


@query("SELECT uid, is_new, k AS error_code, 'm' || k AS msg, ms AS ts FROM r_ok WHERE event_type = 'error'")
def error_log_facts(i: Inputs):
    return flat_log(logs.error_facts(app_log(i)), "err.error_code", "err.msg", "ts")


_FIX = """
WITH f AS (SELECT uid, arg_min(is_new, ms) AS n0, min(ms) AS m0 FROM r_ok GROUP BY uid),
d AS (SELECT uid, cast(make_timestamp(m0 * 1000) as date) - CASE WHEN n0 = '1' THEN 0 ELSE 1 END AS first_day FROM f)
SELECT r.uid, CASE WHEN is_new = '1' AND cast(make_timestamp(ms * 1000) as date) <> first_day THEN '0' ELSE is_new END AS is_new, ms AS ts
FROM r_ok r JOIN d ON r.uid = d.uid
"""


@query(_FIX)
def fix_is_new(i: Inputs):
    return flat_log(logs.fix_is_new(app_log(i)), "ts")


@query(_FIX)
def stream_fix_is_new(i: Inputs):
    return flat_log(jobs.fix_is_new_job(app_log(i, live=True), scratch(i.spark, "fix-is-new"), buckets=8), "ts")


def unified(i: Inputs, live: bool = False):
    return logs.unify_user_actions(logs.log_parts(raw_log(events_of(i, live))))


cte("r_uni", """
SELECT 'start' AS event_type, mid, uid, is_new, vc, ch, ar, ms AS event_ts, CASE WHEN has_page THEN page_id END AS page_id, CASE WHEN has_page THEN last_page_id END AS last_page_id,
       CASE WHEN has_page THEN during_time END AS during_time, cast(NULL as varchar) AS item, cast(NULL as bigint) AS j FROM r_ok WHERE event_type = 'signup'
UNION ALL SELECT 'page', mid, uid, is_new, vc, ch, ar, ms, page_id, last_page_id, during_time, NULL, NULL FROM r_ok WHERE event_type <> 'signup'
UNION ALL SELECT 'display', mid, uid, is_new, vc, ch, ar, ms, page_id, last_page_id, during_time, item, j FROM r_disp
UNION ALL SELECT 'action', mid, uid, is_new, vc, ch, ar, ms + 1, page_id, last_page_id, during_time, NULL, NULL FROM r_ok WHERE event_type = 'click'
""")


@query("SELECT event_type, mid, uid, event_ts, page_id, item FROM r_uni")
def unify_user_actions(i: Inputs):
    return unified(i).select("event_type", "mid", F.col("common.uid").alias("uid"), "event_ts", F.col("page.page_id").alias("page_id"), F.col("display.item").alias("item"))


@query("SELECT uid, is_new, ms AS ts FROM r_ok")
def drop_unparseable(i: Inputs):
    return flat_log(app_log(i), "ts")


# windows over user actions

def win(size: int, at: str) -> str:
    start = f"to_timestamp(({at}) // {size * 1000} * {size})"
    return (f"strftime({start} AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS stt, "
            f"strftime(({start} AT TIME ZONE 'UTC') + interval {size} seconds, '%Y-%m-%d %H:%M:%S') AS edt")


def timed(df, ms: str = "event_ts"):
    return windows.event_timed(df, ms)


def closed(size: int, at: str, top: str) -> str:
    """Windows a stream has closed once its input is used up."""
    return f"(({at}) // {size * 1000} + 1) * {size * 1000} <= {top} - 5000"


@query(f"SELECT {win(3600, 'event_ts')}, vc, ch, ar, is_new, count(*) AS pv_ct, count(DISTINCT uid) AS uv_ct FROM r_uni GROUP BY ALL")
def pv_uv_window(i: Inputs):
    return windows.pv_uv_window(timed(unified(i)), "1 hour")


@query(f"SELECT {win(10, 'event_ts')}, vc, ch, ar, is_new, count(*) AS pv_ct, count(DISTINCT uid) AS uv_ct FROM r_uni GROUP BY ALL")
def pv_uv_window_10s(i: Inputs):
    return windows.pv_uv_window(timed(unified(i)))


@query(f"""
SELECT {win(3600, 'event_ts')}, vc, ch, ar, is_new, count(*) AS pv_ct, count(DISTINCT uid) AS uv_ct FROM r_uni
WHERE {closed(3600, 'event_ts', "(SELECT max(event_ts) FROM r_uni)")} GROUP BY ALL
""")
def stream_pv_uv_window(i: Inputs):
    return streams.run_to_parquet(windows.pv_uv_window(timed(unified(i, live=True)), "1 hour"), "pv-uv")


@query(f"""
SELECT {win(3600, 'event_ts')}, vc, ch, ar, is_new, count(*) AS sv_ct, {big('sum(CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END)', 'uj_ct')},
       {big('sum(during_time)', 'dur_sum')} FROM r_uni WHERE event_type = 'start' GROUP BY ALL
""")
def session_window_stats(i: Inputs):
    return windows.session_window_stats(timed(unified(i)), "1 hour")


@query(f"""
SELECT *, cast(disp_ct > 0 as bigint) AS disp_sku_num, cast(click_ct > 0 as bigint) AS click_sku_num FROM (
SELECT {win(3600, 'event_ts')}, item AS sku_id, page_id, ch, count(*) AS disp_ct, count(*) FILTER (j = 0 AND event_ts % 3 = 0) AS click_ct
FROM r_uni WHERE event_type = 'display' GROUP BY ALL)
""")
def display_click_window(i: Inputs):
    """The first of some displays is clicked as well."""
    clicked = (F.col("event_type") == "display") & (F.col("display.pos_id") == 0) & (F.col("event_ts") % 3 == 0)
    kinds = F.when(clicked, F.array(F.lit("display"), F.lit("click"))).otherwise(F.array("event_type"))
    return windows.display_click_window(timed(unified(i).withColumn("event_type", F.explode(kinds))), "1 hour")


# windows over trade

def details(i: Inputs, live: bool = False):
    kind = F.when(F.col("event_type") == "click", "order").when(F.col("event_type") == "purchase", "payment").when(F.col("event_type") == "error", "refund")
    e = events_of(i, live).select(F.col("k").alias("sku_id"), "user_id", F.col("event_id").alias("order_id"), kind.alias("event_type"),
                                  money("value").alias("amount"), F.col("ms").alias("ts")).where(F.col("event_type").isNotNull())
    return windows.event_timed(e.withColumns({f"{n}_amount": F.when(F.col("event_type") == n, F.col("amount")) for n in ("order", "payment", "refund")}))


cte("t_det", """
SELECT k AS sku_id, user_id, event_id AS order_id, CASE event_type WHEN 'click' THEN 'order' WHEN 'purchase' THEN 'payment' ELSE 'refund' END AS kind,
       cast(value as decimal(16,2)) AS amount, epoch_us(ts) // 1000 AS ms FROM x_ev WHERE event_type IN ('click', 'purchase', 'error')
""")


def _kind(kind: str, extra: str = "", size: int = 10, where: str = "") -> str:
    return f"""
SELECT {win(size, 'ms')}, sku_id, count(*) AS {kind}_ct, count(DISTINCT user_id) AS {kind}_user_ct{extra}, {dbl('sum(amount)', f'{kind}_amount')}
FROM t_det WHERE kind = '{kind}' {where} GROUP BY stt, edt, sku_id
"""


@query(_kind("order", ", count(*) AS sku_num"))
def order_window_stats(i: Inputs):
    return windows.order_stats(details(i))


@query(_kind("payment"))
def payment_window_stats(i: Inputs):
    return windows.payment_stats(details(i))


@query(_kind("refund"))
def refund_window_stats(i: Inputs):
    return windows.refund_stats(details(i))


DAY = 86400


def _trade(where: str = "") -> str:
    return f"""
SELECT * FROM ({_kind('order', ', count(*) AS sku_num', DAY, where)}) o LEFT JOIN ({_kind('payment', '', DAY, where)}) p USING (stt, edt, sku_id)
LEFT JOIN ({_kind('refund', '', DAY, where)}) r USING (stt, edt, sku_id)
"""


@query(_trade())
def trade_window_stats(i: Inputs):
    return windows.trade_window_stats(details(i), "1 day")


@query(_trade(f"AND {closed(DAY, 'ms', '(SELECT max(ms) FROM t_det)')}"))
def stream_trade_window_stats(i: Inputs):
    return streams.run_to_parquet(windows.trade_window_stats(details(i, live=True), "1 day"), "trade-window")


@query(f"""
SELECT {win(300, 'epoch_us(ts) // 1000')}, {dbl('sum(cast(value as decimal(16,2)))', 'window_gmv')}, count(*) AS window_payments, count(DISTINCT user_id) AS window_users
FROM x_ev WHERE event_type = 'purchase' GROUP BY ALL
""")
def payment_5min(i: Inputs):
    return windows.payment_5min(windows.event_timed(payments(i)))


def payments(i: Inputs):
    return events_of(i).where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("payment_id"), F.col("user_id").cast("string").alias("user_id"), F.col("k").cast("string").alias("sku_id"),
        money("value").alias("amount"), F.col("ms").alias("ts"))


def enriched_orders(i: Inputs, live: bool = False):
    e = events_of(i, live).where(F.col("event_type").isin("click", "purchase", "error"))
    return windows.event_timed(e.select(
        "user_id", (F.col("event_id") % 700).alias("order_id"), F.concat(F.lit("ch"), F.col("k") % 4).alias("channel"),
        F.concat(F.lit("prov"), F.col("user_id") % 25).alias("province"), money("value").alias("order_amount"),
        money(F.when(F.col("event_type") == "error", F.col("value")).otherwise(0)).alias("refund_amount"),
        money(F.col("k") % 5).alias("coupon_amount"), F.when(F.col("event_type") == "purchase", F.col("ts")).alias("pay_time"), F.col("ms").alias("ts")))


cte("t_ord", """
SELECT user_id, event_id % 700 AS order_id, 'ch' || (k % 4) AS channel, 'prov' || (user_id % 25) AS province, cast(value as decimal(16,2)) AS amount,
       CASE WHEN event_type = 'error' THEN cast(value as decimal(16,2)) ELSE 0 END AS refund, k % 5 AS coupon, event_type = 'purchase' AS paid, epoch_us(ts) // 1000 AS ms
FROM x_ev WHERE event_type IN ('click', 'purchase', 'error')
""")


def _user_orders(where: str = "") -> str:
    return f"""
SELECT {win(60, 'ms')}, user_id, count(DISTINCT order_id) AS order_ct, {big('sum(CASE WHEN refund > 0 THEN 1 ELSE 0 END)', 'refund_ct')},
       {dbl('sum(amount)', 'order_amount_sum')}, {dbl('sum(refund)', 'refund_amount_sum')}, {dbl('sum(coupon)', 'coupon_amount_sum')}
FROM t_ord {where} GROUP BY stt, edt, user_id
"""


@query(_user_orders())
def user_order_window(i: Inputs):
    return windows.user_order_window(enriched_orders(i))


@query(_user_orders(f"WHERE {closed(60, 'ms', '(SELECT max(ms) FROM t_ord)')}"))
def stream_user_order_window(i: Inputs):
    return jobs.closed_windows_job(windows.user_order_rows(enriched_orders(i, live=True)), windows.user_order_totals)


@query(f"""
SELECT {win(DAY, 'ms')}, channel, count(DISTINCT user_id) AS user_cnt, count(DISTINCT (user_id, order_id)) AS order_cnt, {dbl('sum(amount)', 'pay_amount')},
       cast(sum(amount) as double) / count(DISTINCT (user_id, order_id)) AS avg_order_amount FROM t_ord GROUP BY stt, edt, channel
""")
def platform_stats(i: Inputs):
    return windows.platform_stats(enriched_orders(i), "1 day")


_PROVINCE = f"""
SELECT province, count(DISTINCT user_id) AS user_cnt, {dbl('sum(amount)', 'order_amount')}, count(DISTINCT CASE WHEN paid THEN user_id END) AS pay_user_cnt,
       {dbl('sum(refund)', 'refund_amount')} FROM t_ord GROUP BY province
"""


@query(_PROVINCE)
def province_stats(i: Inputs):
    return users.province_stats(enriched_orders(i))


@query(_PROVINCE)
def stream_province_stats(i: Inputs):
    return jobs.province_stats_job(enriched_orders(i, live=True))


# alerts

def rules(i: Inputs):
    """One rule per size of part, from the part table: field, operator and threshold vary with it."""
    p = i.table("part").select("p_size").distinct()
    n = F.col("p_size")
    fields = F.array(*[F.lit(f) for f in ("order_amount", "refund_amount", "refund_rate", "order_ct", "order_user_ct", "refund_user_ct", "sku_num")])
    ops = F.array(*[F.lit(o) for o in (">", ">=", "<", "<=", "==")])
    return p.select(n.cast("bigint").alias("id"), F.get(fields, (n % 7).cast("int")).alias("field_name"), F.get(ops, (n % 5).cast("int")).alias("operator"),
                    (n * 0.5).cast("double").alias("threshold"), F.concat(F.lit("rule "), n).alias("description"),
                    F.when(n % 4 == 0, 0).otherwise(1).alias("status"))


@query(f"""
WITH s AS ({_trade()}),
v AS (SELECT stt, edt, sku_id, order_amount, refund_amount, f, CASE f WHEN 'order_amount' THEN order_amount WHEN 'refund_amount' THEN refund_amount
        WHEN 'refund_rate' THEN CASE WHEN order_amount > 0 THEN refund_amount / order_amount END WHEN 'order_ct' THEN order_ct WHEN 'order_user_ct' THEN order_user_ct
        WHEN 'refund_user_ct' THEN refund_user_ct ELSE sku_num END AS val
      FROM s, (VALUES ('order_amount'), ('refund_amount'), ('refund_rate'), ('order_ct'), ('order_user_ct'), ('refund_user_ct'), ('sku_num')) t(f)),
r AS (SELECT DISTINCT cast(p_size as bigint) AS id, p_size * 0.5 AS threshold, p_size % 5 AS op,
        ['order_amount', 'refund_amount', 'refund_rate', 'order_ct', 'order_user_ct', 'refund_user_ct', 'sku_num'][p_size % 7 + 1] AS f FROM part WHERE p_size % 4 <> 0)
SELECT id AS rule_id, 'rule ' || id AS alert_type, edt AS alert_time,
       'ALERT SKU: ' || sku_id || ' | order_amount: ' || printf('%.2f', order_amount) || ' | refund_amount: ' || printf('%.2f', coalesce(refund_amount, 0.0)) AS message
FROM v JOIN r USING (f) WHERE val IS NOT NULL AND CASE op WHEN 0 THEN val > threshold WHEN 1 THEN val >= threshold WHEN 2 THEN val < threshold WHEN 3 THEN val <= threshold ELSE val = threshold END
""")
def metric_alerts(i: Inputs):
    return windows.metric_alerts(windows.trade_window_stats(details(i), "1 day"), rules(i))


@query(f"""
WITH s AS ({_trade()}) SELECT stt, edt, sku_id, '退款率报警 SKU: ' || sku_id || ' 退款率: ' || printf('%.2f', refund_amount / order_amount) || '  阈值: 0.30' AS message
FROM s WHERE order_amount <> 0 AND refund_amount / order_amount > 0.3
""")
def refund_rate_alert(i: Inputs):
    return windows.refund_rate_alert(windows.trade_window_stats(details(i), "1 day"), 0.3)


# users

def behaviour(i: Inputs, live: bool = False):
    k, kind = F.col("k"), F.col("event_type")
    what = F.when(kind == "signup", "cart").when(kind == "purchase", "pay").when(kind == "error", "search").otherwise(kind)
    return events_of(i, live).select(
        "user_id", F.concat_ws("_", "user_id", F.to_date("ts")).alias("session_id"), what.alias("behavior_type"), F.col("ms").alias("behavior_time"),
        F.concat(F.lit("b"), k % 7).alias("brand_id"), F.concat(F.lit("c"), k % 11).alias("category3_id"), F.when(k % 13 != 0, F.concat(F.lit("p"), k % 3)).alias("platform"),
        F.when(k % 2 == 0, "M").alias("user_id_gender"), (18 + F.col("user_id") % 50).cast("string").alias("user_id_age"), F.lit(None).cast("string").alias("user_id_level"),
        F.concat(F.lit("prov"), F.col("user_id") % 25).alias("user_id_province"), F.concat(F.lit("ch"), k % 4).alias("user_id_channel"),
        F.when(k % 5 == 0, "1").alias("user_id_is_blacklist"), F.concat(F.lit("c"), k % 11).alias("category3_id_category3_id"),
        F.concat(F.lit("c2-"), k % 5).alias("category3_id_category2_id"), F.when(k % 3 == 0, F.lit("c1")).alias("category3_id_category1_id"),
        F.concat(F.lit("b"), k % 7).alias("sku_id_brand_id"), F.col("ms").alias("ts"), "event_id")


cte("u_beh", """
SELECT user_id, user_id || '_' || dt AS session_id, CASE event_type WHEN 'signup' THEN 'cart' WHEN 'purchase' THEN 'pay' WHEN 'error' THEN 'search' ELSE event_type END AS b,
       epoch_us(ts) // 1000 AS ms, 'b' || (k % 7) AS brand_id, 'c' || (k % 11) AS category3_id, CASE WHEN k % 13 <> 0 THEN 'p' || (k % 3) END AS platform, k, event_id FROM x_ev
""")
_BEH = f"""
SELECT user_id, {', '.join(big(f"sum({n})", n) for n in ('pv', 'click', 'cart', 'pay'))}, count(*) AS session_ct, {big('sum(CASE WHEN records = 1 THEN 1 ELSE 0 END)', 'bounce_ct')},
       round(avg(len), 2) AS avg_stay_duration FROM (
  SELECT user_id, session_id, count(*) AS records, max(ms) - min(ms) AS len, {', '.join(f"sum(CASE WHEN b = '{k}' THEN 1 ELSE 0 END) AS {n}" for n, k in (('pv', 'view'), ('click', 'click'), ('cart', 'cart'), ('pay', 'pay')))}
  FROM u_beh GROUP BY ALL) GROUP BY user_id
"""


@query(_BEH)
def user_behaviour_stats(i: Inputs):
    return users.user_behaviour_stats(behaviour(i))


@query(_BEH)
def stream_user_behaviour_stats(i: Inputs):
    return jobs.behaviour_stats_job(behaviour(i, live=True))


_FUNNEL = """
SELECT user_id, v AS view_cnt, c AS cart_cnt, p AS pay_cnt, cast(c as double) / v AS view_to_cart_rate, cast(p as double) / c AS cart_to_pay_rate, cast(p as double) / v AS view_to_pay_rate
FROM (SELECT user_id, count(*) FILTER (b = 'view') AS v, count(*) FILTER (b = 'cart') AS c, count(*) FILTER (b = 'pay') AS p FROM u_beh GROUP BY user_id)
WHERE v > 0 AND c > 0 AND p > 0
"""


@query(_FUNNEL)
def user_funnel(i: Inputs):
    return users.user_funnel(behaviour(i))


@query(_FUNNEL)
def user_funnel_all(i: Inputs):
    return users.user_funnel(behaviour(i))


_TOP = "(SELECT user_id, name FROM (SELECT user_id, brand_id AS name, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, brand_id) AS rn FROM u_beh WHERE b = '{k}' GROUP BY user_id, brand_id) WHERE rn = 1)"
_PLACE = "(SELECT user_id, category3_id, platform FROM (SELECT user_id, category3_id, platform, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, category3_id, platform) AS rn FROM u_beh WHERE platform IS NOT NULL GROUP BY user_id, category3_id, platform) WHERE rn = 1)"


def _preference(join: str, tail: str = "") -> str:
    return f"""
SELECT * FROM (SELECT user_id, v.name AS top_view_brand, c.name AS top_cart_brand, p.name AS top_pay_brand, cp.category3_id AS prefer_category3, cp.platform AS prefer_platform
FROM {_TOP.format(k='view')} v {join} JOIN {_TOP.format(k='cart')} c USING (user_id) {join} JOIN {_TOP.format(k='pay')} p USING (user_id) {join} JOIN {_PLACE} cp USING (user_id)) {tail}
"""


@query(_preference("LEFT", "WHERE top_cart_brand IS NOT NULL AND top_pay_brand IS NOT NULL AND prefer_category3 IS NOT NULL AND prefer_platform IS NOT NULL"))
def user_preference(i: Inputs):
    return users.user_preference(behaviour(i), "left", complete_only=True)


@query(_preference("FULL"))
def stream_user_preference(i: Inputs):
    return jobs.preference_job(behaviour(i, live=True))


@query(_preference("FULL"))
def user_preference_full(i: Inputs):
    return users.user_preference(behaviour(i), "full")


@query("""
WITH b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ms DESC, event_id DESC) AS rn FROM u_beh) WHERE rn = 1)
SELECT coalesce(b.user_id, o.user_id) AS user_id, CASE WHEN k % 2 = 0 THEN 'M' ELSE '未知' END AS gender, CASE WHEN b.user_id IS NULL THEN '未知' ELSE 18 + b.user_id % 50 || '' END AS age, '未知' AS level,
       coalesce('prov' || (b.user_id % 25), '未知') AS province, coalesce('ch' || (k % 4), '未知') AS channel, CASE WHEN k % 5 = 0 THEN '1' ELSE '0' END AS is_blacklist,
       coalesce('c' || (k % 11), '无') AS top_click_category3, coalesce('c2-' || (k % 5), '无') AS top_click_category2, CASE WHEN k % 3 = 0 THEN 'c1' ELSE '无' END AS top_click_category1,
       coalesce('b' || (k % 7), '无') AS top_brand
FROM b FULL JOIN (SELECT DISTINCT o_custkey AS user_id FROM orders) o ON b.user_id = o.user_id
""")
def user_tags(i: Inputs):
    bought = i.table("orders").select(F.col("o_custkey").alias("user_id"))
    return users.user_tags(behaviour(i), bought, ("ts", "event_id"))


# de-duplication

def doubled(i: Inputs, live: bool = False):
    """Orders with every third one sent twice and every fifth one sent again with the same key and another time."""
    o = stream_of(i, "orders") if live else i.table("orders")
    copies = F.filter(F.array(F.lit(0), F.when(F.col("o_orderkey") % 3 == 0, 0), F.when(F.col("o_orderkey") % 5 == 0, 1)), lambda c: c.isNotNull())
    rows = o.select("o_orderkey", "o_custkey", "o_orderdate", F.explode(copies).alias("again"))
    return rows.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("event_time"),
                       (F.unix_millis("o_orderdate") + F.col("again")).alias("ts_ms"))


_ONCE = "SELECT o_orderkey AS order_id, o_custkey AS user_id, epoch_us(o_orderdate) // 1000 + a AS ts_ms FROM orders, (VALUES (0), (1)) t(a) WHERE a = 0 OR o_orderkey % 5 = 0"


@query(_ONCE)
def dedup_exact(i: Inputs):
    return dedup.dedup_exact(doubled(i)).drop("event_time")


@query(_ONCE)
def stream_dedup_exact(i: Inputs):
    return streams.run_to_parquet(state.exactly_once(doubled(i, live=True)), "dedup").drop("event_time")


@query(_ONCE)
def dedup_bounded(i: Inputs):
    return dedup.dedup_bounded(doubled(i), ["order_id", "ts_ms"], "event_time", "1 hour").drop("event_time")


@query(_ONCE)
def stream_dedup_bounded(i: Inputs):
    return streams.run_to_parquet(dedup.dedup_bounded(doubled(i, live=True), ["order_id", "ts_ms"], "event_time", "1 hour").drop("event_time"), "dedup-bounded")


_NEWER = """
SELECT o_custkey AS user_id, o_orderkey AS order_id, ms AS ts_ms FROM (SELECT *, max(ms) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
FROM (SELECT *, epoch_us(o_orderdate) // 1000 AS ms FROM orders)) WHERE seen IS NULL OR ms > seen
"""


def arriving(i: Inputs, live: bool = False):
    o = stream_of(i, "orders", "o_orderkey") if live else i.table("orders")
    return o.select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("order_id"), F.unix_millis("o_orderdate").alias("ts_ms"))


@query(_NEWER)
def dedup_newer_only(i: Inputs):
    return dedup.dedup_newer_only(arriving(i), ["user_id"], ["order_id"])


@query(_NEWER)
def stream_dedup_newer_only(i: Inputs):
    return jobs.newer_only_job(arriving(i, live=True), ["user_id"], ["order_id"])


@query("""
WITH e AS (SELECT event_type, event_id, ts, event_id // 50 AS batch, CASE WHEN event_id % 40 = 7 THEN ts - interval 2 hours ELSE ts END AS at_time FROM x_ev),
t AS (SELECT event_type, batch, max(max(at_time)) OVER (PARTITION BY event_type ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM e GROUP BY event_type, batch)
SELECT e.event_type, e.event_id, e.batch, coalesce(at_time < top - interval 5 seconds, false) AS is_late FROM e JOIN t ON e.event_type = t.event_type AND e.batch = t.batch
""")
def late_rows(i: Inputs):
    moved = F.when(F.col("event_id") % 40 == 7, F.col("ts") - F.expr("interval 2 hours")).otherwise(F.col("ts"))
    e = events_of(i).select("event_type", "event_id", moved.alias("at"), F.expr("event_id div 50").alias("batch"))
    return dedup.late_rows(e, 5, "event_type", "at", "batch").drop("at")


# late rows of a faulty source, to an output of their own, before the windows

_FAULTY_EVENTS = faulty_sql("(SELECT event_id, event_type, user_id, k AS sku_id, cast(value as decimal(16,2)) AS amount, epoch_us(ts) // 1000 AS ms FROM x_ev)", "event_id", "ms")
_SPLIT = f"""
WITH e AS ({_FAULTY_EVENTS}),
t AS (SELECT event_type, batch, max(max(ms)) OVER (PARTITION BY event_type ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM e GROUP BY event_type, batch),
m AS (SELECT e.*, coalesce(ms < top - 5000, false) AS is_late FROM e JOIN t USING (event_type, batch))
"""


def split_events(i: Inputs):
    e = events_of(i).select("event_id", "event_type", "user_id", F.col("k").alias("sku_id"), money("value").alias("amount"), "ms")
    lines = faulty_lines(i, e, "event_id", "ms", "faulty-events")
    rows = streams.parsed(lines, T.StructType.fromDDL("event_id bigint, event_type string, user_id bigint, sku_id bigint, amount decimal(16,2), ms bigint"))
    return jobs.late_split_job(rows.withColumn("at", F.timestamp_millis("ms")), 5, "event_type", "at", scratch(i.spark, "late-rows"))


@query(_SPLIT + "SELECT event_type, event_id, ms AS ts, is_late FROM m")
def stream_late_rows(i: Inputs):
    on_time, late = split_events(i)
    rows = on_time.withColumn("is_late", F.lit(False)).unionByName(late.withColumn("is_late", F.lit(True)))
    return rows.select("event_type", "event_id", F.col("ms").alias("ts"), "is_late")


@query(_SPLIT + f"""SELECT {win(3600, 'ms')}, sku_id, count(*) AS order_ct, count(DISTINCT user_id) AS order_user_ct, count(*) AS sku_num, {dbl('sum(amount)', 'order_amount')}
FROM m WHERE event_type = 'click' AND NOT is_late GROUP BY stt, edt, sku_id""")
def stream_on_time_windows(i: Inputs):
    on_time, _ = split_events(i)
    orders = on_time.where(F.col("event_type") == "click").select(
        "sku_id", "user_id", F.col("event_id").alias("order_id"), F.lit("order").alias("event_type"), F.col("amount").alias("order_amount"), F.col("ms").alias("ts"))
    return windows.order_stats(windows.event_timed(orders), "1 hour")


# alerts of a stream whose rules change

RULE_SCHEMA = "id bigint, field_name string, operator string, threshold double, description string, status int"
ALERT_SCHEMA = "rule_id bigint, alert_type string, message string, alert_time string"


def rules_of(i: Inputs, version: int):
    """The rules as of a version: some are added with 2, some thresholds double with 3, some are switched off with 4."""
    n = F.col("id")
    return rules(i).where((n % 5 != 3) | F.lit(version >= 2)).withColumns({
        "threshold": F.when((n % 3 == 2) & F.lit(version >= 3), F.col("threshold") * 2).otherwise(F.col("threshold")),
        "status": F.when((n % 7 == 1) & F.lit(version >= 4), 0).otherwise(F.col("status"))})


@query(f"""
WITH s AS (SELECT *, epoch(strptime(stt, '%Y-%m-%d %H:%M:%S'))::BIGINT AS sec FROM ({_trade()})),
b AS (SELECT *, (sec - min(sec) OVER ()) * 5 // (max(sec) OVER () - min(sec) OVER () + 1) AS version FROM s),
v AS (SELECT stt, edt, sku_id, version, order_amount, refund_amount, f, CASE f WHEN 'order_amount' THEN order_amount WHEN 'refund_amount' THEN refund_amount
        WHEN 'refund_rate' THEN CASE WHEN order_amount > 0 THEN refund_amount / order_amount END WHEN 'order_ct' THEN order_ct WHEN 'order_user_ct' THEN order_user_ct
        WHEN 'refund_user_ct' THEN refund_user_ct ELSE sku_num END AS val
      FROM b, (VALUES ('order_amount'), ('refund_amount'), ('refund_rate'), ('order_ct'), ('order_user_ct'), ('refund_user_ct'), ('sku_num')) t(f)),
p AS (SELECT DISTINCT cast(p_size as bigint) AS id FROM part WHERE p_size % 4 <> 0),
r AS (SELECT id, version, id * 0.5 * CASE WHEN id % 3 = 2 AND version >= 3 THEN 2 ELSE 1 END AS threshold, id % 5 AS op,
        ['order_amount', 'refund_amount', 'refund_rate', 'order_ct', 'order_user_ct', 'refund_user_ct', 'sku_num'][id % 7 + 1] AS f
      FROM p, range(5) x(version) WHERE (id % 5 <> 3 OR version >= 2) AND NOT (id % 7 = 1 AND version >= 4))
SELECT id AS rule_id, 'rule ' || id AS alert_type, edt AS alert_time,
       'ALERT SKU: ' || sku_id || ' | order_amount: ' || printf('%.2f', order_amount) || ' | refund_amount: ' || printf('%.2f', coalesce(refund_amount, 0.0)) AS message
FROM v JOIN r USING (f, version) WHERE val IS NOT NULL AND CASE op WHEN 0 THEN val > threshold WHEN 1 THEN val >= threshold WHEN 2 THEN val < threshold WHEN 3 THEN val <= threshold ELSE val = threshold END
""")
def stream_metric_alerts(i: Inputs):
    stats = windows.trade_window_stats(details(i), "1 day")
    timed_stats = stats.withColumn("_sec", F.unix_timestamp("stt"))
    first, last = timed_stats.agg(F.min("_sec"), F.max("_sec")).first()
    folder = dealt(i, timed_stats.withColumn("_batch", batch_of("_sec", first or 0, last or 0)).drop("_sec"), "window-stats")
    source = i.spark.readStream.schema(stats.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    book = jobs.RuleBook(i.spark, scratch(i.spark, "rule-book"), RULE_SCHEMA)
    return jobs.alert_job(source, book, windows.metric_alerts, scratch(i.spark, "alerts"), ALERT_SCHEMA, before=lambda n: book.publish(rules_of(i, n), n))


# messages, words, pages

@query("""
WITH m AS (SELECT doc_id, split_part(regexp_replace(text, ',+\\z', ''), ',', -1) AS last FROM documents),
w AS (SELECT DISTINCT last AS word FROM m JOIN labels USING (doc_id) WHERE toxic = 1)
SELECT doc_id AS user_id, cast(CASE WHEN word IS NOT NULL THEN 1 ELSE 0 END as bigint) AS is_violation, CASE WHEN word IS NOT NULL THEN 'P0' ELSE '' END AS violation_grade, coalesce(word, '') AS violation_msg
FROM m LEFT JOIN w ON last = word
""")
def flag_sensitive_messages(i: Inputs):
    docs = i.table("documents").select(F.col("doc_id").alias("user_id"), F.col("text").alias("msg"))
    bad = i.table("labels").where(F.col("toxic") == 1).select(F.col("doc_id").alias("user_id"))
    listed = docs.join(bad, "user_id").select(text.last_part("msg").alias("word"))
    return text.flag_sensitive_messages(docs, listed).drop("msg")


@query(f"""
SELECT {win(600, 'cast(epoch_us(ts) // 1000 as bigint)')}, source, word AS keyword, count(*) AS ct FROM (
  SELECT timestamp '2024-01-01' + doc_id * interval 1 second AS ts, source, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS word FROM documents) GROUP BY ALL
""")
def keyword_counts(i: Inputs):
    docs = i.table("documents").select(F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id")).alias("ts"), "source", "text")
    return text.keyword_counts(docs, "text", "ts", "source", "10 minutes")


@query("""
SELECT page_id, url, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title, trim(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)) AS heading,
       trim(regexp_extract(html, '(?is)<html[^>]*\\slang="([^"]*)"', 1)) AS lang, array_to_string(regexp_extract_all(html, '(?is)<a\\s[^>]*href="([^"]*)"', 1), '|') AS links,
       cast(len(regexp_extract_all(html, '(?is)<p[^>]*>(.*?)</p>', 1)) as bigint) AS paragraphs FROM pages
""")
def extract_page_fields(i: Inputs):
    wide = text.extract_page_fields(i.table("pages"))
    return wide.withColumns({"links": F.array_join("links", "|"), "paragraphs": F.size("paragraphs")})


@query("""
WITH bare AS (SELECT page_id, url, regexp_replace(html, '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g') AS html FROM pages),
     items AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1)) AS item, generate_subscripts(regexp_extract_all(html, '(?is)<li[^>]*>(.*?)</li>', 1), 1) AS item_no FROM bare)
SELECT page_id, url, cast(item_no AS bigint) AS item_no, CASE WHEN item NOT LIKE '%href="/t%' THEN split_part(split_part(item, 'href="', 2), '"', 1) END AS href,
       CASE WHEN item LIKE '%href="/t%' THEN split_part(split_part(item, 'href="', 2), '"', 1) END AS old_name,
       trim(regexp_replace(regexp_replace(item, '<[^>]*>', '', 'g'), '\\s+', ' ', 'g')) AS label FROM items
""")
def extract_page_items(i: Inputs):
    """A third of the pages with single quotes; links to /t... hold a name in place of an href."""
    html = F.regexp_replace("html", 'href="/t', 'name="/t')
    pages = i.table("pages").withColumn("html", F.when(F.col("page_id") % 3 == 1, F.translate(html, '"', "'")).otherwise(html))
    return items.extract_page_items(pages, "li", {"href": items.attribute("a", "href"), "old_name": items.attribute("a", "name"), "label": items.element("a")})


# the first rows of a stream

FIRST_ROWS = 100


@query(f"""
SELECT o_orderkey AS id, o_custkey AS user_id, o_orderstatus AS status
FROM (SELECT *, (o_orderkey - min(o_orderkey) OVER ()) * 5 // (max(o_orderkey) OVER () - min(o_orderkey) OVER () + 1) AS own FROM orders)
WHERE own = 0 ORDER BY o_orderkey DESC LIMIT {FIRST_ROWS}
""")
def stream_first_rows(i: Inputs):
    """The first rows of five files of orders, each in falling order of key; later batches add none."""
    o = i.table("orders")
    first, last = o.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    line = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("status")))
    rows = o.select(line.alias("value"), F.col("o_orderkey").alias("_at"), batch_of("o_orderkey", first or 0, last or 0).alias("_batch"))
    schema = schemas.struct(id="bigint", user_id="bigint", status="string")
    stream = streams.json_stream(i.spark, "text", dealt(i, rows, "first-rows", "text", "_at"), schema, files_per_batch=1)
    return streams.run_to_parquet(streams.first_rows(stream, FIRST_ROWS), "first")
