"""Change records: flatten, route, cut into facts and dimensions, join into wide order rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.latest import latest_by_key
from tidemill.sources.bucketed import Bucketed
from tidemill.sources.schemas import ORDER_ROW
from tidemill.sources.streams import once

# Where change records go by table and operation, and the sink of all others.
FACT_ROUTES = [
    ("favor_info", "insert", "dwd_interaction_favor_add"),
    ("coupon_use", "insert", "dwd_tool_coupon_get"),
    ("coupon_use", "update", "dwd_tool_coupon_use"),
    ("order_info", "insert", "dwd_trade_order_detail"),
    ("order_info", "update", "dwd_trade_order_pay"),
    ("refund_payment", "insert", "dwd_trade_order_refund"),
    ("payment_info", "insert", "dwd_trade_pay_detail"),
    ("user_info", "insert", "dwd_user_register"),
]
DEFAULT_SINK = "dwd_dynamic_fallback"

# Dimension rules - source table, sink table, columns kept, row key.
DIM_RULES = [
    ("activity_info", "dim_activity_info", "id,activity_name,activity_type,activity_desc,start_time,end_time,create_time", "id"),
    ("activity_rule", "dim_activity_rule", "id,activity_id,activity_type,condition_amount,condition_num,benefit_amount,benefit_discount,benefit_level", "id"),
    ("activity_sku", "dim_activity_sku", "id,activity_id,sku_id,create_time", "id"),
    ("base_category1", "dim_base_category1", "id,name", "id"),
    ("base_category2", "dim_base_category2", "id,name,category1_id", "id"),
    ("base_category3", "dim_base_category3", "id,name,category2_id", "id"),
    ("base_province", "dim_base_province", "id,name,region_id,area_code,iso_code,iso_3166_2", "id"),
    ("base_region", "dim_base_region", "id,region_name", "id"),
    ("base_trademark", "dim_base_trademark", "id,tm_name", "id"),
    ("coupon_info", "dim_coupon_info", "id,coupon_name,coupon_type,condition_amount,condition_num,activity_id,benefit_amount,benefit_discount,create_time,range_type,limit_num,taken_count,start_time,end_time,operate_time,expire_time,range_desc", "id"),
    ("coupon_range", "dim_coupon_range", "id,coupon_id,range_type,range_id", "id"),
    ("financial_sku_cost", "dim_financial_sku_cost", "id,sku_id,sku_name,busi_date,is_lastest,sku_cost,create_time", "id"),
    ("sku_info", "dim_sku_info", "id,spu_id,price,sku_name,sku_desc,weight,tm_id,category3_id,sku_default_img,is_sale,create_time", "id"),
    ("spu_info", "dim_spu_info", "id,spu_name,description,category3_id,tm_id", "id"),
    ("user_info", "dim_user_info", "id,login_name,name,user_level,birthday,gender,create_time,operate_time", "id"),
    ("base_dic", "dim_base_dic", "dic_code,dic_name", "dic_code"),
]


def fact_routes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FACT_ROUTES, "table string, type string, sink_table string")


def dim_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DIM_RULES, "source_table string, sink_table string, sink_columns string, sink_row_key string")


def _table() -> Column:
    return F.col("source")["table"]


def _kind(op: Column, read_as: str) -> Column:
    return (
        F.when(op == "c", "insert").when(op == "r", read_as).when(op == "u", "update").when(op == "d", "delete")
    )


def cdc_flatten(envelopes: DataFrame) -> DataFrame:
    """database, tableName, type, before, after; missing rows become empty objects and a create becomes an insert."""
    return envelopes.select(
        F.col("source")["db"].alias("database"), _table().alias("tableName"), _kind(F.col("op"), "read").alias("type"),
        F.coalesce("before", F.lit("{}")).alias("before"), F.coalesce("after", F.lit("{}")).alias("after"),
    )


def cdc_route(envelopes: DataFrame, routes: DataFrame, default: str = DEFAULT_SINK) -> DataFrame:
    """Records with an ``after`` row and the sink for their table and operation; snapshot rows count as inserts."""
    rows = envelopes.where(F.col("after").isNotNull()).select(
        _table().alias("_t"), _kind(F.col("op"), "insert").alias("_k"), F.col("after").alias("data")
    )
    # routes are a handful of rows of configuration; without the hint the records of one table and operation meet in one task
    named = F.broadcast(routes.select(F.col("table").alias("_rt"), F.col("type").alias("_rk"), "sink_table"))
    on = (F.col("_t") == F.col("_rt")) & (F.col("_k") == F.col("_rk"))
    return rows.join(named, on, "left").select(F.coalesce("sink_table", F.lit(default)).alias("sink_table"), "data")


def snapshot_rows(envelopes: DataFrame, table: str, schema) -> DataFrame:
    """The ``after`` rows of one table's snapshot records, parsed."""
    rows = envelopes.where((_table() == table) & (F.col("op") == "r") & F.col("after").isNotNull())
    return rows.select(once(F.from_json("after", schema)).alias("row")).select("row.*")


# Fields taken over per table, as target name -> field of the change record.
FACT_FIELDS = {
    "order_info": {"order_id": "id", "user_id": "user_id", "sku_id": "sku_id", "province_id": "province_id",
                   "total_amount": "total_amount", "create_time": "create_time"},
    "payment_info": {"payment_id": "id", "order_id": "order_id", "user_id": "user_id", "total_amount": "total_amount",
                     "payment_type": "payment_type", "payment_time": "payment_time"},
    "refund_info": {"refund_id": "id", "order_id": "order_id", "user_id": "user_id", "refund_amount": "refund_amount",
                    "refund_type": "refund_type", "refund_time": "refund_time"},
}


def cdc_facts(envelopes: DataFrame, table: str) -> DataFrame:
    """All change rows of a table with its mapped fields, its operation and its time."""
    fields = FACT_FIELDS[table]
    rows = envelopes.where((_table() == table) & F.col("after").isNotNull())
    return rows.select(
        F.lit(table).alias("table"), "op", F.col("ts_ms").alias("ts"),
        *[F.get_json_object("after", f"$.{source}").alias(name) for name, source in fields.items()],
    )


def split_by_table(envelopes: DataFrame, tables: Sequence[str]) -> dict[str, DataFrame]:
    return {t: envelopes.where(_table() == t) for t in tables}


# dimensions

def current_config(config_changes: DataFrame) -> DataFrame:
    """Rule changes (op, source_table, sink_table, sink_columns, sink_row_key, ts_ms) -> rules in force.

    A deleted rule is gone; a changed rule replaces the old one of its source table.
    """
    newest = latest_by_key(config_changes, ["source_table"], ["ts_ms"])
    return newest.where(F.col("op") != "d").drop("op", "ts_ms")


def dim_changes(envelopes: DataFrame, rules: DataFrame) -> DataFrame:
    """Change rows of configured tables: sink table, row key, the configured columns as a map, time."""
    rows = envelopes.where((F.col("op") != "d") & F.col("after").isNotNull()).select(
        _table().alias("_t"), once(F.from_json("after", "map<string,string>")).alias("_row"), "ts_ms"
    )
    # rules are a handful of rows of configuration; without the hint all records of a table meet in one task
    joined = rows.join(F.broadcast(rules), F.col("_t") == F.col("source_table"))
    keep = F.split("sink_columns", ",")
    return joined.select(
        "sink_table", F.col("_row")[F.col("sink_row_key")].alias("row_key"),
        F.map_filter("_row", lambda name, _: F.array_contains(keep, name)).alias("columns"), "ts_ms",
    ).where(F.col("row_key").isNotNull())


def cdc_dims_by_config(envelopes: DataFrame, rules: DataFrame) -> DataFrame:
    """The newest row per sink table and row key."""
    changes = dim_changes(envelopes, rules)
    newest = changes.groupBy("sink_table", "row_key").agg(
        F.max_by(F.map_entries("columns"), F.struct("ts_ms", F.to_json("columns"))).alias("entries")
    )
    return newest.select("sink_table", "row_key", F.map_from_entries("entries").alias("columns"))


# wide orders

WIDE_TABLES = {
    "order_detail": ["id"],
    "order_info": ["id"],
    "order_detail_activity": ["order_detail_id"],
    "order_detail_coupon": ["order_detail_id"],
    "payment_info": ["order_id"],
    "order_refund_info": ["order_id"],
}


def order_rows(envelopes: DataFrame) -> DataFrame:
    """Change records with ``after`` read as an order row."""
    rows = envelopes.where(F.col("after").isNotNull())
    return rows.select(_table().alias("table"), once(F.from_json("after", ORDER_ROW)).alias("after"), "ts_ms")


_DETAIL_TABLES = ("order_detail", "order_detail_activity", "order_detail_coupon")
# Details are reduced a quarter at a time, so that what they are reduced from and to is never there as a whole.
_QUARTERS = [f"detail-{n}" for n in range(4)]


def keyed_rows(rows: DataFrame) -> DataFrame:
    """Order rows with ``side`` (order, or a quarter of the details) and the ``key`` they are reduced by. A field that is the key of its table is left out of the
    row, where all rows of a key hold the same."""
    table = F.col("table")
    keyed_by = {field: [t for t, fields in WIDE_TABLES.items() if fields == [field]] for field in ("id", "order_detail_id", "order_id")}
    fields = {n: F.col(f"after.{n}") for n in ORDER_ROW.names}
    key = F.coalesce(*[F.when(table.isin(tables), fields[n]) for n, tables in keyed_by.items()])
    after = [(F.when(~table.isin(keyed_by[n]), c) if n in keyed_by else c).alias(n) for n, c in fields.items()]
    quarter = F.concat(F.lit("detail-"), F.pmod(F.xxhash64(key), F.lit(len(_QUARTERS))))
    side = F.when(table.isin(*_DETAIL_TABLES), quarter).otherwise("order")
    return rows.where(table.isin(*WIDE_TABLES)).select(side.alias("side"), key.alias("key"), "table", F.struct(*after).alias("after"), "ts_ms")


def _newest(table: str, columns: dict[str, str], by_refund_time: bool = False) -> Column:
    """Among the rows of one table in a group: the wanted columns of the newest one; of equal times the greatest row.

    The row that decides is the row that is wanted, so it is kept once.
    """
    here = F.col("table") == table
    newest = F.max(F.when(here, F.struct(*([F.col("after.refund_create_time").alias("_at")] if by_refund_time else []), "ts_ms", "after")))
    wanted = [(newest["ts_ms"] if source == "ts_ms" else newest["after"][source.removeprefix("after.")]).alias(name) for name, source in columns.items()]
    return F.when(newest.isNotNull(), F.struct(*wanted))


_DETAIL = {"order_id": "after.order_id", "sku_id": "after.sku_id", "sku_name": "after.sku_name", "order_price": "after.order_price",
           "sku_num": "after.sku_num", "order_detail_create_time": "after.create_time", "ts": "ts_ms"}
_ORDER = {"user_id": "after.user_id", "province_id": "after.province_id", "order_create_time": "after.create_time"}
_PAYMENT = {"payment_type": "after.payment_type", "payment_time": "after.callback_time", "pay_amount": "after.total_amount"}
_REFUND = {"refund_amount": "after.refund_amount", "refund_reason_type": "after.refund_reason_type",
           "refund_create_time": "after.refund_create_time"}


def wide_details(keyed: DataFrame) -> DataFrame:
    """The newest rows of the three tables keyed by detail, in one aggregation."""
    return keyed.where(F.col("side") != "order").groupBy(F.col("key").alias("order_detail_id")).agg(
        _newest("order_detail", _DETAIL).alias("detail"),
        _newest("order_detail_activity", {"activity_id": "after.activity_id"}).alias("activity"),
        _newest("order_detail_coupon", {"coupon_id": "after.coupon_id"}).alias("coupon"),
    ).where(F.col("detail").isNotNull()).select("order_detail_id", "detail.*", "activity.activity_id", "coupon.coupon_id")


def wide_orders(keyed: DataFrame) -> DataFrame:
    """The newest rows of the three tables keyed by order, in one aggregation. Orders without a user are left out."""
    return keyed.where(F.col("side") == "order").groupBy(F.col("key").alias("_order")).agg(
        _newest("order_info", _ORDER).alias("info"), _newest("payment_info", _PAYMENT).alias("payment"),
        _newest("order_refund_info", _REFUND, by_refund_time=True).alias("refund"),
    ).where(F.col("info.user_id").isNotNull()).select("_order", "info.*", "payment.*", "refund.*")


def wide_met(details: DataFrame, orders: DataFrame) -> DataFrame:
    """Details with the rows of their order. Sizes are estimated from the files, before their rows become text and are parsed, so the
    join is asked not to broadcast."""
    kind = F.when(F.col("refund_amount").isNotNull(), "refund").when(F.col("pay_amount").isNotNull(), "payment").otherwise("order")
    return details.join(orders.hint("merge"), F.col("order_id") == F.col("_order")).drop("_order").withColumn("event_type", kind)


def wide_of_rows(rows: DataFrame) -> DataFrame:
    """Detail with its order, promotion, coupon, payment and newest refund; rows without a user are left out.

    The three tables keyed by detail are reduced in one aggregation, the three keyed by order in another, and the
    two results meet in a single join - in place of five joins of six de-duplicated tables.
    """
    keyed = keyed_rows(rows)
    return wide_met(wide_details(keyed), wide_orders(keyed))


def wide_log(spark: SparkSession) -> Bucketed:
    """A log of ``keyed_rows``, to which rows can be added; a row that is added again changes nothing."""
    return Bucketed(spark, "wide_rows", "key", by="side")


def wide_of_log(log: Bucketed) -> DataFrame:
    """``wide_of_rows`` of the rows of a log. Details are written once more, dealt by order, so nothing is shuffled; the log's rows of
    the details go as that is done."""
    keyed = log.read()
    details = Bucketed(log.spark, "wide_details", "order_id")
    for quarter in _QUARTERS:
        details.add(wide_details(keyed.where(F.col("side") == quarter)))
        log.drop(quarter)
    return wide_met(details.read(), wide_orders(keyed))


# Change records of more than these bytes, as the planner estimates them, are reduced from a log.
LOG_BYTES = 256 << 20


def cdc_order_wide(envelopes: DataFrame) -> DataFrame:
    """Wide rows of all change records. Many records are parsed once and kept in a log, in place of shuffles of whole rows."""
    rows = order_rows(envelopes)
    if int(envelopes._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= LOG_BYTES:
        return wide_of_rows(rows)
    log = wide_log(envelopes.sparkSession)
    log.add(keyed_rows(rows))
    return wide_of_log(log)


def lifecycle_events(orders: DataFrame, payments: DataFrame, refunds: DataFrame) -> DataFrame:
    """Order, payment and refund rows as events of an order detail, each with only its own amount."""
    def event(df: DataFrame, amount: str, *columns: str) -> DataFrame:
        return df.select("order_detail_id", "order_id", "user_id", *columns, F.col("total_amount").cast("double").alias(amount), "ts")

    parts = [event(orders, "order_amount", "sku_id"), event(payments, "pay_amount"), event(refunds, "refund_amount", "sku_id")]
    both = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return both.where(F.col("order_detail_id").isNotNull())


def lifecycle_events_of(lines: DataFrame, kinds: dict[str, tuple[Column | None, Column, Column]]) -> DataFrame:
    """``lifecycle_events`` of rows that hold order, payment and refund at once, in one pass.

    ``kinds`` names each amount (``order_amount``, ``pay_amount``, ``refund_amount``) with its condition (None: every row), value and time.
    """
    events = []
    for name, (present, value, ts) in kinds.items():
        sku = F.lit(None).cast(lines.schema["sku_id"].dataType) if name == "pay_amount" else F.col("sku_id")
        amounts = [(value if n == name else F.lit(None)).cast("double").alias(n) for n in kinds]
        event = F.struct(sku.alias("sku_id"), *amounts, ts.alias("ts"))
        events.append(event if present is None else F.when(present, event))
    base = ["order_detail_id", "order_id", "user_id"]
    rows = lines.where(F.col("order_detail_id").isNotNull()).select(*base, F.explode(F.array_compact(F.array(*events))).alias("_event"))
    return rows.select(*base, "_event.*")


def order_lifecycle_merge(events: DataFrame) -> DataFrame:
    """One row per order detail: for each column the newest value that is not NULL; of equal times the greatest."""
    columns = ["order_id", "user_id", "sku_id", "order_amount", "pay_amount", "refund_amount"]
    return events.groupBy("order_detail_id").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("ts", c))).alias(c) for c in columns], F.max("ts").alias("ts")
    )


def order_refund_interval_join(
    orders: DataFrame, refunds: DataFrame, minutes: int = 5, delay: str = "5 seconds"
) -> DataFrame:
    """Orders and refunds of the same order at most ``minutes`` apart. On streams the bound also limits the state."""
    o = orders.withWatermark("order_time", delay)
    r = refunds.select(F.col("order_id").alias("_refund_order"), *[c for c in refunds.columns if c != "order_id"]).withWatermark(
        "refund_time", delay)
    gap = F.expr(f"refund_time between order_time - interval {minutes} minutes and order_time + interval {minutes} minutes")
    return o.join(r, (F.col("order_id") == F.col("_refund_order")) & gap).drop("_refund_order")


# snapshot phase

def is_snapshot() -> Column:
    return F.coalesce((F.col("op") == "r") | (F.col("source")["snapshot"] == "true"), F.lit(False))


def snapshot_phase_filter(envelopes: DataFrame) -> DataFrame:
    return envelopes.where(is_snapshot())


def snapshot_completion(envelopes: DataFrame) -> DataFrame:
    """Tables whose snapshot is over: the time of their first change record."""
    return envelopes.where(~is_snapshot()).groupBy(_table().alias("table")).agg(F.min("ts_ms").alias("completed_at"))
