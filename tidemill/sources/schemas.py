"""Explicit schemas of the streamed records. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def struct(**fields: str | T.DataType) -> T.StructType:
    kinds = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType()}
    return T.StructType([T.StructField(n, kinds[t] if isinstance(t, str) else t) for n, t in fields.items()])


COMMON = struct(**{c: "string" for c in ("ar", "uid", "ch", "is_new", "vc", "ba", "os", "md", "mid", "sid")})
PAGE = struct(
    page_id="string", last_page_id="string", during_time="bigint", item="string", item_type="string",
    from_pos_id="string", from_pos_seq="string", refer_id="string",
)
DISPLAY = struct(item="string", item_type="string", pos_id="int", pos_seq="int")
ACTION = struct(action_id="string", item="string", item_type="string", ts="bigint")
START = struct(entry="string", loading_time="bigint", open_ad_id="string", open_ad_ms="bigint", open_ad_skip_ms="bigint")
ERROR = struct(error_code="bigint", msg="string")
APP_LOG = struct(
    common=COMMON, page=PAGE, start=START, displays=T.ArrayType(DISPLAY), actions=T.ArrayType(ACTION), err=ERROR, ts="bigint",
)
USER_ACTION = struct(
    event_type="string", mid="string", event_ts="bigint", common=COMMON, page=PAGE, display=DISPLAY, action=ACTION, ts="bigint",
)

# ``before`` and ``after`` stay JSON text: their fields depend on the source table.
ENVELOPE = struct(
    op="string", before="string", after="string", source=T.MapType(T.StringType(), T.StringType()), ts_ms="bigint",
)

ORDER_ROW = struct(**{c: "string" for c in (
    "id", "order_id", "order_detail_id", "sku_id", "sku_name", "order_price", "sku_num", "create_time", "user_id",
    "province_id", "activity_id", "activity_rule_id", "coupon_id", "coupon_use_id", "payment_type", "callback_time",
    "total_amount", "refund_amount", "refund_reason_type", "refund_reason_txt", "refund_create_time",
)})

ORDER_WIDE = struct(**{c: "string" for c in (
    "order_detail_id", "order_id", "sku_id", "sku_name", "order_price", "sku_num", "order_detail_create_time", "user_id",
    "province_id", "order_create_time", "activity_id", "coupon_id", "payment_type", "payment_time", "pay_amount",
    "refund_amount", "refund_reason_type", "refund_create_time", "event_type",
)}, ts="bigint")
