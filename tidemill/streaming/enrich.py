"""Dimension enrichment of streams and batches: left joins against dimension tables; rows without a match pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.joins import lookup, lookup_text
from tidemill.sources.schemas import ORDER_WIDE, USER_ACTION, struct
from tidemill.sources.streams import parse


def _chain(df: DataFrame, dims: Mapping[str, tuple[DataFrame, str]], keys: Sequence[str]) -> DataFrame:
    """For each key: join its dimension, fields named ``<key>_<column>``."""
    for key in keys:
        dim, dim_key = dims[key]
        df = lookup_text(df, dim, key, dim_key, dim.columns, f"{key}_")
    return df


def enrich_orders(orders: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """User, item, category, province and page fields of an order row."""
    return _chain(orders, dims, ["user_id", "sku_id", "category3_id", "province", "page_id"])


def enrich_behaviour(behaviour: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """User, item, category and page fields of a behaviour row."""
    return _chain(behaviour, dims, ["user_id", "sku_id", "category3_id", "page_id"])


def _dim_fields(df: DataFrame, dim: DataFrame, key: Column, dim_key: str, columns: Sequence[str] | None = None, prefix: str = "dim_") -> DataFrame:
    """Add ``dim_<column>`` fields; where an earlier dimension gave the same field, the later one wins if it has a value."""
    columns = dim.columns if columns is None else columns
    joined = lookup_text(df, dim, key, dim_key, columns, "_new_")
    fields = {}
    for c in columns:
        new = F.col(f"_new_{c}")
        fields[f"{prefix}{c}"] = F.coalesce(new, F.col(f"{prefix}{c}")) if f"{prefix}{c}" in df.columns else new
    return joined.withColumns(fields).drop(*[f"_new_{c}" for c in columns])


def _key_of(df: DataFrame, name: str, extra: Sequence[Column] = ()) -> Column:
    """The key from the row itself, else from what earlier dimensions gave."""
    here = [F.col(c) for c in (name, f"dim_{name}") if c in df.columns]
    return F.coalesce(*here, *extra) if here or extra else F.lit(None).cast("string")


ORDER_DETAIL_KEYS = ["sku_id", "spu_id", "category3_id", "tm_id", "user_id", "province_id"]


def _completed(dims: Mapping[str, tuple[DataFrame, str]], keys: Sequence[str], held: Sequence[str]) -> list[tuple[str, DataFrame]]:
    """The dimensions to join to the rows, by ``_key``. One whose key no record holds and one dimension before it gives is joined to that
    dimension in place of the rows: each join of the rows moves them all."""
    out: list[tuple[str, DataFrame]] = []
    for key in keys:
        dim, dim_key = dims[key]
        givers = [n for n, (_, earlier) in enumerate(out) if key in earlier.columns]
        if key in held or len(givers) != 1:
            out.append((key, dim.withColumn("_key", F.col(dim_key))))
        else:
            first, giver = out[givers[0]]
            out[givers[0]] = first, _dim_fields(giver, dim, F.col(key), dim_key, prefix="")
    return out


def enrich_order_detail(raw: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> tuple[DataFrame, DataFrame]:
    """Wide order records as text -> (rows with the fields of six dimensions and amounts as DOUBLE, dirty records).

    ``cast_error`` tells which amount is no number. Rows without an order id are left out.
    """
    filled = raw.where(F.trim("value") != "")
    both = parse(filled, ORDER_WIDE)
    dirty = both.where(F.col("bad").isNotNull()).select(F.col("bad").alias("raw"), F.lit("JSON").alias("error"))
    rows = both.where(F.col("bad").isNull()).select("record.*").drop("_corrupt")
    for key, dim in _completed(dims, ORDER_DETAIL_KEYS, rows.columns):
        rows = _dim_fields(rows, dim, _key_of(rows, key), "_key", [c for c in dim.columns if c != "_key"])
    amounts = {"order_amount": "order_price", "payment_amount": "pay_amount"}
    bad = [
        F.when(F.col(source).isNotNull() & F.col(source).try_cast("double").isNull(), F.concat(F.lit(f"{source}: "), source))
        for source in amounts.values()
    ]
    rows = rows.withColumns({name: F.col(source).try_cast("double") for name, source in amounts.items()})
    rows = rows.withColumn("cast_error", F.coalesce(*bad))
    return rows.where(F.col("order_id").isNotNull()), dirty


USER_ACTION_EXTRA = struct(sku_id="string", tm_id="string", category3_id="string", uid="string")


def enrich_user_action(raw: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> tuple[DataFrame, DataFrame]:
    """User actions as text -> (rows with item, brand, category and user fields, dirty records).

    A key is looked for in the record itself, then in ``common``, then as the displayed item.
    """
    from pyspark.sql import types as T

    schema = T.StructType([*USER_ACTION.fields, *USER_ACTION_EXTRA.fields])
    both = parse(raw, schema)
    dirty = both.where(F.col("bad").isNotNull()).select(F.col("bad").alias("raw"), F.lit("JSON").alias("err"))
    rows = both.where(F.col("bad").isNull()).select("record.*").drop("_corrupt")
    fallback = {"sku_id": [F.col("display.item")], "uid": [F.col("common.uid")], "tm_id": [], "category3_id": []}
    for key in ("sku_id", "tm_id", "category3_id", "uid"):
        dim, dim_key = dims[key]
        rows = _dim_fields(rows, dim, _key_of(rows, key, fallback[key]), dim_key)
    return rows, dirty


def enrich_order_user_item(orders: DataFrame, users: DataFrame, sku: DataFrame) -> DataFrame:
    """Gender and age of the user; name, product and price of the item."""
    u = users.select(F.col("id").alias("_uid"), F.col("gender").alias("user_gender"), F.col("age").alias("user_age"))
    s = sku.select(F.col("id").alias("_sid"), "sku_name", "spu_id", "price")
    return lookup(lookup(orders, u, "user_id", "_uid"), s, "sku_id", "_sid")


def enrich_payments(payments: DataFrame, users: DataFrame, sku: DataFrame) -> DataFrame:
    u = users.select(F.col("id").alias("_uid"), F.col("gender").alias("user_gender"), F.col("age").alias("user_age"))
    s = sku.select(F.col("id").alias("_sid"), "sku_name", F.col("category3_id").alias("category"))
    valid = payments.where(F.col("payment_id").isNotNull())
    if payments.isStreaming:
        # every batch would send a broadcast dimension to the driver again
        u, s = u.hint("merge"), s.hint("merge")
    return lookup(lookup(valid, u, "user_id", "_uid"), s, "sku_id", "_sid")


def comment_order_join(
    comments: DataFrame, orders: DataFrame, order_key: str = "order_id", info_key: str = "id", minutes: int | None = None,
    comment_time: str = "comment_time", order_time: str = "create_time",
) -> DataFrame:
    """Comments with their order's fields as ``info_<field>``. ``minutes`` bounds the gap, which streams need."""
    info = orders.select(*[F.col(c).alias(f"info_{c}") for c in orders.columns])
    on = F.col(order_key) == F.col(f"info_{info_key}")
    if minutes is not None:
        at = f"info_{order_time}"
        on = on & F.expr(f"{at} between {comment_time} - interval {minutes} minutes and {comment_time} + interval {minutes} minutes")
    return comments.join(info, on)
