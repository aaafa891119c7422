"""Table reads and writes: each query writes given tables to the scratch folder and reads the result back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from bindings.inputs import Inputs
from bindings.register import query
from tidemill.functions.columns import money
from tidemill.session import scratch
from tidemill.sources import streams, tables
from tidemill.sources.keyed import KeyedTable

_ORDERS = "SELECT o_orderkey AS id, o_custkey AS user_id, cast(o_totalprice as double) AS amount, strftime(o_orderdate, '%Y-%m') AS dt FROM orders"


def orders(i: Inputs):
    return i.table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), money("o_totalprice").alias("amount"),
                                    F.date_format("o_orderdate", "yyyy-MM").alias("dt"))


@query(_ORDERS)
def table_orc(i: Inputs):
    """Partitioned ORC table written and read back."""
    at = scratch(i.spark, "orc")
    tables.overwrite_days(orders(i), at, fmt="orc")
    return tables.scan(i.spark, at, "orc")


@query(_ORDERS + " WHERE strftime(o_orderdate, '%Y-%m') = '1997-05'")
def table_pruned_scan(i: Inputs):
    """One partition of a partitioned Parquet table."""
    at = scratch(i.spark, "pruned")
    tables.overwrite_days(orders(i), at)
    return tables.scan(i.spark, at).where(F.col("dt") == "1997-05")


@query(f"SELECT * REPLACE (CASE WHEN dt = '1997-05' THEN amount * 0 ELSE amount END AS amount) FROM ({_ORDERS}) WHERE dt <> '1998-02' OR amount > 200000")
def table_overwrite_partitions(i: Inputs):
    """Two partitions replaced by new rows, the others left as they were."""
    at = scratch(i.spark, "overwrite")
    tables.overwrite_days(orders(i), at)
    new = orders(i).where(F.col("dt") == "1997-05").withColumn("amount", (F.col("amount") * 0).cast("decimal(16,2)"))
    new = new.unionByName(orders(i).where((F.col("dt") == "1998-02") & (F.col("amount") > 200000)))
    tables.overwrite_days(new, at)
    return tables.scan(i.spark, at)


@query("SELECT n_nationkey AS id, n_name AS name, '2024-01-02' AS dt FROM nation UNION ALL SELECT n_nationkey, n_name || '!', '2024-01-03' FROM nation")
def table_overwrite_day(i: Inputs):
    """Each day written twice: the second write replaces the first."""
    at = scratch(i.spark, "day")
    n = i.table("nation").select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"))
    tables.overwrite_day(n, at, "2024-01-02")
    tables.overwrite_day(n, at, "2024-01-03")
    tables.overwrite_day(n.withColumn("name", F.concat("name", F.lit("!"))), at, "2024-01-03")
    return tables.scan(i.spark, at, first="2024-01-02", last="2024-01-03")


@query("SELECT s_suppkey AS id, s_name AS name, '2024-01-02' AS dt FROM supplier UNION ALL SELECT s_suppkey, s_name, '2024-01-02' FROM supplier")
def table_append(i: Inputs):
    at = scratch(i.spark, "append")
    s = i.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    tables.append_day(s, at, "2024-01-02")
    tables.append_day(s, at, "2024-01-02")
    return tables.scan_day(i.spark, at, "2024-01-02")


@query(f"SELECT strftime(o_orderdate, '%Y-%m') AS dt, count(*) + CASE WHEN strftime(o_orderdate, '%Y-%m') = '1997-05' THEN 1 ELSE 0 END AS orders FROM orders GROUP BY strftime(o_orderdate, '%Y-%m')")
def table_merge_results(i: Inputs):
    """A result history whose one period is computed again with other numbers."""
    at = scratch(i.spark, "history")
    monthly = orders(i).groupBy("dt").agg(F.count(F.lit(1)).alias("orders"))
    tables.merge_results(monthly, at)
    tables.merge_results(monthly.where(F.col("dt") == "1997-05").withColumn("orders", F.col("orders") + 1), at)
    return tables.scan(i.spark, at).select(F.col("dt").cast("string").alias("dt"), "orders")


@query("SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer")
def table_tsv(i: Inputs):
    at = scratch(i.spark, "tsv")
    tables.write_tsv(i.table("customer").select("c_custkey", "c_name", "c_acctbal"), at)
    return tables.scan(i.spark, at, "csv", schema="id bigint, name string, balance double")


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, cast(c_acctbal as double) AS balance FROM customer")
def table_column_families(i: Inputs):
    """Keyed rows with one struct per column family, read by field path."""
    rows = i.table("customer").select(F.col("c_custkey").alias("id"), "c_name", "c_mktsegment", "c_acctbal")
    wide = tables.column_families(rows, "id", {"info": ["c_name", "c_mktsegment"], "money": ["c_acctbal"]})
    return wide.select("id", F.col("info.c_name").alias("name"), F.col("info.c_mktsegment").alias("segment"), F.col("money.c_acctbal").alias("balance"))


@query("SELECT p_brand AS brand, count(*) AS parts, cast(avg(p_size) as double) AS mean_size FROM part GROUP BY p_brand HAVING count(*) > 3")
def view_query(i: Inputs):
    name = tables.as_view(i.table("part"), "tidemill_parts")
    return i.spark.sql(f"WITH p AS (SELECT p_brand AS brand, p_size FROM {name}) "
                       "SELECT brand, count(*) AS parts, avg(p_size) AS mean_size FROM p GROUP BY brand HAVING count(*) > 3")


@query("""
SELECT o_custkey AS user_id, o_orderkey AS order_id, epoch_us(o_orderdate) // 1000 AS ts FROM
  (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
""")
def keyed_upsert(i: Inputs):
    """Three batches, the last one twice, into a keyed table; then one row per key from a compacted copy."""
    o = i.table("orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("order_id"), F.unix_millis("o_orderdate").alias("ts"), "o_orderstatus")
    wanted = o.drop("o_orderstatus").schema
    table = KeyedTable(i.spark, scratch(i.spark, "keyed"), wanted, ["user_id"], ["ts", "order_id"], buckets=8)
    for n, status in enumerate(("F", "O", "P", "P")):
        table.upsert(o.where(F.col("o_orderstatus") == status), min(n, 2))
    return table.compact(scratch(i.spark, "keyed-packed"), 2).read()


@query("SELECT event_type AS topic, arg_min(event_id, event_id) || '' AS value FROM events GROUP BY event_type")
def topic_preview(i: Inputs):
    records = i.table("events").select(F.col("event_type").alias("topic"), F.col("event_id").cast("string").alias("value"), F.col("event_id").alias("offset"))
    return streams.topic_preview(records)


@query("SELECT n_nationkey AS id, n_name AS name FROM nation")
def sink_without_marked_fields(i: Inputs):
    n = i.table("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("internal"))
    return streams.without_fields(n, ["internal"])


@query("SELECT * REPLACE (amount + 1 AS amount) FROM (" + _ORDERS + ") WHERE dt < '1998-01'")
def table_save(i: Inputs):
    """A catalogue table made from a query twice: the second one replaces it."""
    name = f"saved_orders_{uuid.uuid4().hex[:12]}"
    for rows in (orders(i), orders(i).where(F.col("dt") < "1998-01").withColumn("amount", (F.col("amount") + 1).cast("decimal(16,2)"))):
        tables.save_table(rows, name, partition_by=["dt"])
    return i.spark.table(name)
