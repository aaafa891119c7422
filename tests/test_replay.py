"""Tables dealt into batches: one part a batch, however many files it is written as."""

import re
import time

import pytest
from pyspark.sql import functions as F

from bindings import changes, replay
from bindings.inputs import Inputs
from bindings.live import stream_of
from bindings.replay import in_batches
from tidemill.sources import streams

SMALL = "/root/testdata/sf0.01"


@pytest.fixture
def many_tasks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def batches(spark, stream, *columns):
    seen = []
    streams.run_each_batch(stream, "seen", lambda batch, n: seen.append(batch.agg(*columns).first()))
    return seen


@pytest.mark.parametrize("by", ["o_orderdate", "o_orderkey"])
def test_batches_of_a_table_are_in_order(spark, many_tasks, by):
    i = Inputs(spark, SMALL)
    stream = stream_of(i, "orders", by)
    assert i.folders["orders", by][1] > 1
    seen = batches(spark, stream, F.count("*"), F.min(by), F.max(by))
    assert len(seen) == 5 and sum(n for n, _, _ in seen) == 15000
    assert all(a[2] < b[1] for a, b in zip(seen, seen[1:]))


@pytest.mark.parametrize("fmt", ["text", "parquet"])
def test_batches_of_few_or_no_rows(spark, fmt):
    i = Inputs(spark, SMALL)
    parts = [spark.range(n).select((F.col("id") + 100 * n).cast("string").alias("value")) for n in (50, 0, 1, 2, 40)]
    folder = in_batches(i, parts, 3, "few", fmt)
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 3).format(fmt).load(folder)
    assert [n for n, in batches(spark, stream, F.count("*"))] == [50, 0, 1, 2, 40]


def test_rows_of_one_block_are_kept_in_many_tasks(spark, many_tasks, monkeypatch):
    """The tables' files hold one block each, which one task reads; kept so, each batch would be taken from that task's rows."""
    orders, met = Inputs(spark, SMALL).table("orders"), []
    monkeypatch.setattr(replay, "in_batches", lambda i, parts, *a, **k: met.extend(p.groupBy(F.spark_partition_id()).count().count() for p in parts))
    files = replay.files_of(orders)
    replay.dealt(Inputs(spark, SMALL), orders.withColumn("_batch", (F.col("o_orderkey") % 5).cast("int")), "x", files=files)
    assert files > 1 and met == [files] * 5


def test_batches_of_a_table_leave_no_shuffle_files(spark):
    """Dealt from one spread copy, a table lies on the disk as shuffle files too for as long as the driver collects no garbage."""
    def files():
        return set(re.findall(r"shuffle_\S+\.data", spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")))

    before = files()
    rows = spark.range(5000).select("id", (F.col("id") % 5).cast("int").alias("_batch"))
    folder = replay.dealt(Inputs(spark, SMALL), rows, "unkept", files=3, kept=False)
    until = time.monotonic() + 20
    while files() - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not files() - before and spark.read.parquet(folder).count() == 5000


def test_only_rows_in_few_blocks_are_spread(spark, tmp_path):
    rows = spark.range(4000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    rows.repartition(24).write.parquet(f"{tmp_path}/many")
    rows.coalesce(1).write.parquet(f"{tmp_path}/one")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        spread = {}
        for name in ("many", "one"):
            df = spark.read.parquet(f"{tmp_path}/{name}")
            assert replay.files_of(df) > 8
            out = changes.envelopes_of(df, ["id"], (None, F.col("text")), (F.col("id") > 9, F.col("text")))
            spread[name] = "REPARTITION_BY_COL" in out._jdf.queryExecution().executedPlan().toString()
            assert out.count() == 7990
        assert spread == {"many": False, "one": True}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
