"""Streaming sources and sinks. ``fmt`` is "kafka" where the connector is on the class path, or a file format."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemill.session import scratch


def text_stream(spark: SparkSession, fmt: str, at: str, servers: str = "", offsets: str = "earliest",
                files_per_batch: int | None = None) -> DataFrame:
    """Raw records as one column ``value``: a Kafka topic, or a folder of text files with one record per line."""
    if fmt == "kafka":
        raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
               .option("subscribe", at).option("startingOffsets", offsets).load())
        return raw.select(F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(at)


def json_stream(spark: SparkSession, fmt: str, at: str, schema: T.StructType, **options) -> DataFrame:
    """Records of a known schema; records that do not parse are left out."""
    return parsed(text_stream(spark, fmt, at, **options), schema)


def once(column: Column) -> Column:
    """An expensive expression worked out once per row.

    Without this the optimizer copies it into every filter and projection that uses its result. A generator of
    exactly one row keeps it in one place.
    """
    return F.explode(F.array(column))


def parse(raw: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Add ``record`` and ``bad``: the raw text where it is no JSON object of the schema, else NULL."""
    marked = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    record = F.from_json(column, marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    with_record = raw.select("*", once(record).alias("record"))
    broken = F.col("record").isNull() | F.col("record._corrupt").isNotNull()
    return with_record.withColumn("bad", F.when(broken, F.coalesce(F.col(column), F.lit(""))))


def parsed(raw: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Only the records that parse, as columns."""
    return parse(raw, schema, column).where(F.col("bad").isNull()).select("record.*").drop("_corrupt")


def topic_rows(df: DataFrame, topic: str | Column, key: str | None = None) -> DataFrame:
    """Rows as Kafka records: JSON value, topic per record, optional key."""
    route = F.lit(topic) if isinstance(topic, str) else topic
    value = F.to_json(F.struct(*[c for c in df.columns]))
    columns = [route.alias("topic"), value.alias("value")]
    return df.select(*columns, F.col(key).cast("string").alias("key")) if key else df.select(*columns)


def start_topic_sink(rows: DataFrame, fmt: str, at: str, checkpoint: str, servers: str = "") -> StreamingQuery:
    """Route each record to the topic named in its ``topic`` column; on files, one folder per topic."""
    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if fmt == "kafka":
        return (writer.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all")
                .option("kafka.enable.idempotence", "true").start())
    return writer.format(fmt).partitionBy("topic").option("path", at).start()


def run_to_parquet(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over everything available now and return what it wrote."""
    spark = stream.sparkSession
    out, checkpoint = scratch(spark, name), scratch(spark, f"{name}-checkpoint")
    (stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
     .option("path", out).trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(stream.schema).parquet(out)


def run_until_idle(stream: DataFrame, name: str, mode: str = "append", linger: float = 0.0, checkpoint: str | None = None, out: str | None = None,
                   state_tasks: int | None = None) -> DataFrame:
    """Run a stream whose state knows processing time until its sources have nothing new, and return what it wrote.

    Such a query always has one more batch to run, so it never ends under ``availableNow``. Here it runs under a processing-time
    trigger and is stopped once its sources have stood still for ``linger`` seconds, time for its timers to fire. A later run with
    the same ``checkpoint`` and ``out`` goes on from there.

    ``state_tasks`` bounds the tasks of a state that stays small whatever the rows: each of them starts a state store and a Python worker in
    every batch, idle ones too. A state that grows with its rows keeps the session's shuffle partitions.
    """
    spark = stream.sparkSession
    out, checkpoint = out or scratch(spark, name), checkpoint or scratch(spark, f"{name}-checkpoint")
    writer = (stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", out)
              .trigger(processingTime="200 milliseconds"))
    # a query takes the settings of its session when it starts, and keeps their number of tasks in its checkpoint
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(min(int(tasks), state_tasks or int(tasks))))
    try:
        query = writer.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
    still, first = None, None
    try:
        while not query.awaitTermination(0.2):
            progress = query.lastProgress
            if progress is None:
                continue
            first = progress["batchId"] if first is None else first
            # the first batch may be one that an earlier run had planned, before what is new
            if progress["batchId"] == first or any(s["startOffset"] != s["endOffset"] for s in progress["sources"]):
                still = None
            elif still is None:
                still = time.monotonic()
            if still is not None and time.monotonic() - still >= linger:
                break
    finally:
        query.stop()
    return spark.read.schema(stream.schema).parquet(out)


def run_each_batch(stream: DataFrame, name: str, step: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Run ``step(batch, batch_id)`` over everything available now."""
    checkpoint = scratch(stream.sparkSession, f"{name}-checkpoint")
    (stream.writeStream.outputMode(mode).foreachBatch(step).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def jdbc_step(url: str, table: str, columns: list[str], batch_rows: int = 2000, **options: str) -> Callable[[DataFrame, int], None]:
    """A batch step that appends the named columns, in that order, to a database table; unnamed columns are skipped."""

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.select(*columns).write.mode("append").format("jdbc").options(
            url=url, dbtable=table, batchsize=str(batch_rows), **options).save()

    return step


def without_fields(df: DataFrame, marked: list[str]) -> DataFrame:
    """Drop the fields marked as not for the sink."""
    return df.drop(*marked)


def first_rows(stream: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of a stream (append mode), in the order of its files. One task takes them and stops reading there."""
    return stream.coalesce(1).limit(n)


def topic_preview(records: DataFrame) -> DataFrame:
    """The first record of each topic."""
    return records.groupBy("topic").agg(F.min_by("value", "offset").alias("value"))
