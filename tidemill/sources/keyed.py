"""A keyed table on plain files: upserts are appended per batch and the newest row per key is taken on read.

Each batch owns one folder and overwrites it when it is run again, so a repeated batch changes nothing. Rows are
spread over ``buckets`` by key, and a read for a set of keys touches only their buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.operators.latest import latest_by_key

BUCKETS = 64


class KeyedTable:
    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order: Sequence[str],
        buckets: int = BUCKETS, bucket_by: Sequence[str] | None = None,
    ):
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.order, self.buckets = list(keys), list(order), buckets
        self.bucket_by = list(bucket_by or keys)

    def _bucket(self):
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.bucket_by]), F.lit(self.buckets)).cast("int")

    def upsert(self, rows: DataFrame, batch_id: int) -> None:
        """Add one batch; inside the batch only the newest row per key is kept."""
        newest = latest_by_key(rows.select(*self.schema.names), self.keys, self.order).withColumn("bucket", self._bucket())
        newest.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(
            f"{self.path}/batch={batch_id}")

    def _rows(self) -> DataFrame:
        full = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType()), T.StructField("bucket", T.IntegerType())])
        return self.spark.read.schema(full).parquet(self.path)

    def exists(self) -> bool:
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def read(self, near: DataFrame | None = None, before: int | None = None) -> DataFrame:
        """Current rows, all or those with the ``bucket_by`` values in ``near``, as of before batch ``before``.

        For ``near`` the touched bucket numbers (at most ``buckets`` of them) are fetched first, so that only their
        folders are read.
        """
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        rows = self._rows()
        if before is not None:
            rows = rows.where(F.col("batch") < before)
        if near is not None:
            wanted = near.select(*self.bucket_by).distinct()
            touched = [r[0] for r in wanted.select(self._bucket().alias("b")).distinct().collect()]
            on = [rows[k].eqNullSafe(wanted[k]) for k in self.bucket_by]
            rows = rows.where(F.col("bucket").isin(touched)).join(wanted, on, "left_semi")
        newest = latest_by_key(rows.drop("bucket"), self.keys, [*self.order, "batch"])
        return newest.select(*self.schema.names)

    def compact(self, into: str, last_batch: int) -> "KeyedTable":
        """A copy holding one row per key, to which later batches can be added."""
        packed = KeyedTable(self.spark, into, self.schema, self.keys, self.order, self.buckets, self.bucket_by)
        packed.upsert(self.read(), last_batch)
        return packed
