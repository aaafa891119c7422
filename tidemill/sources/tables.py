"""Partitioned tables: scans by day and the write modes of the layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.columns import Day, day


def scan(spark: SparkSession, path: str, fmt: str = "parquet", first: Day | None = None, last: Day | None = None,
         date: str = "dt", schema=None) -> DataFrame:
    """A table, cut to the days ``first`` to ``last``; on a table partitioned by ``date`` only those folders are read."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("sep", "\t").option("header", "false")
    df = reader.load(path)
    if first is not None:
        df = df.where(F.col(date) >= day(first))
    if last is not None:
        df = df.where(F.col(date) <= day(last))
    return df


def scan_day(spark: SparkSession, path: str, of: Day, fmt: str = "parquet", date: str = "dt") -> DataFrame:
    return scan(spark, path, fmt, of, of, date)


def _by_day(df: DataFrame, date: str) -> DataFrame:
    """Rows of a day brought together, so that a day is written by few tasks; AQE splits a large day again."""
    return df.hint("rebalance", date)


def overwrite_days(df: DataFrame, path: str, date: str = "dt", fmt: str = "parquet") -> None:
    """Replace the days present in ``df`` and leave the others (dynamic partition overwrite)."""
    _by_day(df, date).write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic").partitionBy(date).save(path)


def overwrite_day(df: DataFrame, path: str, of: Day, date: str = "dt", fmt: str = "parquet") -> None:
    """Replace one day by rows without a day column. Running it again gives the same table."""
    df = df.withColumn(date, day(of))
    df.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic").partitionBy(date).save(path)


def append_days(df: DataFrame, path: str, date: str = "dt", fmt: str = "parquet") -> None:
    _by_day(df, date).write.mode("append").format(fmt).partitionBy(date).save(path)


def append_day(df: DataFrame, path: str, of: Day, date: str = "dt", fmt: str = "parquet") -> None:
    df.withColumn(date, day(of)).write.mode("append").format(fmt).partitionBy(date).save(path)


def merge_results(results: DataFrame, path: str, date: str = "dt", fmt: str = "parquet") -> None:
    """New result rows into a result history: the days in ``results`` are replaced, so a rerun leaves no old numbers."""
    overwrite_days(results.distinct(), path, date, fmt)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").csv(path)


def save_table(df: DataFrame, name: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Create a table from a query, replacing one of that name."""
    writer = df.write.mode("overwrite").format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def column_families(df: DataFrame, key: str, families: dict[str, list[str]]) -> DataFrame:
    """A keyed row with one struct per column family."""
    return df.select(key, *[F.struct(*columns).alias(family) for family, columns in families.items()])


def as_view(df: DataFrame, name: str) -> str:
    df.createOrReplaceTempView(name)
    return name


def written_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers n of the folders ``name=n`` below ``path`` that have been written to their end, ascending."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    done = [s.getPath() for s in fs.listStatus(at) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return sorted(int(p.getName().split("=")[1]) for p in done)
