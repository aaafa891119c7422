"""Dimension tables that a stream of rule changes makes, drops and makes anew.

Rule changes and dimension rows come in one stream of change records. A batch's rule changes hold for all of its rows. Every
making of a sink table is a *generation*, named by the batch that made it; rows are stored under table and generation, so a table
that is dropped or made anew is empty without a row being touched, and its old columns are gone with the old rows.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.sources.streams import run_each_batch
from tidemill.sources.tables import written_numbers
from tidemill.streaming import cdc

#: Fixed value: the table whose change records are rule changes.
RULE_TABLE = "table_process_dim"
RULE = "source_table string, sink_table string, sink_columns string, sink_row_key string"
TABLES = f"{RULE}, since bigint"
ROWS = "row_key string, columns map<string,string>, ts_ms bigint, sink_table string, since bigint, batch bigint"


def table_steps(envelopes: DataFrame, rule_table: str = RULE_TABLE) -> DataFrame:
    """Rule changes as steps on sink tables: ``made`` is true where one is made, false where one is dropped.

    A created or read rule makes its table, a deleted one drops it, a changed one drops the table it named before and makes the
    one it names now. Rules without a sink table are no steps.
    """
    rule = T.StructType.fromDDL(RULE)
    changes = envelopes.where(F.col("source")["table"] == rule_table).select(
        "op", "ts_ms", F.from_json("before", rule).alias("before"), F.from_json("after", rule).alias("after"))

    def step(row: str, made: bool):
        return F.struct(*[F.col(row)[c].alias(c) for c in rule.names], F.lit(made).alias("made"))

    drops = F.when(F.col("op").isin("d", "u"), step("before", False))
    makes = F.when(F.col("op").isin("c", "r", "u"), step("after", True))
    steps = changes.select("ts_ms", F.explode(F.array(drops, makes)).alias("step")).where(F.col("step.sink_table").isNotNull())
    return steps.select("step.*", "ts_ms")


def tables_after(earlier: DataFrame, steps: DataFrame, version: int) -> DataFrame:
    """The sink tables that stand after ``steps``: a row a table with its rule and the batch that made it.

    A table that is made while it stands takes the new rule and keeps its rows; one that is dropped at any time of the batch keeps
    none. The latest step decides; of steps of one time the making one, then the greatest rule.
    """
    rule = ["source_table", "sink_columns", "sink_row_key"]
    last = steps.groupBy("sink_table").agg(
        F.max(F.struct("ts_ms", "made", *rule)).alias("last"), F.max(~F.col("made")).alias("dropped"))
    both = earlier.join(last, "sink_table", "full")
    met = F.col("last").isNotNull()
    fresh = met & (F.col("dropped") | F.col("since").isNull())
    return both.where(~met | F.col("last.made")).select(
        F.when(met, F.col("last.source_table")).otherwise(F.col("source_table")).alias("source_table"), "sink_table",
        *[F.when(met, F.col(f"last.{c}")).otherwise(F.col(c)).alias(c) for c in rule[1:]],
        F.when(fresh, F.lit(version)).otherwise(F.col("since")).cast("bigint").alias("since"))


class DimTables:
    """Sink tables under ``path``: ``tables`` holds one small list of tables a version, ``rows`` the dimension rows.

    A batch reads the list of the version before it, never stored rows; it adds its rows and then publishes its own list. Readers
    see the newest published version or any older one that is kept, so a half-written batch is never seen, and a batch that is
    run again writes the same.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def versions(self) -> list[int]:
        return written_numbers(self.spark, f"{self.path}/tables")

    def tables(self, version: int | None = None) -> DataFrame:
        """The tables that stand, as of a version."""
        version = self._version(version)
        if version is None:
            return self.spark.createDataFrame([], TABLES)
        return self.spark.read.schema(TABLES).parquet(f"{self.path}/tables/version={version}")

    def _version(self, version: int | None) -> int | None:
        known = self.versions()
        if version is None:
            return known[-1] if known else None
        if version not in known:
            raise ValueError(f"version {version} is not published or has been removed")
        return version

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Rule changes and dimension rows of one batch."""
        batch = batch.persist()
        try:
            before = [v for v in self.versions() if v < batch_id]
            earlier = self.tables(before[-1]) if before else self.spark.createDataFrame([], TABLES)
            now = tables_after(earlier, table_steps(batch), batch_id).coalesce(1).persist()
            try:
                rows = cdc.dim_changes(batch.where(~F.col("source")["table"].eqNullSafe(RULE_TABLE)), now.drop("since"))
                stored = rows.join(now.select("sink_table", "since"), "sink_table").withColumn("batch", F.lit(batch_id).cast("bigint"))
                # not dealt by table: one of them may hold most rows
                stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                    "sink_table", "since", "batch").parquet(f"{self.path}/rows")
                now.write.mode("overwrite").parquet(f"{self.path}/tables/version={batch_id}")
            finally:
                now.unpersist()
        finally:
            batch.unpersist()

    def read(self, version: int | None = None) -> DataFrame:
        """sink_table, row_key, columns: the newest row of each key in the tables that stand."""
        version = self._version(version)
        if version is None:
            return self.spark.createDataFrame([], "sink_table string, row_key string, columns map<string,string>")
        stored = self.spark.read.schema(ROWS).parquet(f"{self.path}/rows").where(F.col("batch") <= version)
        live = stored.join(self.tables(version).select("sink_table", "since"), ["sink_table", "since"], "left_semi")
        newest = live.groupBy("sink_table", "row_key").agg(
            F.max_by(F.map_entries("columns"), F.struct("ts_ms", "batch", F.to_json("columns"))).alias("entries"))
        return newest.select("sink_table", "row_key", F.map_from_entries("entries").alias("columns"))

    def table(self, name: str, version: int | None = None) -> DataFrame:
        """One table with the columns its rule lists, NULL where a row has none; the row key is a column of it only if listed."""
        rule = self.tables(version).where(F.col("sink_table") == name).first()
        if rule is None:
            raise ValueError(f"no dimension table {name}")
        names = list(dict.fromkeys(n for n in (rule["sink_columns"] or "").split(",") if n))
        return self.read(version).where(F.col("sink_table") == name).select(*[F.col("columns")[n].alias(n) for n in names])

    def remove_old(self, keep: int = 1) -> int:
        """Remove all but the newest ``keep`` versions and the generations that none of them names; the number of generations removed.

        Generations newer than the newest version belong to a batch that is being written, and stay.
        """
        known = self.versions()
        if keep < 1 or not known:
            return 0
        standing = set()
        for version in known[-keep:]:
            standing.update((t["sink_table"], t["since"]) for t in self.tables(version).select("sink_table", "since").toLocalIterator())
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/rows")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for version in known[:-keep]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/tables/version={version}"), True)
        removed = 0
        for at in fs.globStatus(jvm.org.apache.hadoop.fs.Path(folder, "sink_table=*/since=*")) or []:
            since = int(at.getPath().getName().split("=")[1])
            name = unquote(at.getPath().getParent().getName().split("=", 1)[1])
            if since <= known[-1] and (name, since) not in standing:
                fs.delete(at.getPath(), True)
                removed += 1
        return removed


def dim_lifecycle_job(envelopes: DataFrame, path: str) -> DimTables:
    """A stream of rule changes and dimension rows -> the tables it makes."""
    tables = DimTables(envelopes.sparkSession, path)
    run_each_batch(envelopes, "dim-lifecycle", tables.add)
    return tables
