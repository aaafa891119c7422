"""A faulty text source: a table's records as lines of text that come doubled, late, out of order and cut off.

Five batches are written one after the other and read one at a time. Time, from the first to the last record, is cut in five; a
record comes with the batch of its time, or later:

* every 17th record (by number, remainder 3) comes two batches late, every 11th (remainder 5) comes again with the next batch;
* the lines of a file are in falling order of time; a large batch has several files;
* every 29th record (remainder 1) is cut off after 20 characters.

Batches of records that come in order hold no late row; here the rows two batches late are late by hours.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings.inputs import Inputs
from tidemill.session import scratch, shuffles_dropped
from tidemill.sources import streams

BATCHES = 5
LATE, AGAIN, CUT = (17, 3), (11, 5), (29, 1)


def in_batches(i: Inputs, parts: Iterable[DataFrame], files: int, name: str, fmt: str = "parquet", order: str | None = None, spread: bool = True) -> str:
    """Frames written one after the other, each as exactly ``files`` files, so that a stream of ``files`` files a batch reads one
    frame a batch whatever its size; the folder. With ``order`` the rows of a file are in falling order of it.

    A large table in one file a batch would pass through one task; in as many files as tasks happen to write, a batch would hold
    a piece of a frame, and pieces come in no order of time. Frames that lie in ``files`` tasks already need no ``spread``.
    """
    out = scratch(i.spark, name)
    for n, part in enumerate(parts):
        part = part.repartition(files) if spread else part
        part = part.sortWithinPartitions(F.col(order).desc()).drop(order) if order else part
        part.write.mode("append").format(fmt).options(**{"compression": "zstd"} if fmt == "parquet" else {}).save(out)
        # few or no rows leave tasks without a file
        for _ in range(files * (n + 1) - len(i.spark.read.schema(part.schema).format(fmt).load(out).inputFiles())):
            i.spark.createDataFrame([], part.schema).coalesce(1).write.mode("append").format(fmt).save(out)
    return out


def files_of(rows: DataFrame) -> int:
    """Files a batch: one for a small table, else as many as tasks read it."""
    return rows.rdd.getNumPartitions()


def spread_rows(rows: DataFrame, tasks: int) -> DataFrame:
    """Rows in ``tasks`` tasks by a hash of all they hold. Not in turn, for which each task would sort its rows first: a file whose
    rows are one block is read by one task, however many tasks its bytes are dealt to."""
    plain = [f"`{f.name}`" for f in rows.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return rows.repartition(tasks, F.xxhash64(*plain))


def dealt(i: Inputs, rows: DataFrame, name: str, fmt: str = "parquet", order: str | None = None, files: int = 1, kept: bool = True) -> str:
    """Rows with a column ``_batch`` as ``files`` files a batch, in that order; the folder.

    The rows are read once and spread before they are kept: kept as they are read, those of one block would be one task's in every batch.
    Rows that cost no more than a reading need not be ``kept``: each batch is then read and spread by itself, so that a large table does
    not lie on the disk a second time as shuffle files and a third time as kept rows.
    """
    if not kept:
        with shuffles_dropped(i.spark):
            return in_batches(i, (spread_rows(rows.where(F.col("_batch") == n).drop("_batch"), files) for n in range(BATCHES)),
                              files, name, fmt, order, spread=False)
    rows = spread_rows(rows, files).persist()
    try:
        return in_batches(i, (rows.where(F.col("_batch") == n).drop("_batch") for n in range(BATCHES)), files, name, fmt, order, spread=False)
    finally:
        rows.unpersist()


def batch_of(ms, first: int, last: int):
    """The fifth of the time between the first and the last record."""
    return F.expr(f"cast(({ms} - {first}) * {BATCHES} div {last - first + 1} as int)")


def faulty_lines(i: Inputs, rows: DataFrame, number: str, ms: str, name: str) -> DataFrame:
    """``rows`` as a stream of text (``value``): JSON of its columns, with the faults above."""
    first, last = rows.agg(F.min(ms), F.max(ms)).first()
    own = batch_of(ms, first or 0, last or 0)
    n = F.col(number)
    line = F.to_json(F.struct(*rows.columns))
    value = F.when(n % CUT[0] == CUT[1], F.substring(line, 1, 20)).otherwise(line)
    comes = F.least(F.when(n % LATE[0] == LATE[1], own + 2).otherwise(own), F.lit(BATCHES - 1))
    again = F.when(n % AGAIN[0] == AGAIN[1], F.least(comes + 1, F.lit(BATCHES - 1)))
    sent = rows.select(value.alias("value"), F.col(ms).alias("_at"), F.explode(F.array(comes, again)).alias("_batch")).where(F.col("_batch").isNotNull())
    files = files_of(rows)
    return streams.text_stream(i.spark, "text", dealt(i, sent, name, "text", "_at", files), files_per_batch=files)


def faulty_sql(table: str, number: str, ms: str) -> str:
    """The records of ``table`` that can be read, as often as they come, with ``batch``."""
    return f"""(SELECT *, unnest(CASE WHEN {number} % {AGAIN[0]} = {AGAIN[1]} THEN [comes, least(comes + 1, {BATCHES - 1})] ELSE [comes] END) AS batch FROM (
    SELECT *, least(CASE WHEN {number} % {LATE[0]} = {LATE[1]} THEN own + 2 ELSE own END, {BATCHES - 1}) AS comes FROM (
        SELECT *, ({ms} - min({ms}) OVER ()) * {BATCHES} // (max({ms}) OVER () - min({ms}) OVER () + 1) AS own FROM {table}))
    WHERE {number} % {CUT[0]} <> {CUT[1]})"""
