"""Keep-latest, change merge, history tables, de-duplication (batch)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.columns import Day, day

OPEN_END = "9999-12-31"


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row with the greatest ``order`` per key.

    An aggregate, not a window: rows of a hot key are reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def dim_upsert_latest(changes: DataFrame, keys: Sequence[str], order: Sequence[str], op: str = "op") -> DataFrame:
    """Change rows -> current row per key. Delete records are skipped, as a keyed put-only store would."""
    return latest_by_key(changes.where(F.col(op) != "d"), keys, order).drop(op)


def scd2_merge(
    history: DataFrame,
    changes: DataFrame,
    key: str,
    as_of: Day,
    change_order: Sequence[str | Column] = (),
) -> DataFrame:
    """Open history rows + one day's changes -> rows with ``start_date`` / ``end_date``.

    A changed key's open row is closed the day before and its new row opened on ``as_of``. Unchanged keys
    stay open with their old start. Closed rows pass through untouched. If a key changed more than once that
    day, ``change_order`` decides which row is the last. Rows that an earlier run of the same day opened are dropped and
    those it closed are opened again first, so a rerun on its own output changes nothing.
    """
    day_before = F.date_sub(day(as_of), 1)
    history = history.where(F.coalesce(F.col("start_date") <= day_before, F.lit(True))).withColumn(
        "end_date", F.when(F.col("end_date") == day_before, F.lit(OPEN_END).cast("date")).otherwise(F.col("end_date")))
    attributes = [c for c in history.columns if c not in (key, "start_date", "end_date")]
    new = changes.select(key, *attributes, *[c for c in change_order if isinstance(c, str) and c not in (key, *attributes)])
    order = list(change_order) or [F.struct(*attributes)]
    new = latest_by_key(new, [key], order).select(key, *attributes)
    is_open = F.col("end_date") == F.lit(OPEN_END).cast("date")
    touched = new.select(F.col(key), F.lit(True).alias("_touched"))
    kept = history.join(touched, key, "left").select(
        key,
        *attributes,
        "start_date",
        F.when(is_open & F.col("_touched"), day_before).otherwise(F.col("end_date")).alias("end_date"),
    )
    opened = new.select(
        key, *attributes, day(as_of).alias("start_date"), F.lit(OPEN_END).cast("date").alias("end_date")
    )
    return kept.unionByName(opened)
