"""Row order within a key, whatever the size of a key.

A window over a key would stream it through one task, and a key may hold a large part of all rows. Rows are therefore
sorted across the cluster by (key, order), written once so that their places are fixed, and worked on in blocks: the rows
of one key in one partition. What a block needs from its neighbours - the rows before it, the first row after it, the
greatest value before it - comes from one small row per block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import pinned

_PLACE_BITS = 33  # monotonically_increasing_id keeps the row's place in the low 33 bits


class _Blocks:
    """Sorted, written rows with ``_part`` and ``_place``, and windows over their blocks."""

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]):
        self.columns, self.keys = df.columns, list(keys) or ["_all"]
        if not keys:
            df = df.withColumn("_all", F.lit(0))
        fixed = pinned(df.orderBy(*self.keys, *order))
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
        self.rows = fixed.withColumn("_part", F.spark_partition_id()).withColumn("_place", place)
        self.inside = Window.partitionBy("_part", *self.keys).orderBy("_place")
        self.by_part = Window.partitionBy(*self.keys).orderBy("_part")
        self.earlier = self.by_part.rowsBetween(Window.unboundedPreceding, -1)

    def summary(self, *aggregates: Column) -> DataFrame:
        """One row per block."""
        return self.rows.groupBy("_part", *self.keys).agg(*aggregates)

    def joined(self, blocks: DataFrame) -> DataFrame:
        """Rows with the columns of their block."""
        own = ["_part", *self.keys]
        b = blocks.select(*[F.col(c).alias(f"_b{c}") for c in own], *[c for c in blocks.columns if c not in own])
        return self.rows.join(b, [self.rows[c].eqNullSafe(b[f"_b{c}"]) for c in own]).drop(*[f"_b{c}" for c in own])

    def numbers(self) -> DataFrame:
        """Block rows with ``_first``, the place of its first row, and ``_before``, the key's rows in earlier blocks."""
        blocks = self.summary(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
        return blocks.withColumn("_before", F.coalesce(F.sum("_n").over(self.earlier), F.lit(0)))


def _number() -> Column:
    return (F.col("_place") - F.col("_first") + F.col("_before") + 1).cast("bigint")


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "rn") -> DataFrame:
    """``row_number`` per key. ``order`` must be unique within a key. Without keys the whole frame is ranked."""
    blocks = _Blocks(df, keys, order)
    return blocks.joined(blocks.numbers()).withColumn(name, _number()).select(*blocks.columns, name)


def next_values(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], columns: dict[str, str], number: str | None = None
) -> DataFrame:
    """Add each ``columns[name]`` of the following row within the key as ``name`` (NULL on the last row).

    ``number`` also adds the row number. Only the last row of a block looks at the next block.
    """
    blocks = _Blocks(df, keys, order)
    first = F.min_by(F.struct(*[F.col(source).alias(name) for name, source in columns.items()]), "_place").alias("_head")
    summary = blocks.summary(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"), F.max("_place").alias("_last"), first)
    summary = summary.withColumns({
        "_before": F.coalesce(F.sum("_n").over(blocks.earlier), F.lit(0)), "_follow": F.lead("_head").over(blocks.by_part),
    }).drop("_head")
    rows = blocks.joined(summary)
    follow = {name: F.when(F.col("_place") == F.col("_last"), F.col(f"_follow.{name}")).otherwise(F.lead(source).over(blocks.inside))
              for name, source in columns.items()}
    if number:
        follow[number] = _number()
    return rows.withColumns(follow).select(*blocks.columns, *follow)


def new_maxima(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str) -> DataFrame:
    """Rows whose ``value`` is greater than every earlier row's of the same key."""
    blocks = _Blocks(df, keys, order)
    summary = blocks.summary(F.max(value).alias("_top")).withColumn("_carried", F.max("_top").over(blocks.earlier)).drop("_top")
    before = F.max(value).over(blocks.inside.rowsBetween(Window.unboundedPreceding, -1))
    seen = blocks.joined(summary).withColumn("_seen", F.greatest(before, F.col("_carried")))
    return seen.where(F.col("_seen").isNull() | (F.col(value) > F.col("_seen"))).select(*blocks.columns)
