"""Counting pairs of rows of one key that lie close in time, without forming all pairs of a busy key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _slotted(df: DataFrame, key: str, time: str, tags: Sequence[str], width: int) -> DataFrame:
    """Rows merged on exact time, with the time cut into a slot of ``width`` microseconds and an offset."""
    micros = F.unix_micros(F.col(time))
    timed = df.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withColumn("_t", micros)
    merged = timed.groupBy(key, "_t", *tags).agg(F.count(F.lit(1)).alias("_n"))
    offset = F.pmod(F.col("_t"), F.lit(width))
    return merged.select(
        key, *tags, "_n", offset.alias("_off"), ((F.col("_t") - offset) / F.lit(width)).cast("bigint").alias("_slot")
    )


def _neighbours(slot: Column) -> Column:
    return F.explode(F.array(slot - 1, slot, slot + 1))


def _step(bits: Sequence[int], wanted: int) -> Column:
    """For each bit of the offset that has the wanted value: (level, the bits above it)."""
    entries = [
        F.when(
            F.shiftright("_off", b).bitwiseAND(F.lit(1)) == wanted,
            F.struct(F.lit(b).alias("level"), F.shiftright("_off", b + 1).alias("prefix")),
        )
        for b in bits
    ]
    return F.array_compact(F.array(*entries))


def _same_offset() -> Column:
    return F.array(F.struct(F.lit(-1).alias("level"), F.col("_off").alias("prefix")))


def _counted(left: DataFrame, right: DataFrame, key: str, tag: str, tags: Sequence[str], width: int) -> DataFrame:
    """Pair counts from products of group counts.

    Same slot: every pair is near enough. Neighbour slot: near enough when one offset is not above the other,
    which holds when the offsets are equal or first differ at one bit that is 1 on the greater side. Grouping
    both sides by (bit, bits above) turns that into an equi join of counts: at most one row per bit, and no
    row pairs. Sizes are estimated from the files, before the rows are spread, so the join is asked not to broadcast.
    """
    bits = range(int(width).bit_length())
    side_left = [
        (F.lit(0), F.array(F.struct(F.lit(-2).alias("level"), F.lit(0).cast("bigint").alias("prefix")))),
        (F.lit(1), F.concat(_step(bits, 1), _same_offset())),
        (F.lit(-1), F.concat(_step(bits, 0), _same_offset())),
    ]
    side_right = [
        side_left[0],
        (F.lit(1), F.concat(_step(bits, 0), _same_offset())),
        (F.lit(-1), F.concat(_step(bits, 1), _same_offset())),
    ]

    def spread(df: DataFrame, sides, names: Sequence[str], count: str, shift: int) -> DataFrame:
        ways = F.array(*[F.struct(d.alias("dir"), cells.alias("cells")) for d, cells in sides])
        rows = df.select(key, *names, "_n", "_slot", "_off", F.explode(ways).alias("_way"))
        rows = rows.select(key, *names, "_n", (F.col("_slot") + shift * F.col("_way.dir")).alias("_slot"),
                           F.col("_way.dir").alias("_dir"), F.explode("_way.cells").alias("_cell"))
        return rows.groupBy(key, "_slot", "_dir", "_cell", *names).agg(F.sum("_n").alias(count))

    a = spread(left, side_left, [tag], "_left_n", 1)
    b = spread(right, side_right, tags, "_right_n", 0)
    return a.hint("merge").join(b, [key, "_slot", "_dir", "_cell"]).where(F.col(tag) != F.col(tags[0]))


def near_pair_counts(left: DataFrame, right: DataFrame, key: str, time: str, tag: str, tags: Sequence[str], seconds: int) -> DataFrame:
    """For each (left ``tag``, right ``tags``): pairs with the same key, at most ``seconds`` apart, of
    different ``tag`` / ``tags[0]``. Columns: tag, tags, ``pairs``.

    Time slots as wide as the range make this an equi join on (key, slot); the right side is first cut to the slots in and
    beside those of the left side. Pairs are products of group counts and are never formed.
    """
    width = seconds * 1_000_000
    a = _slotted(left, key, time, [tag], width)
    around = a.select(key, _neighbours(F.col("_slot")).alias("_slot")).distinct()
    b = _slotted(right, key, time, tags, width).join(around.hint("merge"), [key, "_slot"], "left_semi")
    counted = _counted(a, b, key, tag, tags, width)
    return counted.groupBy(tag, *tags).agg(F.sum(F.col("_left_n") * F.col("_right_n")).alias("pairs"))
