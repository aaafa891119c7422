"""Tables of fixed size over 64-bit numbers, which never grow with the data: bits that say "perhaps" or "surely not", and counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bit_table(numbers: DataFrame, column: str, log_bits: int) -> np.ndarray:
    """Bits set for the low ``log_bits`` bits of each number: at most 2**(log_bits-6) rows of 64 bits reach the driver."""
    low = F.col(column).bitwiseAND(F.lit((1 << log_bits) - 1))
    one = F.expr("shiftleft(1L, cast(place as int))")
    words = numbers.where(F.col(column).isNotNull()).select(F.shiftright(low, 6).alias("word"), low.bitwiseAND(F.lit(63)).alias("place")) \
        .groupBy("word").agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(1 << (log_bits - 6), np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def in_table(bits: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    low = numbers & np.uint64(len(bits) * 64 - 1)
    return (bits[low >> np.uint64(6)] >> (low & np.uint64(63))) & np.uint64(1) > 0


def id_number(doc_id: Column) -> Column:
    """An id spread over 64 bits."""
    return F.xxhash64(doc_id.cast("string"))


PARTS = 64


def packed(kind: int, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A table of counts as rows (kind, part, counts); parts without counts are left out. Most counts of a task are small or
    none, so the rows are compressed for the shuffle."""
    for part, block in enumerate(counts.reshape(PARTS, -1)):
        if block.any():
            yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int64()), pa.array([part], pa.int64()), pa.array([_pressed(block)], pa.binary())],
                                             ["kind", "part", "counts"])


def _pressed(counts: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(counts.astype("<i8").tobytes())


def _unpressed(counts: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(counts.as_buffer()), "<i8")


def _added(rows: pa.Table) -> pa.Table:
    total = sum(_unpressed(c) for c in rows.column("counts"))
    return pa.table({"kind": rows.column("kind")[:1], "part": rows.column("part")[:1], "counts": pa.array([_pressed(total)], pa.binary())})


PACKED = "kind long, part long, counts binary"


#: Tables are added in two turns, so that no task adds those of more than a 64th of all tasks, or more than 64.
LANES = 64


def added_in_turns(rows: DataFrame, keys: list[str], add, schema: str) -> DataFrame:
    """The packed rows of each value of ``keys`` added by ``add``, first those of every 64th task, then their sums."""
    first = rows.withColumn("lane", F.spark_partition_id() % LANES).groupBy(*keys, "lane").applyInArrow(add, schema)
    return first.groupBy(*keys).applyInArrow(add, schema)


def count_tables(rows: DataFrame, size: int) -> dict[int, np.ndarray]:
    """The sums, by kind, of the tables that tasks have packed: PARTS rows of fixed size for each kind reach the driver, in one job."""
    out: dict[int, np.ndarray] = {}
    for batch in added_in_turns(rows, ["kind", "part"], _added, PACKED).toArrow().to_batches():
        for kind, part, counts in zip(batch.column("kind").to_pylist(), batch.column("part").to_pylist(), batch.column("counts")):
            out.setdefault(kind, np.zeros((PARTS, size // PARTS), np.int64))[part] = _unpressed(counts)
    return {k: v.reshape(-1) for k, v in out.items()}
