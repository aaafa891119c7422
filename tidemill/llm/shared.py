"""Helpers of this subpackage: tables, kept results, folds, picked columns."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a temporary one only for a local session without it."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_shipped: set[str] = set()

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def _released(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``fn`` whose worker gives unused Arrow memory back when its partition is done; workers are reused and wait for more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        pa.default_memory_pool().release_unused()

    return run


def in_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow``; the modules of this subpackage are sent to the executors once per application.

    Batches of texts are at most 8 MB, a single longer row aside, where the session sets no limit of its own: a batch stands
    in the executor twice while it grows, and once more in the worker, for every task at work.
    """
    context, conf = df.sparkSession.sparkContext, df.sparkSession.conf
    if BATCH_BYTES not in conf.getAll:
        conf.set(BATCH_BYTES, "8m")
    if context.applicationId not in _shipped:
        here = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="llm-")) / "tidemill_llm.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for file in [here.parent / "__init__.py", *sorted(here.glob("*.py"))]:
                z.write(file, file.relative_to(here.parent.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return df.mapInArrow(_released(fn), schema)


def kept(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, its lineage cut there; survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under new names, so that extra or clashing columns never meet ours."""
    return df.select(*[df[f"`{old}`"].alias(new) for new, old in names.items()])


def fold(doc_id: Column) -> Column:
    """crc32 of the id's text modulo 4; 2 is held out from all fitting. NULL for a NULL id."""
    return F.crc32(doc_id.cast("string")) % 4


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``most`` bytes of text, at row limits; an Arrow batch may hold far more.

    The column is made non-null: NULL reads as the empty text.
    """
    for batch in batches:
        at = batch.schema.get_field_index(column)
        texts = batch.column(at).cast(pa.large_string()).fill_null("")
        batch = batch.set_column(at, column, texts)
        ends = pc.cumulative_sum(pc.binary_length(texts)).to_numpy(zero_copy_only=False)
        begin = 0
        while begin < batch.num_rows:
            done = int(ends[begin - 1]) if begin else 0
            end = max(begin + 1, int(ends.searchsorted(done + most, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def utf8(texts: pa.Array):
    """(bytes, offsets) of a slice of large strings, as numpy arrays; offsets begin at 0."""
    import numpy as np

    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]
